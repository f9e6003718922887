"""Small captured pages of the job board with every element the extractors read."""

HOST = "jobs-example.sk"
SITE = f"https://www.{HOST}"

LISTING = """<body class="listing"><span class="offer-counter">1-20 z 20 345</span>
<div class="list-row native-agent"><h2><a href="/x/O99">Promoted</a></h2></div>
<div class="list-row">
 <a class="offer-company-logo-link" href="/praca/acme/C12345"><img src="/logo.png"></a>
 <h2><a href="/praca/acme/O1234567">Offer name</a></h2>
 <span class="employer">Acme</span><span class="job-location">Bratislava</span>
 <div class="label-group"><a data-dimension7="Salary label">901 - 1 231 EUR/mesiac</a><a>label</a><a> </a></div>
 <div class="list-footer"><span class="info"><strong>pred 4 minútami</strong> Pridané</span></div>
</div><div class="list-row"><h2><a>No link</a></h2></div></body>"""

DETAIL = """<div id="content"><div class="container"><span class="label">Label</span><div id="detail"><div class="card-content">
<h1 itemprop="title">T</h1><a class="easy-design-btn-offer-list" href="/e"></a><div class="easy-design-logo"><img src="l.png"></div>
<span class="salary-range">2 000 EUR/mesiac</span><span itemprop="employmentType">plný úväzok, živnosť</span>
<div class="panel-body"><div class="row"></div><div class="row"><div><span>Dohodou</span></div></div></div>
<span itemprop="jobLocation">L</span><span itemprop="datePosted">2023-04-22</span>
<div class="details-section"><span class="tel">+421</span><span class="tel"></span></div>
<div class="job-info"><h3 class="subtitle-line">Výhody</h3><h4>Náplň práce</h4><div>first</div>
 <h4>Zodpovednosti</h4><div>text <i class="text-gray">drop</i></div><h4>Benefity</h4><div>b</div><h4>Výhody</h4><div> </div></div>
<div class="job-requirements"><h4>Pozícii vyhovujú so vzdelaním</h4><div>VŠ</div><h4>Ostatné</h4></div>
<div class="overall-info"><div class="hidden-xs"><a href="/0">0</a><strong>Lokality</strong><a href="/l1">L1</a>
 <strong>Pozícia</strong><a href="p1">P1</a></div></div></div></div></div></div>"""

LINKS = """<ul class="nav-tabs"><li><a>Slovensko</a></li><li><a>Zahraničie</a></li></ul>
<div><h1>t</h1><div class="card"><a href="#a">A</a><a>none</a><div><a href="/praca/z/">Z</a><span>3</span></div>
<a href="/praca/r/"><h2>Region <span>7 966</span></h2></a><a href="/praca/s/">Same parent</a><span>5</span>
<div><a href="/praca/d/">District</a><span>12</span></div></div></div><div class="card"><a href="/out">out</a></div>"""

PARTNERS = """<ul class="nav-tabs"><li><a>Category 1</a></li></ul><div class="tab-content">
<div class="card"><div class="row"><div><img src="/l.png"></div><div><a href="http://p.example">Name</a> description</div></div></div>
<div class="card"><div class="row"><div></div><div><a href="http://q.example">Q</a></div></div></div></div>"""

ROWS = [
    (1, SITE + "/praca/?page_num=5", LISTING),
    (2, SITE + "/praca/acme/O1234567", DETAIL),
    (3, SITE + "/praca/zoznam-lokalit/", LINKS),
    (4, SITE + "/partneri", PARTNERS),
    (5, SITE, "x"),
    (6, SITE + "/praca/accenture/C3691", '<body class="listing custom-design">'),
    (7, "https://other.example.org/", ""),
    (8, SITE + "/praca/zoznam-lokalit?tab_index=1", LINKS),
]
