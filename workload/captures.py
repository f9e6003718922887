"""Captured pages of a job board, derived from the given tables with Spark.

Every table row ends up in some page and every page holds a bounded number of
rows (consecutive keys), so the work grows with the tables and no group does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOST = "jobs-example.sk"
SITE = f"https://www.{HOST}"
PER_PAGE = 20  # cards on a listing page
PER_LISTING = 2000  # orders in one listing: 100 pages
PER_LIST = 50  # links on a list page
TASK_PAGES = 1000  # detail pages or profiles of one row that a task makes
TASK_ROWS = 10000  # rows that a task puts into pages of many
MANY_TASKS = 64  # as many tasks as keep a cluster busy; from there on they grow
FULL_TASK = 5  # times the rows, at most: a task's fixed cost is that of some hundred pages or more
FILES = 100  # at most, of one arrival: as many as a micro-batch takes by default


def table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.repartition(partitions) if partitions else rows


def tasks(spark: SparkSession, sf_dir: str, name: str, rows: int) -> int:
    """How many tasks share a table out at ``rows`` rows each.

    A row of a table is small, the page made of it and the work on the page are not: sized by bytes, as scans and adaptive
    execution do, a few tasks would have all pages. A table's rows are counted from its footers. Every task reads the plan with all its
    expressions and starts a parser, so those of a table that has work for many hold more rows each.
    """
    return task_count(table(spark, sf_dir, name).count(), rows)


def task_count(total: int, rows: int) -> int:
    """Tasks for ``total`` rows: ``rows`` each up to ``MANY_TASKS`` tasks, then up to ``FULL_TASK`` times as many."""
    some = max(1, -(-total // rows))
    return min(some, max(MANY_TASKS, -(-total // (rows * FULL_TASK))))


def gathered(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Bring the rows of a page together before their HTML is written, in ``parts`` tasks.

    The groupings that follow use this partitioning.
    """
    return df.repartition(parts, *keys)


def shown(*keys: str) -> list[Column]:
    """The keys of a grouping as aggregates under their own names.

    A page's URL is made of these. Of the keys themselves, Spark would move each filter on the URL below the grouping and so test
    URLs once per row and not once per page, in the few tasks of the scan.
    """
    return [F.max(k).alias(f"shown_{k}") for k in keys]


def text(*parts: Column | str) -> Column:
    """Concatenate columns and literal text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def spaced(number: Column) -> Column:
    """12345 -> "12 345"."""
    return F.translate(F.format_number(number, 0), ",", " ")


def block(key: str, size: int) -> Column:
    """Number of the run of ``size`` consecutive keys a key falls into."""
    return F.floor(F.col(key) / size).cast("bigint")


def joined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))


def salary_text() -> Column:
    low = F.floor(F.col("o_totalprice") / 100)
    return (
        F.when(F.col("o_orderstatus") == "F", text(spaced(low), " EUR/mesiac"))
        .when(
            F.col("o_orderstatus") == "O",
            text(spaced(low), " - ", spaced(low + 500), " Kč/mesiac"),
        )
        .otherwise("Dohodou")
    )


def offer_path() -> Column:
    return text("/praca/c", F.col("o_custkey"), "/O", F.col("o_orderkey") + 1000000)


def card_html() -> Column:
    """One offer card; urgent orders are promoted cards, one segment has no logo."""
    promoted = F.when(F.col("o_orderpriority") == "1-URGENT", " native-agent").otherwise("")
    logo = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(
        text('<a class="offer-company-logo-link" href="/praca/c', F.col("o_custkey"), "/C",
             F.col("o_custkey") + 1000, '"><img src="/logo/', F.col("o_custkey"), '.png"></a>')
    )
    second = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority"))
    change = F.when(F.col("o_orderstatus") == "F", " Pridané").otherwise(" Upravené")
    return text(
        '<div class="list-row', promoted, '">', logo,
        '<h2><a href="', offer_path(), '">Order ', F.col("o_orderkey"), " &amp; co</a></h2>",
        '<span class="employer">', F.col("c_name"), '</span><span class="job-location"> ',
        F.col("n_name"), ' </span><div class="label-group"><a data-dimension7="Salary label">',
        salary_text(), "</a><a>", F.col("c_mktsegment"), "</a><a>", second,
        '</a></div><div class="list-footer"><span class="info"><strong>pred ',
        F.col("c_nationkey"), " dňami</strong>", change, "</span></div></div>",
    )


def listing_pages(spark: SparkSession, sf_dir: str, empty_from: int | None = None) -> DataFrame:
    """Listing pages of 20 orders each; from ``empty_from`` on pages show no cards."""
    orders = joined_orders(spark, sf_dir).withColumns({
        "listing": block("o_orderkey", PER_LISTING),
        "page_num": block("o_orderkey", PER_PAGE) % (PER_LISTING // PER_PAGE) + 1,
    })
    orders = gathered(orders, tasks(spark, sf_dir, "orders", TASK_ROWS), "listing", "page_num")
    pages = orders.select("listing", "page_num", "o_orderkey", card_html().alias("card")).groupBy(
        "listing", "page_num"
    ).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("o_orderkey", "card"))), lambda c: c["card"]
            ),
            "\n",
        ).alias("cards"),
        *shown("listing", "page_num"),
    ).select("cards", F.col("shown_listing").alias("listing"), F.col("shown_page_num").alias("page_num"))
    cards = F.col("cards")
    if empty_from is not None:
        cards = F.when(F.col("page_num") < empty_from, cards).otherwise("")
    page_id = F.col("listing") * 1000 + F.col("page_num")
    counter = text(
        '<span class="offer-counter">', (F.col("page_num") - 1) * PER_PAGE + 1, "-",
        F.col("page_num") * PER_PAGE, " z ", spaced(F.lit(PER_LISTING)), "</span>",
    )
    return pages.select(
        page_id.alias("page_id"),
        text(SITE, "/praca/blok-", F.col("listing"), "/?page_num=", F.col("page_num")).alias("url"),
        text('<body class="listing">', counter, cards, "</body>").alias("html"),
    )


def order_detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages of all orders but the pending ones. They name no employer."""
    orders = joined_orders(spark, sf_dir).filter(F.col("o_orderstatus") != "P").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    ).repartition(tasks(spark, sf_dir, "orders", TASK_PAGES * 4))
    contract = F.when(F.col("o_orderstatus") == "F", "plný úväzok, živnosť").otherwise(
        "skrátený úväzok"
    )
    return orders.select(
        (F.col("o_orderkey") + 100000000000).alias("page_id"),
        text(SITE, offer_path()).alias("url"),
        text(
            '<div id="content"><div class="container"><span class="label">',
            F.col("o_orderpriority"),
            '</span><div id="detail"><div class="card-content"><h1 itemprop="title">Detail ',
            F.col("o_orderkey"), '</h1><span class="salary-range">', salary_text(),
            '</span><span itemprop="employmentType">', contract,
            '</span><span itemprop="datePosted">', F.date_format("o_orderdate", "yyyy-MM-dd"),
            "</span></div></div></div></div>",
        ).alias("html"),
    )


def part_detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full detail pages, one per part."""
    p = table(spark, sf_dir, "part", tasks(spark, sf_dir, "part", TASK_PAGES))
    contract = (
        F.when(F.col("p_type") == "ECONOMY", "plný úväzok")
        .when(F.col("p_type") == "STANDARD", "živnosť, plný úväzok")
        .when(F.col("p_type") == "SMALL", "Plný úväzok")
        .when(F.col("p_type") == "PROMO", "na dohodu (brigády), internship, stáž")
        .otherwise("skrátený úväzok")
    )
    return p.select(
        F.col("p_partkey").alias("page_id"),
        text(SITE, "/praca/p/O", F.col("p_partkey") + 1000, "?s=", F.col("p_size")).alias("url"),
        text(
            '<html><body><div id="content"><div class="container"><span class="label">',
            F.upper("p_type"), '</span><span class="label"> </span><div id="detail">',
            '<div class="card-content"><h1 itemprop="title"> ', F.col("p_name"),
            ' </h1><span itemprop="hiringOrganization">', F.col("p_brand"),
            '</span><a class="easy-design-btn-offer-list" href="../f', F.col("p_size"),
            '"></a><div class="easy-design-logo"><img src="//cdn.example.org/',
            F.col("p_partkey"), '.png"></div><span itemprop="employmentType">', contract,
            '</span><div class="panel-body"><div class="row"><div><span>skip</span></div></div>',
            '<div class="row"><div><i>od</i> <span>', F.col("p_size"), ".5.2023</span></div>",
            "<div><span>other</span></div></div></div>",
            '<span itemprop="jobLocation">Sklad ', F.col("p_size"), "</span>",
            '<div class="details-section"><span class="tel">+421', F.col("p_partkey"),
            '</span><span class="tel"></span><span class="tel">+420</span></div>',
            '<div class="job-info"><h3 class="subtitle-line">Náplň práce</h3>',
            "<h4>Náplň práce</h4><div>first</div><h4>Právomoci a Benefity</h4><div>",
            F.col("p_name"), ' <i class="text-gray">note</i>&quot;x&quot;</div></div>',
            '<div class="job-requirements"><h3 class="subtitle-line">R</h3>',
            "<h4>Pozícii vyhovujú uchádzači so vzdelaním</h4><div>", F.col("p_type"),
            "</div><h4>Ostatné</h4></div>",
            '<div class="company-info"><h4>Počet zamestnancov</h4><div>', F.col("p_size"),
            " - ", F.col("p_size") + 10, "</div><h4>Kontakt</h4><div>Meno<br>", F.col("p_brand"),
            "</div></div></div></div></div></div></body></html>",
        ).alias("html"),
    )


def customer_detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages whose info block lists location and profession links."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.repartition(tasks(spark, sf_dir, "customer", TASK_PAGES))
    return c.select(
        F.col("c_custkey").alias("page_id"),
        text(SITE, "/praca/k/O", F.col("c_custkey") + 1000).alias("url"),
        text(
            '<div id="content"><div class="container"><div id="detail"><div class="card-content">',
            '<div class="overall-info"><div class="hidden-xs"><a href="/x">before</a>',
            '<strong>Lokality</strong><a href="/praca/n', F.col("n_nationkey"), '/">',
            F.col("n_name"), '</a><span>,</span><a href="r', F.col("r_regionkey"), '">',
            F.col("r_name"), "</a><strong>Pozícia</strong>",
            '<a href="?m=1">', F.col("c_mktsegment"), "</a>",
            "<strong>Pozícia a lokalita</strong><a>", F.col("c_name"),
            '</a><strong>Iné</strong><a href="/y">after</a>',
            "</div></div></div></div></div></div>",
        ).alias("html"),
    )


def location_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location lists: per run of 50 orders, one tab with the filled orders and one
    with the others. Priorities are headings, orders are links."""
    orders = table(spark, sf_dir, "orders").select(
        block("o_orderkey", PER_LIST).alias("blok"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("tab"),
        F.col("o_orderpriority").alias("prio"), "o_orderkey",
        text(
            '<div><a href="/praca/o', F.col("o_orderkey"), '/">Order ', F.col("o_orderkey"),
            "</a><span>", spaced(F.floor("o_totalprice")), "</span></div>",
        ).alias("link"),
    )
    groups = gathered(orders, tasks(spark, sf_dir, "orders", TASK_ROWS), "blok").groupBy("blok", "tab", "prio").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("o_orderkey", "link"))).alias("links"),
    )
    section = text(
        '<a href="/praca/', F.lower(F.translate("prio", " ", "-")), '/"><h2>', F.col("prio"),
        " <span>", F.col("n"), "</span></h2></a>",
        F.array_join(F.transform("links", lambda x: x["link"]), ""),
    )
    pages = groups.select("blok", "tab", "prio", section.alias("section")).groupBy("blok", "tab").agg(
        F.array_sort(F.collect_list(F.struct("prio", "section"))).alias("sections"), *shown("blok", "tab")
    ).select("sections", F.col("shown_blok").alias("blok"), F.col("shown_tab").alias("tab"))
    return pages.select(
        (F.col("blok") * 10 + F.col("tab")).alias("page_id"),
        text(SITE, "/praca/zoznam-lokalit/?blok=", F.col("blok"), "&tab_index=", F.col("tab")).alias("url"),
        text(
            '<ul class="nav-tabs"><li><a>Slovensko</a></li><li><a> </a></li><li><a>Zahraničie</a></li></ul>',
            '<div><h1>Lokality</h1><div class="card"><a href="#a">A</a>',
            '<div><a href="/praca/vsetko/">All</a></div>',
            F.array_join(F.transform("sections", lambda s: s["section"]), ""),
            "</div></div>",
        ).alias("html"),
    )


def location_entry_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list pages themselves, as captured before any tab was opened."""
    entry = F.regexp_replace("url", r"&tab_index=\d+$", "").alias("url")
    first = F.min_by(F.struct("page_id", "html"), "page_id").alias("first")
    return location_pages(spark, sf_dir).groupBy(entry).agg(first).select(
        (F.col("first.page_id") + 50000000000).alias("page_id"), "url", "first.html"
    )


def company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company lists of 50 customers without headings or tabs."""
    c = table(spark, sf_dir, "customer")
    links = c.select(
        block("c_custkey", PER_LIST).alias("blok"), "c_custkey",
        text(
            '<li><a href="/praca/c/C', F.col("c_custkey"), '">', F.col("c_name"), "</a> <span>",
            F.col("c_nationkey"), "</span></li>",
        ).alias("link"),
    )
    pages = gathered(links, tasks(spark, sf_dir, "customer", TASK_ROWS), "blok").groupBy("blok").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "link"))).alias("links"), *shown("blok")).select(
        "links", F.col("shown_blok").alias("blok")
    )
    return pages.select(
        (F.col("blok") + 20000000000).alias("page_id"),
        text(SITE, "/praca/zoznam-spolocnosti?blok=", F.col("blok")).alias("url"),
        text(
            '<div><h1>Spoločnosti</h1><ul class="card">',
            F.array_join(F.transform("links", lambda x: x["link"]), ""), "</ul></div>",
        ).alias("html"),
    )


def partner_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partner pages of 50 suppliers, one card per region, the last card without a tab."""
    nation = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = s.select(
        block("s_suppkey", PER_LIST).alias("blok"), F.col("n_regionkey").alias("region"), "s_suppkey",
        text(
            '<div class="row"><div><img src="/l', F.col("s_suppkey"), '.png"></div><div>',
            '<a href="http://p', F.col("s_suppkey"), '.example.org/">', F.col("s_name"), "</a> from ",
            F.col("n_name"), "</div></div>",
        ).alias("row"),
    )
    cards = gathered(rows, tasks(spark, sf_dir, "supplier", TASK_ROWS), "blok").groupBy("blok", "region").agg(
        F.array_sort(F.collect_list(F.struct("s_suppkey", "row"))).alias("rows")
    ).select(
        "blok", "region",
        text('<div class="card">', F.array_join(F.transform("rows", lambda r: r["row"]), ""), "</div>").alias("card"),
    )
    pages = cards.groupBy("blok").agg(
        F.array_sort(F.collect_list(F.struct("region", "card"))).alias("cards"), *shown("blok")
    ).select("cards", F.col("shown_blok").alias("blok"))
    tabs = F.transform(
        F.slice("cards", F.lit(1), F.size("cards") - 1),
        lambda c: text("<li><a>Region ", c["region"], "</a></li>"),
    )
    return pages.select(
        (F.col("blok") + 30000000000).alias("page_id"),
        text(SITE, "/partneri/?blok=", F.col("blok")).alias("url"),
        text(
            '<ul class="nav-tabs">', F.array_join(tabs, ""), '</ul><div class="tab-content">',
            F.array_join(F.transform("cards", lambda c: c["card"]), ""), "</div>",
        ).alias("html"),
    )


def company_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One company page per customer; those with a negative balance use a custom design."""
    design = F.when(F.col("c_acctbal") < 0, " custom-design").otherwise("")
    return table(spark, sf_dir, "customer", tasks(spark, sf_dir, "customer", TASK_PAGES * 4)).select(
        (F.col("c_custkey") + 40000000000).alias("page_id"),
        text(SITE, "/praca/c/C", F.col("c_custkey") + 100).alias("url"),
        text('<html><body class="listing', design, '"><p>', F.col("c_name"), "</body>").alias("html"),
    )


def company_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company pages that list the customer's orders, at most 20 keys apart; customers with a negative balance use a custom design."""
    design = F.when(F.col("c_acctbal") < 0, " custom-design").otherwise("")
    orders = joined_orders(spark, sf_dir).withColumn("page_num", block("o_orderkey", PER_PAGE))
    orders = orders.withColumn("design", design)
    pages = gathered(orders, tasks(spark, sf_dir, "orders", TASK_ROWS), "o_custkey", "page_num").groupBy("o_custkey", "page_num", "design").agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("o_orderkey", card_html().alias("card")))), lambda c: c["card"]
        ), "").alias("cards"),
        *shown("o_custkey", "page_num", "design"),
    ).select("cards", *[F.col(f"shown_{k}").alias(k) for k in ("o_custkey", "page_num", "design")])
    return pages.select(
        (F.col("o_custkey") * 10000000 + F.col("page_num")).alias("page_id"),
        text(SITE, "/praca/c/C", F.col("o_custkey") + 100, "?page_num=", F.col("page_num")).alias("url"),
        text('<html><body class="listing', F.col("design"), '">', F.col("cards"), "</body>").alias("html"),
    )


def counter_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last listing page of each customer, with a result counter.

    The counted results are the customer's orders times 137; customers of one
    segment have an unreadable total, customers without orders no counter.
    """
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.count(F.lit(1)) * 137).alias("total"))
    c = table(spark, sf_dir, "customer").join(
        orders, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    last = F.ceil(F.coalesce("total", F.lit(1)) / PER_PAGE)
    pages = c.select("*", F.explode(F.array_distinct(F.array(F.lit(1).cast("bigint"), last))).alias("k"))
    shown = F.when(F.col("c_mktsegment") == "MACHINERY", "veľa").otherwise(spaced(F.col("total")))
    counter = F.coalesce(
        text('<p class="offer-counter">', (F.col("k") - 1) * PER_PAGE + 1, "-", F.col("k") * PER_PAGE,
             " z ", F.when(F.col("total").isNotNull(), shown), "</p>"),
        F.lit(""),
    )
    return pages.select(
        (F.col("c_custkey") * 100000 + F.col("k")).alias("page_id"),
        text(SITE, "/praca/zakaznik-", F.col("c_custkey"), "/?page_num=", F.col("k")).alias("url"),
        text('<body class="listing">', counter, "</body>").alias("html"),
    )


def site_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of every route, from all orders, customers, suppliers, parts and pages."""
    def urls(name: str, *parts: Column | str) -> DataFrame:
        return table(spark, sf_dir, name).select(text(*parts).alias("url"))

    found = table(spark, sf_dir, "pages").select("url")
    for more in (
        urls("orders", SITE, "/praca/acme/O", F.col("o_orderkey")),
        urls("customer", "http://", HOST.upper(), "/praca/x/C", F.col("c_custkey")),
        urls("customer", SITE, "/praca/?company_id=", F.col("c_custkey"), "&utm=1"),
        urls("supplier", SITE, "/praca/zoznam-lokalit/?p=", F.col("s_suppkey")),
        urls("supplier", SITE, "/praca/zoznam-pozicii#", F.col("s_suppkey")),
        urls("supplier", SITE, "/praca/zoznam-ine-veci~", F.col("s_suppkey")),
        urls("supplier", SITE, "/partneri/?p=", F.col("s_suppkey")),
        urls("supplier", SITE, "/?p=", F.col("s_suppkey")),
        urls("supplier", SITE, "/praca#", F.col("s_suppkey")),
        urls("part", SITE, "/praca/", F.translate("p_name", " ", "-"), "/?page_num=", F.col("p_size")),
        urls("part", "https://not", HOST, "/praca/", F.col("p_partkey")),
    ):
        found = found.unionByName(more)
    return found
