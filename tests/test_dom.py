import time

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetables.functions.arrays import outermost
from pagetables.functions.dom import Dom
from pagetables.functions.shred import shred_batch, shred_html

PAGE = """<!doctype html><html lang=sk><head><title>A &amp; B</title><script>var t="</p>";</script></head>
<body class="listing  main"><div id=top><p>one<p>two <b>bold</div><ul class="nav"><li>A<li>B<ul><li>C</ul><li>D</ul>
<div class="row"><div>1</div><div data-k="v w">2 <span>x</span> y</div></div><!-- no --><a href="#a">z</a>&nbsp;</body>"""


def find(spark, html, **columns):
    df = spark.createDataFrame([(html,)], "html string").select(shred_html(F.col("html")).alias("nodes"))
    return df.select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


@pytest.mark.parametrize("selector, texts", [
    ("p", ["one", "two bold"]), ("#top p", ["one", "two bold"]), ("ul.nav > li", ["A", "BC", "D"]),
    ("ul ul li", ["C"]), ("li:nth-child(2)", ["BC"]), ("body.listing:not(.custom-design) title", []),
    ("body.listing.main #top > p:nth-child(1)", ["one"]), ('[data-k="v w"]', ["2 x y"]),
    (".row > div:nth-child(2) span", ["x"]), (".row div:not([data-k])", ["1"]),
    ("head title", ["A & B"]), ("body.custom-design", []), ("A[href]", ["z"]), (".row > span", []),
])
def test_selectors(spark, selector, texts):
    dom = Dom("nodes")
    assert find(spark, PAGE, t=dom.texts(dom.find_all(selector)))["t"] == texts


def test_text_without_parts_and_relations(spark):
    dom = Dom("nodes")
    cell = dom.find('[data-k="v w"]')
    got = find(
        spark, PAGE, rest=dom.text(cell, without=F.array(dom.find("span", cell))),
        nothing=dom.text(cell, without=F.array(dom.find("em", cell))),
        lower=dom.text_lower(dom.find("title")), missing=dom.text(dom.find("h6")),
        kids=F.size(dom.children(dom.find(".row"))), up=dom.attr(dom.parent(dom.find("html")), "lang"),
        lang=dom.attr(dom.find("html"), "lang"), script=dom.text(dom.find("script")),
    )
    assert got == {"rest": "2  y", "nothing": "2 x y", "lower": "a & b", "missing": None, "kids": 2,
                   "up": None, "lang": "sk", "script": None}


def test_missing_page_has_no_elements(spark):
    dom = Dom("nodes")
    assert find(spark, None, n=F.size("nodes"), t=dom.text(dom.root()), l=dom.texts(dom.find_all("p"))) == {
        "n": 0, "t": None, "l": []}


def test_unknown_selector_is_refused():
    with pytest.raises(ValueError):
        Dom(None).find_all("a + b")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([
    "<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "<td>", "<table>", "</table>",
    "<br/>", "x", "&amp;", "<", "<!--", "-->", "<script>", "</script>", "<a href='", "'>", "</a>", "<h1>", "</h2>",
])))
def test_elements_nest(pieces):
    nodes = shred_batch(pa.array(["".join(pieces)]))[0].as_py()
    assert [n["id"] for n in nodes] == list(range(len(nodes)))
    seen = {}
    for n in nodes:
        assert n["id"] <= n["last"] < len(nodes)
        if n["id"]:
            parent = nodes[n["parent"]]
            assert parent["id"] < n["id"] and n["last"] <= parent["last"]
            seen[parent["id"]] = seen.get(parent["id"], 0) + 1
            assert n["nth"] == seen[parent["id"]]


CARDS = """<div class="list-row"><h2><a href="/x/O{0}">Name {0}</a></h2><span class="employer">E{0}</span>
<div class="list-footer"><span class="info"><strong>now</strong> x</span></div></div>"""


@pytest.mark.parametrize("depth", [5, 600, 5000])
def test_depth_changes_nothing(spark, depth):
    html = "<body class=listing>" + "<div class=d>" * depth + "".join(CARDS.format(k) for k in range(3)) + "<i>end</i>"
    dom = Dom("nodes")
    card = dom.find(".list-row:nth-child(2)")
    got = find(
        spark, html, names=dom.texts(dom.find_all("body.listing .list-row h2 > a")), deep=dom.texts(dom.find_all(".d .info strong")),
        own=dom.text(dom.find("body .d h2 a", card)), boxed=dom.texts(Dom("nodes", box=card).find_all(".d .employer")),
        end=dom.text(dom.find(".d > i")), whole=F.md5(dom.raw_text(dom.root())), nested=F.size(dom.find_all(".d .d")),
        none=F.size(dom.find_all("i .employer")),
    )
    whole = got.pop("whole")
    assert whole == find(spark, html.replace("<div class=d>", ""), w=F.md5(dom.raw_text(dom.root())))["w"]
    assert got == {"names": ["Name 0", "Name 1", "Name 2"], "deep": ["now"] * 3, "own": "Name 1", "boxed": ["E1"], "end": "end", "nested": depth - 1, "none": 0}


def test_a_megabyte_of_nested_elements_is_read_in_linear_time(spark):
    def seconds(count):
        began = time.perf_counter()
        nodes = shred_batch(pa.array(["<p>" + "<div>" * count + "x<b>y"]))[0]
        assert len(nodes) == count + 3
        return time.perf_counter() - began

    seconds(2_000)
    small, large = min(seconds(20_000) for _ in range(3)), min(seconds(200_000) for _ in range(2))
    assert large < 40 * small
    dom = Dom("nodes")
    assert find(spark, "<div>" * 200_000 + "x<b>y", t=dom.text(dom.find("div div > div b")))["t"] == "y"


def test_selectors_inside_many_elements(spark):
    """Scoped, plain and box forms agree; the spans are found once."""
    html = "<ul class=a><li>" + "<div class=row><em><u>1</u></em><u>2</u></div>" * 700 + "</ul><div class=row><u>3</u></div>"
    dom = Dom("nodes")

    def texts(d):
        return F.transform(d.find_all(".row"), lambda r: F.array_join(d.texts(d.find_all(".a .row u", r)), "+"))

    got = find(spark, html, scoped=dom.scoped([".a .row u"], texts), page=dom.texts(dom.find_all(".a .row u")))
    assert got["scoped"] == ["1+2"] * 700 + [""] and got["page"] == ["1", "2"] * 700


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=60), min_size=1, max_size=4))
def test_outermost_spans(spark, depths):
    """Against a plain sweep, on pages of nested and lined up elements; also in pieces."""
    pages, want = [], []
    for steps in depths:
        html = "".join("<s>" if k else "</s>" for k in steps)
        nodes = [n for n in shred_batch(pa.array([html]))[0].as_py() if n["tag"] == "s"]
        pages.append((html,))
        want.append([n["id"] for n in nodes if not any(o["id"] < n["id"] <= o["last"] for o in nodes)])
    df = spark.createDataFrame(pages, "html string").select(shred_html(F.col("html")).alias("nodes"))
    spans = F.transform(F.filter("nodes", lambda n: n["tag"] == "s"), lambda n: F.struct(n["id"].alias("id"), n["last"].alias("last")))
    assert [r.ids for r in df.select(F.transform(outermost(spans), lambda x: x["id"]).alias("ids")).collect()] == want


def test_many_spans_are_swept_in_pieces(spark):
    html = "".join("<s><s></s></s>" if k % 3 == 0 else "<s></s>" for k in range(3000))
    dom = Dom("nodes")
    got = find(spark, f"<div>{html}</div><s><b>x</b></s>", n=F.size(dom._spans((("s",),))), b=dom.texts(dom.find_all("s b")), s=F.size(dom.find_all("s s")))
    assert got == {"n": 3001, "b": ["x"], "s": 1000}
