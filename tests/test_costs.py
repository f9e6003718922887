"""What a page and a task cost: tags read once, URLs cut without patterns, tasks that grow, state written side by side."""

import glob
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions import shred as S
from pagetables.functions import text as X
from pagetables.functions import urls as U
from pagetables.functions.arrays import let
from pagetables.streaming.state import KeyedState
from workload import captures as C


def test_tags_that_repeat_are_read_once(monkeypatch):
    pages = pa.array(['<div class="a b" id="c"><a href="/x">t</a></div>' * 50, '<DIV class="a b"><a href=\'/x\'></DIV>'] * 20)
    calls = []
    read = S._attributes
    monkeypatch.setattr(S, "_attributes", lambda found: calls.append(found) or read(found))
    found = S.shred_batch(pages)
    # the two plain tags and <DIV ...> once, the one in single quotes on each of its pages
    assert len(calls) == 3 + 20
    monkeypatch.setattr(S, "_KNOWN", 0)
    assert S.shred_batch(pages).equals(found)


@pytest.mark.parametrize("page", [
    '<a b="x>" c="y">t</a><a b="x>', '<a b="x>y</a><a b="x>y</a>" c>z', '<p>1<p>2</p></p><P>3', "<a =\"><a =\">\"x", "</html></body><html></html>t",
    "<i></b></i><!-- <i> --><i>", "<li><li></li></ul>", "<br></br><br>", "<" * 200 + ">", "<title><b></title><b></b>",
])
def test_remembered_tags_change_no_page(page, monkeypatch):
    pages = pa.array([page, page + page, "<div>" + page + "</div>" + page])
    found = S.shred_batch(pages)
    monkeypatch.setattr(S, "_KNOWN", 0)
    assert S.shred_batch(pages).equals(found)


def test_remembered_tags_are_bounded():
    known = {}
    columns = S._Columns(known)
    columns.add_page("".join(f'<a href="/{k}">' for k in range(3 * S._KNOWN)))
    assert len(known) == S._KNOWN and max(map(len, known)) <= S._SHORT


def test_let_maps_no_array(spark):
    rows = spark.range(3).select(let(F.col("id") + 1, lambda x: F.struct(x.alias("a"), (x * x).alias("b"))).alias("s"))
    assert [tuple(r.s) for r in rows.orderBy("s").collect()] == [(1, 1), (2, 4), (3, 9)]
    assert "transform(" not in rows._jdf.queryExecution().analyzed().toString()
    assert spark.range(1).select(let(F.lit(None).cast("int"), lambda x: F.coalesce(x, F.lit(7)))).first()[0] == 7


URLS = [
    "HTTPS://Www.X.sk:443/a/b?x=1&a=2#f?g", "http://x.sk", "http://x.sk?", "http://x.sk#", "http://x.sk/?q#", "http://x.sk:80?a//b", "http://x.sk:/p",
    "http://", "http:///p", "ftp://u:p@x:21/a;b", "http://x.sk/a b?c d#e f", " http://x.sk/a", "http://x.sk/č?ž#š", "http://x.sk/a\n", "http://x.sk/a#b\n",
    "http://x.sk/a#b\nc", "x.sk/a", "//x.sk/a", "mailto:a@b", "", "1http://x", "a+b-c.d://h/p", "http://x.sk/a://b?c://d", None,
]


def test_urls_are_cut_as_the_pattern_cuts_them(spark):
    rows = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "k int, u string")
    u = F.col("u")
    groups = [F.regexp_extract(u, U._URL, k) for k in range(1, 6)]
    asked = F.when(u.rlike(U._URL), F.struct(
        F.lower(groups[0]).alias("scheme"), F.lower(groups[1]).alias("host"),
        F.when(groups[2] == "", "/").otherwise(groups[2]).alias("path"), groups[3].alias("query"), groups[4].alias("fragment"),
    ))
    for r in rows.select("u", U.split_url(u).alias("got"), asked.alias("asked")).collect():
        assert r.got == r.asked, r.u
    plain = [u for u in URLS if u and re.fullmatch(r"[a-zA-Z][a-zA-Z0-9+.-]*://[!-~]*", u)]
    cut = spark.createDataFrame([(u,) for u in plain], "u string")
    # by marks alone
    assert cut.filter(F.col("u").rlike(U._PLAIN)).count() == len(plain) > 10


@pytest.mark.parametrize("ref, found", [
    ("/a/b", "http://x.sk/a/b"), ("/", "http://x.sk/"), ("/a.b", "http://x.sk/a.b"), ("/a/../b", "http://x.sk/b"), ("/.a", "http://x.sk/.a"),
    ("/a?b", "http://x.sk/a?b"), ("//h/p", "http://h/p"), (" /a ", "http://x.sk/a"), ("b", "http://x.sk/p/b"), (None, None), ("", "http://x.sk/p/q?r"),
])
def test_links_resolve(spark, ref, found):
    rows = spark.createDataFrame([("http://x.sk:80/p/q?r#s", ref)], "base string, ref string")
    assert rows.select(U.resolve_url(F.col("base"), F.col("ref"))).first()[0] == found


@pytest.mark.parametrize("shown, asked", [
    ("1 200 EUR/mesiac", (1200, None, "eur", "month")), ("900 - 1 100,5 Kč/hod", (900, 1100, "kč", "hour")), ("5 EUR/hod - x", (5, None, "eur", "hour")),
    ("5-6/hod", (None, None, None, None)), ("-5 EUR/hod", (None, None, None, None)), ("Od 5 EUR", (None, None, None, None)), ("5 EUR/a-b/c", (5, None, "eur", "a")),
    ("1 - 2 EUR", (None, None, None, None)), ("/", (None, None, None, None)), ("\x011 EUR/hod", None),
])
def test_salaries(spark, shown, asked):
    pay = spark.createDataFrame([(shown,)], "t string").select(X.parse_salary(F.col("t")).alias("p")).first().p
    if asked is not None:
        assert (pay.salaryRangeLower, pay.salaryRangeUpper, pay.salaryCurrency, pay.salaryPeriod) == asked
    assert pay.salaryRange == shown


def test_tasks_grow_with_the_table():
    assert [C.task_count(n, 4000) for n in (0, 1, 4000, 25000, 256000)] == [1, 1, 1, 7, 64]
    assert C.task_count(900_000, 4000) == 64
    assert C.task_count(54_000_000, 4000) == 54_000_000 // (4000 * C.FULL_TASK)


def test_state_is_written_by_many_tasks(spark, tmp_path):
    state = KeyedState(f"{tmp_path}/s", T.StructType([T.StructField("k", T.LongType())]))
    state.put(spark.range(3000).select(F.col("id").alias("k")), F.col("k"), 0)
    files = glob.glob(f"{tmp_path}/s/bucket=*/batch_id=0/*.parquet")
    assert len(files) == 256
    assert len({re.search(r"part-(\d+)", f)[1] for f in files}) == 8
    assert sorted(r.k for r in state.every(spark).collect()) == list(range(3000))
