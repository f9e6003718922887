import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetables.functions import arrays as A
from pagetables.functions import text as X
from pagetables.functions import urls as U


def values(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema).coalesce(1)
    return [r.asDict(recursive=True) for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]


SALARIES = [
    ("2 000 EUR/mesiac", 2000, None, "eur", "month"),
    ("Od 6,5 EUR/hod.", 6, None, "eur", "hour"),
    ("901 - 1 231 EUR/mesiac", 901, 1231, "eur", "month"),
    ("35 000 - 45 000 Kč/mesiac", 35000, 45000, "kč", "month"),
    ("6.5 - 7.5 EUR/hod", 6, 7, "eur", "hour"),
    ("6.5 EUR/hod", None, None, None, None),
    ("Od 1 000 - 1500 EUR/mesiac", None, None, None, None),
    ("900 EUR/týždeň", 900, None, "eur", "t"),
    ("1 000 EUR/mesiac", 1, None, "000 eur", "month"),
    (", EUR/hod", None, None, "eur", "hour"),
    ("Dohodou", None, None, None, None),
    ("\x01odd", None, None, None, None),
    ("", None, None, None, None),
    (None, None, None, None, None),
]


def test_salary_texts(spark):
    got = values(spark, [(s[0],) for s in SALARIES], "t string", pay=X.parse_salary(F.col("t")))
    for row, (text, lower, upper, currency, period) in zip(got, SALARIES):
        assert row["pay"] == {
            "salaryRange": text or None, "salaryRangeLower": lower, "salaryRangeUpper": upper,
            "salaryCurrency": currency, "salaryPeriod": period,
        }, text


def test_salary_with_no_break_space_read_as_blank(spark):
    got = values(spark, [("1 000 EUR/mesiac",)], "t string",
                 pay=X.parse_salary(F.col("t"), normalize_space=True))
    assert got[0]["pay"]["salaryRangeLower"] == 1000
    assert got[0]["pay"]["salaryCurrency"] == "eur"


@pytest.mark.parametrize("text, options, want", [
    ("20 345", dict(mode="int", remove_whitespace=True), 20345),
    ("20 345", dict(mode="int"), 20),
    ("12abc", dict(mode="int"), 12),
    ("abc", dict(mode="int"), None),
    ("", dict(mode="int"), None),
    ("", dict(mode="int", allow_empty=True), None),
    ("-7", dict(mode="int"), -7),
    ("0x1F", dict(mode="int"), 31),
    ("99999999999999999999", dict(mode="int"), None),
    ("1.234,5", dict(separator=r"\.", decimal=","), 1234.5),
    ("1.5e3x", dict(), 1500.0),
    (".5", dict(), 0.5),
    ("5.", dict(), 5.0),
    (None, dict(), None),
])
def test_numbers(spark, text, options, want):
    assert values(spark, [(text,)], "t string", n=X.str_as_number(F.col("t"), **options)) == [{"n": want}]


def test_result_count(spark):
    rows = [("1-20 z 20 345",), ("7 z 7",), ("x",), ("",), (None,)]
    got = [r["c"] for r in values(spark, rows, "t string", c=X.result_count(F.col("t")))]
    assert got[0] == {"total": 20345, "lowerPageEnd": 1, "upperPageEnd": 20}
    assert got[1] == {"total": 7, "lowerPageEnd": 7, "upperPageEnd": None}
    assert got[2] == {"total": 0, "lowerPageEnd": 0, "upperPageEnd": None}
    assert got[3] is None and got[4] is None


def test_codes_and_change_types(spark):
    rows = [("plný úväzok, živnosť", "Pridané"), ("Plný úväzok", "iné"), (None, None)]
    got = values(spark, rows, "a string, b string",
                 codes=X.codes_in_text(F.col("a"), {"fte": "plný úväzok", "self": "živnosť"}),
                 change=X.last_change_type(F.col("b"), "pridané"),
                 period=X.default_salary_period(F.length("a") * 10))
    assert [g["codes"] for g in got] == [["fte", "self"], [], []]
    assert [g["change"] for g in got] == ["added", "modified", "modified"]
    assert [g["period"] for g in got[:2]] == ["month", "month"]


def test_sorted_urls_keep_order_of_repeats(spark):
    rows = [("http://A.com?b=1&a=2&b=0",), ("https://x.sk/p?%C3%A9=1&[]=q r#t",), ("https://x.sk/p?",), ("nope",)]
    got = values(spark, rows, "u string", s=U.sort_url(F.col("u")), k=U.url_key(F.col("u")))
    assert [g["s"] for g in got] == [
        "http://a.com/?a=2&b=1&b=0", "https://x.sk/p?%5B%5D=q+r&%C3%A9=1#t", "https://x.sk/p", None,
    ]
    assert got[1]["k"] == "https://x.sk/p?%5B%5D=q+r&%C3%A9=1"


def test_query_parameters(spark):
    u = F.col("u")
    rows = [("https://x.sk/p?b=1&a=%25&b=2#t",)]
    got = values(spark, rows, "u string", one=U.set_query_param(u, "b", F.lit("n w")),
                 new=U.set_query_params(u, {"c": F.lit(5), "a": F.lit("z")}),
                 b=U.get_query_param(u, "b"), none=U.get_query_param(u, "q"),
                 dropped=U.drop_query_param(u, "b"), path=U.resolve_url_path(u, F.lit("zz")))[0]
    assert got == {
        "one": "https://x.sk/p?b=n+w&a=%25#t", "new": "https://x.sk/p?b=1&a=z&b=2&c=5#t", "b": "1",
        "none": None, "dropped": "https://x.sk/p?a=%25#t", "path": "https://x.sk/zz?b=1&a=%25&b=2#t",
    }


@pytest.mark.parametrize("ref, want", [
    ("k", "https://x.sk/a/k"), ("/k", "https://x.sk/k"), ("../k?x=1", "https://x.sk/k?x=1"),
    ("./", "https://x.sk/a/"), ("../../../k", "https://x.sk/k"), ("?n=2", "https://x.sk/a/b?n=2"),
    ("#f", "https://x.sk/a/b?q=1#f"), ("", "https://x.sk/a/b?q=1"), ("//h.sk/z", "https://h.sk/z"),
    ("mailto:a@b.sk", "mailto:a@b.sk"), ("http://o.sk", "http://o.sk"), (None, None),
])
def test_resolved_links(spark, ref, want):
    rows = [("https://X.sk/a/b?q=1#top", ref)]
    assert values(spark, rows, "u string, r string", x=U.resolve_url(F.col("u"), F.col("r"))) == [{"x": want}]


def test_links_can_keep_the_page_query(spark):
    got = values(spark, [("https://x.sk/praca/?page_num=5",)], "u string",
                 a=U.resolve_url(F.col("u"), F.lit("/praca/c/O1"), True),
                 b=U.resolve_url(F.col("u"), F.lit("/p?x=1"), True))
    assert got == [{"a": "https://x.sk/praca/c/O1?page_num=5", "b": "https://x.sk/p?x=1"}]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("ab&=%é +", max_size=4), st.text("01?#/", max_size=3)), max_size=5))
def test_sorting_twice_changes_nothing(spark, params):
    url = "https://x.sk/p?" + "&".join(f"{k}={v.replace('#', '')}" for k, v in params)
    once = U.sort_url(F.col("u"))
    got = values(spark, [(url,)], "u string", once=once, twice=U.sort_url(once))[0]
    assert got["once"] is not None and got["once"] == got["twice"]


def test_pairs_and_headings(spark):
    rows = [(["H1", "a", "b", "H2", "c"],), (["x", "H1"],), ([],)]
    got = values(
        spark, rows, "xs array<string>", p=A.pairs(F.col("xs")),
        h=A.fill_headings(F.col("xs"), lambda x: x.startswith("H"), lambda x: F.lower(x),
                          lambda x, h: F.concat_ws(":", h, x)),
    )
    assert got[0]["p"] == [{"first": "H1", "second": "a"}, {"first": "b", "second": "H2"}, {"first": "c", "second": None}]
    assert [g["h"] for g in got] == [["h1:H1", "h1:a", "h1:b", "h2:H2", "h2:c"], ["x", "h1:H1"], []]
    assert got[2]["p"] == []
