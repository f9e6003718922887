"""Which captures count, and where the work of it stands in the plan."""

import itertools

import pytest
from pyspark.sql import functions as F

import pages as T
from pagetables.operators import relational as R
from pagetables.params import RunParams
from pagetables.plans import datasets as P
from pagetables.sources.pages import captured
from pagetables.spec import job_board

SPEC = job_board(T.HOST)


def board(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, at string")
    return captured(df.withColumn("fetched_at", F.col("at").cast("timestamp")).drop("at"))


def card(k, name):
    return f'<div class="list-row"><h2><a href="/praca/acme/O{k}">{name}</a></h2></div>'


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


CAPTURES = [
    (1, "/praca/a/", card(100, "old"), "2024-05-01"), (2, "/praca/a/?page_num=1", card(100, "new"), "2024-05-02"),
    (3, "/praca/a/?page_num=2", card(102, "second"), None), (4, "/praca/b/", card(200, "b"), "2024-05-01"),
    (5, "/praca/b/", card(201, "b too"), "2024-05-01"), (6, "/praca/c/", card(300, "c"), "2024-05-03"),
    (6, "/praca/c/", card(300, "c"), "2024-05-03"), (None, "/praca/d/", card(400, "no id"), None), (7, "/praca/d/", card(400, "with id"), None),
]


@pytest.mark.parametrize("few", [200_000, 0], ids=["broadcast", "shuffled"])
def test_the_latest_capture_counts(spark, monkeypatch, few):
    monkeypatch.setattr(R, "_FEW", few)
    pages = board(spark, [(k, T.SITE + u, h, t) for k, u, h, t in CAPTURES])
    rows = P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers")).collect()
    assert sorted(r.offerName for r in rows) == ["b too", "c", "new", "second", "with id"]


def test_repeats_of_every_dataset_count_once(spark):
    rows = [(k, u, h, "2024-01-01") for k, u, h in T.ROWS]
    once, often = board(spark, rows), board(spark, rows * 3)
    for kind, detailed in (("jobOffers", False), ("jobOffers", True), ("locations", False), ("partners", False)):
        params = RunParams(dataset=kind, detailed=detailed)
        a, b = (sorted(str(r) for r in P.run_dataset(p, SPEC, params).drop("metadata").collect()) for p in (once, often))
        assert a == b


def test_parsing_comes_after_choosing(spark):
    rows = [(k, T.SITE + u, h, t) for k, u, h, t in CAPTURES[:5]]
    plan = plan_of(P.run_dataset(board(spark, rows), SPEC, RunParams(dataset="jobOffers")))
    # plans print from the result down to the scan
    assert plan.count("ArrowEvalPython") == 1 and plan.index("ArrowEvalPython") < plan.index("BroadcastHashJoin")
    assert "Exchange hashpartitioning" not in plan
    single = plan_of(P.run_dataset(board(spark, rows[1:4]), SPEC, RunParams(dataset="jobOffers")))
    assert "Exchange" not in single and "Join" not in single


def test_entries_are_extracted_once(spark):
    plan = plan_of(P.run_dataset(board(spark, [(1, T.SITE + "/praca/a/", card(1, "x"), None)]), SPEC, RunParams(dataset="jobOffers")))
    assert plan.count("native-agent") == 1  # the test of a card, in one projection


def test_one_page_in_most_captures(spark):
    hot = [(k, T.SITE + "/praca/hot/", card(k, f"n{k}"), "2024-05-01") for k in range(1, 600)]
    rest = [(1000 + k, f"{T.SITE}/praca/l{k}/", card(5000 + k, f"m{k}"), "2024-05-01") for k in range(300)]
    rows = P.run_dataset(board(spark, hot + rest).repartition(8), SPEC, RunParams(dataset="jobOffers")).collect()
    assert sorted(r.offerName for r in rows) == sorted(["n599", *[f"m{k}" for k in range(300)]])


def test_merge_leaves_wide_rows_alone(spark):
    """Lone detail pages are found on keys: the parsed pages meet the cards in one join, and no copy of them is written."""
    pages = board(spark, [(k, u, h, None) for k, u, h in [*T.ROWS, (60, T.SITE + "/praca/acme/O7777777", T.DETAIL)]])
    rows = P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers", detailed=True))
    assert plan_of(rows).count("ArrowEvalPython") == 1
    assert sorted(r.offerId for r in rows.collect()) == ["O1234567", "O7777777"]


@pytest.mark.parametrize("how, want", [("listing", 2), ("both", 3), ("detail", 3)])
def test_merge_forms_agree(spark, how, want):
    base = [(60, T.SITE + "/praca/acme/O7777777", T.DETAIL, None), (2, T.SITE + "/praca/acme/O1234567", T.DETAIL, None)]
    listing = [(k, f"{T.SITE}/praca/l{k}/", T.LISTING, None) for k in (10, 11)]
    pages = board(spark, base + listing)
    params = RunParams(dataset="jobOffers", detailed=True)
    cards, details = P.offer_cards(pages, SPEC, params), P.offer_details(pages, SPEC, params)
    found = [
        sorted(map(str, R.merge_listing_detail(cards, details, how, keys=keys, unique=unique).collect()))
        for keys, unique in itertools.product((None, P.detail_keys(pages, SPEC)), (False, True))
    ]
    assert all(f == found[0] for f in found) and len(found[0]) == want
