import itertools
import random

import pytest
from pyspark.sql import functions as F

import pages as T
from pagetables.operators import limits as Lim
from pagetables.operators import relational as R
from pagetables.operators import listing as Li
from pagetables.operators import routing as Ro
from pagetables.sources.pages import captured
from pagetables.spec import job_board

SPEC = job_board(T.HOST)


def brute_quota(pages, limit, existing, until_empty):
    kept = {}
    for listing, group in itertools.groupby(sorted(pages), key=lambda p: p[0]):
        left = None if limit is None else max(limit - existing, 0)
        for _, number, n, empty in group:
            if until_empty and empty:
                break
            take = n if left is None else min(n, left)
            if left is not None:
                left -= take
            if take:
                kept[listing, number] = take
    return kept


@pytest.mark.parametrize("limit, existing, until_empty", [
    (None, 0, True), (50, 0, True), (20, 0, True), (40, 5, False), (3000, 0, True), (5, 9, True),
])
def test_quota_equals_counting_one_by_one(spark, limit, existing, until_empty):
    rng = random.Random(7)
    pages = []
    for listing, most in (("hot", 4500), ("a", 3), ("b", 1200)):
        for number in sorted(rng.sample(range(1, most * 2), most)):
            n = rng.choice([0, 1, 20])
            pages.append((listing, number, n, n == 0 and rng.random() < 0.002))
    df = spark.createDataFrame(pages, "listing string, page_num long, n int, empty boolean")
    got = {(r.listing, r.page_num): r.keep for r in Lim.page_quota(df, limit, existing, until_empty).collect()}
    assert got == brute_quota(pages, limit, existing, until_empty)


def test_next_pages_stop_at_the_limit(spark):
    rows = [("l", i, 20, False, f"{T.SITE}/praca/?page_num={i}") for i in (1, 2, 3)]
    df = spark.createDataFrame(rows, "listing string, page_num long, n int, empty boolean, effective_url string")
    got = {r.listing_page_num for r in Lim.next_pages(df, limit=40).collect()}
    assert got == {2}
    assert {r.listing_page_num for r in Lim.next_pages(df).collect()} == {2, 3, 4}


def test_announced_pages_of_large_counters(spark):
    rows = [("https://a.sk/", 20 * 2345), ("https://b.sk/", 1), ("https://c.sk/", 0)]
    df = spark.createDataFrame(rows, "listing string, total long").select(
        "listing", F.struct("total").alias("counter"))
    nothing = df.withColumn("page_num", F.lit(0).cast("bigint"))
    got = Lim.announced_pages(nothing)
    counts = {r.parent_url: (r.n, r.lo, r.hi) for r in got.groupBy("parent_url").agg(
        F.countDistinct("listing_page_num").alias("n"), F.min("listing_page_num").alias("lo"),
        F.max("listing_page_num").alias("hi")).collect()}
    assert counts == {"https://a.sk/": (2345, 1, 2345), "https://b.sk/": (1, 1, 1)}
    assert got.count() == 2346


def test_gaps_between_captured_pages(spark):
    rng = random.Random(3)
    pages, want = [], []
    for listing, total, most in (("https://h.sk/", 10 ** 11, 4200), ("https://s.sk/", 410, 30), ("https://n.sk/", None, 5), ("https://one.sk/", 20, 1)):
        seen = sorted(rng.sample(range(1, 2 * most + 1), most))
        pages += [(listing, k, total if k % 2 or most == 1 else None) for k in seen]
        if total is None or not any(k % 2 or most == 1 for k in seen):
            continue
        last, ends = -(-total // 20), [0, *[k for k in seen], None]
        for a, b in zip(ends, ends[1:]):
            lo, hi = a + 1, min(last, (b if b else last + 1) - 1)
            if lo <= hi:
                want.append((listing, lo, hi))
    df = spark.createDataFrame(pages, "listing string, page_num long, total long").select(
        "listing", "page_num", F.when(F.col("total").isNotNull(), F.struct("total")).alias("counter"))
    got = Lim.announced_gaps(df)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert max(r["last"] for r in got.collect()) == 5 * 10 ** 9  # one row for billions of pages


def test_run_rows_sum_up_in_ranges(spark):
    rng = random.Random(9)
    pages = [(f"l{k:04d}", n, rng.choice([0, 5, 20]), False) for k in range(600) for n in range(1, rng.randint(2, 5))]
    df = spark.createDataFrame(pages, "listing string, page_num long, n int, empty boolean")
    got = Lim.run_rows(df)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    before, want = 0, {}
    for listing, number, n, _ in sorted(pages):
        want[listing, number] = before
        before += n
    assert {(r.listing, r.page_num): r.before for r in got.collect()} == want


def test_only_new_with_repeats_and_missing_keys(spark):
    fresh = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 5), (None, 4), ("c", 6)], "k string, v int")
    prior = spark.createDataFrame([("c", 0), ("c", 1)], "k string, v int")
    got = {tuple(r) for r in R.only_new(fresh, prior, ("k",), order=("v",)).collect()}
    # rows without a key can't be told apart and stay
    assert got == {("a", 1), ("b", 3), (None, 4), (None, 5)}
    with_null = prior.unionByName(spark.createDataFrame([(None, 9)], prior.schema))
    assert {tuple(r) for r in R.only_new(fresh, with_null, ("k",), order=("v",)).collect()} == got


def offers(spark, cards, details):
    from pagetables.schemas import OFFER_DETAILED, OFFER_SIMPLE, PAGES

    info = [f for f in PAGES if f.name != "html"]

    def frame(rows, schema):
        df = spark.createDataFrame(rows, "page_id long, url string, offerUrl string, lastChangeType string")
        page = F.struct(*[(F.col(f.name) if f.name in ("page_id", "url") else F.lit(None)).cast(f.dataType).alias(f.name) for f in info])
        return df.select(page.alias("page"), *[
            (F.col(f.name) if f.name in ("offerUrl", "lastChangeType") else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema])

    return frame(cards, OFFER_SIMPLE), frame(details, OFFER_DETAILED)


def test_merge_multiplies_by_cards_only(spark):
    u = T.SITE + "/praca/c/O11"
    cards = [(1, "l", u, "added"), (2, "l", u + "?#x", "modified"), (3, "l", None, "added"), (4, "l", u + "9", "added")]
    details = [(10, u, u, None), (11, u, u, None), (12, u + "5", u + "5", None)]
    listing, detail = offers(spark, cards, details)
    got = R.merge_listing_detail(listing, detail).collect()
    assert sorted((r.page.page_id, r.offerUrl, r.lastChangeType) for r in got) == [(1, u, "added"), (2, u + "?#x", "modified")]
    got = R.merge_listing_detail(listing, detail, "detail").collect()
    assert sorted((r.page.page_id, r.offerUrl, r.lastChangeType or "") for r in got) == [
        (11, u, "added"), (11, u, "modified"), (12, u + "5", "")]


def test_popular_offer_is_split(spark):
    u = T.SITE + "/praca/c/O11"
    cards = [(i, "l", u if i % 3 else f"{u}{i}", "added") for i in range(60000)]
    listing, detail = offers(spark, cards, [(1, u, u, None)] + [(i, f"{u}{i}", f"{u}{i}", None) for i in range(0, 300, 3)])
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        merged = R.merge_listing_detail(listing.repartition(8), detail)
        assert merged.count() == 40000 + 100
        merged.write.format("noop").mode("overwrite").save()
        rows = merged.collect()
        assert len(rows) == 40100
        assert "skew=true" in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_pages_are_parsed_once_and_selectors_do_not_shuffle(spark):
    df = captured(spark.createDataFrame(T.ROWS, "page_id long, url string, html string"))
    pages = Li.explode_entries(Li.listing_pages(Ro.routed_dom(df, SPEC, "jobListing"), SPEC))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan


def test_url_filters_reach_below_the_parser(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame(T.ROWS, "page_id long, url string, html string").write.parquet(path)
    df = captured(spark.read.parquet(path))
    plan = Ro.routed_dom(df, SPEC, "partners")._jdf.queryExecution().executedPlan().toString()
    parser, scan = plan.index("ArrowEvalPython"), plan.index("FileScan")
    assert "RLIKE" in plan[parser:scan]
    wanted = R.frontier_gap(
        Lim.frontier(df, F.col("effective_url"), "x", F.lit(1), F.lit(None), "r"), df)
    assert "html" not in wanted._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split(">")[0]
