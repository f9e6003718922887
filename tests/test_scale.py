"""What keeps tasks small when the tables grow: pages per task, elements per batch, tests per page."""

import glob
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagetables.functions.shred import shred_batch, shred_batches
from workload import captures as C, queries as Q


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Some tables with rows of their own; customers and orders refer to each other."""
    root = str(tmp_path_factory.mktemp("sf"))
    n = F.col("id")
    tables = {
        "region": spark.range(2).select(n.cast("int").alias("r_regionkey"), F.concat(F.lit("R"), n).alias("r_name")),
        "nation": spark.range(4).select(
            n.cast("int").alias("n_nationkey"), F.concat(F.lit("N"), n).alias("n_name"), (n % 2).cast("int").alias("n_regionkey")
        ),
        "customer": spark.range(2500).select(
            n.alias("c_custkey"), F.concat(F.lit("Customer "), n).alias("c_name"), (n % 4).cast("int").alias("c_nationkey"),
            (n - 100.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
        ),
        "orders": spark.range(25000).select(
            n.alias("o_orderkey"), (n % 2500).alias("o_custkey"), F.when(n % 3 == 0, "F").otherwise("O").alias("o_orderstatus"),
            (n * 10.0).alias("o_totalprice"), F.lit("2024-01-01").cast("timestamp").alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority"),
        ),
        "part": spark.range(3500).select(
            n.alias("p_partkey"), F.lit("part").alias("p_name"), F.lit("brand").alias("p_brand"), F.lit("SMALL").alias("p_type"),
            F.lit(3).alias("p_size"), F.lit(1.0).alias("p_retailprice"),
        ),
        "supplier": spark.range(70).select(
            n.alias("s_suppkey"), F.lit("s").alias("s_name"), (n % 4).cast("int").alias("s_nationkey"), F.lit(0.0).alias("s_acctbal")
        ),
    }
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def test_parser_hands_pages_back_by_elements():
    draw = random.Random(3)
    pages = [None if draw.random() < 0.1 else "<p>a<b>c</b>" * draw.randrange(40) for _ in range(500)]
    batches = list(shred_batches(iter([pa.array(pages[:300], pa.string()), pa.array(pages[300:], pa.string())]), 200))
    whole = shred_batch(pa.array(pages, pa.string()))
    assert sum(map(len, batches)) == len(pages)
    assert [p for b in batches for p in b.to_pylist()] == whole.to_pylist()
    # one page has no more than 2 * 40 elements and the root
    assert max(len(b.flatten()) for b in batches) < 200 + 81


def test_parser_with_no_pages():
    assert list(shred_batches(iter([]))) == []
    assert len(shred_batch(pa.array([], pa.string()))) == 0


def test_parser_in_spark_keeps_pages_with_their_rows(spark):
    from pagetables.functions.shred import shred_html

    rows = spark.range(3000, numPartitions=1).select("id", F.concat(F.lit("<i>"), F.lit("<p>x" * 30), F.lit("<u>"), "id").alias("html"))
    back = rows.withColumn("nodes", shred_html(F.col("html"))).select("id", F.element_at("nodes", -1)["text"].alias("t"))
    assert back.filter(F.col("id").cast("string") != F.col("t")).count() == 0 and back.count() == 3000


@pytest.mark.parametrize("pages, parts", [
    (C.part_detail_pages, 4), (C.customer_detail_pages, 3), (C.company_profiles, 1), (C.order_detail_pages, 7),
    (C.listing_pages, 3), (C.location_pages, 3), (C.company_listings, 3),
])
def test_pages_are_shared_out_by_rows(spark, sf, pages, parts):
    assert pages(spark, sf).rdd.getNumPartitions() == parts


@pytest.mark.parametrize("pages", [
    C.listing_pages, C.location_pages, C.company_pages, C.partner_pages, C.company_listings,
])
def test_url_filters_are_tested_per_page(spark, sf, pages):
    asked = pages(spark, sf).filter(F.col("url").rlike("page_num=[0-9]*7|blok=[0-9]*7"))
    lines = asked._jdf.queryExecution().optimizedPlan().toString().splitlines()
    test = [k for k, line in enumerate(lines) if "RLIKE" in line]
    assert test and max(test) < min(k for k, line in enumerate(lines) if "Aggregate" in line)


def test_filter_urls_are_shared_out(spark, sf, monkeypatch):
    monkeypatch.setattr(C, "TASK_ROWS", 500)
    assert Q.q18b_filter_urls(spark, sf).rdd.getNumPartitions() == 5


def test_arrivals_are_written_by_many_tasks(spark, sf, monkeypatch):
    """Three arrivals, each of several files and still one micro-batch."""
    bases = []
    workspace = Q.workspace

    def known(session, name):
        bases.append(workspace(session, name))
        return bases[-1]

    monkeypatch.setattr(Q, "workspace", known)
    rows = Q.q26b_late_captures(spark, sf)
    assert rows.count() == 25000
    assert len(glob.glob(f"{bases[0]}/in/*.parquet")) == 9
    assert len(glob.glob(f"{bases[0]}/out/jobOffers/batch_id=*")) == 3


def test_ingested_pages_are_written_by_many_tasks(spark, sf, monkeypatch):
    """The location pages have three tasks, profiles and partners one each."""
    bases = []
    workspace = Q.workspace

    def known(session, name):
        bases.append(workspace(session, name))
        return bases[-1]

    monkeypatch.setattr(Q, "workspace", known)
    assert Q.q26_ingest(spark, sf).count() == 3
    assert len(glob.glob(f"{bases[0]}/in/*.parquet")) == 5
