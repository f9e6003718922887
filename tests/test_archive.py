"""The archive of loads, and the ledger that readers go by."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pagetables.params import RunParams
from pagetables.plans import datasets as P
from pagetables.schemas import PAGES
from pagetables.sources import arrivals as A
from pagetables.sources import ledger as Led
from pagetables.sources.pages import captured
from pagetables.sources.workspace import workspace
from pagetables.spec import DATASET_KINDS, job_board
from tests.pages import DETAIL, HOST, ROWS, SITE

SPEC = job_board(HOST)


def pages_of(spark, rows):
    return captured(spark.createDataFrame(rows, "page_id long, url string, html string"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/pages/**/*.parquet", recursive=True)}


@pytest.fixture
def archive(spark):
    root = workspace(spark, "archive")
    A.append_load(pages_of(spark, ROWS[:4]), [SPEC], root, "one")
    return root


def test_a_second_crawl_appends(spark, archive):
    before = files(archive)
    entry = A.append_load(pages_of(spark, ROWS[4:]), [SPEC], archive, "two")
    assert (entry.rows, entry.left_out, entry.number) == (3, 1, 1)
    after = files(archive)
    assert before.items() <= after.items() and len(after) > len(before)
    assert A.read_loads(spark, SPEC, archive).count() == 7
    assert A.read_loads(spark, SPEC, archive, ("one",)).count() == 4


def test_a_repeated_load_replaces_its_first_run(spark, archive):
    A.append_load(pages_of(spark, ROWS[:2]), [SPEC], archive, "one")
    assert sorted(r.page.page_id for r in A.read_loads(spark, SPEC, archive).collect()) == [1, 2]
    assert [tuple(r) for r in A.loads_of(spark, archive).collect()] == [("one", 2, 2, 0)]


def test_an_unfinished_load_is_not_seen(spark, archive):
    pages_of(spark, ROWS).select("page", "effective_url", "html").write.parquet(f"{archive}/pages/load_version=x/host={HOST}/route=jobListing/list_kind=none")
    assert A.read_loads(spark, SPEC, archive).count() == 4
    with pytest.raises(ValueError):
        A.read_loads(spark, SPEC, archive, ("three",))


def test_sites_are_told_apart(spark):
    root, other = workspace(spark, "sites"), job_board("other.example.org")
    rows = ROWS[:2] + [(9, "https://www.other.example.org/praca/x/O12", DETAIL)]
    A.append_load(pages_of(spark, rows), [SPEC, other], root, "all")
    assert [r.page.page_id for r in A.read_loads(spark, other, root).collect()] == [9]
    assert A.read_loads(spark, SPEC, workspace(spark, "none")).count() == 0


@pytest.mark.parametrize("kind", DATASET_KINDS)
def test_datasets_read_their_own_partitions(spark, archive, kind):
    A.append_load(pages_of(spark, ROWS[4:]), [SPEC], archive, "two")
    rows = P.run_dataset(A.read_loads(spark, SPEC, archive), SPEC, RunParams(dataset=kind))
    assert rows.count() >= 0
    filters = [line for line in plan_of(rows).splitlines() if "PartitionFilters" in line]
    assert filters and all("host" in f and "load_version" in f and "route" in f.split("PartitionFilters")[1].split("PushedFilters")[0] for f in filters)


def test_one_routed_folder_is_read_per_dataset(spark, archive):
    pages = A.read_loads(spark, SPEC, archive).filter(F.col("route") == "partners")
    assert {r.f.split("/route=")[1].split("/")[0] for r in pages.select(F.input_file_name().alias("f")).collect()} == {"partners"}


def test_fan_out_of_an_archive_equals_fan_out_of_pages(spark, archive):
    lone = [(50, f"{SITE}/praca/acme/O7777777", DETAIL), (51, f"{SITE}/praca/acme/O8888888", DETAIL)]
    A.append_load(pages_of(spark, ROWS[4:] + lone), [SPEC], archive, "two")
    both = [P.fan_out(p, SPEC, RunParams(dataset="jobOffers")) for p in (A.read_loads(spark, SPEC, archive), pages_of(spark, ROWS + lone))]
    for kind in DATASET_KINDS:
        a, b = (sorted(str(r) for r in x[kind].drop("metadata").collect()) for x in both)
        assert a == b
    offers = {r.offerId for r in both[0]["jobOffers"].collect()}
    assert {"O7777777", "O8888888"} <= offers


def test_published_versions(spark):
    root = workspace(spark, "published")
    assert Led.published(spark, root) is None
    Led.publish(spark.range(3), root)
    reader = Led.published(spark, root)
    Led.publish(spark.range(10), root)
    # a reader keeps its version while the next one is written and named
    assert reader.count() == 3 and Led.published(spark, root).count() == 10
    spark.range(99).write.parquet(f"{root}/all/version=unnamed")
    assert Led.published(spark, root).count() == 10
    Led.publish(spark.range(5), root)
    assert len(Led.retire(spark, root, keep=2)) == 1
    assert Led.published(spark, root).count() == 5 and os.path.isdir(f"{root}/all/version=unnamed")
    assert Led.finished(spark, root)["all"].number == 3


def test_captured_columns(spark):
    assert [f.name for f in A.CAPTURED["page"].dataType] == [f.name for f in PAGES if f.name != "html"]
