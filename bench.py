"""Time the headline queries; prints one JSON line.

Captured pages are built and written before the clock starts. Queries over them warm up on a few pages; each
query runs twice, and the better run counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.operators import detail as D
from pagetables.operators import routing as Ro
from pagetables.params import RunParams
from pagetables.plans.datasets import run_dataset
from pagetables.session import builder
from pagetables.sources.pages import read_pages
from workload import captures as C
from workload import queries as registered

RUNS = 2
OFFERS = RunParams(dataset="jobOffers")

#: Captured pages by name, and the queries over them.
FIXTURES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "listing": C.listing_pages,
    "listing_and_detail": lambda s, d: C.listing_pages(s, d).unionByName(C.order_detail_pages(s, d)),
    "part_detail": C.part_detail_pages,
    "locations": C.location_pages,
}
OVER_PAGES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "q10_listing": ("listing", lambda p: run_dataset(p, registered.SPEC, OFFERS)),
    "q11_detail": ("part_detail", lambda p: D.job_details(Ro.routed_dom(p, registered.SPEC, "jobDetail"), registered.SPEC)),
    "q13_locations": ("locations", lambda p: run_dataset(p, registered.SPEC, RunParams(dataset="locations"))),
    "q17_max_entries": ("listing", lambda p: run_dataset(p, registered.SPEC, RunParams(dataset="jobOffers", max_entries=5000))),
    "q20_merge": ("listing_and_detail", lambda p: run_dataset(p, registered.SPEC, RunParams(dataset="jobOffers", detailed=True))),
    "q25_salary_by_location": ("listing", lambda p: run_dataset(p, registered.SPEC, OFFERS).groupBy("location").agg(F.avg("salaryRangeLower").alias("pay"))),
}
OVER_TABLES = ("q07_page_text", "q08_nav_links", "q09_salaries", "q26_ingest")


def seconds(run: Callable[[], DataFrame]) -> tuple[float, int]:
    """The time of one run, and its rows."""
    began = time.time()
    df = run()
    observed = df.agg(F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct("*")))))  # every column is made
    rows = observed.first()[0]
    return time.time() - began, rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = (
        builder("pagetables-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    fixtures, pages = {}, {}
    for name, build in FIXTURES.items():
        began = time.time()
        build(spark, sf_dir).repartition(int(cpus)).write.parquet(f"{shared}/{name}")
        pages[name] = spark.read.parquet(f"{shared}/{name}").count()
        fixtures[name] = round(time.time() - began, 3)
    runs = {q: (f, lambda f=f, fn=fn: fn(read_pages(spark, f"{shared}/{f}"))) for q, (f, fn) in OVER_PAGES.items()}
    runs |= {q: (None, lambda q=q: registered.queries()[q](spark, sf_dir)) for q in OVER_TABLES}
    timed, rates = {}, {}
    for name, (fixture, run) in sorted(runs.items()):
        if fixture:
            seconds(lambda: OVER_PAGES[name][1](read_pages(spark, f"{shared}/{fixture}").limit(50)))
        took, rows = min(seconds(run) for _ in range(RUNS))
        timed[name] = round(took, 3)
        rates[name] = {"rows": rows, "rows_per_s": round(rows / took, 1)}
        if fixture:
            rates[name]["pages_per_s"] = round(pages[fixture] / took, 1)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rates": rates, "fixtures": fixtures,
    }))


if __name__ == "__main__":
    main()
