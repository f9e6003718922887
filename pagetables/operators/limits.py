"""Row limits, end of pagination and next pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.functions.urls import set_query_param
from pagetables.operators.listing import page_number
from pagetables.schemas import FRONTIER
from pagetables.sources.workspace import cut
from pagetables.spec import ROWS_PER_PAGE

_SPAN = 1000  # pages per running-sum block


def running_rows(pages: DataFrame) -> DataFrame:
    """Rows before each page of its listing: (listing, page_num, n, before, end_page).

    ``pages`` has one row per captured page: ``n`` rows to count, ``empty`` if the
    page showed none at all. ``end_page`` is the first empty page of the listing
    up to the end of this block.

    The running sum has two levels so that a listing with most of the pages is
    no single task's work: pages are summed in blocks of consecutive numbers,
    one window runs over the blocks and one over the pages of each block.
    """
    counts = pages.groupBy("listing", "page_num").agg(
        F.sum("n").cast("bigint").alias("n"), F.bool_and("empty").alias("empty")
    )
    counts = counts.withColumn("block", F.floor(F.col("page_num") / _SPAN))
    blocks = counts.groupBy("listing", "block").agg(
        F.sum("n").alias("rows"),
        F.min(F.when(F.col("empty"), F.col("page_num"))).alias("empty_at"),
    )
    by_block = Window.partitionBy("listing").orderBy("block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = blocks.select(
        "listing", "block",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before_block"),
        F.min("empty_at").over(so_far).alias("end_page"),
    )
    in_block = (
        Window.partitionBy("listing", "block").orderBy("page_num")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.join(blocks, ["listing", "block"]).select(
        "listing", "page_num", "n",
        (F.col("before_block") + F.coalesce(F.sum("n").over(in_block), F.lit(0))).alias("before"),
        "end_page",
    )


def run_rows(pages: DataFrame) -> DataFrame:
    """``running_rows`` with ``before`` counted over all listings of a run, in the order of their keys.

    Pages after a listing's end count nothing. The sum over listings is taken in ranges of listings side by side; what lies before
    each range is added from the ranges' totals, as many numbers as partitions, which a job right away finds.
    """
    placed = cut(running_rows(pages).filter(
        F.col("end_page").isNull() | (F.col("page_num") < F.col("end_page"))
    ), "running-rows")
    spark = placed.sparkSession
    sums = placed.groupBy(F.col("listing").alias("_listing")).agg(F.sum("n").alias("_rows"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(sums.repartitionByRange(parts, "_listing").withColumn("_part", F.spark_partition_id()), "listing-ranges")
    before, total = [], 0
    for r in sorted(ranged.groupBy("_part").agg(F.sum("_rows").alias("n")).collect()):
        before.append((r[0], total))
        total += r.n
    earlier = Window.partitionBy("_part").orderBy("_listing").rowsBetween(Window.unboundedPreceding, -1)
    ranges = F.broadcast(spark.createDataFrame(before, "_part int, _before bigint"))
    offsets = ranged.withColumn("_within", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).join(ranges, "_part").select(
        "_listing", (F.col("_before") + F.col("_within")).alias("_earlier")
    )
    return placed.join(offsets, F.col("listing") == F.col("_listing")).select(
        "listing", "page_num", "n", (F.col("before") + F.col("_earlier")).alias("before"), "end_page"
    )


def limit_rows(rows: DataFrame, limit: int, existing: int = 0) -> DataFrame:
    """The first ``limit`` less ``existing`` rows of a run, by listing, page_num and pos.

    Counts per page are summed up in two levels, so no task holds the kept rows. The input
    is read twice, so pass a written table.
    """
    counts = rows.groupBy("listing", "page_num").agg(F.count(F.lit(1)).alias("n"))
    left = F.lit(max(limit - existing, 0)) - F.col("before")
    quota = run_rows(counts.withColumn("empty", F.lit(False))).select(
        F.col("listing").alias("_listing"), F.col("page_num").alias("_page"),
        F.least(F.col("n"), left).alias("_keep"),
    ).filter("_keep > 0")
    nth = F.row_number().over(Window.partitionBy("listing", "page_num").orderBy("pos"))
    found = rows.join(quota, (F.col("listing") == F.col("_listing")) & (F.col("page_num") == F.col("_page")))
    return found.withColumn("_nth", nth).filter("_nth <= _keep").drop("_listing", "_page", "_keep", "_nth")


def page_quota(pages: DataFrame, limit: int | None = None, existing: int = 0,
               until_empty: bool = True) -> DataFrame:
    """How many rows to keep of each listing page: (listing, page_num, keep).

    Rows count in page order up to ``limit`` less ``existing`` rows; with
    ``until_empty`` a listing ends at its first page without rows.
    """
    placed = running_rows(pages)
    if until_empty:
        placed = placed.filter(
            F.col("end_page").isNull() | (F.col("page_num") < F.col("end_page"))
        )
    keep = F.col("n")
    if limit is not None:
        left = F.lit(max(limit - existing, 0)) - F.col("before")
        keep = F.least(keep, F.greatest(left, F.lit(0)))
    return placed.select("listing", "page_num", keep.cast("int").alias("keep")).filter("keep > 0")


def limit_entries(pages: DataFrame, limit: int | None = None, existing: int = 0,
                  until_empty: bool = True) -> DataFrame:
    """Cut the ``entries`` of listing pages to the quota. Row order is page order.

    Each listing page number must occur once (``latest_pages`` sees to it). The
    input is read twice, so pass a written or checkpointed table.
    """
    quota = page_quota(pages.select("listing", "page_num", "n", "empty"), limit, existing, until_empty)
    return (
        pages.join(quota, ["listing", "page_num"])
        .withColumn("entries", F.slice("entries", F.lit(1), F.col("keep")))
        .withColumn("n", F.col("keep"))
        .drop("keep")
    )


def next_page_url(url: Column) -> Column:
    """The same listing, one page on; a missing page number counts as 1."""
    return set_query_param(url, "page_num", page_number(url) + 1)


def next_pages(pages: DataFrame, limit: int | None = None, existing: int = 0,
               per_run: bool = False) -> DataFrame:
    """Frontier rows: the page after each captured page that had rows, until the limit.

    A page that uses the limit up asks for no further page. ``per_run``: the limit is one for all listings.
    """
    source = pages.filter(~F.col("empty"))
    if limit is not None:
        still_open = (run_rows if per_run else running_rows)(pages).filter(
            F.col("before") + F.col("n") < max(limit - existing, 0)
        )
        source = source.join(
            still_open.select("listing", "page_num"), ["listing", "page_num"], "left_semi"
        )
    return frontier(
        source,
        url=next_page_url(F.col("effective_url")),
        label="jobListing",
        page_num=F.col("page_num") + 1,
        parent=F.col("effective_url"),
        reason="next page",
    )


def announced_gaps(pages: DataFrame) -> DataFrame:
    """(listing, first, last): runs of page numbers that a listing's result counter announces and no page answers.

    A run is one row, however far a counter counts. Gaps are found between neighbours within blocks of page numbers, and between
    the ends of blocks, so that a listing with most of the pages is no single task's work.
    """
    last = (
        pages.filter(F.col("counter").isNotNull())
        .groupBy("listing")
        .agg(F.max("counter.total").alias("total"))
        .filter(F.col("total") > 0)
        .select("listing", F.ceil(F.col("total") / ROWS_PER_PAGE).cast("bigint").alias("last_page"))
    )
    seen = pages.filter(F.col("page_num") > 0).select("listing", "page_num", F.floor(F.col("page_num") / _SPAN).alias("block")).distinct()
    in_block = Window.partitionBy("listing", "block").orderBy("page_num")
    inner = seen.select("listing", (F.col("page_num") + 1).alias("first"), (F.lead("page_num").over(in_block) - 1).alias("last")).filter(F.col("last").isNotNull())
    ends = seen.groupBy("listing", "block").agg(F.min("page_num").alias("low"), F.max("page_num").alias("high"))
    by_block = Window.partitionBy("listing").orderBy("block")
    outer = ends.select(
        "listing", (F.coalesce(F.lag("high").over(by_block), F.lit(0)) + 1).alias("first"), (F.col("low") - 1).alias("last")
    )
    tops = ends.groupBy("listing").agg(F.max("high").alias("high"))
    tails = last.join(tops, "listing", "left").select("listing", (F.coalesce("high", F.lit(0)) + 1).alias("first"), "last_page")
    between = inner.unionByName(outer).join(last, "listing").select("listing", "first", F.least("last", "last_page").alias("last"))
    return between.unionByName(tails.withColumnRenamed("last_page", "last")).filter("first <= last")


def gap_pages(gaps: DataFrame) -> DataFrame:
    """Frontier rows for all pages of ``announced_gaps``, one each."""
    # numbers in base 1000, so that no counter, however wrong, asks for a huge array
    numbers = gaps.select("listing", "last", F.col("first").alias("k"))
    for step in (1_000_000, 1000, 1):
        left = F.floor((F.col("last") - F.col("k")) / step)
        here = left if step == 1_000_000 else F.least(left, F.lit(999))
        numbers = numbers.select(
            "listing", "last", F.col("k").alias("begin"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), here)).alias("i"),
        ).select("listing", "last", (F.col("begin") + F.col("i") * step).alias("k"))
    return frontier(
        numbers,
        url=set_query_param(F.col("listing"), "page_num", F.col("k")),
        label="jobListing",
        page_num=F.col("k"),
        parent=F.col("listing"),
        reason="announced page",
    )


def announced_pages(pages: DataFrame) -> DataFrame:
    """Frontier rows for the pages that a listing's result counter announces, less those that ``pages`` has."""
    return gap_pages(announced_gaps(pages))


def frontier(rows: DataFrame, url: Column, label: str, page_num: Column, parent: Column,
             reason: str) -> DataFrame:
    """Rows in the frontier schema."""
    values = {
        "url": url, "label": F.lit(label), "listing_page_num": page_num,
        "parent_url": parent, "reason": F.lit(reason),
    }
    return rows.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in FRONTIER])
