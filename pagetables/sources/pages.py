"""Reading captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.schemas import PAGES


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet",
               partitions: int | None = None) -> DataFrame:
    """Captured pages from files, with missing columns as NULL.

    Parsing costs much more than reading; ``partitions`` deals out the pages of a few small
    files anew, by a shuffle. Without it the scan's own splits stay.
    """
    pages = spark.read.schema(PAGES).format(fmt).load(path)
    return captured(pages.repartition(partitions) if partitions else pages)


def captured(df: DataFrame) -> DataFrame:
    """Any table with page_id, url and html -> (page, effective_url, html).

    ``page`` keeps what is known about the request; the effective URL is the one
    the page was loaded from, else the requested one.
    """
    known = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in PAGES
    ]
    info = [f.name for f in PAGES if f.name != "html"]
    return df.select(*known).select(
        F.struct(*info).alias("page"),
        F.coalesce("loaded_url", "url").alias("effective_url"),
        "html",
    )
