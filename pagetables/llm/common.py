"""Helpers shared by the operators of this package."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.sources.workspace import workspace

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of 8 to 40 bytes that may be broadcast: some tens of MB. Larger sides are shuffled.
BROADCAST_ROWS = 200_000


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write rows as Parquet into the cluster's shared folder and read them from there.

    Every consumer then reads the same rows, also after an executor is lost.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 600):
    """Long rows go to Python in smaller batches than the session's, for the actions within."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(id_column: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % parts


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow side of a join for broadcast if a count shows that it is small.

    A larger side is left to a shuffled join, which gives the same rows. ``df`` must be
    cheap to count, such as a staged table.
    """
    few = df.limit(rows + 1).count() <= rows
    return F.broadcast(df) if few else df


def parts_of_text(rows: DataFrame, column: str, part_bytes: int) -> int:
    """Partitions that hold about so many bytes of a text column as it is in memory; files may be much smaller."""
    size = rows.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, -(-int(size) // part_bytes))


def parts_for(df: DataFrame, part_bytes: int) -> int:
    """Partitions of about so many bytes by the optimizer's estimate, which for files is their size;
    the session's number of shuffle partitions where there is no estimate."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // part_bytes))


def keep_rows(docs: DataFrame, decided: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The rows of ``docs`` without those that ``decided`` (doc_id, whole, kept) drops, and one of each
    that it keeps but that repeats id and text. Rows that it doesn't name stay. ``whole`` is the xxhash64 of the text.

    Only rows that go or repeat are looked up, so that the narrow side of the join is small.
    """
    own = spare(docs.columns)
    named = decided.groupBy("doc_id", "whole").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")).where("NOT kept OR rows > 1")
    named = named.select(F.col("doc_id").alias(f"{own}id"), F.col("whole").alias(f"{own}whole"), F.col("kept").alias(f"{own}kept"))
    named = sized(stage(named, "decided"))
    marked = docs.withColumn(f"{own}text", F.xxhash64(text_of(text_column)))
    on = F.col(id_column).eqNullSafe(F.col(f"{own}id")) & (F.col(f"{own}text") == F.col(f"{own}whole"))
    others = marked.join(named, on, "left_anti").drop(f"{own}text")
    repeated = marked.join(named.where(F.col(f"{own}kept")), on, "left_semi").dropDuplicates([id_column, f"{own}text"]).drop(f"{own}text")
    return others.unionByName(repeated)


def spare(columns: list[str]) -> str:
    """A beginning that none of these columns' names has."""
    own = "_own_"
    while any(c.lower().startswith(own) for c in columns):
        own = f"_{own}"
    return own
