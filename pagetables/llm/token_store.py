"""Token ids of documents in Parquet files that can be read by column, row group and page."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import parts_of_text, sized, small_batches, text_of
from .worker import release

STORED = "doc_id long, shard int, shard_start long, n_tokens long, token_ids array<int>"


@dataclass(frozen=True)
class StoreParams:
    tokenizer: str  # path of a tokenizers file
    end_id: int = 2
    shard_bytes: int = 32 << 20  # of text to a file
    row_group_bytes: int = 16 << 20
    page_rows: int = 2_000  # most rows of a page, so that a page index leads to few documents
    dictionary_bytes: int = 1 << 20  # all ids of a vocabulary of 262,144 fit
    batch_rows: int = 1500  # documents that go to Python at a time
    chars: int = 5_000_000  # about as many are encoded together
    keep: int = 300_000  # words remembered; the most frequent, once there are twice as many


def write_tokens(docs: DataFrame, path: str, params: StoreParams, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write the token ids of every whole text into ``path``/tokens, ordered by id, and a manifest of the files' first positions.

    Ids are dictionary-encoded lists; numbers that rise are delta-encoded (format version 2). Files
    hold ranges of ids, have small row groups and page indexes, so that a reader of some documents, or of lengths and positions
    alone, reads little else. A null text is an empty one. Rows that repeat an id
    lie side by side, ordered by their texts' hash; null ids come first. Other columns are ignored.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    parts = parts_of_text(rows, "text", params.shard_bytes)
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    spark = docs.sparkSession
    with small_batches(spark, params.batch_rows):
        (
            ordered.mapInArrow(_encoder(params), STORED)
            .write.option("compression", "zstd")
            .option("parquet.writer.version", "v2")
            .option("parquet.block.size", params.row_group_bytes)
            .option("parquet.page.row.count.limit", params.page_rows)
            .option("parquet.enable.dictionary", "true")
            .option("parquet.dictionary.page.size", params.dictionary_bytes)
            .parquet(f"{path}/tokens")
        )
    lengths = _files(spark, path).groupBy("shard").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
    # one row per file, so a plain window is enough
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    lengths.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/manifest")


def _encoder(params: StoreParams):
    def encode(stream):
        from .tokens import batches, coder

        code, shard, at = coder(params.tokenizer, params.keep), TaskContext.get().partitionId(), 0
        for batch in stream:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in batches(texts, params.chars):
                ids, lengths = code.encode(texts.slice(a, b - a))
                ends = np.cumsum(lengths)
                ids = np.insert(ids, ends, params.end_id)
                offsets = np.concatenate(([0], ends + np.arange(1, b - a + 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(a, b - a),
                        pa.array(np.full(b - a, shard, np.int32)),
                        pa.array(at + offsets[:-1]),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                    ],
                    names=["doc_id", "shard", "shard_start", "n_tokens", "token_ids"],
                )
                at += int(offsets[-1])

    return encode


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(f"{path}/tokens")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, token_ids); start counts the tokens of all documents before.

    Filters on doc_id reach the row groups and pages, and columns not asked for are not read.
    """
    firsts = spark.read.parquet(f"{path}/manifest").select("shard", "first")
    return _files(spark, path).join(sized(firsts), "shard").select(
        "doc_id", (F.col("first") + F.col("shard_start")).alias("start"), "n_tokens", "token_ids"
    )


def token_digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows as ``read_tokens`` gives them; counts and digests come from the ids."""

    def digest(stream):
        from .tokens import crc32_of

        release()
        for batch in stream:
            lists = batch.column(2)
            ids, offsets = np.asarray(lists.values), np.asarray(lists.offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array([crc32_of(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "token_ids").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
