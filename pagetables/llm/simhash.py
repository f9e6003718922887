"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, sized, small_batches, stage, text_of
from .components import components
from .worker import release

BITS, RADIUS = 64, 3
#: Each level's map from the 64 bits to nonzero vectors of RADIUS + 1 bits. Rotated against each other,
#: so that what one level leaves open the next levels tell apart.
LEVELS = tuple(
    [1 + (a * i + b * (i // 15)) % 15 for i in range(BITS)] for a, b in ((1, 0), (2, 1), (4, 7), (7, 2))
)


def masks(level: int) -> list[int]:
    """The 2^(RADIUS+1) - 1 covering masks: mask v has the bits whose vector has an odd product with v.

    For any RADIUS bits some v is orthogonal to all their vectors, so two fingerprints that differ
    there and nowhere else agree on all of mask v: every pair within the radius meets in some table.
    """
    return [
        sum(1 << i for i, x in enumerate(LEVELS[level]) if (x & v).bit_count() % 2)
        for v in range(1, 1 << (RADIUS + 1))
    ]


@dataclass(frozen=True)
class SimHashParams:
    shingle: int = 3
    seed: int = 42
    bucket: int = 64  # larger buckets are told apart by the next level's masks


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 params: SimHashParams = SimHashParams()) -> DataFrame:
    """(doc_id, whole, fingerprint): a bit is set if it is in over half of the hashes of the shingles, repeats included.

    ``whole`` is a hash of the text, which with the id names a row. A text of fewer words is one shingle; one without words has fingerprint 0.
    """
    size, seed = params.shingle, params.seed

    def sketch(stream):
        import xxhash

        release()
        digest = xxhash.xxh64_intdigest
        for batch in stream:
            prints = np.zeros(batch.num_rows, np.uint64)
            for a in range(0, batch.num_rows, 256):
                for k, text in enumerate(batch.column(2).slice(a, 256).to_pylist(), a):
                    words = text.encode("utf-8").lower().split()
                    if not words:
                        continue
                    joined, n = b" ".join(words), len(words)
                    if n <= size:
                        hashes = np.array([digest(joined, seed)], np.uint64)
                    else:
                        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
                        begins = np.concatenate(([0], ends[:n - size] + 1)).tolist()
                        hashes = np.array(
                            [digest(joined[x:y], seed) for x, y in zip(begins, ends[size - 1:].tolist())], np.uint64
                        )
                    prints[k] = majority(hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], names=["doc_id", "whole", "fingerprint"]
            )

    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_of(text_column)).alias("whole"), text_of(text_column).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sketch, f"doc_id {kind}, whole long, fingerprint long")


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits that are set in over half of the 64-bit hashes."""
    counts = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 14):  # a long text is counted in parts
        bits = np.unpackbits(hashes[a:a + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0]


def _link(stream):
    """Within each bucket, edges that connect what is linked: at most one fewer than its fingerprints."""
    for batch in stream:
        lists = batch.column(0)
        values, offsets = np.asarray(lists.values), np.asarray(lists.offsets)
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            own = np.sort(values[a:b])
            bits = own.view(np.uint64)
            if len(own) == 2:
                if int(bits[0] ^ bits[1]).bit_count() <= RADIUS:
                    out.append((own[1], own[0]))
                continue
            open_, order = np.ones(len(own), bool), []
            for first in range(len(own)):  # grow one linked set after another
                if not open_[first]:
                    continue
                open_[first] = False
                order = [first]
                while order:
                    k = order.pop()
                    near = np.flatnonzero(open_ & (np.bitwise_count(bits ^ bits[k]) <= RADIUS))
                    open_[near] = False
                    order += near.tolist()
                    out += [(own[n], own[k]) for n in near.tolist()]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def links(prints: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fingerprint) that connect all that lie within the radius.

    Each fingerprint goes to one bucket of each covering mask. Small buckets are compared
    inside a task. The fingerprints of larger buckets go to a bucket for each of the next level's masks, which
    are covering as well, so no pair is lost; after four levels fewer than 12 bits are open, and with them a
    bucket's size is bounded.
    """
    def exploded(rows: DataFrame, level: int) -> DataFrame:
        tables = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks(level)])
        return (
            rows.withColumn("_m", F.explode(tables))
            .select("fp", F.col("mask").bitwiseOR(F.col("_m")).alias("mask"), (F.col("path") * 15).alias("path"), F.col("_m"))
            .withColumn("path", F.col("path") + F.array_position(tables, F.col("_m")) - 1)
            .select("fp", "mask", "path", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        )

    rows = prints.select(F.col("fingerprint").alias("fp"), F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("path"))
    edges = []
    for level in range(len(LEVELS)):
        cells = exploded(rows, level)
        counts = cells.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1")
        last = level == len(LEVELS) - 1
        few = counts if last else counts.where(F.col("n") <= params.bucket)
        buckets = cells.join(few, ["path", "key"]).groupBy("path", "key").agg(F.collect_list("fp").alias("fps"))
        edges.append(buckets.select("fps").mapInArrow(_link, "a long, b long"))
        if last:
            break
        crowded = stage(counts.where(F.col("n") > params.bucket).select("path", "key"), "crowded")
        if crowded.isEmpty():
            break
        rows = stage(cells.join(sized(crowded), ["path", "key"], "left_semi").select("fp", "mask", "path"), "crowded-cells")
    every = edges[0]
    for more in edges[1:]:
        every = every.unionByName(more)
    return every.distinct()


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                params: SimHashParams = SimHashParams()) -> DataFrame:
    """One row per document: (doc_id, whole, fingerprint, component_id, members, root).

    Documents are linked if their fingerprints differ in at most 3 bits; component_id is the smallest id
    reachable. Equal fingerprints are one class from the start, so thousands of copies are one
    node. A null text counts as empty; texts without words have fingerprint 0 and are linked
    like any other. Null ids are never the smallest unless there is no other. No rows give no rows. Other columns are ignored.
    """
    with small_batches(docs.sparkSession):
        prints = stage(fingerprints(docs, id_column, text_column, params), "fingerprints")
    classes = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")), "classes")
    roots = components(links(classes, params))
    linked = (
        classes.join(roots, F.col("fingerprint") == F.col("node"), "left")
        .withColumn("root", F.coalesce("root", "fingerprint"))
    )
    linked = stage(linked.select("fingerprint", "first", "rows", "root"), "linked")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("rows").alias("members"))
    labels = linked.join(least, "root").select("fingerprint", "component_id", "members", "root")
    return prints.join(labels, "fingerprint").select("doc_id", "whole", "fingerprint", "component_id", "members", "root")


def hexed(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     params: SimHashParams = SimHashParams()) -> DataFrame:
    """The rows that stay, with all their columns: of each component the one with the smallest id.

    Of rows that repeat that id, the one with the smallest hash of its text stays.
    """
    groups = stage(near_groups(docs, id_column, text_column, params).where("members > 1"), "near-groups")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # by root, as ids may be repeated or null in several components
    stay = groups.where(own).groupBy(F.col("root").alias("_r")).agg(F.min("whole").alias("_stays"))
    decided = groups.join(stay, F.col("root") == F.col("_r")).select(
        "doc_id", "whole", (own & (F.col("whole") == F.col("_stays"))).alias("kept")
    )
    return keep_rows(docs, decided, id_column, text_column)
