"""Approximate nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SUBSTRING = 8  # bits
VALUES = 1 << SUBSTRING


@dataclass(frozen=True)
class SearchParams:
    bits: int = 256
    candidates: int = 400  # nearest codes that are reranked at least, from each block
    share: float = 0.06  # and at least so many of the block's codes
    block: int = 16384  # vectors that share an index
    block_bytes: int = 32 << 20  # of their components, which makes blocks of long vectors smaller
    sample: int = 8192  # vectors, drawn by hash, on which the rotations are fitted
    rounds: int = 30
    seed: int = 42

    @property
    def substrings(self) -> int:
        return self.bits // SUBSTRING


def usable(vector: str) -> Column:
    """Not null, not zero, every component there and finite."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def fit_rotations(sample: np.ndarray, norm: float, params: SearchParams) -> np.ndarray:
    """(dims + 1, bits): rotations learned by alternating between signs and the rotation nearest to them.

    Vectors get one more component that makes all as long as the longest, so that codes follow inner products.
    """
    x = _lengthened(sample, norm)
    dims = x.shape[1]
    rng = np.random.default_rng(params.seed)
    _, _, axes = np.linalg.svd(x if len(x) >= dims else np.vstack((x, np.eye(dims) * 1e-6)), full_matrices=False)
    base, out = x @ axes.T, []
    for _ in range(-(-params.bits // dims)):
        rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        for _ in range(params.rounds):
            a, _, b = np.linalg.svd(np.where(base @ rotation >= 0, 1.0, -1.0).T @ base)
            rotation = (a @ b).T
        out.append(axes.T @ rotation)
    return np.concatenate(out, axis=1)[:, : params.bits]


def _lengthened(x: np.ndarray, norm: float) -> np.ndarray:
    return np.column_stack((x, np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))))


def encode(x: np.ndarray, rotations: np.ndarray, norm: float | None) -> np.ndarray:
    """(n, substrings) codes of a byte each; without ``norm`` the added component is 0, as queries have it."""
    full = np.column_stack((x, np.zeros(len(x)))) if norm is None else _lengthened(x, norm)
    return np.packbits(full @ rotations >= 0, axis=1, bitorder="little")


class MultiIndex:
    """One index per substring over the codes of a block.

    The index of a substring leads from each of its values to the bitmap of the codes that have it, or, at level r,
    one that differs in at most r bits. A level is made from the one before when a query first needs it.
    """

    def __init__(self, codes: np.ndarray, params: SearchParams):
        self.params, self.codes = params, codes
        self.words = np.ascontiguousarray(codes).view(np.uint64)
        n = len(codes)
        first = np.zeros((params.substrings, VALUES, -(-n // 8)), np.uint8)
        rows = np.arange(n)
        for k in range(params.substrings):
            np.bitwise_or.at(first[k], (codes[:, k], rows >> 3), (1 << (rows & 7)).astype(np.uint8))
        self.level, self.lists = 0, first

    def _raise_to(self, level: int) -> None:
        values = np.arange(VALUES)
        while self.level < level:
            for k, own in enumerate(self.lists):
                wider = own.copy()
                for b in range(SUBSTRING):
                    wider |= own[values ^ (1 << b)]
                self.lists[k] = wider
            self.level += 1

    def certain(self, level: int) -> int:
        """Codes within so many bits are all found at a level: with one more bit, some substring still differs in ``level`` at most."""
        return self.params.substrings * (level + 1) - 1

    def probe(self, queries: np.ndarray, level: int) -> np.ndarray:
        """(queries, bytes) bitmaps of the codes that have some substring within ``level`` bits of the query's."""
        self._raise_to(level)
        found = self.lists[0][queries[:, 0]]
        for k in range(1, self.params.substrings):
            found |= self.lists[k][queries[:, k]]
        return found

    def search(self, queries: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """For each query all codes within the least radius that holds ``candidates`` of them (and ``share`` of the block's), and that radius.

        Level by level, codes that probing finds for the first time are compared. A query is answered when so many lie within what the level makes certain.
        """
        p, n = self.params, len(self.codes)
        want = min(n, max(p.candidates, int(np.ceil(p.share * n))))
        out: list = [None] * len(queries)
        words = np.ascontiguousarray(queries).view(np.uint64)
        found: list[list[np.ndarray]] = [[] for _ in queries]
        gaps: list[list[np.ndarray]] = [[] for _ in queries]
        open_ = np.arange(len(queries))
        seen = np.zeros((len(queries), self.lists.shape[2]), np.uint8)
        # rising levels for all queries at once, as an index only rises; the last level finds every code
        for level in range(self.level, SUBSTRING + 1):
            hit = self.probe(queries[open_], level)
            new = np.unpackbits(hit & ~seen[open_], axis=1, count=n, bitorder="little")
            seen[open_] |= hit
            left = []
            for q, row in zip(open_.tolist(), new):
                at = np.flatnonzero(row)
                found[q].append(at)
                gaps[q].append(np.bitwise_count(self.words[at] ^ words[q]).sum(axis=1, dtype=np.int32))
                near = np.concatenate(gaps[q])
                if (near <= self.certain(level)).sum() < want:
                    left.append(q)
                    continue
                radius = int(np.partition(near, want - 1)[want - 1])
                out[q] = np.concatenate(found[q])[near <= radius], radius
                found[q] = gaps[q] = []
            open_ = np.array(left, np.int64)
            if not left:
                break
        return out


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
            params: SearchParams = SearchParams()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds its k nearest others by inner product, in
    double precision, ties to the smaller id.

    Vectors are dealt to blocks of bounded size, each with its indexes, and meet the queries block by
    block. Every answer comes out of the indexes: a query probes wider substrings until enough codes lie within the radius that pigeonhole
    makes certain. A block returns at most k rows per query, so vectors aren't paired in the
    shuffle; the best k over all blocks remain. A query doesn't find rows with its own id. Of equal vectors only those
    that can be among the answers, by the smallest ids, enter a block, so a vector that many rows repeat fills none.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without id or of another
    than the most frequent dimension. Rows that repeat an id are candidates of their own, and the first asks. A query finds all candidates if there are
    fewer than k. No rows give no rows. Other columns are ignored.
    """
    p = params
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"), queries.alias("asks"))
    rows = rows.where(usable("v") & F.col("id").isNotNull()).withColumn("dims", F.size("v"))
    shape = rows.groupBy("dims").agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("norm"))
    shape = shape.orderBy(F.col("n").desc(), "dims").first()
    if shape is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.col("dims") == shape["dims"])
    draw = F.pmod(F.xxhash64(F.lit(p.seed), "id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < min(1.0, p.sample / shape["n"])).select("v").toPandas()["v"]
    sample = np.array(sample.tolist() or [[0.0] * shape["dims"]], float)
    norm = float(shape["norm"])
    rotations = fit_rotations(sample, norm, p)
    indexed = stage(_distinct(rows.select("id", "v"), k), "vectors")
    size = max(1, min(p.block, p.block_bytes // (8 * shape["dims"])))
    blocks = max(1, -(-indexed.count() // size))
    indexed = indexed.select(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "v")
    asked = rows.where("asks").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "v")
    met = indexed.unionByName(asked).repartitionById(blocks, "block").sortWithinPartitions("block", "kind", "id")
    found = met.mapInArrow(_searcher(rotations, norm, k, p), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """Rows (id, v) that can be among the k nearest of some query: equal vectors score alike, so the smallest ids win.

    A query leaves out rows of its own id, of which k are kept; among 2 k rows k others remain.
    """
    same = rows.withColumn("nth", F.row_number().over(Window.partitionBy("v", "id").orderBy("id"))).where(F.col("nth") <= k)
    first = same.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("nth") <= 2 * k)
    return first.select("id", "v")


def _searcher(rotations: np.ndarray, norm: float, k: int, p: SearchParams):
    def search(stream):
        block, parts, index, ids, x, asked = None, [], None, None, None, None
        for batch in stream:
            at = np.asarray(batch.column(0))
            kind, own = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            values = np.asarray(batch.column(3).values).reshape(len(at), -1)
            edges = np.flatnonzero(np.diff(at) | np.diff(kind)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(at)]):
                if at[a] != block:
                    block, parts, index, asked = at[a], [], None, None
                if kind[a] == 0:
                    parts.append((own[a:b], values[a:b]))
                    continue
                if index is None:
                    if not parts:
                        continue
                    ids, x = np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts])
                    index = MultiIndex(encode(x, rotations, norm), p)
                for c in range(a, b, 256):
                    d = min(b, c + 256)
                    keep = np.ones(d - c, bool)
                    keep[1:] = own[c + 1:d] != own[c:d - 1]
                    keep[0] = own[c] != asked  # rows that repeat a query's id ask once
                    asked = own[d - 1]
                    yield _answers(own[c:d][keep], values[c:d][keep], encode(values[c:d][keep], rotations, None), index, ids, x, k)

    return search


def _answers(own, queries, codes, index, ids, x, k):
    out = []
    for q, (near, _) in enumerate(index.search(codes)):
        near = near[ids[near] != own[q]]
        score = (x[near] * queries[q]).sum(axis=1)
        best = np.lexsort((ids[near], -score))[:k]
        out.append((np.full(len(best), own[q]), ids[near][best], score[best]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])
