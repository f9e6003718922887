"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_rows, sized, small_batches, stage, text_of
from .worker import held

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_ANY = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class LanguageParams:
    sample: int = 600  # distinct training texts per language, drawn by hash; the model is fitted on these only
    centroids: int = 3  # per language
    dims: int = 8192  # buckets of character trigrams
    rounds: int = 12
    sharpness: float = 30.0  # of the score
    reject: float = 0.05  # cosine below which a text is nobody's, however short
    seed: int = 42
    folds: int = 5  # of the sample, each judged by centroids fitted on the others, to set the limits
    quantile: float = 0.005  # of the cosines of such documents
    margin: float = 0.8  # of that quantile: a language's limit
    enough: int = 20  # documents of a language for limits of its own, else ``reject``


#: Trigrams in a text for which limits are set; between them they follow the logarithm.
SIZES = tuple(4 << k for k in range(11))


@dataclass
class LanguageModel:
    languages: list[str]
    owner: np.ndarray  # language of each centroid
    weights: np.ndarray  # idf times unit centroid, (dims, centroids)
    idf: np.ndarray
    limits: np.ndarray  # cosine that a text of a language must reach, (languages, SIZES)
    params: LanguageParams


def _grams(dims: int):
    """Trigrams of the letters of a word, with its begin and end, as hash buckets."""
    from .wordpool import windows

    def make(words):
        parts = [_LETTERS.findall(w) for w in words]
        flat = [p for own in parts for p in own]
        codes, counts = windows(flat, 3, 1)
        per_word = np.array([len(own) for own in parts], np.int64)
        ends = np.concatenate(([0], np.cumsum(counts)))
        upto = np.cumsum(per_word)
        mixed = (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        return (mixed % np.uint64(dims)).astype(np.int64), ends[upto] - ends[upto - per_word]

    return make


def _counts(texts: list[str], pool, dims: int) -> np.ndarray:
    """(texts, dims) counts of trigrams of whole texts."""
    words = [t.lower().split() for t in texts]
    numbers = pool.numbers([w for own in words for w in own])
    ids, lengths = pool.gather(numbers)
    text_of_word = np.repeat(np.arange(len(texts)), [len(own) for own in words])
    cells = np.repeat(text_of_word, lengths) * dims + ids
    return np.bincount(cells, minlength=len(texts) * dims).reshape(len(texts), dims).astype(np.float32)


def _weighted(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts)


def _pool(dims: int):
    """The pool that this worker holds from task to task."""
    from .wordpool import WordPool

    return held(lambda: WordPool(_grams(dims), keep=150_000), dims)


def _spans(texts, chars: int = 400_000, most: int = 64):
    from .tokens import batches

    for a, b in batches(texts, chars):
        for c in range(a, b, most):
            yield c, min(b, c + most)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _centres(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """At most ``k`` centroids of unit vectors, by cosine."""
    order = np.argsort(x @ x.mean(axis=0), kind="stable")
    k = min(k, len(x))
    centres = x[order[np.linspace(0, len(x) - 1, k).astype(int)]]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        centres = np.stack([x[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(k)])
        centres = _unit(centres)
    return centres


def _limits(counts: np.ndarray, x: np.ndarray, own_idf: np.ndarray, p: LanguageParams) -> np.ndarray:
    """The limit of one language for each of ``SIZES``: a low quantile, with a margin, of the cosines of documents that the
    centroids were not fitted on. Longer documents also stand for shorter ones, by a random part of their trigrams.

    ``own_idf``: weights as if the document had not been counted.
    """
    if len(x) < p.enough:
        return np.full(len(SIZES), p.reject)
    rng = np.random.default_rng(p.seed)
    fold = np.arange(len(x)) % p.folds
    found: list[list[float]] = [[] for _ in SIZES]
    for f in range(p.folds):
        centres = _centres(x[fold != f], p.centroids, p.rounds)
        for row in counts[fold == f]:
            at = np.flatnonzero(row)
            every = np.repeat(at, row[at].astype(int))
            rng.shuffle(every)
            for k, size in enumerate(SIZES):
                ids, n = np.unique(every[:size], return_counts=True)
                v = _weighted(n.astype(np.float32)) * own_idf[ids]
                found[k].append(float((centres[:, ids] @ v).max() / np.linalg.norm(v)))
                if size >= len(every):
                    break
    limits = [np.quantile(c, p.quantile) * p.margin if len(c) >= p.enough else np.nan for c in found]
    for k in range(1, len(limits)):  # too few texts of that length: the limit of shorter ones
        limits[k] = limits[k - 1] if np.isnan(limits[k]) else limits[k]
    return np.maximum(limits, p.reject)


def fit(train: DataFrame, text_column: str = "text", lang_column: str = "lang", params: LanguageParams = LanguageParams()) -> LanguageModel:
    """Fit on at most ``sample`` distinct texts per language, drawn by a hash of the text; copies of a text count once.

    Trigram counts are damped by logarithm, weighted by inverse document frequency and normalised; each language's vectors are clustered
    by cosine in a task of its own, whose size the sample bounds, which also sets the language's limits. The driver gets
    document frequencies, centroids and limits.
    """
    p, dims = params, params.dims
    rows = train.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(lang_column).alias("lang"), F.col(text_column).alias("text")
    )
    keyed = rows.withColumn("hash", F.xxhash64("text"))
    totals = stage(keyed.select("lang", "hash").distinct().groupBy("lang").count(), "languages")
    draw = F.pmod(F.xxhash64(F.lit(p.seed), "text"), F.lit(1 << 30)) / float(1 << 30)
    # a little more is drawn than is kept, so that the bound is met exactly
    drawn = keyed.join(sized(totals), "lang").withColumn("draw", draw).where(F.col("draw") < F.lit(1.3 * p.sample + 50) / F.col("count"))
    distinct = drawn.groupBy("lang", "hash").agg(F.min("draw").alias("draw"), F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "hash"))
    sample = distinct.withColumn("place", place).where(F.col("place") <= p.sample).select("lang", "hash", "text")

    def vectors(stream):
        pool = _pool(dims)
        for batch in stream:
            for a, b in _spans(batch.column(2)):
                counts = _counts(batch.column(2).slice(a, b - a).to_pylist(), pool, dims)
                at = [np.flatnonzero(row) for row in counts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([x.astype(np.int32) for x in at], pa.list_(pa.int32())),
                     pa.array([row[x] for row, x in zip(counts, at)], pa.list_(pa.float32()))],
                    names=["lang", "hash", "ids", "counts"],
                )

    with small_batches(train.sparkSession):
        drawn = stage(sample.mapInArrow(vectors, "lang string, hash long, ids array<int>, counts array<float>").where("size(ids) > 0"), "language-sample")
    n = drawn.count()
    df = np.zeros(dims)
    for row in drawn.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # at most dims rows
        df[row[0]] = row[1]
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1

    own_idf = (np.log(max(n, 1) / np.maximum(df, 1)) + 1).astype(np.float32)

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("hash", kind="stable")
        raw = np.zeros((len(frame), dims), np.float32)
        for k, (ids, counts) in enumerate(zip(frame["ids"], frame["counts"])):
            raw[k, ids] = counts
        x = _unit(_weighted(raw) * idf)
        centres = _centres(x, p.centroids, p.rounds)
        limits = _limits(raw, x, own_idf, p)
        k = len(centres)
        return pd.DataFrame({
            "lang": frame["lang"].iloc[:1].repeat(k).to_numpy(), "centroid": list(range(k)), "vector": list(centres), "limits": [limits] * k,
        })

    found = drawn.groupBy("lang").applyInPandas(cluster, "lang string, centroid int, vector array<float>, limits array<double>").orderBy("lang", "centroid").collect()
    languages = sorted({r.lang for r in found})
    owner = np.array([languages.index(r.lang) for r in found], np.int64)
    centres = np.array([r.vector for r in found], np.float32).reshape(-1, dims)
    limits = np.array([next(r.limits for r in found if r.lang == name) for name in languages]).reshape(-1, len(SIZES))
    return LanguageModel(languages, owner, np.ascontiguousarray((centres * idf).T), idf, limits, p)


GUESS = "_lang string, _score double, _cosine double, _rejected boolean"


def identify(docs: DataFrame, model: LanguageModel, keep: list[str], text_column: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with _lang, _score, _cosine and _rejected.

    _lang is the language of the centroid with the largest cosine; ``und`` if the text is null or has no letter, or if
    nothing was learned. _score is its share against the other languages, 0 for ``und``. _rejected: ``und``, or farther from
    its centroids than the limit of the language allows for as many trigrams. No rows give no rows.
    """
    languages, owner, weights, idf, limits, p = model.languages, model.owner, model.weights, model.idf, model.limits, model.params
    sizes = np.log2(SIZES)

    def predict(stream):
        pool = _pool(p.dims)
        for batch in stream:
            texts = batch.column(batch.num_columns - 1)
            for a, b in _spans(texts):
                some = [t or "" for t in texts.slice(a, b - a).to_pylist()]
                known = np.array([bool(languages) and bool(_ANY.search(t)) for t in some], bool)
                lang, score, cos = [UNKNOWN] * len(some), np.zeros(len(some)), np.zeros(len(some))
                limit = np.zeros(len(some))
                if known.any():
                    counts = _counts(some, pool, p.dims)
                    size = np.log2(np.maximum(counts.sum(axis=1), 1))
                    x = _weighted(counts)
                    cosine = (x @ weights) / np.maximum(np.sqrt((x * x) @ (idf * idf)), 1e-9)[:, None]
                    best = np.stack([cosine[:, owner == k].max(axis=1) for k in range(len(languages))], axis=1).astype(float)
                    top = best.argmax(axis=1)
                    cos = np.where(known, best[np.arange(len(some)), top], 0.0)
                    score = np.where(known, 1 / np.exp(p.sharpness * (best - best.max(axis=1, keepdims=True))).sum(axis=1), 0.0)
                    for k, own in enumerate(limits):
                        limit = np.where(top == k, np.interp(size, sizes, own), limit)
                    lang = [languages[k] if ok else UNKNOWN for k, ok in zip(top, known)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(a, b - a) for k in range(batch.num_columns - 1)],
                     pa.array(lang, pa.string()), pa.array(score), pa.array(cos), pa.array(~known | (cos < limit))],
                    names=[*batch.schema.names[:-1], "_lang", "_score", "_cosine", "_rejected"],
                )

    rows = docs.select(*keep, F.col(text_column).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(predict, f"{kinds}, {GUESS}")


def known_language(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns.

    The texts pass by Python once to be judged; what comes back are the rejected rows' ids and hashes.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_of(text_column)).alias("whole"), F.col(text_column).alias("text"))
    with small_batches(docs.sparkSession):
        gone = stage(identify(rows, model, ["doc_id", "whole"]).where("_rejected").select("doc_id", "whole", F.lit(False).alias("kept")), "rejected")
    return keep_rows(docs, gone, id_column, text_column)
