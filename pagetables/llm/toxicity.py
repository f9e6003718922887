"""Toxicity by class-conditional Kneser-Ney models with shared backoff."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized, stage, text_of
from .worker import held

_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class ToxicityParams:
    sample: int = 4_000  # training documents per class, drawn by hash; the models are fitted on these only
    order: int = 5  # characters, within words
    discount: float = 0.75
    tune: int = 4  # every so many-th of the sample sets the weights of the likelihoods, not the models
    window: int = 12  # words of the strongest passage
    flag_at: float = 0.7
    seed: int = 42


@dataclass
class ToxicityModel:
    """What the two models say about a window of characters: log10 toxic minus log10 ordinary likelihood."""

    codes: np.ndarray  # windows of ``order`` characters, sorted
    gains: np.ndarray
    contexts: np.ndarray  # their contexts, sorted, for windows not seen
    context_gains: np.ndarray
    weights: np.ndarray  # of the features, with a constant last
    params: ToxicityParams


def _folded(sample: DataFrame, params: ToxicityParams) -> DataFrame:
    """(word, toxic count, ordinary count) over the words of the sample, counted per task first."""

    def count(stream):
        from collections import Counter

        for batch in stream:
            own = (Counter(), Counter())
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own[toxic].update(_LETTERS.findall(text.lower()))
            words = list(own[0].keys() | own[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([own[1][w] for w in words], pa.int64()), pa.array([own[0][w] for w in words], pa.int64())],
                names=["word", "t", "o"],
            )

    return sample.select("toxic", "text").mapInArrow(count, "word string, t long, o long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _sums(codes: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct codes in order, with the sums of the columns."""
    distinct, place = np.unique(codes, return_inverse=True)
    return (distinct, *[np.bincount(place, weights=c, minlength=len(distinct)) for c in columns])


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def fit_models(words: list[str], toxic: np.ndarray, ordinary: np.ndarray, params: ToxicityParams):
    """Kneser-Ney models of both classes over the windows of words that occur so often.

    The highest order has the counts of each class. All lower orders are shared: continuation counts
    of both classes together. An expression that a class lacks so has the shared likelihood, not a small one, and rare
    expressions say little for either class.
    """
    from .wordpool import windows

    n, d = params.order, params.discount
    codes, counts = windows(words, n, n - 1)
    place = np.repeat(np.arange(len(words)), counts)
    codes, t, o = _sums(codes, toxic[place], ordinary[place])
    # shared lower orders: in how many ways a window continues to the left, from distinct windows one longer
    shared = None
    levels, longer = [], codes
    for k in range(n - 1, 0, -1):
        shorter, ways = np.unique(longer & ((1 << 12 * k) - 1), return_counts=True)
        levels.append((shorter, ways.astype(float)))
        longer = shorter
    symbols = max(1, len(levels[-1][0]) + 1) if levels else 1
    for size, (grams, ways) in zip(range(1, n), reversed(levels)):
        context = grams >> 12
        keys, total, kinds = _sums(context, ways, np.ones(len(ways)))
        at = np.searchsorted(keys, context)
        below = np.full(len(grams), 1.0 / symbols) if shared is None else _lookup(shared[0], shared[1], grams & ((1 << 12 * (size - 1)) - 1), 1.0 / symbols)
        shared = (grams, (np.maximum(ways - d, 0) + d * kinds[at] * below) / total[at])
    context = codes >> 12
    keys, total_t, total_o, kinds_t, kinds_o = _sums(context, t, o, (t > 0).astype(float), (o > 0).astype(float))
    at = np.searchsorted(keys, context)
    below = _lookup(*shared, codes & ((1 << 12 * (n - 1)) - 1), 1.0 / symbols) if shared else np.full(len(codes), 1.0 / symbols)

    def of_class(c, total, kinds):
        seen = total[at] > 0
        own = (np.maximum(c - d, 0) + d * kinds[at] * below) / np.maximum(total[at], 1)
        return np.where(seen, own, below)

    gains = np.log10(of_class(t, total_t, kinds_t)) - np.log10(of_class(o, total_o, kinds_o))
    rest = [np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0) for total, kinds in ((total_t, kinds_t), (total_o, kinds_o))]
    return codes, gains.astype(np.float32), keys, (np.log10(rest[0]) - np.log10(rest[1])).astype(np.float32)


def _gain_of_words(codes, gains, contexts, context_gains, order):
    """What each word says, summed over its characters."""
    from .wordpool import windows

    def make(words):
        parts = [_LETTERS.findall(w) for w in words]
        flat = [p for own in parts for p in own]
        wanted, counts = windows(flat, order, order - 1)
        each = _lookup(codes, gains, wanted, np.nan)
        lost = np.isnan(each)
        each[lost] = _lookup(contexts, context_gains, wanted[lost] >> 12, 0.0)
        per_word = np.array([len(own) for own in parts], np.int64)
        place = np.repeat(np.repeat(np.arange(len(words)), per_word), counts)
        return np.bincount(place, weights=each, minlength=len(words)).astype(np.float32), np.ones(len(words), np.int64)

    return make


def _features(texts: list[str], pool, window: int) -> np.ndarray:
    """Per text: the gain per word over the whole text, over its strongest passage, of its strongest words, and log length."""
    words = [t.lower().split() for t in texts]
    every = [w for own in words for w in own]
    gain = pool.gather(pool.numbers(every))[0].astype(float) if every else np.zeros(0)
    out, at = np.zeros((len(texts), 4)), 0
    for k, own in enumerate(words):
        n = len(own)
        if not n:
            continue
        g = gain[at:at + n]
        at += n
        sums = np.concatenate(([0.0], np.cumsum(g)))
        w = min(window, n)
        top = np.partition(g, n - min(3, n))[n - min(3, n):]
        out[k] = sums[-1] / n, (sums[w:] - sums[:-w]).max() / w, np.clip(top, -3, 6).mean(), np.log10(n)
    return out


def _pool_of(key: str, model: tuple, order: int):
    """The pool of a model that this worker holds from task to task."""
    from .wordpool import WordPool

    return held(lambda: WordPool(_gain_of_words(*model, order), keep=250_000), key)


def _measure(rows: DataFrame, keep: list[str], model, params: ToxicityParams, finish=None, kind: str = "features array<double>") -> DataFrame:
    """``keep`` columns of each row with its features, or what ``finish`` makes of them."""
    import uuid

    key = uuid.uuid4().hex
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def measure(stream):
        from .tokens import batches

        pool = _pool_of(key, shared.value, params.order)
        for batch in stream:
            texts = batch.column(batch.num_columns - 1)
            for a, b in batches(texts):
                found = _features(texts.slice(a, b - a).to_pylist(), pool, params.window)
                columns = [pa.array(list(found))] if finish is None else finish(found)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(a, b - a) for k in range(batch.num_columns - 1)], *columns],
                    names=[*batch.schema.names[:-1], *[x.split()[0] for x in kind.split(", ")]],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return rows.select(*keep, "text").mapInArrow(measure, f"{kinds}, {kind}")


def draw(labels: DataFrame, id_column: str = "doc_id", params: ToxicityParams = ToxicityParams()) -> tuple[DataFrame, dict[int, int]]:
    """About ``sample`` labels (id, toxic) of each class, drawn by a hash of the id, few enough to be broadcast, and how many each class has."""
    rows = labels.where(F.col("toxic").isin(0, 1)).select(id_column, F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, params.sample / max(1, counts.get(1, 0))).otherwise(params.sample / max(1, counts.get(0, 0)))
    drawn = F.pmod(F.xxhash64(F.lit(params.seed), id_column), F.lit(1 << 30)) / float(1 << 30) < share
    return stage(rows.where(drawn), "toxicity-labels"), counts


def fit(labelled: DataFrame, params: ToxicityParams = ToxicityParams(), counts: dict[int, int] | None = None) -> ToxicityModel:
    """Fit on rows (text, toxic 0 or 1), about ``sample`` of each class, drawn by a hash of the text. ``counts`` are the classes' true sizes
    if the rows are a sample already.

    Three quarters make the models; the rest, which these haven't seen, weigh the length-normalised differences against each
    other by logistic regression. Without both classes every score is the share of toxic rows.
    """
    p = params
    rows = labelled.where(F.col("toxic").isin(0, 1)).select(F.col("toxic").cast("int").alias("toxic"), text_of("text").alias("text"))
    totals = stage(rows.groupBy("toxic").count().withColumnRenamed("toxic", "_class"), "classes")
    draw = F.pmod(F.xxhash64(F.lit(p.seed), "text"), F.lit(1 << 30)) / float(1 << 30)
    part = F.pmod(F.xxhash64(F.lit(p.seed + 1), "text"), F.lit(p.tune)) == 0
    sample = (
        rows.join(sized(totals), F.col("toxic") == F.col("_class"))
        .where(draw < F.lit(float(p.sample)) / F.col("count")).select("toxic", "text", part.alias("tune"))
    )
    sample = stage(sample, "toxicity-sample")
    counted = _folded(sample.where("NOT tune"), p).toPandas()
    model = fit_models(counted["word"].tolist(), counted["t"].to_numpy(float), counted["o"].to_numpy(float), p)
    measured = _measure(sample.where("tune"), ["toxic"], model, p).toPandas()
    x = np.array(measured["features"].tolist(), float).reshape(-1, 4)
    counts = counts or {r["_class"]: r["count"] for r in totals.collect()}
    weights = _logistic(x, measured["toxic"].to_numpy(float), counts)
    return ToxicityModel(*model, weights, p)


def _logistic(x: np.ndarray, y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Ridge logistic regression by Newton's steps; rows weigh so that the classes have their true shares."""
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    base = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
    if len(set(y.tolist())) < 2:
        return np.array([1.0, 1.0, 0.5, 0.0, base])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    ridge = np.diag([0.5] * x.shape[1] + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * q * (1 - q))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w)), z.T @ (weight * (y - q)) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    own = w[:-1] / scale
    return np.append(own, w[-1] - own @ mean)


def score(docs: DataFrame, keep: list[str], model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """The columns ``keep`` of each row with score (0 to 1), predicted (1 from ``flag_at`` on) and the two
    length-normalised differences behind it, of the whole text and of its strongest passage.

    A null or empty text and one without letters has no evidence: all features 0. No rows give no rows.
    """
    p, weights = model.params, model.weights

    def finish(found):
        q = 1 / (1 + np.exp(-np.clip(found @ weights[:-1] + weights[-1], -40, 40)))
        return [pa.array(q), pa.array((q >= p.flag_at).astype(np.int32)), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())]

    rows = docs.select(*keep, text_of(text_column).alias("text"))
    tables = (model.codes, model.gains, model.contexts, model.context_gains)
    return _measure(rows, keep, tables, p, finish, "score double, predicted int, whole_gain double, passage_gain double")
