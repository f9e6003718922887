import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetables.llm import queries, toxicity

DATA = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    got = queries.op2_toxicity(spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    toxic, clean = rows[rows.toxic == 1].score.to_numpy(), rows[rows.toxic == 0].score.to_numpy()
    area = (toxic[:, None] > clean[None, :]).mean() + 0.5 * (toxic[:, None] == clean[None, :]).mean()
    assert area >= 0.9 and rows[rows.toxic == 0].predicted.mean() <= 0.02
    assert got.count() == 1000 and got.where("score < 0 OR score > 1 OR predicted != CAST(score >= 0.7 AS INT)").count() == 0


def test_models_are_distributions_and_share_what_is_rare():
    words = ["abc", "abd", "abe", "xyz", "xbq"]
    t, o = np.array([5.0, 0, 0, 3, 0]), np.array([0.0, 4, 2, 3, 1])
    params = toxicity.ToxicityParams(order=3)
    codes, gains, contexts, context_gains = toxicity.fit_models(words, t, o, params)
    from pagetables.llm.wordpool import windows

    gain_of = lambda w: toxicity._gain_of_words(codes, gains, contexts, context_gains, 3)([w])[0][0]
    assert gain_of("abc") > 0.3 and gain_of("abd") < -0.3
    assert abs(gain_of("xyz")) < 0.3
    assert gain_of("123") == 0
    # a context that no model has seen says nothing
    unseen, _ = windows(["qqq"], 3, 2)
    assert toxicity._lookup(contexts, context_gains, unseen[2:3] >> 12, 0.0)[0] == 0


@pytest.mark.parametrize("classes", [(0, 1), (1,), (0,), ()])
def test_odd_rows_and_missing_classes(spark, documents, no_documents, classes):
    labelled = documents.select("text", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("toxic")).where(F.col("toxic").isin(*classes) if classes else F.lit(False))
    model = toxicity.fit(labelled)
    rows = toxicity.score(documents, ["doc_id"], model).collect()
    assert len(rows) == documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 8)}) == 1  # null, empty and white space
    assert toxicity.score(no_documents, ["doc_id"], model).count() == 0


class Plain:
    """Kneser-Ney models of both classes with shared lower orders, by dictionaries and recursion."""

    def __init__(self, words, toxic, ordinary, order, discount):
        self.n, self.d = order, discount
        self.own = {0: {}, 1: {}}
        for word, t, o in zip(words, toxic, ordinary):
            for gram in self.grams(word):
                for cls, times in ((1, t), (0, o)):
                    self.own[cls][gram] = self.own[cls].get(gram, 0) + times
        seen = {g for counts in self.own.values() for g in counts}
        self.ways = {}
        for size in range(order - 1, 0, -1):
            self.ways[size] = {}
            for gram in seen:
                self.ways[size][gram[1:]] = self.ways[size].get(gram[1:], 0) + 1
            seen = set(self.ways[size])
        self.alphabet = sorted(g[0] for g in seen)

    def grams(self, word):
        padded = "\x01" * (self.n - 1) + word + "\x02"
        return [padded[k:k + self.n] for k in range(len(word) + 1)]

    def _smoothed(self, counts, gram, below):
        same = [c for g, c in counts.items() if g[:-1] == gram[:-1] and c > 0]
        if not same:
            return below
        return (max(counts.get(gram, 0) - self.d, 0) + self.d * len(same) * below) / sum(same)

    def shared(self, gram):
        if not gram:
            return 1 / (len(self.alphabet) + 1)
        return self._smoothed(self.ways[len(gram)], gram, self.shared(gram[1:]))

    def p(self, cls, gram):
        return self._smoothed(self.own[cls], gram, self.shared(gram[1:]))

    def gain(self, word):
        return sum(np.log10(self.p(1, g) / self.p(0, g)) for g in self.grams(word))


def _plain_of_small_corpus(order=4):
    words = ["hate", "hater", "hat", "that", "this", "stupid", "study", "idiot", "idea", "the", "then", "a"]
    draw = np.random.default_rng(3)
    toxic, ordinary = (draw.integers(0, 6, len(words)).astype(float) for _ in range(2))
    params = toxicity.ToxicityParams(order=order)
    return words, toxic, ordinary, params, Plain(words, toxic, ordinary, order, params.discount)


@pytest.mark.parametrize("order", [2, 3, 4, 5])
def test_gains_against_dictionaries(order):
    words, toxic, ordinary, params, plain = _plain_of_small_corpus(order)
    model = toxicity.fit_models(words, toxic, ordinary, params)
    make = toxicity._gain_of_words(*model, order)
    for word in [*words, "hated", "thesis", "idiotic", "zebra", "stud", "tat"]:
        assert abs(make([word])[0][0] - plain.gain(word)) < 1e-4, word


def test_both_models_are_distributions():
    _, _, _, params, plain = _plain_of_small_corpus()
    contexts = {g[:-1] for counts in plain.own.values() for g in counts} | {"zzz", "\x01\x01z"}
    for cls in (0, 1):
        for context in contexts:
            assert abs(sum(plain.p(cls, context + c) for c in [*plain.alphabet, "\x7f"]) - 1) < 1e-9


def test_scores_against_plain_loops(spark, documents):
    """Features and scores of whole texts from the dictionaries' gains and the fitted weights."""
    import re

    words, toxic, ordinary, params, plain = _plain_of_small_corpus()
    weights = np.array([2.0, 1.0, 0.5, 0.1, -0.3])
    model = toxicity.ToxicityModel(*toxicity.fit_models(words, toxic, ordinary, params), weights, params)
    texts = ["that idiot", "This, THEN that.", "", None, "a", "hate " * 40 + "the study", "stupid-idea 42", " \n "]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(rows, ["doc_id"], model).collect()}
    for k, text in enumerate(texts):
        gains = [sum(plain.gain(part) for part in re.findall(r"[^\W\d_]+", w)) for w in (text or "").lower().split()]
        features = [0.0] * 4
        if gains:
            w = min(params.window, len(gains))
            passage = max(sum(gains[a:a + w]) for a in range(len(gains) - w + 1)) / w
            strongest = [min(max(g, -3), 6) for g in sorted(gains)[-3:]]
            features = [sum(gains) / len(gains), passage, sum(strongest) / len(strongest), np.log10(len(gains))]
        want = 1 / (1 + np.exp(-(np.dot(features, weights[:-1]) + weights[-1])))
        assert abs(got[k].score - want) < 1e-4 and got[k].predicted == (got[k].score >= 0.7), text
        assert abs(got[k].whole_gain - features[0]) < 1e-4 and abs(got[k].passage_gain - features[1]) < 1e-4
