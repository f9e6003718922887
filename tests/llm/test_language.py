import numpy as np
from pyspark.sql import functions as F

from pagetables.llm import language, queries
from pagetables.llm.wordpool import WordPool, windows


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.001"
    got = queries.op6_language(spark, data)
    right = got.join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = right.where("held_out").agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()
    assert got.count() == 200 and held[0] > 20 and held[1] >= 0.95
    assert right.where("rejected OR score < 0 OR score > 1").count() == 0


def test_odd_rows(spark, documents, no_documents):
    model = language.fit(documents)
    assert set(model.languages) == {"en", "de", "xx"}
    rows = language.identify(documents, model, ["doc_id"], "text")
    got = rows.collect()
    assert len(got) == documents.count()
    und = [r for r in got if r._lang == "und"]
    assert len(und) == 5 and all(r._score == 0 and r._rejected for r in und)  # null twice, empty, white space, no letter
    kept = language.known_language(documents, model)
    assert kept.columns == documents.columns and kept.schema == documents.schema
    assert kept.count() == documents.count() - 5
    nothing = language.fit(no_documents)
    assert nothing.languages == []
    assert {r._lang for r in language.identify(documents, nothing, ["doc_id"]).collect()} == {"und"}
    assert language.known_language(no_documents, model).count() == 0


def test_windows_and_pool_forget_without_changing_results():
    codes, counts = windows(["ab", "", "é"], 3, 1)
    assert counts.tolist() == [2, 0, 1] and len(codes) == 3
    pool = WordPool(lambda words: (windows(words, 2, 1)), keep=3)
    for words in (["a", "b", "a"], ["c", "d", "e"], ["a", "x" * 100, "x" * 100]):
        numbers = pool.numbers(words)
        flat, lengths = pool.gather(numbers)
        want, want_lengths = windows(words, 2, 1)
        assert flat.tolist() == want.tolist() and lengths.tolist() == want_lengths.tolist()


def test_rejects_a_left_out_language_and_random_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    train = docs.where("doc_id % 5 <> 0")
    rng = np.random.default_rng(1)
    alphabets = {"latin": range(97, 123), "cyrillic": range(0x430, 0x450), "cjk": range(0x4E00, 0x5E00)}
    noise = [
        (k, " ".join("".join(chr(c) for c in rng.choice(list(letters), rng.integers(2, 9))) for _ in range(words)), f"{name} {words}")
        for name, letters in alphabets.items() for words in (20, 100, 1000) for k in range(10)
    ]
    model = language.fit(train)

    def shares(rows, model):
        got = language.identify(rows, model, ["lang"]).groupBy("lang").agg(F.avg(F.col("_rejected").cast("double")).alias("part"))
        return {r.lang: r.part for r in got.collect()}

    clean = shares(docs.where("doc_id % 5 = 0"), model)
    assert max(clean.values()) <= 0.03, clean
    random = shares(spark.createDataFrame(noise, "doc_id long, text string, lang string"), model)
    assert min(random.values()) == 1.0, random
    for out in ("es", "en"):
        foreign = shares(docs.where(F.col("lang") == out), language.fit(train.where(F.col("lang") != out)))
        assert foreign[out] >= 0.9, foreign


def _dense(texts, dims):
    """Trigram counts by plain loops."""
    import re

    out = np.zeros((len(texts), dims))
    for k, text in enumerate(texts):
        for word in text.lower().split():
            for part in re.findall(r"[^\W\d_]+", word):
                padded = [1, *map(ord, part), 2]
                for a, b, c in zip(padded, padded[1:], padded[2:]):
                    out[k, _bucket(a, b, c, dims)] += 1
    return out


def _bucket(a, b, c, dims):
    """Three characters of 12 bits, spread by a multiplication."""
    key = (a % 4093) << 24 | (b % 4093) << 12 | c % 4093
    return (key * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % dims


def test_predictions_against_dense_cosines(spark):
    """Counts, weights, cosines, shares and rejections of every text against plain loops over the same centroids."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "Ärger über ÖL, naïve café 日本 42 a", None), (-2, "x", None), (-3, None, None), (-4, "", None)], docs.schema)
    docs = docs.unionByName(odd)
    model = language.fit(docs.where("doc_id % 5 <> 0"))
    got = {r.doc_id: r for r in language.identify(docs, model, ["doc_id"]).collect()}
    rows = docs.collect()
    dims = model.params.dims
    counts = _dense([r.text or "" for r in rows], dims)
    centres = (model.weights / model.idf[:, None]).T.astype(float)
    assert np.allclose(np.linalg.norm(centres, axis=1), 1, atol=1e-4)
    for r, own in zip(rows, counts):
        guess = got[r.doc_id]
        if not any(ch.isalpha() for ch in r.text or ""):
            assert guess._lang == "und" and guess._score == 0 and guess._rejected
            continue
        vector = np.log1p(own) * model.idf
        cosines = centres @ vector / np.linalg.norm(vector)
        best = np.array([cosines[model.owner == k].max() for k in range(len(model.languages))])
        assert abs(guess._cosine - best.max()) < 1e-4
        assert best[model.languages.index(guess._lang)] >= best.max() - 1e-4
        share = 1 / np.exp(model.params.sharpness * (best - best.max())).sum()
        assert abs(guess._score - share) < 1e-2
        limit = np.interp(np.log2(own.sum()), np.log2(language.SIZES), model.limits[model.languages.index(guess._lang)])
        assert guess._rejected == (guess._cosine < limit) or abs(guess._cosine - limit) < 1e-4


def test_copies_count_once_and_the_sample_is_bounded(spark):
    """A text that makes up most rows neither fills the sample nor one task."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    copies = docs.limit(1).crossJoin(spark.range(3000)).select("text", "lang")
    one, many = language.fit(docs), language.fit(docs.unionByName(copies))
    assert one.languages == many.languages and np.allclose(one.weights, many.weights) and np.allclose(one.limits, many.limits)
    few = language.fit(docs, params=language.LanguageParams(sample=5, centroids=9))
    assert all((few.owner == k).sum() <= 5 for k in range(len(few.languages)))
