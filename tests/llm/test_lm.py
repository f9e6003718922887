import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pagetables.llm import lm, queries
from pagetables.llm.eliasfano import EliasFano, dump, load

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n,most", [(0, 1), (1, 5), (10, 10), (1000, 10**6), (1000, 2**63), (20_000, 30_000)])
def test_elias_fano(n, most, tmp_path):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, most, n, dtype=np.uint64))
    with open(tmp_path / "x", "wb") as file:
        file.write(dump(EliasFano.of(values).arrays("x")))
    sequence = EliasFano.from_arrays(load(str(tmp_path / "x")), "x")
    assert (sequence.at(np.arange(len(values))) == values).all()
    asked = np.concatenate((values, rng.integers(0, most, 2000, dtype=np.uint64), np.array([0, most, 2**64 - 1], np.uint64)))
    place = {int(v): k for k, v in enumerate(values)}
    assert sequence.find(asked).tolist() == [place.get(int(v), -1) for v in asked]


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


class Brute:
    """The same model from plain dictionaries."""

    def __init__(self, texts, discount=0.75):
        self.words, self.pairs, self.kinds, self.d2 = Counter(), Counter(), Counter(), discount
        for text in texts:
            own = tokens(text)
            self.words.update(own)
            self.pairs.update(zip([None, *own], own))
        self.kinds.update(v for v, _ in self.pairs)
        self.n, self.v = sum(self.words.values()), len(self.words)
        ones, twos = (sum(c == k for c in self.words.values()) for k in (1, 2))
        self.d = ones / (ones + 2 * twos) if ones and twos else 0.5

    def base(self, own):
        return sum(math.log10((self.words[w] + 1) / (self.n + self.v + 1)) for w in own)

    def score(self, own):
        total = 0.0
        for v, w in zip([None, *own], own):
            single = (max(self.words[w] - self.d, 0) + self.d * self.v / (self.v + 1)) / self.n
            c = self.words[v]
            pair = max(self.pairs[v, w] - self.d2, 0) / c if c else 0
            rest = self.d2 * self.kinds[v] / c if c else 1
            total += math.log10(pair + rest * single)
        return total


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    brute = Brute([t for d, t in docs if crc(d) % 7 != 2])
    got = {r.doc_id: r for r in queries.op3_lm_score(spark, DATA).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        r, own = got[doc_id], tokens(text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(doc_id) % 7 == 2, len(own), sum(brute.words[w] > 0 for w in own), brute.n)
        assert abs(r.base_score - brute.base(own)) < 1e-6 * len(own)
        assert abs(r.score - brute.score(own)) < 0.01 * len(own)  # likelihoods are quantised
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_many_shards_and_flushes_give_the_same(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    whole = lm.fit(docs, f"{tmp_path}/a")
    cut = lm.fit(docs.repartition(5), f"{tmp_path}/b", params=lm.LmParams(word_shard_bytes=20_000, pair_shard_tokens=1500, flush=3000))
    assert (whole.tokens, whole.words, whole.pair_shards) == (cut.tokens, cut.words, 1) and cut.pair_shards > 20 and cut.split
    a, b = ({r.doc_id: r for r in lm.score(docs, ["doc_id"], m).collect()} for m in (whole, cut))
    for k, r in a.items():
        assert (r.n_tokens, r.n_known) == (b[k].n_tokens, b[k].n_known) and r.base_score == pytest.approx(b[k].base_score)
        assert abs(r.score - b[k].score) < 0.01 * r.n_tokens


def test_odd_rows(spark, documents, no_documents, tmp_path):
    texts = [r.text for r in documents.collect()]
    model = lm.fit(documents, f"{tmp_path}/a")
    brute = Brute(texts)
    assert (model.tokens, model.words) == (brute.n, brute.v)
    got = lm.score(documents, ["doc_id"], model).collect()
    want = sorted((round(brute.base(tokens(t)), 6), len(tokens(t))) for t in texts)
    assert sorted((round(r.base_score, 6), r.n_tokens) for r in got) == want
    nothing = lm.fit(no_documents, f"{tmp_path}/b")
    assert all(r.score == r.base_score and r.n_known == 0 for r in lm.score(documents, ["doc_id"], nothing).collect())
    assert lm.score(no_documents, ["doc_id"], model).count() == 0
