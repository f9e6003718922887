import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pagetables.llm import jaccard, queries
from pagetables.llm.shingles import ShingleCoder

DATA = "/root/testdata/sf0.001"


def shingles(text, size=4):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, near=85):
    """(id, size, least id reachable, links) by comparing all."""
    sets = [shingles(t) for _, t in rows]
    label, links = list(range(len(rows))), [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= near * len(a | b):
                links[i] += 1
                links[j] += 1
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), x in zip(rows, label):
        least[x] = doc if least.get(x) is None else min(least[x], least[x] if doc is None else doc)
    return [(doc, len(s), least[x], n) for (doc, _), s, x, n in zip(rows, sets, label, links)]


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def columns(df):
    return [tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "links").collect()]


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    same(columns(queries.op11_jaccard_join(spark, DATA)), brute(rows))


def test_odd_rows(spark, documents, no_documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    same(columns(jaccard.similar(documents)), brute(rows))
    assert jaccard.similar(no_documents).count() == 0


def near_copies(draw, words, edits):
    out = list(words)
    for k in draw.sample(range(len(out)), edits):
        out[k] = f"x{draw.randrange(10 ** 6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def crowd(spark):
    """A family of near copies, chains of them, a passage that many texts share, and sets on the very threshold."""
    draw = random.Random(3)
    text = lambda n: [f"w{draw.randrange(4000)}" for _ in range(n)]
    base, passage = text(200), text(60)
    rows = [near_copies(draw, base, draw.randint(0, 8)) for _ in range(90)]
    rows += [" ".join(text(draw.randint(30, 200)) + passage + text(20)) for _ in range(120)]
    rows += [" ".join(passage + text(draw.randint(0, 12))) for _ in range(60)]
    chain = text(150)
    for _ in range(30):
        chain = near_copies(draw, chain, 2).split()
        rows.append(" ".join(chain))
    rows += [" ".join(f"c{k}" for k in range(a, a + 103)) for a in range(0, 60, 4)]  # 100 shingles, shared 96, 92, ...
    rows += rows[::7]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("params", [
    jaccard.JoinParams(),
    jaccard.JoinParams(common=2, unit_rows=4, unit_shingles=900, list_rows=10),
    jaccard.JoinParams(common=10 ** 9, list_rows=20),
    jaccard.JoinParams(common=2, most_common=5, unit_rows=1),
], ids=["default", "small parts", "long lists", "few common"])
def test_crowded_groups(spark, crowd, params):
    same(columns(jaccard.similar(spark.createDataFrame(crowd, "doc_id long, text string"), params=params)), brute(crowd))


def test_other_thresholds(spark, crowd):
    some = crowd[:150]
    got = jaccard.similar(spark.createDataFrame(some, "doc_id long, text string"), params=jaccard.JoinParams(near=60))
    same(columns(got), brute(some, near=60))


def test_overlaps_from_differences():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 400, n)).astype(np.uint64) for n in (300, 200, 1, 280, 390, 50)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert jaccard.overlaps(sets).tolist() == want


def test_sketches_never_overstate():
    draw = np.random.default_rng(2)
    pool = draw.integers(0, 1 << 63, 3000).astype(np.uint64)
    for _ in range(200):
        a, b = (np.unique(draw.choice(pool, draw.integers(1, 2500))) for _ in range(2))
        x, y = jaccard.sketch_of(a), jaccard.sketch_of(b)
        width = min(len(x), len(y))
        apart = np.bitwise_count(jaccard.folded(x, width) ^ jaccard.folded(y, width)).sum()
        assert apart <= len(np.setxor1d(a, b))


def test_shingle_numbers_tell_words_apart(monkeypatch):
    """As many numbers as shingles, equal for equal ones, also where texts are hashed in small pieces."""
    texts = ["", None, "a", "A", "a b", "b a", "ab", "a b c d", "a b c d e a b c d", "é É x  y", "\x0bz\x0c \x00 ", "q" * 3000 + " t u v w"]
    texts += [" ".join(random.Random(k).choices(["aa", "ab", "b", "ba"], k=30)) for k in range(50)]
    monkeypatch.setattr("pagetables.llm.shingles._PIECE", 64)
    got = ShingleCoder(4, 1).sets(pa.array(["skipped", *texts])[1:])
    names = {}
    for text, own in zip(texts, got):
        want = shingles(text)
        assert len(own) == len(want)
        for key in want:
            names.setdefault(key, None)
    assert len(np.unique(np.concatenate(got))) == len(names)
