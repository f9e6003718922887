import hashlib
import random
import re

import numpy as np
import pytest

from pagetables.llm import fim, oracle, queries

DATA = "/root/testdata/sf0.001"


def brute(doc_id, text, percent=100, unit=r"[^\n]*\n|[^\n]+"):
    text = text or ""
    units = re.findall(unit, text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle = "".join(units[:a]), "".join(units[a:b])
    suffix = text[len(prefix) + len(middle):]
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), out


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = [(*brute(d, t)[:5], sha(brute(d, t)[5]), sha(t)) for d, t in rows]
    got = [tuple(r) for r in queries.op12_fill_in_middle(spark, DATA).collect()]
    same(got, want)
    assert {r[2] for r in got} == {"psm", "spm"}
    assert "op12_fill_in_middle" in oracle.oracle_sql()


def test_odd_rows(spark, documents, no_documents):
    more = [(20, "a <M> b\nc"), (21, "<"), (22, "x\n<P\n>"), (23, "\n\n\n"), (24, "<S\ny<M"), (25, "é\r\n日本\n\U0001f600" * 9)]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = docs.collect()
    for percent in (100, 40, 0):
        params = fim.FimParams(percent=percent)
        made = fim.fill_in_middle(docs, params=params)
        same([tuple(r) for r in made.select("doc_id", "units", "form", "prefix_chars", "middle_chars", "output").collect()],
             [brute(d, t, percent) for d, t in rows])
        same([(r.doc_id, r.text) for r in fim.restore(made, params).collect()], [(d, t or "") for d, t in rows])
    assert fim.fill_in_middle(documents).columns[0] == "doc_id"
    assert fim.fill_in_middle(no_documents).count() == 0


def test_other_units(spark):
    rows = [(k, "één twee  drie, vier. " * k + "end") for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    params = fim.FimParams(unit=r"\s*\S+\s*")
    made = fim.fill_in_middle(docs, params=params)
    same([tuple(r) for r in made.select("doc_id", "units", "form", "prefix_chars", "middle_chars", "output").collect()],
         [brute(d, t, unit=r"\s*\S+\s*") for d, t in rows])


@pytest.mark.parametrize("shape", ["few", "runs", "dense", "mixed"])
def test_boundary_set_selects_every_position(shape):
    draw = np.random.default_rng(4)
    few = np.unique(draw.integers(0, 400_000, 300))
    runs = np.concatenate([np.arange(a, a + 900) for a in range(5, 300_000, 7000)])
    dense = np.flatnonzero(draw.random(3 << 16) < 0.4)
    positions = {"few": few, "runs": runs, "dense": dense, "mixed": np.unique(np.concatenate((few + 900_000, runs + 400_000, dense)))}[shape]
    held = fim.BoundarySet(positions)
    kinds = {kind for kind, _ in held.containers}
    assert kinds == {"few": {0}, "runs": {1}, "dense": {2}, "mixed": {0, 1, 2}}[shape]
    assert len(held) == len(positions)
    for rank in [0, len(positions) - 1, *random.Random(1).sample(range(len(positions)), 250)]:
        assert held.select(rank) == positions[rank]
    for rank in (-1, len(positions)):
        with pytest.raises(IndexError):
            held.select(rank)
    assert len(fim.BoundarySet(np.zeros(0, np.int64))) == 0
