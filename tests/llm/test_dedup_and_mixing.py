from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from check_queries import TABLES, compare
from pagetables.llm import exact_dedup, mixing, oracle

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    ok, note = compare(spark, con, name, DATA)
    assert ok, note


def groups_of(rows):
    texts = {}
    for r in rows:
        texts.setdefault(r.text or "", []).append(r.doc_id)
    return texts


def check_groups(spark, docs):
    texts = groups_of(docs.collect())
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == sum(map(len, texts.values()))
    want = Counter()
    for ids in texts.values():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids)) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) <= {1} and len(kept) == len(texts)


def test_exact_groups_of_odd_rows(spark, documents, no_documents):
    check_groups(spark, documents)
    assert exact_dedup.exact_groups(no_documents).count() == 0
    kept = exact_dedup.drop_copies(documents)
    assert kept.columns == documents.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter(groups_of(documents.collect()).keys())
    assert exact_dedup.drop_copies(no_documents).count() == 0


def test_chunks_that_only_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_hash", lambda c: F.length(c).cast("long"))
    rows = [(k, t) for k, t in enumerate(["aa", "bb", "aa", "cc", "bb", "", "dddd", "eeee" * 2000, "ffff" * 2000, "eeee" * 2000])]
    check_groups(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_chunks_join_to_the_text(spark):
    texts = ["", "a", "x" * 10_000, "One. Two! Three?\n" * 400, "ž😀.\n" * 900, "\n" * 5000]
    params = exact_dedup.ChunkParams()
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", exact_dedup.chunks(F.col("t"), params).alias("c")).collect()
    assert all("".join(r.c) == r.t for r in rows)
    assert max(len(c) for r in rows for c in r.c) <= 4096


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Reshare until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        now = {s for s in order if s not in full and left * weight[s] / open_ > most * sizes[s]} if open_ else set()
        if not now:
            return {s: most * sizes[s] if s in full else left * weight[s] / open_ for s in order}
        full |= now


def test_mix_of_odd_rows(spark, documents, no_documents):
    rows = mixing.mix(documents).collect()
    assert len(rows) == documents.count()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r.size
    assert mixing.mix(no_documents).count() == 0
    assert mixing.mixed(no_documents).count() == 0
    assert mixing.mixed(documents).columns == documents.columns


def test_mix_meets_its_targets_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    small = mixing.MixParams(shard_words=500, shard_docs=20, block=8)
    for params in (mixing.MixParams(), small):
        first, again = (sorted(map(tuple, mixing.mix(d, params=params).collect())) for d in (docs, docs.repartition(5)))
        assert first == again
        taken, target = Counter(), {}
        for _, source, _, _, aim, n in first:
            taken[source] += n
            target[source] = aim
        for source, aim in target.items():
            assert abs(taken[source] - aim) <= 0.03 * aim + 64, source


def test_apportionment_gives_the_highest_quotients(spark):
    cells = {"a": 5300.0, "b": 10.0, "c": 2400.0, "d": 2290.0, "e": 0.0, "f": 10.0}
    for seats in (0, 1, 7, 50, 1001):
        quotients = sorted(((-w / (2 * k + 1), s, k) for s, w in cells.items() if w for k in range(seats + 1)))[:seats]
        want = Counter(s for _, s, _ in quotients)
        rows = spark.createDataFrame(list(cells.items()), "cell string, w double").selectExpr("*", "1 AS g", f"{seats}L AS seats")
        got = mixing.apportion(rows, ["g"], ["cell"], "w", "seats", "won").collect()
        assert {r.cell: r.won for r in got} == {s: want[s] for s in cells}
