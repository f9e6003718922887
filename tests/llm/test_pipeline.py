import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from test_simhash import brute, fingerprint

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, DATA).cache()
        out.append(docs)
    return out


def key(rows):
    return sorted(((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows), key=str)


def test_stages_equal_brute_force(stages):
    docs, known, exact, near, mixed, packed = stages
    assert key(known.collect()) == key(docs.collect())  # all are in a known language
    last = {}
    for r in known.collect():
        last[r.text] = max((last.get(r.text, r), r), key=lambda x: x.doc_id)
    assert key(exact.collect()) == key(last.values())
    prints = [(r.doc_id, fingerprint(r.text)) for r in exact.collect()]
    stay = {c for _, c in brute(prints)}
    assert key(near.collect()) == key(r for r in exact.collect() if r.doc_id in stay)
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in near.collect()}
    assert mixed.groupBy("doc_id").count().where("count > 2").count() == 0
    words = F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))
    before, after = near.agg(words).first()[0], mixed.agg(words).first()[0]
    assert 1.35 <= after / before <= 1.65
    assert packed.where("piece = 0").count() == mixed.count()


def test_odd_rows_pass_every_stage(spark, documents, no_documents):
    docs = documents.select("doc_id", "text", "lang", "source", F.col("size").cast("long").alias("n_chars"))
    for rows in (docs, docs.where("false")):
        now = rows
        for _, function in corpus_pipeline.STAGES:
            now = function(spark, now, DATA)
        assert (now.count() > 0) == (rows.count() > 0)
