"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.sources.workspace import workspace

from .common import fold, sized
from . import conversations, exact_dedup, fim, jaccard, language, lm, mixing, neighbours, packing, simhash, token_store, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    """Where a public tokenizer's file is; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "tokens")
    params = token_store.StoreParams(_tokenizer("word_bpe_49k.json"), end_id=2)
    token_store.write_tokens(_table(spark, sf_dir, "documents"), path, params)
    return token_store.token_digests(token_store.read_tokens(spark, path))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held_out = fold("doc_id", 3) == 1
    drawn, counts = toxicity.draw(labels.where(~held_out))
    model = toxicity.fit(docs.select("doc_id", "text").join(sized(drawn), "doc_id"), counts=counts)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return toxicity.score(rows, ["doc_id", "held_out"], model)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 7) == 2
    model = lm.fit(docs.where(~held_out), workspace(spark, "trie"))
    scores = lm.score(docs.select("doc_id", held_out.alias("held_out"), "text"), ["doc_id", "held_out"], model)
    return scores.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = language.fit(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    guessed = language.identify(rows, model, ["doc_id", "held_out"])
    return guessed.select(
        "doc_id", "held_out", F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
        F.col("_cosine").alias("cosine"), F.col("_rejected").alias("rejected"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hexed("fingerprint").alias("fingerprint"), "component_id", "members")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    parts = packing.pieces(docs, _tokenizer("byte_bpe_50k.json"), capacity=1024, end_id=2, keep=400_000, chars=8_000_000)
    return packing.pack(parts, packing.PackParams(capacity=1024, batch_rows=2400))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_digests(_table(spark, sf_dir, "documents"), workspace(spark, "fim"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, lengths = conversations.shared_heads(conversations.turn_rows(_table(spark, sf_dir, "conversations")), every=20, ways=4)
    return conversations.trie(turns, lengths).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [(name, f) for name, f in globals().items() if name.startswith("op") and name[2].isdigit()]
    return dict(sorted(found, key=lambda item: int(item[0][2:].split("_")[0])))
