"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, sized, spare, stage, text_of


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = (3, 1, 2)  # of the sources in code-point order, repeating
    share: float = 1.5  # of all words that the mix takes
    epochs: int = 2  # most times that a word is taken
    block: int = 64  # words
    shard_words: int = 1 << 20
    shard_docs: int = 1 << 14
    seed: int = 42


def _draw(*parts) -> Column:
    """32 bits of a seeded md5, as a number; any SQL engine can give the same."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """(source, source_size) with ``weight`` and ``target``: shares by weight, none above
    ``epochs`` times its source; what a full source can't take goes to the others by weight.

    The level at which the others meet is found in one pass over the sources ordered by the
    weight at which they fill up. One row per source, so a plain window is enough.
    """
    n = len(params.weights)
    every = Window.partitionBy()
    filling = Window.orderBy(F.col("_full"), F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in params.weights])
    return (
        sources.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", F.element_at(weights, ((F.col("_rank") - 1) % n + 1).cast("int")).cast("long"))
        .withColumn("_cap", params.epochs * F.col("source_size"))
        .withColumn("_full", F.col("_cap").cast("double") / F.col("weight"))
        .withColumn("_total", params.share * F.sum("source_size").over(every))
        .withColumn("_before", F.coalesce(F.sum("_cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_open", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", (F.col("_total") - F.col("_before")) / F.col("_open"))
        .withColumn("_met", F.max(F.when(F.col("_full") > F.col("_level"), F.col("_level"))).over(every))
        .withColumn("target", F.when(F.col("_full") <= F.col("_level"), F.col("_cap").cast("double"))
                    .otherwise(F.col("_met") * F.col("weight")))
        .select("source", "source_size", "_docs", "_rank", "weight", "target")
    )


def apportion(cells: DataFrame, within: list[str], order: list[str], weight: str, seats: str, out: str) -> DataFrame:
    """Deal ``seats`` of each ``within`` group to its cells by the highest quotients weight/(2k+1),
    ties by ``order`` (Sainte-Lague).

    With n cells and total weight W, a cell's seats differ from its exact share q by at most
    n/2 * weight/W + 1, so only the quotients in that range are made and ranked, about 4 n in all,
    and the seats below are certain.
    """
    group = Window.partitionBy(*within)
    share = F.coalesce(F.col(weight) / F.nullif(F.col("_w"), F.lit(0.0)), F.lit(0.0))
    bounded = (
        cells.withColumn("_w", F.sum(F.col(weight).cast("double")).over(group))
        .withColumn("_n", F.count("*").over(group))
        .withColumn("_share", share)
        .withColumn("_base", F.greatest(F.lit(0), F.floor(F.col(seats) * F.col("_share") - F.col("_share") * F.col("_n") / 2 - 1.5)).cast("long"))
        .withColumn("_left", (F.col(seats) - F.sum("_base").over(group)).cast("long"))
    )
    ranked = (
        bounded.withColumn("_k", F.explode(F.sequence(F.col("_base"), F.col("_base") + F.ceil(F.col("_share") * F.col("_n")).cast("long") + 4)))
        .withColumn("_q", F.col(weight).cast("double") / (2 * F.col("_k") + 1))
        .withColumn("_place", F.row_number().over(group.orderBy(F.col("_q").desc(), *[F.col(c).asc_nulls_last() for c in order], F.col("_k"))))
    )
    keep = [c for c in cells.columns]
    return ranked.groupBy(*keep).agg(
        (F.min("_base") + F.sum(F.when((F.col("_place") <= F.col("_left")) & (F.col("_q") > 0), 1).otherwise(0))).cast("long").alias(out)
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        params: MixParams = MixParams()) -> DataFrame:
    """How many words of each document the mix takes, one row per input row:
    (doc_id, source, size, source_size, target, taken).

    Each source's documents are dealt to shards, put in seeded order and laid end to end as blocks
    of ``block`` words. The highest quotients give blocks to sources and then to the source's shards.
    A shard takes its blocks once or more as a whole, and from a seeded start so many of them
    once more as its quota leaves; a document's words are taken as often as its blocks. Everything
    past the count of words is on narrow rows; a shard is bounded, so a hot source is many shards.

    A null text has no words, a null source is a source of its own and comes last. Documents without
    words take none. Repeated rows are documents of their own. No rows give no rows. Other columns are ignored.
    """
    p = params
    sizes = stage(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(source_column).alias("source"),
            F.regexp_count(text_of(text_column), F.lit(WORD)).cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    aims = targets(per_source, p)
    total = F.round(F.sum("target").over(Window.partitionBy()) / p.block).cast("long")
    sources = apportion(aims.withColumn("_all", F.lit(1)).withColumn("_seats", total), ["_all"], ["source"], "target", "_seats", "_blocks")
    sources = stage(
        sources.select(
            "source", "source_size", "target", "_rank", "_blocks",
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / p.shard_words), F.ceil(F.col("_docs") / p.shard_docs)).cast("long").alias("_shards"),
        ),
        "mix-sources",
    )
    key = F.md5(F.concat_ws(":", F.lit(str(p.seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    dealt = (
        sizes.join(sized(sources), sizes["source"].eqNullSafe(sources["source"]))
        .select(
            "doc_id", sizes["source"], "size", "source_size", "target", "_rank", "_blocks",
            (_draw(F.lit(p.seed), F.lit("shard"), F.col("doc_id")) % F.col("_shards")).alias("_shard"),
            key.alias("_key"),
        )
    )
    shards = dealt.groupBy("_rank", "_shard", "_blocks").agg(F.sum("size").alias("_words"))
    quotas = (
        apportion(shards, ["_rank"], ["_shard"], "_words", "_blocks", "_quota")
        .withColumn("_own", F.ceil(F.col("_words") / p.block).cast("long"))
        .withColumn("_quota", F.least(F.col("_quota"), p.epochs * F.col("_own")))
        .select(
            F.col("_rank").alias("_r"), F.col("_shard").alias("_s"), "_own",
            F.when(F.col("_own") > 0, F.floor(F.col("_quota") / F.col("_own"))).otherwise(0).cast("long").alias("_whole"),
            F.when(F.col("_own") > 0, F.col("_quota") % F.col("_own")).otherwise(0).cast("long").alias("_more"),
            F.when(F.col("_own") > 0, _draw(F.lit(p.seed), F.lit("start"), F.col("_rank"), F.col("_shard")) % F.col("_own")).otherwise(0).cast("long").alias("_start"),
        )
    )
    line = Window.partitionBy("_rank", "_shard").orderBy("_key", "doc_id", "size")
    placed = dealt.withColumn("_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    low, high = F.col("_start") * p.block, (F.col("_start") + F.col("_more")) * p.block
    begin, end = F.col("_end") - F.col("size"), F.col("_end")
    within = F.greatest(F.lit(0), F.least(end, high) - F.greatest(begin, low))
    wrapped = F.greatest(F.lit(0), F.least(end, high - F.col("_own") * p.block) - begin)
    return (
        placed.join(quotas, (F.col("_rank") == F.col("_r")) & (F.col("_shard") == F.col("_s")))
        .select(
            "doc_id", "source", "size", "source_size", "target",
            (F.col("_whole") * F.col("size") + within + wrapped).cast("long").alias("taken"),
        )
    )


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
          params: MixParams = MixParams()) -> DataFrame:
    """The mix itself: each row as often as the nearest whole number of times that its words are taken.

    Rows that repeat id, source and size share what they take evenly, null ids and sources included. Rows without words stay once. As whole blocks are
    dealt out, a corpus of less than half a block of words takes none. No rows give no rows.
    """
    own = spare(docs.columns)
    taken = stage(mix(docs, id_column, text_column, source_column, params), "mix-taken")
    times = stage(
        taken.groupBy("doc_id", "source", "size")
        .agg((F.sum("taken") / F.count("*")).alias("_taken"))
        .select(
            F.col("doc_id").alias(f"{own}id"), F.col("source").alias(f"{own}source"), F.col("size").alias(f"{own}size"),
            F.when(F.col("size") > 0, F.floor(F.col("_taken") / F.col("size") + 0.5)).otherwise(1).cast("int").alias(f"{own}times"),
        )
        .where(F.col(f"{own}times") != 1),
        "mix-times",
    )
    marked = docs.withColumn(f"{own}words", F.regexp_count(text_of(text_column), F.lit(WORD)).cast("long"))
    on = (
        F.col(id_column).eqNullSafe(F.col(f"{own}id")) & F.col(source_column).eqNullSafe(F.col(f"{own}source"))
        & (F.col(f"{own}words") == F.col(f"{own}size"))
    )
    # only rows that don't stay once are named, so the narrow side is small
    return (
        marked.join(sized(times), on, "left")
        .withColumn(f"{own}times", F.coalesce(f"{own}times", F.lit(1)))
        .where(F.col(f"{own}times") > 0)
        .withColumn(f"{own}copy", F.explode(F.sequence(F.lit(1), F.col(f"{own}times"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
