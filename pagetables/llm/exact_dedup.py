"""Exact deduplication by content-defined chunk recipes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_rows, sized, stage, text_of

#: A chunk ends with the first sentence or line end after the least length; without one it has the full length.
CHUNK = r"(?s).{{{least},{last}}}?[\n.!?]|.{{1,{most}}}"


@dataclass(frozen=True)
class ChunkParams:
    least: int = 512
    most: int = 4096

    @property
    def pattern(self) -> str:
        return CHUNK.format(least=self.least, last=self.most - 1, most=self.most)


def chunks(text: Column, params: ChunkParams) -> Column:
    """The text cut where its content says so; joined again, the chunks are the text."""
    return F.regexp_extract_all(text, F.lit(params.pattern), F.lit(0))


def _hash(text: Column) -> Column:
    return F.xxhash64(text)


def _recipe(text: Column, params: ChunkParams) -> Column:
    return F.transform(chunks(text, params), _hash)


def _clashes(docs: DataFrame, suspects: DataFrame, params: ChunkParams) -> DataFrame:
    """Chunks that differ although their hashes are equal: (h, chunk, variant), variant from 1 on for all but the first.

    Only texts whose whole recipe occurs again are read, and each distinct chunk moves once.
    """
    pieces = (
        docs.withColumn("_whole", _hash(F.col("_text")))
        .join(sized(suspects.select("_whole").distinct()), "_whole", "left_semi")
        .select(F.explode(chunks(F.col("_text"), params)).alias("chunk"))
        .select(_hash(F.col("chunk")).alias("h"), "chunk")
        .distinct()
    )
    # min and max of another hash would be a guess; the chunks themselves are compared
    many = pieces.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    ordered = Window.partitionBy("h").orderBy("chunk")
    return (
        pieces.join(many, "h", "left_semi")
        .withColumn("variant", F.row_number().over(ordered) - 1)
        .where("variant > 0")
    )


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", params: ChunkParams = ChunkParams()
) -> DataFrame:
    """Groups of identical texts, one row per input row:
    (doc_id, keep_id, group_size, kept, text_sha256).

    Each text becomes a recipe, the ordered list of its chunks' 64-bit hashes. Recipes that
    differ prove that texts differ. Where recipes are equal, the chunks are compared by content,
    and chunks that only share a hash get identifiers of their own. Groups are rows with equal
    lists of identifiers.

    A null text counts as empty; empty texts are equal. The largest id stays, null ids come
    last; of rows that repeat id and text, one stays. No rows give no rows. Other columns are ignored.
    """
    return _groups(docs, id_column, text_column, params).drop("_whole")


def _groups(docs: DataFrame, id_column: str, text_column: str, params: ChunkParams) -> DataFrame:
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"))
    recipes = stage(
        rows.select(
            F.monotonically_increasing_id().alias("_row"),
            "doc_id",
            _recipe(F.col("_text"), params).alias("_recipe"),
            _hash(F.col("_text")).alias("_whole"),
            F.unhex(F.sha2(F.encode("_text", "UTF-8"), 256)).alias("_sha"),
        ),
        "recipes",
    )
    again = stage(
        recipes.groupBy("_recipe", "_whole").agg(F.count("*").alias("n")).where("n > 1").select("_recipe", "_whole"),
        "repeated-recipes",
    )
    clashes = stage(_clashes(rows, again, params), "clashes")
    keyed = recipes.withColumn("_variants", F.lit(None).cast("array<struct<pos:int,variant:int>>"))
    if not clashes.isEmpty():
        keyed = _verified(rows, recipes, clashes, params)
    grouped = (
        keyed.groupBy("_recipe", "_whole", "_variants")
        .agg(F.max("doc_id").alias("_keep"), F.count("*").alias("_size"))
        .where("_size > 1")
    )
    same = (
        (F.col("r._recipe") == F.col("g._recipe"))
        & (F.col("r._whole") == F.col("g._whole"))
        & F.col("r._variants").eqNullSafe(F.col("g._variants"))
    )
    found = keyed.alias("r").join(grouped.alias("g"), same, "left").select(
        "r.doc_id", "r._row", "r._sha", "r._whole",
        F.when(F.col("g._size").isNull(), F.col("r.doc_id")).otherwise(F.col("g._keep")).alias("keep_id"),
        F.coalesce("g._size", F.lit(1)).cast("long").alias("group_size"),
    )
    # rows that repeat an id within their group: one of them stays
    first = F.row_number().over(Window.partitionBy("doc_id", "_sha").orderBy("_row"))
    return found.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (first == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"), "_whole",
    )


def _verified(rows, recipes, clashes, params) -> DataFrame:
    """Recipes with, for chunks that only share a hash with others, the positions and variants."""
    hit = recipes.select("_recipe", "_whole", F.explode("_recipe").alias("h")).join(
        sized(clashes.select("h").distinct()), "h", "left_semi"
    )
    texts = (
        rows.withColumn("_whole", _hash(F.col("_text")))
        .join(sized(hit.select("_whole").distinct()), "_whole", "left_semi")
        .select("_whole", F.sha2(F.encode("_text", "UTF-8"), 256).alias("_hex"), "_text")
        .distinct()
        .select("_whole", "_hex", F.posexplode(chunks(F.col("_text"), params)).alias("pos", "chunk"))
        .withColumn("h", _hash(F.col("chunk")))
    )
    variants = (
        texts.join(clashes, ["h", "chunk"])
        .groupBy("_whole", "_hex")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "variant"))).alias("_variants"))
    )
    return recipes.withColumn("_hex", F.lower(F.hex("_sha"))).join(variants, ["_whole", "_hex"], "left").drop("_hex")


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                params: ChunkParams = ChunkParams()) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat id and text, one stays."""
    groups = _groups(docs, id_column, text_column, params).where("group_size > 1")
    return keep_rows(docs, groups.select("doc_id", F.col("_whole").alias("whole"), "kept"), id_column, text_column)
