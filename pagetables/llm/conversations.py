"""Prefix trie of conversations by whole-sequence collapse.

Turns are numbered and digested once; from then on rows are narrow. A prefix is named by the XOR of its turns' digests, each of
which is bound to its place, so that running XORs over bounded stretches of turns name all prefixes of a conversation
of any length. Identical conversations collapse to one weighted sequence, and only sequences are unfolded into prefixes.
"""

from __future__ import annotations

from dataclasses import dataclass
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, parts_for, sized, stage

KEY = ("key1", "key2")


@dataclass(frozen=True)
class TrieParams:
    stretch: int = 1 << 15  # turns of one conversation that are handled together
    part_bytes: int = 16 << 20  # of input to a range of turns
    chunk: int = 1 << 13  # ids of members that are joined to one text at a time
    crowd: int = 1 << 16  # nodes with more children are looked up apart from others


def _digest(role: str, text: str) -> tuple[list[Column], list[Column]]:
    """Role and text without nulls, and 120 bits of their SHA-256 as two numbers."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    digest = F.sha2(F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said), 256)
    lanes = [F.conv(F.substring(digest, begin, 15), 16, 10).cast("long").alias(f"digest{k}") for k, begin in ((1, 1), (2, 16))]
    return said, lanes


def turn_rows(table: DataFrame, params: TrieParams = TrieParams(), conv: str = "conv_id", turn: str = "turn",
              role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, digest1, digest2, words): the turns of each conversation numbered from 1, staged.

    Turns rise, null first; equal ones are ordered by the SHA-256 of role and text, so that repeated rows are turns of their own. Null
    roles and texts are empty ones. Rows without a conversation id belong to none and are left out. The numbering
    is by ranges of rows, so a conversation may be spread over many tasks.
    """
    said, lanes = _digest(role, text)
    rows = table.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), *lanes,
        F.regexp_count(said[1], F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["turn", "digest1", "digest2"]
    told = rows.groupBy("conv_id", *order).agg(F.max("words").alias("words"), F.count("*").alias("times"))
    ranged = told.repartitionByRange(parts_for(table, params.part_bytes), "conv_id", *order)
    rows = stage(ranged.withColumn("part", F.spark_partition_id()), "turns")
    sums = rows.groupBy("conv_id", "part").agg(F.sum("times").alias("times"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("conv_id", "part", F.coalesce(F.sum("times").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv_id", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("upto", F.sum("times").over(within)).join(offsets, ["conv_id", "part"])
    last = F.col("before") + F.col("upto")
    return stage(
        placed.select("conv_id", F.explode(F.sequence(last - F.col("times") + 1, last)).alias("place"), "digest1", "digest2", "words"),
        "numbered-turns",
    )


def shared_heads(turns: DataFrame, every: int = 20, ways: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on shared heads: (turns, lengths), where lengths has every conversation, also one without turns.

    Conversation c takes the first h turns of conversation c - c % every, h = crc32(c as text) % ways, and its own turns after its first h.
    The remainder has the sign of c, as in SQL.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    c = F.col("conv_id")
    heads = sizes.select("conv_id", "own", (c - c % every).alias("base"), (F.crc32(c.cast("string").cast("binary")) % ways).alias("h"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("have"))
    heads = heads.join(bases, "base", "left").withColumn("got", F.least("h", F.coalesce("have", F.lit(0))))
    heads = stage(heads.select("conv_id", "base", "h", "got", (F.greatest(F.col("own") - F.col("h"), F.lit(0)) + F.col("got")).alias("turns")), "heads")
    # few turns of few conversations: the first ones of each base
    given = turns.where((c % every == 0) & (F.col("place") < ways)).withColumnRenamed("conv_id", "base")
    first = given.join(heads.where("got > 0").select("conv_id", "base", "got"), "base").where("place <= got").select(*turns.columns)
    moved = sized(heads.select("conv_id", "h", "got"))
    rest = turns.join(moved, "conv_id").where("place > h").withColumn("place", F.col("place") - F.col("h") + F.col("got")).select(*turns.columns)
    return stage(first.unionByName(rest), "rebuilt-turns"), heads.select("conv_id", "turns")


def own_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (turns, lengths)."""
    return turns, turns.groupBy("conv_id").agg(F.max("place").alias("turns"))


def prefixes(turns: DataFrame, params: TrieParams) -> tuple[DataFrame, DataFrame]:
    """Running names within stretches (conv_id, stretch, depth, mark1, mark2, run1, run2, words), and what lies before
    each stretch (conv_id, stretch, before1, before2, all1, all2). Both are staged."""
    marked = turns.select(
        "conv_id", F.floor((F.col("place") - 1) / params.stretch).alias("stretch"), F.col("place").alias("depth"),
        F.xxhash64("place", "digest1", "digest2").alias("mark1"), F.xxhash64(F.lit(7), "place", "digest1", "digest2").alias("mark2"), "words",
    )
    line = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = stage(marked.select(
        "*", F.bit_xor("mark1").over(line).alias("run1"), F.bit_xor("mark2").over(line).alias("run2")
    ), "running-names")
    totals = running.groupBy("conv_id", "stretch").agg(F.bit_xor("mark1").alias("all1"), F.bit_xor("mark2").alias("all2"))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = totals.select(
        "conv_id", "stretch", *[F.coalesce(F.bit_xor(f"all{k}").over(before), F.lit(0).cast("long")).alias(f"before{k}") for k in (1, 2)], "all1", "all2",
    )
    return running, stage(stretches, "stretches")


def end_lists(sequences: DataFrame, params: TrieParams) -> DataFrame:
    """(turns, key1, key2, ends_sha256): the digest of each sequence's members' ids, ascending and joined by commas.

    Ranges of members are joined to texts side by side; what is then hashed in order is a stream of these texts.
    """
    key = ["turns", *KEY]
    parts = parts_for(sequences, params.part_bytes)
    chunks = params.chunk

    def join_ids(stream):
        held, ids, first = None, [], None
        out: list[tuple] = []

        def close():
            if ids:
                out.append((*held, first, ",".join(map(str, ids))))
                ids.clear()

        for batch in stream:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != held or len(ids) >= chunks:
                    close()
                    held, first = row[:3], row[3]
                ids.append(row[3])
            yield _batch(out, ("turns", *KEY, "first"), "ids")
            out.clear()
        close()
        yield _batch(out, ("turns", *KEY, "first"), "ids")

    def hash_all(stream):
        held, state, out = None, None, []
        for batch in stream:
            for *name, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if name != held:
                    if state:
                        out.append((*held, state.hexdigest()))
                    held, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(out, ("turns", *KEY), "ends_sha256")
            out.clear()
        if state:
            out.append((*held, state.hexdigest()))
        yield _batch(out, ("turns", *KEY), "ends_sha256")

    kinds = "turns long, key1 long, key2 long"
    ordered = sequences.select(*key, "conv_id").repartitionByRange(parts, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
    texts = ordered.mapInArrow(join_ids, f"{kinds}, first long, ids string")
    return texts.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(hash_all, f"{kinds}, ends_sha256 string")


def _batch(rows: list[tuple], numbers: tuple[str, ...], text: str) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(numbers))]
    return pa.RecordBatch.from_arrays([*columns, pa.array([r[-1] for r in rows], pa.string())], names=[*numbers, text])


def trie(turns: DataFrame, lengths: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """One row per node, that is per distinct sequence of the first d turns of some conversation, d = 0 included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, key1, key2): conv_id is the least member,
    saved_tokens sums (n_convs - 1) * words of the last turn over the subtree, ends_sha256 digests the ids of the conversations
    that end here. ``turns`` is (conv_id, place, digest1, digest2, words) with places from 1 on without gaps, ``lengths`` has a row (conv_id, turns)
    for every conversation. No conversations give no rows. Prefixes are told apart by their depth and 128 bits.
    """
    running, stretches = prefixes(turns, params)
    zero = F.lit(0).cast("long")
    names = stretches.groupBy("conv_id").agg(F.bit_xor("all1").alias("key1"), F.bit_xor("all2").alias("key2"))
    whole = lengths.join(names, "conv_id", "left").select(
        "conv_id", F.col("turns").cast("long").alias("turns"), F.coalesce("key1", zero).alias("key1"), F.coalesce("key2", zero).alias("key2")
    )
    whole = stage(whole, "whole-sequences")

    # identical conversations collapse; each sequence is unfolded once, from its least member's turns
    sequences = stage(whole.groupBy("turns", *KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight")), "sequences")
    own = stretches.join(sequences.select("conv_id", "weight", "turns"), "conv_id")
    unfolded = running.join(own.select("conv_id", "stretch", "before1", "before2", "weight", "turns"), ["conv_id", "stretch"]).select(
        "conv_id", "stretch", "depth", "words", "weight", "turns",
        *[F.col(f"run{k}").bitwiseXOR(F.col(f"before{k}")).alias(f"key{k}") for k in (1, 2)],
        *[F.col(f"run{k}").bitwiseXOR(F.col(f"before{k}")).bitwiseXOR(F.col(f"mark{k}")).alias(f"up{k}") for k in (1, 2)],
    )
    root = sequences.select(
        "conv_id", F.lit(-1).cast("long").alias("stretch"), zero.alias("depth"), zero.alias("words"), "weight", "turns",
        zero.alias("key1"), zero.alias("key2"), zero.alias("up1"), zero.alias("up2"),
    )
    unfolded = stage(unfolded.unionByName(root), "unfolded")
    proper = unfolded.where("depth < turns").select(F.col("depth").alias("turns"), *KEY).distinct()
    leaves = sequences.join(proper, ["turns", *KEY], "left_anti").select("conv_id")

    nodes = stage(unfolded.groupBy("depth", *KEY).agg(
        F.min(F.struct("conv_id", "stretch")).alias("first"), F.sum("weight").alias("n_convs"), F.max("words").alias("words"),
        F.min("up1").alias("up1"), F.min("up2").alias("up2"),
    ).select("depth", *KEY, "first.*", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), "up1", "up2"), "nodes")

    # A sequence that is the least member of a node is that of all nodes below on its path: it owns the end of its path.
    # What a node saves with all below: the rest of its owner's path, and all that the other sequences through it own.
    owned = nodes.groupBy("conv_id", "stretch").agg(F.sum("saved").alias("saved"), F.min("depth").alias("top"))
    after = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(1, Window.unboundedFollowing)
    line = Window.partitionBy("conv_id", "stretch").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    later = owned.select("conv_id", "stretch", F.coalesce(F.sum("saved").over(after), F.lit(0)).alias("later"))
    below = nodes.withColumn("own", F.sum("saved").over(line)).join(later, ["conv_id", "stretch"]).select(
        "depth", *KEY, (F.col("own") + F.col("later")).alias("saved")
    )
    ends = owned.groupBy("conv_id").agg(F.sum("saved").alias("all_saved"), F.min("top").alias("top"))
    told = ends.join(leaves.withColumn("leaf", F.lit(1)), "conv_id", "left")
    each = unfolded.select("conv_id", "stretch").distinct().join(told, "conv_id")
    through = unfolded.join(each, ["conv_id", "stretch"]).select(
        "depth", *KEY, F.coalesce("leaf", F.lit(0)).alias("leaf"), F.when(F.col("depth") < F.col("top"), F.col("all_saved")).otherwise(0).alias("saved")
    )
    sums = through.select("depth", *KEY, "leaf", "saved").unionByName(below.select("depth", *KEY, F.lit(0).alias("leaf"), "saved")).groupBy("depth", *KEY).agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    up = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("key1"), F.col("up2").alias("key2")).agg(
        F.count("*").alias("n_children")
    )
    last = end_lists(whole, params).withColumnRenamed("turns", "depth")
    done = nodes.join(sums, ["depth", *KEY]).join(up, ["depth", *KEY], "left").join(last, ["depth", *KEY], "left").select(
        "depth", *KEY, "conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "up1", "up2",
    )
    done = stage(done, "trie-nodes")
    parents = done.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("key1").alias("up1"), F.col("key2").alias("up2"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    # the few parents of very many nodes go to these; all others are joined
    crowded = sized(stage(parents.where(F.col("n_children") > params.crowd).drop("n_children"), "crowded-parents"))
    few = parents.where(F.col("n_children") <= params.crowd).drop("n_children")
    on = ["depth", "up1", "up2"]
    top = done.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    rest = done.where("depth > 0")
    found = rest.join(crowded, on).unionByName(rest.join(crowded, on, "left_anti").join(few, on)).unionByName(top.select(*on, *[c for c in top.columns if c not in on]))
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "key1", "key2"
    )


def node_texts(nodes: DataFrame, turns: DataFrame, table: DataFrame, conv: str = "conv_id",
               role: str = "role", text: str = "text") -> DataFrame:
    """Nodes below the root with the role and text of their last turn, found by its digest."""
    said, lanes = _digest(role, text)
    texts = table.where(F.col(conv).isNotNull()).select(*lanes, said[0].alias("role"), said[1].alias("text")).dropDuplicates(["digest1", "digest2"])
    at = turns.select("conv_id", F.col("place").alias("depth"), "digest1", "digest2")
    return nodes.join(at, ["conv_id", "depth"]).join(texts, ["digest1", "digest2"]).drop("digest1", "digest2")
