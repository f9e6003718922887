"""Best-fit packing of token pieces into sequences by a linear grouping scheme."""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stage, text_of
from .worker import release


@dataclass(frozen=True)
class PackParams:
    capacity: int = 1024
    groups: int = 512  # of large lengths, with equally many pieces each
    small: int = 256  # shorter pieces only fill gaps; at most three others share a sequence
    part_rows: int = 1 << 16  # rows of a part in which ranks are counted
    batch_rows: int = 600  # documents that go to Python at a time


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
           id_column: str = "doc_id", text_column: str = "text", ids: bool = False, keep: int = 200_000,
           chars: int = 2_000_000) -> DataFrame:
    """Token pieces of whole texts: (doc_id, piece, start, length, ids_crc32), with ``ids`` also token_ids.

    A document's ids and the end id are cut only if they are more than ``capacity``; then the first
    piece has what is over and the others are full. A null text is an empty one and gives the end id alone. Texts of any length are encoded whole.
    No rows give no rows. ``keep`` words are remembered and about ``chars`` characters encoded together: more of both is faster and takes more memory.
    """
    schema = PIECES + (", token_ids array<int>" if ids else "")

    def cut(stream):
        from .tokens import batches, coder, crc32_of

        code = coder(tokenizer, keep)
        for batch in stream:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in batches(texts, chars):
                flat, lengths = code.encode(texts.slice(a, b - a))
                ends = np.cumsum(lengths)
                flat = np.insert(flat, ends, end_id)
                total = lengths + 1
                begins = np.cumsum(total) - total
                count = -(-total // capacity)
                over = total - (count - 1) * capacity  # length of the first piece
                doc = np.repeat(np.arange(b - a), count)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = np.where(nth == 0, 0, over[doc] + (nth - 1) * capacity)
                length = np.where(nth == 0, over[doc], capacity)
                at = begins[doc] + start
                columns = [
                    keys.slice(a, b - a).take(pa.array(doc)),
                    pa.array(nth.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array([crc32_of(flat[x:y]) for x, y in zip(at.tolist(), (at + length).tolist())], pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if ids:
                    offsets = np.append(at, len(flat)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    return rows.mapInArrow(cut, schema)


# --- the plan: from counts of lengths alone, at most ``capacity`` numbers however many pieces there are ---


@dataclass(frozen=True)
class Group:
    size: int  # the longest length in it
    begin: int  # ranks among the large pieces, from long to short
    end: int


def linear_groups(histogram: dict[int, int], count: int) -> list[Group]:
    """Lengths from long to short in groups of equal cardinality, each rounded up to its longest."""
    lengths = sorted(histogram, reverse=True)
    ends = np.cumsum([histogram[n] for n in lengths])
    total = int(ends[-1]) if lengths else 0
    step = max(1, -(-total // count))
    return [
        Group(lengths[int(np.searchsorted(ends, a, side="right"))], a, min(a + step, total))
        for a in range(0, total, step)
    ]


def configurations(groups: list[Group], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Which groups share a sequence, and how many sequences do so.

    Always the largest size left, with the one or two sizes that fill it best and what else fits, and as
    often as the counts allow. So each step uses up a size, and the steps are a few per group.
    """
    left = [g.end - g.begin for g in groups]
    rising = sorted((g.size, k) for k, g in enumerate(groups))
    out = []
    for lead in range(len(groups)):  # sizes fall
        while left[lead]:
            left[lead] -= 1
            room, chosen = capacity - groups[lead].size, [lead]
            while True:
                open_sizes = [(size, k) for size, k in rising if size <= room and left[k]]
                best = _fullest(open_sizes, left, room)
                if not best:
                    break
                for k in best:
                    left[k] -= 1
                    room -= groups[k].size
                chosen += best
            need = {k: chosen.count(k) for k in chosen}
            more = min(left[k] // n for k, n in need.items())
            for k, n in need.items():
                left[k] -= n * more
            out.append((tuple(chosen), 1 + more))
    return out


def _fullest(sizes: list[tuple[int, int]], left: list[int], room: int) -> list[int]:
    """The one or two groups that leave the least room, rather one than two."""
    if not sizes:
        return []
    best, total = [sizes[-1][1]], sizes[-1][0]
    low, high = 0, len(sizes) - 1
    while low <= high and total < room:
        both = sizes[low][0] + sizes[high][0]
        if both > room:
            high -= 1
            continue
        if both > total and (low != high or left[sizes[low][1]] > 1):
            best, total = [sizes[high][1], sizes[low][1]], both
        low += 1
    return best


def best_fit(gaps: dict[int, int], counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, tuple[int, ...]]]:
    """Small lengths, longest first, each into the least gap that takes it: (gap, from, to, lengths) by
    rank among equal gaps. Gap ``capacity`` stands for new sequences.

    Sequences with equal gaps and content go together as one run, so there are a few runs per
    length, however many sequences they stand for.
    """
    runs = sorted((gap, gap, 0, n, ()) for gap, n in gaps.items() if gap and n)  # room, gap, from, to, content
    fresh = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(runs, (length,))
            if at == len(runs):
                n = max(1, left // (capacity // length))
                insort(runs, (capacity, capacity, fresh, fresh + n, ()))
                fresh += n
                continue
            room, gap, begin, end, content = runs.pop(at)
            fit = room // length
            whole = min(end - begin, left // fit)
            times = fit
            if not whole:
                whole, times = 1, left
            insort(runs, (room - times * length, gap, begin, begin + whole, content + (length,) * times))
            left -= whole * times
            if begin + whole < end:
                insort(runs, (room, gap, begin + whole, end, content))
    return sorted((gap, begin, end, content) for _, gap, begin, end, content in runs if content)


# --- the plan applied to the pieces ---


def _ranked(rows: DataFrame, kind: str, order: list[str], total: int, part_rows: int) -> DataFrame:
    """Number the rows of each ``kind`` from 0: counted in parts of bounded size, then moved by what lies before."""
    parts = max(1, -(-total // part_rows))
    parted = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    before = Window.partitionBy("_kind").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        parted.groupBy(F.col(kind).alias("_kind"), F.col("_part").alias("_p")).count()
        .withColumn("_first", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    )
    own = F.row_number().over(Window.partitionBy(kind, "_part").orderBy(*order)) - 1
    return (
        parted.withColumn("_own", own)
        .join(firsts, (F.col(kind) == F.col("_kind")) & (F.col("_part") == F.col("_p")))
        .withColumn("_rank", (F.col("_own") + F.col("_first")).cast("long"))
        .drop("_own", "_first", "_kind", "_p", "_part")
    )


def _histogram(rows: DataFrame, column: str) -> dict[int, int]:
    """Counts per value; there are at most ``capacity`` values."""
    return {r[0]: r[1] for r in rows.groupBy(column).count().collect()}


def pack(parts: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32; length 1 to ``capacity``) in sequences: the same
    rows with sequence_id and offset.

    Full pieces have a sequence each. Large lengths are rounded up within groups of equal
    cardinality, few-size configurations are found from the counts, and the actual pieces take the
    rounded ones' places. Small pieces then go into the gaps by best fit. The driver sees counts per
    length only; pieces meet their places by their rank among equals, by joins and windows on narrow rows.

    Repeated rows are pieces of their own; null ids are ids like any other. No rows give no rows.
    """
    p = params
    with small_batches(parts.sparkSession, p.batch_rows):
        parts = stage(parts.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    counts = _histogram(parts, "length")
    order = ["doc_id", "piece", "start", "ids_crc32"]
    ranked = stage(_ranked(parts, "length", order, sum(counts.values()), p.part_rows), "ranked-pieces")
    full = counts.get(p.capacity, 0)
    large = {n: c for n, c in counts.items() if p.small <= n < p.capacity}
    small = {n: c for n, c in counts.items() if n < min(p.small, p.capacity)}
    plan, used = _places(linear_groups(large, p.groups), p.capacity, full)
    falling = sorted(large, reverse=True)
    before = dict(zip(falling, np.cumsum([0, *[large[n] for n in falling]]).tolist()))
    placed = stage(
        ranked.where(F.col("length") >= min(p.small, p.capacity)).mapInArrow(_place_large(plan, before, p.capacity), PLACED),
        "placed-pieces",
    )
    spaces = (
        placed.where(F.col("length") < p.capacity).groupBy("sequence_id")
        .agg((F.lit(p.capacity) - F.sum("length")).cast("long").alias("gap")).where("gap > 0")
    )
    spaces = stage(spaces, "gaps")
    gaps = _histogram(spaces, "gap")
    runs = best_fit(gaps, small, p.capacity)
    located = ranked.where(F.col("length") < min(p.small, p.capacity)).mapInArrow(_place_small(runs), LOCATED)
    fresh = located.where(F.col("gap") == p.capacity).withColumn("sequence_id", F.col("gap_rank") + used)
    numbered = _ranked(spaces, "gap", ["sequence_id"], sum(gaps.values()), p.part_rows).withColumnRenamed("_rank", "gap_rank")
    filled = located.where(F.col("gap") < p.capacity).join(numbered, ["gap", "gap_rank"])
    columns = [*order[:3], "length", "ids_crc32", "sequence_id"]
    every = placed.select(columns).unionByName(fresh.select(columns)).unionByName(filled.select(columns))
    line = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), *order)
    return every.withColumn(
        "offset", (F.sum("length").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).cast("long")
    )


PLACED = PIECES + ", sequence_id long"
LOCATED = PIECES + ", gap long, gap_rank long"


def _places(groups: list[Group], capacity: int, first: int):
    """Where the ranks of large pieces go: sorted (rank from, pieces per sequence, first sequence); the next free sequence."""
    cursor = [g.begin for g in groups]
    plan, sequence = [], first
    for chosen, times in configurations(groups, capacity):
        for k in dict.fromkeys(chosen):
            n = chosen.count(k)
            plan.append((cursor[k], n, sequence))
            cursor[k] += n * times
        sequence += times
    return np.array(sorted(plan), np.int64).reshape(-1, 3), sequence


def _place_large(plan: np.ndarray, before: dict[int, int], capacity: int):
    firsts = np.zeros(capacity + 1, np.int64)
    for length, rank in before.items():
        firsts[length] = rank

    def place(stream):
        release()
        for batch in stream:
            length, rank = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "_rank"))
            sequence = rank.copy()  # full pieces
            part = length < capacity
            if part.any():
                at = firsts[length[part]] + rank[part]
                row = plan[np.searchsorted(plan[:, 0], at, side="right") - 1]
                sequence[part] = row[:, 2] + (at - row[:, 0]) // row[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence)], names=[*batch.schema.names[:5], "sequence_id"])

    return place


_LENGTHS = 1 << 40  # ranks below this


def _place_small(runs):
    taken: dict[int, int] = {}
    plan = []
    for gap, begin, end, content in runs:
        for length in dict.fromkeys(content):
            n = content.count(length)
            at = taken.get(length, 0)
            plan.append((length * _LENGTHS + at, n, gap, begin))
            taken[length] = at + n * (end - begin)
    table = np.array(sorted(plan), np.int64).reshape(-1, 4)

    def place(stream):
        for batch in stream:
            length, rank = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "_rank"))
            at = length * _LENGTHS + rank
            row = table[np.searchsorted(table[:, 0], at, side="right") - 1]
            place_in = row[:, 3] + (at - row[:, 0]) // row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(row[:, 2]), pa.array(place_in)], names=[*batch.schema.names[:5], "gap", "gap_rank"]
            )

    return place
