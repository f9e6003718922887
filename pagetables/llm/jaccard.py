"""Self-join of documents' shingle sets by Jaccard similarity, skipping by relations between sets.

Sets that are equal are one class. Each class puts a prefix of its set, in one global order of shingles, into an inverted
index; two similar sets share a shingle of their prefixes. Lists are ordered by set size and skipped in blocks by size and
position. Similar classes form units, and only units are paired, so that a group of near copies isn't multiplied out;
the overlaps within and between units are derived from the differences of each set to one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized, small_batches, stage, text_of
from .components import components
from .shingles import mix, shingle_coder


@dataclass(frozen=True)
class JoinParams:
    shingle: int = 4  # words
    near: int = 85  # sets are linked if 100 * intersection >= near * union
    seed: int = 11
    counted: int = 2  # prefixes in which shingles are counted are so many times as long, as common ones make way to those behind
    common: int = 8  # shingles in more prefixes than this come last in the order, which changes no result
    most_common: int = 1 << 20  # as many of them as are sent to the tasks; the most frequent
    unit_rows: int = 256  # most classes of a unit
    unit_shingles: int = 1 << 20  # about as many shingles in a unit, or one set
    list_rows: int = 8192  # most entries of a list that one task pairs

    def prefix(self, n: np.ndarray | int):
        """How many shingles of a set of ``n`` have to be indexed: a similar set holds one of them."""
        return n + (-self.near * n) // 100 + 1


SETS = "doc_id {kind}, whole long, n int, key1 long, key2 long, first long, tokens array<long>, common int, sketch binary"


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def sketch_of(own: np.ndarray) -> bytes:
    """For each of 2^k places the parity of how many shingles fall on it; as many places as shingles, 64 to 65,536.

    Two sets differ in at least as many shingles as their sketches differ in bits.
    """
    places = min(1 << 16, max(64, 1 << (len(own) - 1).bit_length()))
    parity = np.bincount((own & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch of ``size`` bytes, a power of two and not longer than it is, as words."""
    bits = np.frombuffer(sketch, np.uint64)
    while bits.nbytes > size:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def shingle_sets(docs: DataFrame, id_column: str, text_column: str, params: JoinParams, common: np.ndarray | None = None) -> DataFrame:
    """One row per document: size, two numbers that name the set, its least shingle, the prefix, its part of ``common`` shingles and the sketch.

    The order of shingles puts those of ``common`` (sorted) last, each part by number. Without it, the prefixes are those for counting.
    """
    def prefix(own: np.ndarray) -> tuple[np.ndarray, int]:
        want = params.prefix(len(own))
        if common is None:
            return own[:params.counted * want], 0
        if not len(common) or not len(own):
            return own[:want], 0
        upto = min(len(own), want + 8)
        while True:
            head = own[:upto]
            usual = common[np.minimum(np.searchsorted(common, head), len(common) - 1)] != head
            if upto == len(own) or np.count_nonzero(usual) >= want:
                break
            upto = min(len(own), 2 * upto)
        tokens = np.concatenate((head[usual], head[~usual]))[:want]
        return tokens, max(0, want - int(np.count_nonzero(usual)))

    def make(stream):
        coder = shingle_coder(params.shingle, params.seed)
        names = np.array([0xA5A5A5A5A5A5A5A5, 0x3C3C3C3C3C3C3C3C], np.uint64)
        for batch in stream:
            sets = coder.sets(batch.column(2))
            found = [prefix(own) for own in sets]
            keys = [np.array([mix(own ^ x).sum(dtype=np.uint64) for own in sets], np.uint64) for x in names]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(own) for own in sets], pa.int32()),
                    *[pa.array(_signed(k)) for k in keys],
                    pa.array(_signed(np.array([own[0] if len(own) else 0 for own in sets], np.uint64))),
                    _lists([_signed(tokens) for tokens, _ in found], pa.int64()),
                    pa.array([n for _, n in found], pa.int32()),
                    pa.array([sketch_of(own) if len(own) else b"" for own in sets], pa.binary()),
                ],
                names=["doc_id", "whole", "n", "key1", "key2", "first", "tokens", "common", "sketch"],
            )

    rows = _texts(docs, id_column, text_column)
    return rows.mapInArrow(make, SETS.format(kind=rows.schema["doc_id"].dataType.simpleString()))


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(text_of(text_column)).alias("whole"), text_of(text_column).alias("_text")
    )


def common_shingles(sets: DataFrame, params: JoinParams) -> np.ndarray:
    """Shingles in the prefixes of more than ``common`` different sets, at most ``most_common`` of them, sorted."""
    each = sets.where("n > 0").groupBy("n", "key1", "key2").agg(F.any_value("tokens").alias("tokens"))
    counts = each.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("sets")).where(F.col("sets") > params.common)
    found = counts.orderBy(F.desc("sets"), "token").limit(params.most_common).select("token").toArrow()
    return np.sort(np.asarray(found.column(0).combine_chunks()).view(np.uint64))


def classes_of(sets: DataFrame) -> DataFrame:
    """One row per distinct set, with a number of its own, how many documents have it, and one row of those."""
    each = sets.where("n > 0").groupBy("n", "key1", "key2").agg(
        F.min(F.struct("doc_id", "whole")).alias("row"), F.min("doc_id").alias("least"), F.count("*").alias("members"),
        *[F.any_value(c).alias(c) for c in ("first", "tokens", "common", "sketch")],
    )
    return stage(each.withColumn("class", F.monotonically_increasing_id()), "shingle-classes")


def units_of(classes: DataFrame, params: JoinParams) -> DataFrame:
    """(class, unit): classes with the same least shingle whose sketches are alike are a unit, named after one of them.

    Units only say which sets are compared together. A crowded shingle's classes are dealt over units of bounded size.
    """
    crowds = classes.groupBy("first").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles")).where("rows > 1").select(
        "first", F.greatest(F.ceil(F.col("rows") / params.unit_rows), F.ceil(F.col("shingles") / params.unit_shingles)).alias("parts")
    )
    crowds = sized(stage(crowds, "crowded-shingles"))
    met = classes.select("class", "first", "n", "sketch").join(crowds, "first").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")))
    groups = met.groupBy("first", "part").agg(F.collect_list(F.struct("class", "n", "sketch")).alias("own"))

    def cluster(stream):
        for batch in stream:
            out = []
            for own in _rows(batch.column(0), ("class", "n", "sketch")):
                names, sizes, sketches = own["class"], own["n"], own["sketch"]
                open_ = np.argsort(-sizes, kind="stable")
                while len(open_):
                    lead, rest = open_[0], open_[1:]
                    width = min([len(sketches[k]) for k in open_])
                    bits = folded(sketches[lead], width)
                    apart = np.array([np.bitwise_count(bits ^ folded(sketches[k], width)).sum() for k in rest], np.int64)
                    alike = np.concatenate(([True], apart * 10 < 3 * 8 * width)) if len(rest) else np.array([True])
                    out += [(names[k], names[lead]) for k in open_[alike]]
                    open_ = open_[~alike]
            found = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["class", "unit"])

    return stage(groups.select("own").mapInArrow(cluster, "class long, unit long"), "units")


def _rows(column, names: tuple[str, ...]):
    """The elements of each list of structs: numbers as arrays, others as they are."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets, values = np.asarray(lists.offsets), lists.values
    fields = {}
    for name in names:
        field = values.field(name)
        if pa.types.is_binary(field.type):
            fields[name] = field.to_pylist()
        elif pa.types.is_list(field.type):
            flat, ends = np.asarray(field.values).view(np.uint64), np.asarray(field.offsets)
            fields[name] = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        else:
            fields[name] = np.asarray(field)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield {name: f[a:b] for name, f in fields.items()}


LISTS = ["token", "low", "high", "unit", "part", "least", "most", "rest", "before"]


def unit_pairs(classes: DataFrame, params: JoinParams) -> DataFrame:
    """(u, v) with u < v: units of which two sets may be similar, by the lists of the index.

    An entry is a set's size, how many of its shingles follow from here on in the order, and the shingle before. Classes of a unit
    share an entry in lists of common shingles. A list that is too long for one task is dealt by parts of its units:
    each pair of parts is paired in a task of its own.
    """
    each = classes.select(
        "unit", "n", "common", F.size("tokens").alias("upto"), "tokens", F.posexplode("tokens").alias("at", "token")
    ).select(
        "token", "unit", "n", (F.col("n") - F.col("at")).alias("rest"),
        F.when(F.col("at") > 0, F.get("tokens", F.col("at") - 1)).otherwise(0).alias("before"),
        (F.col("at") >= F.col("upto") - F.col("common")).alias("common"),
    )
    zero = F.lit(0)
    usual = each.where("NOT common").select(
        "token", zero.alias("low"), zero.alias("high"), "unit", zero.alias("part"), F.col("n").alias("least"), F.col("n").alias("most"), "rest", "before"
    )
    first = stage(_paired(usual.unionByName(_split(each.where("common"), params)), params), "list-pairs")
    long = first.where("u IS NULL").select(F.col("v").alias("token"))
    found = [first.where("u IS NOT NULL")]
    if not long.isEmpty():
        found.append(_paired(_split(each.where("NOT common").join(sized(long), "token", "left_semi"), params), params))
    every = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return every.distinct()


def _split(entries: DataFrame, params: JoinParams) -> DataFrame:
    """Entries of common shingles, one per unit, with long lists dealt to the pairs of their parts."""
    own = entries.groupBy("token", "unit").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest"),
        F.when(F.min("before") == F.max("before"), F.min("before")).otherwise(0).alias("before"),
    )
    own = stage(own, "common-entries")
    half = params.list_rows // 2
    long = own.groupBy("token").count().where(F.col("count") > params.list_rows).select("token", F.ceil(F.col("count") / half).cast("int").alias("parts"))
    long = sized(stage(long, "long-lists"))
    zero = F.lit(0)
    short = own.join(long, "token", "left_anti").select(
        "token", zero.alias("low"), zero.alias("high"), "unit", zero.alias("part"), "least", "most", "rest", "before"
    )
    dealt = own.join(long, "token").withColumn("part", F.pmod(F.xxhash64("unit"), F.col("parts")).cast("int")).select(
        "*", F.explode(F.sequence(zero, F.col("parts") - 1)).alias("other")
    ).select("token", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "unit", "part", "least", "most", "rest", "before")
    return short.unionByName(dealt)


def _paired(lists: DataFrame, params: JoinParams) -> DataFrame:
    near, limit = params.near, 2 * params.list_rows

    def possible(x, y, a, b):
        """Which entries a and b (places in x and y) may belong to similar sets that first meet here."""
        return (
            (x["unit"][a] != y["unit"][b])
            & (100 * x["most"][a] >= near * y["least"][b]) & (100 * y["most"][b] >= near * x["least"][a])
            & ((100 + near) * np.minimum(x["rest"][a], y["rest"][b]) >= near * (x["least"][a] + y["least"][b]))
            & ((x["before"][a] != y["before"][b]) | (x["before"][a] == 0))
            & ((x["low"][a] == x["high"][a]) | (x["part"][a] != y["part"][b]))
        )

    def blocks(x, begin, end, size=256):
        """Pairs of a long list, which rises by size: blocks that no set's size or position can reach are skipped."""
        for a in range(begin, end, size):
            upto = min(a + size, end)
            rows = np.arange(a, upto)
            most, rest = x["most"][a:upto].max(), x["rest"][a:upto].max()
            for b in range(a, end, size):
                if near * x["least"][b] > 100 * most:
                    break
                to = min(b + size, end)
                if (100 + near) * min(rest, x["rest"][b:to].max()) < near * (x["least"][a] + x["least"][b]):
                    continue
                i, j = (g.ravel() for g in np.meshgrid(rows, np.arange(b, to), indexing="ij"))
                good = possible(x, x, i, j) & (i < j)
                yield i[good], j[good]

    def pairs(x, ends):
        begins = np.concatenate(([0], ends[:-1]))
        sizes = ends - begins
        few = np.repeat(sizes <= 64, sizes)
        group = np.repeat(np.arange(len(sizes)), sizes)
        step = 1
        while True:  # each entry of short lists with the next, the next but one and so on
            same = np.flatnonzero(few[:-step] & (group[:-step] == group[step:]))
            if not len(same):
                break
            good = same[possible(x, x, same, same + step)]
            yield x["unit"][good], x["unit"][good + step]
            step += 1
        for k in np.flatnonzero((sizes > 64) & (sizes <= limit)):
            for i, j in blocks(x, int(begins[k]), int(ends[k])):
                yield x["unit"][i], x["unit"][j]

    def run(stream):
        held, skipping = None, None
        for batch in _with_end(stream):
            if batch is not None:
                x = {name: np.asarray(batch.column(k)).astype(np.int64) for k, name in enumerate(LISTS)}
                if held:
                    x = {name: np.concatenate((held[name], x[name])) for name in LISTS}
            else:
                x = held or {}
            if not x or not len(x["token"]):
                continue
            key = np.stack([x["token"], x["low"], x["high"]])
            changes = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            ends = np.append(changes, key.shape[1])
            begin = int(ends[-2]) if len(ends) > 1 else 0
            held = None
            out_u, out_v, out_long = [], [], []
            if batch is not None:  # the last list may go on
                held, ends = {name: v[begin:] for name, v in x.items()}, ends[:-1]
                x = {name: v[:begin] for name, v in x.items()}
                if len(held["token"]) > limit:  # too long a list: only its name is kept
                    skipping = held["token"][0]
                    held = {name: v[:1] for name, v in held.items()}
            if len(ends):
                names = x["token"][ends - 1]
                sizes = np.diff(np.concatenate(([0], ends)))
                out_long += names[(sizes > limit) | ((names == skipping) if skipping is not None else False)].tolist()
                for u, v in pairs(x, ends):
                    out_u.append(np.minimum(u, v))
                    out_v.append(np.maximum(u, v))
            found = np.concatenate(out_u) if out_u else np.zeros(0, np.int64), np.concatenate(out_v) if out_v else np.zeros(0, np.int64)
            once = np.unique(np.stack(found), axis=1) if len(found[0]) else np.zeros((2, 0), np.int64)
            lone = np.unique(np.array(out_long, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(once[0]), pa.nulls(len(lone), pa.int64())]),
                    pa.concat_arrays([pa.array(once[1]), pa.array(lone)]),
                ],
                names=["u", "v"],
            )

    ordered = lists.select(*LISTS).repartition("token", "low", "high").sortWithinPartitions("token", "low", "high", "least")
    return ordered.mapInArrow(run, "u long, v long")


def _with_end(stream):
    yield from stream
    yield None


def alike_pairs(pairs: DataFrame, classes: DataFrame, params: JoinParams) -> DataFrame:
    """The pairs of units of which some two sets have sketches near enough. None that holds a link goes."""
    own = classes.select("class", "unit", "n", "sketch").join(
        pairs.select(F.explode(F.array("u", "v")).alias("unit")).distinct(), "unit", "left_semi"
    ).groupBy("unit").agg(F.collect_list(F.struct("class", "n", "sketch")).alias("own"))
    own = stage(own, "sketches")
    near = params.near

    def test(stream):
        for batch in stream:
            keep = np.zeros(batch.num_rows, bool)
            sides = [_rows(batch.column(k), ("n", "sketch")) for k in (2, 3)]
            for k, (a, b) in enumerate(zip(*sides)):
                width = min(map(len, a["sketch"] + b["sketch"]))
                first, second = (np.stack([folded(s, width) for s in side["sketch"]]) for side in (a, b))
                for bits, n in zip(first, a["n"]):
                    apart = np.bitwise_count(second ^ bits).sum(axis=1, dtype=np.int64)
                    if (apart * (100 + near) <= (100 - near) * (n + b["n"].astype(np.int64))).any():
                        keep[k] = True
                        break
            yield batch.filter(pa.array(keep)).select(["u", "v"])

    both = pairs.join(own.select(F.col("unit").alias("u"), F.col("own").alias("a")), "u").join(
        own.select(F.col("unit").alias("v"), F.col("own").alias("b")), "v"
    )
    return both.select("u", "v", "a", "b").mapInArrow(test, "u long, v long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all the sets, derived from what each differs in from the first.

    With R = L without A1 and with B1, S = L without A2 and with B2: |R and S| = |L| - |A1| - |A2| + |what both differ in|.
    """
    lead = sets[0]
    apart = [np.setxor1d(lead, own, assume_unique=True) for own in sets]
    gone = np.array([(len(lead) - len(own) + len(d)) // 2 for own, d in zip(sets, apart)], np.int64)
    flat = np.concatenate(apart)
    row = np.repeat(np.arange(len(sets)), [len(d) for d in apart])
    values, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.zeros((len(sets), len(sets)), np.float64)
    column = np.full(len(values), -1, np.int64)
    often = np.flatnonzero(count > 1)
    column[often] = np.arange(len(often))
    place = column[place]
    for a in range(0, len(often), 4096):
        own = (place >= a) & (place < a + 4096)
        table = np.zeros((len(sets), 4096), np.float32)
        table[row[own], place[own] - a] = 1
        shared += table @ table.T
    np.fill_diagonal(shared, [len(d) for d in apart])
    return len(lead) - gone[:, None] - gone[None, :] + np.rint(shared).astype(np.int64)


def _verified(params: JoinParams):
    """Per pair of units: how many documents each class is linked with (a, null, links), and edges (a, b, 0) that connect what is linked."""
    near, names = params.near, ("class", "n", "members", "shingles")

    def verify(stream):
        for batch in stream:
            out = []
            same = np.asarray(batch.column(0)) == np.asarray(batch.column(1))
            for k, (a, b) in enumerate(zip(*(_rows(batch.column(c), names) for c in (2, 3)))):
                sets = a["shingles"] if same[k] else a["shingles"] + b["shingles"]
                n, cls, members = (a[c] if same[k] else np.concatenate((a[c], b[c])) for c in ("n", "class", "members"))
                both, first = overlaps(sets), len(a["n"])
                linked = 100 * both >= near * (n[:, None].astype(np.int64) + n[None, :] - both)
                if same[k]:
                    np.fill_diagonal(linked, False)
                else:
                    linked[:first, :first] = linked[first:, first:] = False
                links = linked @ members
                out += [(int(c), None, int(m)) for c, m in zip(cls, links) if m]
                out += [(int(cls[x]), int(cls[y]), 0) for x, y in _forest(linked)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names=["a", "b", "links"]
            )

    return verify


def _forest(linked: np.ndarray):
    """Edges that connect what the matrix links: one fewer than each part has members."""
    open_ = linked.any(axis=1)
    while open_.any():
        order = [int(np.flatnonzero(open_)[0])]
        open_[order[0]] = False
        while order:
            x = order.pop()
            for y in np.flatnonzero(linked[x] & open_).tolist():
                open_[y] = False
                order.append(y)
                yield x, y


def linked_classes(docs: DataFrame, classes: DataFrame, pairs: DataFrame, id_column: str, text_column: str, params: JoinParams) -> DataFrame:
    """(a, b, links) as of ``_verified``, staged. Only documents of units that are compared are read again."""
    crowded = classes.groupBy("unit").count().where("count > 1").select("unit")
    every = stage(pairs.unionByName(crowded.select(F.col("unit").alias("u"), F.col("unit").alias("v"))), "compared-units")
    units = every.select(F.explode(F.array("u", "v")).alias("unit")).distinct()
    needed = stage(classes.join(units, "unit", "left_semi").select("class", "unit", "n", "members", "row.*"), "compared-classes")

    def make(stream):
        coder = shingle_coder(params.shingle, params.seed)
        for batch in stream:
            sets = [_signed(own) for own in coder.sets(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(sets, pa.int64())], names=["doc_id", "whole", "shingles"])

    texts = _texts(docs, id_column, text_column)
    names = sized(needed.select(F.col("doc_id").alias("_id"), F.col("whole").alias("_whole")))
    read = texts.join(names, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("whole") == F.col("_whole")), "left_semi")
    sets = read.mapInArrow(make, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, whole long, shingles array<long>")
    sets = sets.select(F.col("doc_id").alias("_id"), F.col("whole").alias("_whole"), "shingles")
    of = needed.join(sets, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("whole") == F.col("_whole")))
    # a row that is repeated gives its set once
    of = of.groupBy("unit", "class", "n", "members").agg(F.any_value("shingles").alias("shingles"))
    own = stage(of.groupBy("unit").agg(F.collect_list(F.struct("class", "n", "members", "shingles")).alias("own")), "unit-sets")
    both = every.join(own.select(F.col("unit").alias("u"), F.col("own").alias("a")), "u").join(
        own.select(F.col("unit").alias("v"), F.col("own").alias("b")), "v"
    )
    return stage(both.select("u", "v", "a", "b").mapInArrow(_verified(params), "a long, b long, links long"), "class-links")


def similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", params: JoinParams = JoinParams()) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, members, links).

    A document's set holds its distinct shingles of ``params.shingle`` words, A-Z lower-cased; a text of fewer words is one shingle. Two documents
    are linked if 100 * intersection >= near * union. ``component_id`` is the smallest id reachable, ``members`` the size of that component,
    ``links`` the number of documents linked with. Null and wordless texts have no set and are linked with nothing. Rows that repeat an id are documents of their own;
    null ids are never the smallest unless there is no other. No rows give no rows. Other columns are ignored. Shingles are told apart by
    64-bit numbers and sets by 128 bits.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        common = common_shingles(shingle_sets(docs, id_column, text_column, params), params)
        sets = stage(shingle_sets(docs, id_column, text_column, params, common), "shingle-sets")
    classes = classes_of(sets)
    units = sized(units_of(classes, params))
    classes = stage(classes.join(units, "class", "left").withColumn("unit", F.coalesce("unit", "class")), "classes")
    pairs = stage(unit_pairs(classes, params), "unit-pairs")
    with small_batches(spark, 64):
        near = stage(alike_pairs(pairs, classes, params), "alike-pairs")
        found = linked_classes(docs, classes, near, id_column, text_column, params)
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "class")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("linked"))
    told = classes.select("class", "n", "key1", "key2", "least", "members").join(roots, "class", "left").join(links, "class", "left")
    told = stage(told.where("members > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "class")), "linked-classes")
    tops = told.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("members").alias("size"))
    told = told.join(tops, "root").select(
        "n", "key1", "key2", "component_id", "size", (F.col("members") - 1 + F.coalesce("linked", F.lit(0))).alias("links")
    )
    told = sized(stage(told, "told"))
    whole = sets.select("doc_id", "n", "key1", "key2").join(told, ["n", "key1", "key2"], "left")
    return whole.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("members"), F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )
