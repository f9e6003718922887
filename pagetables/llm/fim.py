"""Fill-in-middle transformation, with a document's unit boundaries in a compressed set."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of
from .worker import release

#: Lines with their ends; the last may have none.
LINES = r"[^\n]*\n|[^\n]+"


class BoundarySet:
    """Rising positions in containers of 65,536, with the number of positions before each container.

    A container holds the low 16 bits of its positions as an array (few of them), as runs (first, last, and how many come before)
    where these are shorter, or as a bitmap with the number of bits before each word. ``select`` finds the container by its
    cumulative count, and the position inside it from the container alone.
    """

    ARRAY, RUN, BITMAP = range(3)

    def __init__(self, positions: np.ndarray):
        high = positions >> 16
        edges = np.flatnonzero(np.diff(high, prepend=-1, append=-1))
        self.keys = high[edges[:-1]] if len(positions) else np.zeros(0, np.int64)
        self.before = edges if len(positions) else np.zeros(1, np.int64)
        self.containers = [self._container(positions[a:b] & 0xFFFF) for a, b in zip(self.before[:-1], self.before[1:])]

    def __len__(self) -> int:
        return int(self.before[-1])

    def _container(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        # bytes: 2 a position, 6 a run (with its count), 8192 a bitmap and 2048 its counts
        array, run, bitmap = 2 * len(low), 6 * len(first), 8192 + 2048
        if run < min(array, bitmap):
            return self.RUN, (low[first].astype(np.uint16), np.append(first, len(low)).astype(np.int32))
        if array <= bitmap:
            return self.ARRAY, low.astype(np.uint16)
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        return self.BITMAP, (words, np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int32))))

    def select(self, rank: int) -> int:
        """The position with so many before it."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.before, rank, side="right")) - 1
        kind, held = self.containers[at]
        own = rank - int(self.before[at])
        if kind == self.ARRAY:
            low = int(held[own])
        elif kind == self.RUN:
            firsts, counts = held
            run = int(np.searchsorted(counts, own, side="right")) - 1
            low = int(firsts[run]) + own - int(counts[run])
        else:
            words, counts = held
            word = int(np.searchsorted(counts, own, side="right")) - 1
            bits = np.unpackbits(words[word:word + 1].view(np.uint8), bitorder="little")
            low = word * 64 + int(np.flatnonzero(bits)[own - int(counts[word])])
        return (int(self.keys[at]) << 16) + low


@dataclass(frozen=True)
class FimParams:
    unit: str = LINES  # matched left to right; what lies between matches belongs to the unit after it
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: int = 7
    percent: int = 100  # of documents are cut
    spm_percent: int = 50  # of those start with the suffix


def boundaries(text: str, data: bytes, unit: str) -> BoundarySet:
    """Where units end, in bytes of the UTF-8 text."""
    if unit == LINES:
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x0A) + 1
        if data and not data.endswith(b"\n"):
            ends = np.append(ends, len(data))
        return BoundarySet(ends.astype(np.int64))
    ends = np.fromiter((m.end() for m in re.finditer(unit, text) if m.end() > m.start()), np.int64)
    if not text.isascii() and len(ends):
        widths = np.fromiter(map(len, map(str.encode, text)), np.int64, len(text))
        ends = np.cumsum(widths)[ends - 1]
    return BoundarySet(ends)


def choices(doc_id, seed: int) -> tuple[int, int, int, int]:
    """Four numbers that a document's id and the seed fix; a null id is an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k:k + 8], 16) for k in range(0, 32, 8))


def cut(doc_id, text: str, params: FimParams) -> tuple[int, str, bytes, bytes, bytes]:
    """(units, form, prefix, middle, suffix) of one text; a plain one is all prefix."""
    data = text.encode()
    ends = boundaries(text, data, params.unit)
    n = len(ends)
    h1, h2, h3, h4 = choices(doc_id, params.seed)
    marks = (params.prefix, params.suffix, params.middle)
    if not data or any(m in text for m in marks) or h3 % 100 >= params.percent:
        return n, "plain", data, b"", b""
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends.select(k - 1) if k else 0 for k in (low, high))
    return n, "spm" if h4 % 100 < params.spm_percent else "psm", data[:a], data[a:b], data[b:]


def joined(form: str, prefix: bytes, middle: bytes, suffix: bytes, params: FimParams) -> bytes:
    p, s, m = params.prefix.encode(), params.suffix.encode(), params.middle.encode()
    if form == "psm":
        return b"".join((p, prefix, s, suffix, m, middle))
    if form == "spm":
        return b"".join((s, suffix, p, prefix, m, middle))
    return prefix


def restored(output: bytes, form: str, params: FimParams = FimParams()) -> bytes:
    """The text that an output was made of. Marks are found from the left; the text itself holds none."""
    if form == "plain":
        return output
    first, second = (params.prefix, params.suffix) if form == "psm" else (params.suffix, params.prefix)
    head, _, middle = output[len(first.encode()):].partition(params.middle.encode())
    left, _, right = head.partition(second.encode())
    return left + middle + right if form == "psm" else right + middle + left


FIM = "units long, form string, output string, prefix_bytes long, middle_bytes long, prefix_chars long, middle_chars long"


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", params: FimParams = FimParams()) -> DataFrame:
    """(doc_id, units, form, output, prefix_bytes, middle_bytes, prefix_chars, middle_chars): each whole text cut
    in three at unit ends and put together as prefix, suffix, middle (psm) or suffix, prefix, middle (spm).

    The cuts hang on the id and the seed only. Empty texts, those that hold a mark, and those beyond ``percent`` stay as they are (plain, without
    lengths). A null text is an empty one, a null id counts as an empty one. Rows that repeat an id are cut alike if their texts are equal.
    No rows give no rows. Other columns are ignored.
    """

    def transform(stream):
        release()
        for batch in stream:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, form, prefix, middle, suffix = cut(doc_id, text.as_py(), params)
                plain = form == "plain"
                out.append((
                    n, form, joined(form, prefix, middle, suffix, params).decode(),
                    *((None,) * 4 if plain else (len(prefix), len(middle), len(prefix.decode()), len(middle.decode()))),
                ))
            kinds = (pa.int64(), pa.string(), pa.string(), *(pa.int64(),) * 4)
            names = [x.split()[0] for x in FIM.split(", ")]
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return rows.mapInArrow(transform, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FIM}")


def restore(outputs: DataFrame, params: FimParams = FimParams()) -> DataFrame:
    """Rows of ``fill_in_middle`` with ``text``, rebuilt from output and form alone."""
    names = outputs.columns

    def rebuild(stream):
        at = [names.index(c) for c in ("output", "form")]
        for batch in stream:
            texts = [restored(o.encode(), f, params).decode() for o, f in zip(*(batch.column(k).to_pylist() for k in at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema)
    return outputs.mapInArrow(rebuild, f"{fields}, text string")


def fim_digests(docs: DataFrame, path: str, params: FimParams = FimParams()) -> DataFrame:
    """Write the outputs as Parquet, read them back, restore them, and digest both.

    (doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256).
    """
    spark = docs.sparkSession
    made = fill_in_middle(docs, params=params)
    with small_batches(spark):
        made.write.option("compression", "zstd").parquet(path)
    back = restore(spark.read.schema(made.schema).parquet(path), params)
    return back.select(
        "doc_id", F.col("units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )
