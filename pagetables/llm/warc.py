"""WARC archives of pages: a deterministic sharded writer and a reader."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sized, stage

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcParams:
    prefix: str = "pages"
    shard_bytes: int = 32 << 20  # of payload, before compression: what a task sorts and writes
    roll_bytes: int = 2 << 20  # a file is closed when it has so many compressed bytes; a shard is one file or several
    least_revisit: int = 0  # payloads with fewer bytes are always written in full
    date: str = "1970-01-01T00:00:00Z"
    level: int = 4  # of gzip
    split_sample: int = 50_000  # page ids from which the shards' bounds are taken


MANIFEST = "name string, shard int, records long, compressed_bytes long, sha1 string"
NO_ID = -(1 << 63)  # stands for a null page_id where ids are compared
RECORD_BYTES = 512  # about what a record holds beside its payload
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def write_warc(pages: DataFrame, path: str, params: WarcParams = WarcParams()) -> None:
    """Write a record for each row (page_id, url, html) into gzipped WARC files under ``path``, and a manifest of them.

    Records are sorted by page_id over shards, whose bounds come from ids drawn by their hash, so
    the same pages give the same files. An id (or none) whose rows hold more than a shard gets shards of its own after all others, to which
    its payloads are dealt by their hash. Of equal payloads (same SHA-1, second hash and length), the
    smallest page_id's is a response and others revisit it; of rows that repeat that id and payload, the first
    is. Files get their names when they are complete, under the same name on every attempt, and
    count when the manifest, which is written last, lists them.

    A null html is an empty payload, a null url an empty one, a null page_id comes last among equals and
    refers to none if all are null. No rows give a manifest without files. Other columns are ignored.
    """
    p = params
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    key = [F.sha1("payload").alias("digest"), F.xxhash64("payload").alias("second")]
    narrow = stage(rows.select("page_id", *key, F.length("payload").cast("long").alias("bytes")), "payloads")
    again = stage(
        narrow.where(F.col("bytes") >= p.least_revisit).groupBy("digest", "second", "bytes")
        .agg(F.min("page_id").alias("refers"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "repeated-payloads",
    )
    bounds = _bounds(narrow, p)
    hot, parts = _hot(narrow, p)
    firsts = len(bounds) + 1 + np.cumsum(parts) - parts

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series, seconds: pd.Series) -> pd.Series:
        own = ids.to_numpy(np.int64)
        shards = np.searchsorted(bounds, own, side="right")
        if len(hot):
            at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
            shards = np.where(hot[at] == own, firsts[at] + seconds.to_numpy(np.int64) % parts[at], shards)
        return pd.Series(shards.astype(np.int32))

    decided = (
        narrow.join(sized(again), ["digest", "second", "bytes"]).select("page_id", "digest", "second", "refers").distinct()
        .select("page_id", "digest", "second", F.lit(0).alias("tag"), "refers", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    )
    every = decided.unionByName(
        rows.select("page_id", *key, F.lit(1).alias("tag"), F.lit(None).cast("long").alias("refers"), "url", "payload")
    ).withColumn("shard", shard_of(F.coalesce("page_id", F.lit(NO_ID)), "second"))
    # a page's decision comes right before it; the payloads move once
    order = ["shard", F.col("page_id"), "digest", "second", "tag", "url"]
    sorted_rows = every.repartitionById(len(bounds) + 1 + int(parts.sum()), "shard").sortWithinPartitions(*order)
    manifest = sorted_rows.select("shard", "page_id", "digest", "second", "tag", "refers", "url", "payload").mapInArrow(_writer(path, p), MANIFEST)
    manifest.write.parquet(f"{path}/manifest")


def _bounds(narrow: DataFrame, params: WarcParams) -> np.ndarray:
    """Ids at which shards begin, about equal in bytes, from a bounded sample drawn by the ids' hash."""
    n, total = narrow.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    shards = -(-total // params.shard_bytes)
    if shards < 2:
        return np.zeros(0, np.int64)
    every = max(1, n // params.split_sample)
    drawn = narrow.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0))
    drawn = drawn.groupBy("page_id").agg(F.sum("bytes").alias("bytes")).toPandas().sort_values("page_id")
    ends = drawn["bytes"].cumsum().to_numpy()
    if not len(ends):
        return np.zeros(0, np.int64)
    at = np.searchsorted(ends, ends[-1] * np.arange(1, shards) / shards, side="right")
    ids = drawn["page_id"].to_numpy()
    return np.unique(ids[np.minimum(at, len(ids) - 1)])


def _hot(narrow: DataFrame, params: WarcParams) -> tuple[np.ndarray, np.ndarray]:
    """Ids whose payloads hold more than a shard, in order, and the shards each is given; there are fewer of them than shards."""
    heavy = narrow.groupBy("page_id").agg(F.sum(F.col("bytes") + RECORD_BYTES).alias("bytes")).where(F.col("bytes") > params.shard_bytes)
    rows = heavy.select(F.coalesce("page_id", F.lit(NO_ID)).alias("id"), "bytes").groupBy("id").agg(F.sum("bytes").alias("bytes")).collect()
    rows.sort()
    return np.array([r.id for r in rows], np.int64), np.array([-(-r.bytes // params.shard_bytes) for r in rows], np.int64)


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{copy}').urn}>"


def _header(fields: dict[str, object], length: int) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    return VERSION + b"\r\n" + "\r\n".join([*lines, f"Content-Length: {length}"]).encode("utf-8") + b"\r\n\r\n"


def _pressed(header: bytes, block: bytes, level: int) -> bytes:
    """One record as a gzip member, without a time, so that equal records give equal bytes."""
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(header + block + b"\r\n\r\n") + press.flush()


def _escaped(url: str) -> str:
    """White space and controls can't stand in a header line."""
    return re.sub(r"[\x00-\x20\x7f-\xa0%]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode("utf-8")) if m.group() != "%" else "%", url)


def _writer(path: str, p: WarcParams):
    def write(stream):
        from .files import Committed

        attempt = TaskContext.get().taskAttemptId()
        out = shard = decision = last = None
        number = records = size = copies = 0
        sha = hashlib.sha1()

        def close():
            nonlocal out
            out.commit()
            row = (name, shard, records, size, sha.hexdigest())
            out = None
            return pa.RecordBatch.from_arrays([pa.array([x]) if k != 1 else pa.array([x], pa.int32()) for k, x in enumerate(row)], names=["name", "shard", "records", "compressed_bytes", "sha1"])

        for batch in stream:
            shards, ids, digests, seconds, tags, refers, urls = (batch.column(k).to_pylist() for k in range(7))
            payloads = batch.column(7)
            for k in range(batch.num_rows):
                key = (ids[k], digests[k], seconds[k])
                if tags[k] == 0:
                    decision, first = key, refers[k]
                    continue
                if out and shards[k] != shard:
                    yield close()
                if shards[k] != shard:
                    shard, number = shards[k], 0
                if not out:
                    name = f"{p.prefix}-{shard:06d}-{number:05d}.warc.gz"
                    number, records, size, sha = number + 1, 0, 0, hashlib.sha1()
                    out = Committed(path, name, attempt)
                    block = b"software: pagetables\r\nformat: WARC File Format 1.1\r\n"
                    info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<{uuid.uuid5(uuid.NAMESPACE_URL, name).urn}>", "WARC-Date": p.date, "WARC-Filename": name, "Content-Type": "application/warc-fields"}
                    data = _pressed(_header(info, len(block)), block, p.level)
                    out.write(data)
                    sha.update(data)
                    size += len(data)
                copies = copies + 1 if key == last else 0
                last = key
                payload = payloads[k].as_py()
                data = _page_record(ids[k], urls[k], payload, copies, first if key == decision else ids[k], p)
                out.write(data)
                sha.update(data)
                size, records = size + len(data), records + 1
                if size >= p.roll_bytes:
                    yield close()
        if out:
            yield close()

    return write


def _page_record(page_id, url, payload: bytes, copies: int, refers, p: WarcParams) -> bytes:
    digest = _digest(payload)
    revisit = refers != page_id or copies > 0
    if len(payload) < p.least_revisit:
        revisit = False
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id, digest, copies),
        "WARC-Date": p.date,
        "WARC-Target-URI": _escaped(url),
        "Page-ID": page_id,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{_digest(block)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _record_id(refers, digest, 0), "Refers-To-Page-ID": refers}
    return _pressed(_header(fields, len(block)), block, p.level)


def members(stream, piece: int = 1 << 18):
    """The gzip members of a file one by one, read in pieces; memory holds one record."""
    rest = b""
    while True:
        unpress, parts = zlib.decompressobj(31), []
        while not unpress.eof:
            data = rest or stream.read(piece)
            rest = b""
            if not data:
                if parts:
                    raise ValueError("the archive ends within a record")
                return
            parts.append(unpress.decompress(data))
            rest = unpress.unused_data
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.decode("utf-8").split(": ", 1) if b": " in line else (line.decode("utf-8").rstrip(":"), "") for line in lines[1:])
    block = body[: int(fields["Content-Length"])]
    if "WARC-Block-Digest" in fields and fields["WARC-Block-Digest"] != f"sha1:{_digest(block)}":
        raise ValueError(f"the block of {fields['WARC-Record-ID']} differs from its digest")
    return fields, block


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per page record of the files that the manifest lists:
    (page_id, url, payload_bytes, payload_digest, record_type, refers_to), with ``payloads`` also payload (null for revisits).

    Sizes and digests of responses are counted from their payloads and held against the headers;
    those of revisits, which have no payload, are the headers'.
    """
    def read(stream):
        from .files import filesystem

        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in stream:
            for name in batch.column(0).to_pylist():
                system, root = filesystem(path)
                rows, held = [], 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as file:
                    for record in members(file):
                        fields, block = parse_record(record)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_row(fields, block, payloads))
                        held += len(block) if payloads else 200
                        if held > 1 << 22:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    manifest = _listed(spark, path)
    return manifest.mapInArrow(read, RECORDS + (", payload binary" if payloads else ""))


def _listed(spark: SparkSession, path: str) -> DataFrame:
    names = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").select("name")
    files = names.count()
    return names.repartition(max(1, files), "name")


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if revisit:
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    else:
        size = len(payload)
        if _digest(payload) != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} differs from its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    row = (number("Page-ID"), fields["WARC-Target-URI"], size, digest, fields["WARC-Type"], number("Refers-To-Page-ID"))
    return (*row, None if revisit else payload) if payloads else row
