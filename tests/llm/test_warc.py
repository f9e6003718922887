import glob
import gzip
import hashlib

import pytest

from pagetables.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a/", "same", "x"), (2, "http://b/ c\r\nd", "same", "x"), (2, "http://b/", "same", "x"), (2, "http://b/", "other", "x"),
        (3, None, None, "x"), (4, "", "", "x"), (None, "http://n/", "same", None), (None, "http://n/", "alone", None), (None, "http://m/", "alone", None),
        (5, "http://é/%20", "ü" * 100_000 + "\r\n\r\n", "x"), (6, "http://a/", "\r\n\r\nWARC/1.1", "x"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string").selectExpr("*", "digest AS shard", "digest AS tag")


def test_odd_rows(spark, pages, tmp_path):
    warc.write_warc(pages, f"{tmp_path}/w")
    rows = warc.read_warc(spark, f"{tmp_path}/w", payloads=True).collect()
    assert len(rows) == pages.count()
    got = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in rows)
    assert got == sorted([
        (1, "response", 0, 4), (2, "revisit", 1, 4), (2, "revisit", 1, 4), (2, "response", 0, 5), (3, "response", 0, 0),
        (4, "revisit", 3, 0), (0, "revisit", 1, 4), (0, "response", 0, 5), (0, "revisit", 0, 5),
        (5, "response", 0, 200_004), (6, "response", 0, 12),
    ])
    assert {bytes(r.payload) for r in rows if r.payload is not None} == {(r.html or "").encode() for r in pages.collect()}
    assert any(r.url == "http://b/%20c%0D%0Ad" for r in rows)


def test_no_rows(spark, pages, tmp_path):
    warc.write_warc(pages.where("false"), f"{tmp_path}/w")
    assert warc.read_warc(spark, f"{tmp_path}/w").count() == 0


def digests(path):
    return {p.rsplit("/", 1)[1]: hashlib.sha1(open(p, "rb").read()).hexdigest() for p in glob.glob(f"{path}/*.warc.gz")}


def test_same_files_again_with_other_partitions_and_rolled_by_size(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    params = warc.WarcParams(shard_bytes=40_000, roll_bytes=8_000)
    warc.write_warc(pages, f"{tmp_path}/a", params)
    warc.write_warc(pages.repartition(7), f"{tmp_path}/b", params)
    a = digests(f"{tmp_path}/a")
    assert a == digests(f"{tmp_path}/b") and len(a) > 4
    assert any(name.endswith("-00001.warc.gz") for name in a)
    manifest = {r.name: r.sha1 for r in spark.read.parquet(f"{tmp_path}/a/manifest").collect()}
    assert manifest == a
    text = gzip.open(glob.glob(f"{tmp_path}/a/*-000000-00000.warc.gz")[0]).read()  # a plain gzip reader reads it too
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_rolled_by_compressed_size_with_the_parameters_of_the_query(spark, tmp_path):
    """Pages of random letters, which hardly shrink: more than one file of a shard, none far beyond the size at which it closes."""
    from pyspark.sql import functions as F

    noise = F.concat_ws("", *[F.sha2(F.concat_ws("-", F.lit(k), "id"), 512) for k in range(150)])
    pages = spark.range(0, 600, 1, 4).select(F.col("id").alias("page_id"), F.lit("http://a/").alias("url"), noise.alias("html"))
    warc.write_warc(pages, f"{tmp_path}/w")
    files = spark.read.parquet(f"{tmp_path}/w/manifest").orderBy("name").collect()
    roll = warc.WarcParams().roll_bytes
    assert len(files) == 4 and {r.shard for r in files} == {0}
    assert all(roll <= r.compressed_bytes < roll + 100_000 for r in files[:-1]) and files[-1].compressed_bytes < roll
    assert sum(r.records for r in files) == 600 == warc.read_warc(spark, f"{tmp_path}/w").distinct().count()


def test_hot_ids_are_dealt_to_shards_of_their_own(spark, tmp_path):
    """A third of the rows has no id, and a third has one id."""
    from pyspark.sql import functions as F

    page = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, -1).otherwise(F.col("id"))
    html = F.repeat(F.concat((F.col("id") % 200).cast("string"), F.lit(" ")), 50)
    pages = spark.range(600).select(page.alias("page_id"), F.lit("http://a/").alias("url"), html.alias("html"))
    params = warc.WarcParams(shard_bytes=20_000)
    for name, rows in (("a", pages), ("b", pages.repartition(5))):
        warc.write_warc(rows, f"{tmp_path}/{name}", params)
    assert digests(f"{tmp_path}/a") == digests(f"{tmp_path}/b")
    files = spark.read.parquet(f"{tmp_path}/a/manifest").groupBy("shard").agg(F.sum("records").alias("n")).collect()
    assert max(r.n for r in files) <= 80 and sum(r.n for r in files) == 600
    got = warc.read_warc(spark, f"{tmp_path}/a").toPandas()
    # 200 payloads, each in three rows: one response and two that revisit it
    assert len(got) == 600 and (got.record_type == "response").sum() == 200
    assert (got.page_id.isna()).sum() == 200 and (got.page_id == -1).sum() == 200
    want = pages.groupBy("html").agg(F.min("page_id").alias("first"))
    firsts = {hashlib.sha1(r.html.encode()).hexdigest(): r.first for r in want.collect()}
    import base64

    for r in got.itertuples():
        if r.record_type == "revisit":
            assert r.refers_to == firsts[base64.b32decode(r.payload_digest).hex()]


def test_a_file_without_its_manifest_row_does_not_count(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    warc.write_warc(pages, f"{tmp_path}/w")
    with open(f"{tmp_path}/w/pages-999999-00000.warc.gz", "wb") as file:
        file.write(b"left by a lost executor")
    assert warc.read_warc(spark, f"{tmp_path}/w").count() == pages.count()


def test_a_damaged_payload_is_found():
    data = warc._page_record(1, "http://a/", b"payload", 0, 1, warc.WarcParams())
    record = gzip.decompress(data)
    fields, block = warc.parse_record(record)
    assert warc._row(fields, block, False)[2] == 7
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload\r\n", b"paymoad\r\n"))
