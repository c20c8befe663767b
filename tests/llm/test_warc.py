"""WARC bundles: exact round trips, random access, and bundles on their own."""

from __future__ import annotations

import hashlib
import io
import random

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from farelane.llm import queries
from farelane.llm.op11_warc import (
    BundleReader,
    BundleWriter,
    fetch_records,
    page_of,
    read_index,
    read_warc,
    record_id,
    warc_round_trip,
    with_first,
    write_warc,
)

SCHEMA = "page_id long, url string, html string, digest int, first string, page string, frame long, start string"
TEXT = "<p>" + "é" * 200


@pytest.fixture
def pages(spark):
    rows = [
        (5, "http://a/b c\r\nWARC-Type: x 1%20+", TEXT),
        (3, None, TEXT),
        (3, None, TEXT),
        (None, "u", TEXT),
        (7, "é", "short"),
        (8, "é", "short"),
        (9, "", None),
        (-4, "e", ""),
        (None, "q", "y\r\n\r\nWARC/1.1\r\n" * 30),
        (None, "q", "y\r\n\r\nWARC/1.1\r\n" * 30),
        (11, "long", "word \r\n\r\n" * 100_000),
        (12, "long", "word \r\n\r\n" * 100_000),
        (13, "edge", "z" * 100),
        (14, "edge", "z" * 100),
        (15, "edge", "z" * 99),
        (16, "edge", "z" * 99),
    ]
    return spark.createDataFrame([(*r, 1, "f", "p", 2, "s") for r in rows], SCHEMA)


def expected(rows):
    """Brute force: page, bytes, digest, type and what is referred to."""
    first = {}
    for page, html in rows:
        if page is not None:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, html in rows:
        data = (html or "").encode()
        target = first.get(html) if len(data) >= 100 else None
        revisit = target is not None and target != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


def found(df):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_round_trip(pages):
    rows = [(r.page_id, r.html) for r in pages.collect()]
    assert found(warc_round_trip(pages)) == expected(rows)


def test_query(spark, sf_dir):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert found(queries.QUERIES["op11_warc"](spark, sf_dir)) == expected(rows)


def test_payloads_and_uris_come_back(spark, pages, tmp_path):
    index = write_warc(pages, str(tmp_path), frame_bytes=500, bundle_bytes=400)
    records = read_warc(spark, str(tmp_path)).collect()
    assert index.count() == len(records) == 16
    whole = {r.html or "" for r in pages.collect()}
    assert {r.payload for r in records if r.record_type == "response"} == whole
    by_page = {page_of(r.record_id): r for r in records}
    assert by_page["5"].target_uri == "http://a/b c\r\nWARC-Type: x 1%20+"
    assert by_page["5"].refers_to_id == record_id("3") and by_page["5"].payload is None
    assert by_page["3"].target_uri is None and by_page["9"].target_uri == ""
    assert by_page[None].payload == "y\r\n\r\nWARC/1.1\r\n" * 30 or by_page[None].refers_to_id == record_id("3")


def test_fetch_reads_only_what_is_asked_for(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"page {i} " * 40, 0, "", "", 0, "") for i in range(300)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    write_warc(pages, str(tmp_path), frame_bytes=2000, bundle_bytes=3000)
    index = read_index(spark, str(tmp_path))
    assert index.select("bundle").distinct().count() > 3 and index.agg(F.max("frame")).first()[0] > 1
    wanted = index.filter(F.col("record_id").isin([record_id(str(i)) for i in (0, 17, 299)]))
    got = {page_of(r.record_id): r.payload for r in fetch_records(wanted, str(tmp_path)).collect()}
    assert got == {str(i): f"page {i} " * 40 for i in (0, 17, 299)}


def test_frames_are_independent():
    sink, contents = io.BytesIO(), [b"a" * 300_000, b"", random.Random(1).randbytes(1000), b"z"]
    writer = BundleWriter(sink)
    for content in contents:
        writer.frame(content)
    writer.close()
    data = sink.getvalue()
    reader = BundleReader(pa.BufferReader(data))
    assert [reader.frame(i) for i in (3, 1, 0, 2)] == [contents[i] for i in (3, 1, 0, 2)]
    # A reader of plain streams skips the seek table.
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == b"".join(contents)


def test_damage_is_seen():
    with pytest.raises(ValueError, match="footer"):
        BundleReader(pa.BufferReader(b"not a bundle of frames"))
    with pytest.raises(ValueError, match="footer"):
        BundleReader(pa.BufferReader(b""))


def test_a_frequent_payload_is_broadcast(spark):
    """A third of all rows share one payload, others share theirs with one row each."""
    rows = spark.range(6000).select(
        F.col("id").alias("page"),
        F.lit("u").alias("url"),
        F.when(F.col("id") % 3 == 0, F.lit(TEXT)).otherwise(F.concat(F.lit(TEXT), (F.col("id") % 3000).cast("string"))).alias("html"),
    )
    got = with_first(rows).groupBy("first").count().collect()
    sizes = {r["first"]: r["count"] for r in got}
    assert sizes[0] == 2000 and sum(sizes.values()) == 6000 and sorted(sizes.values())[-2] == 2


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert warc_round_trip(none).count() == 0
    assert write_warc(none, str(tmp_path)).count() == 0


def test_text_ids(spark):
    pages = spark.createDataFrame([("a/ä %2B", None, TEXT), ("b", None, TEXT)], "page_id string, url string, html string")
    rows = {r.page_id: r.refers_to for r in warc_round_trip(pages).collect()}
    assert rows == {"a/ä %2B": None, "b": "a/ä %2B"}
