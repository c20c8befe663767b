"""WARC records in seekable Zstandard bundles: independent frames, a seek table, an index of records."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.keys import broadcast_if_small
from farelane.session import fresh_path, hadoop_path, save_table

#: Bytes of records after which a frame ends, compressed bytes after which a bundle does, and the level.
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 32 << 20, 3
#: Bundles that a task reads, where there are many.
TASK_BUNDLES = 4
#: Bytes from which on an equal payload is written once and revisited.
LEAST_BYTES = 100
#: Of so many rows, one may share its payload without being dealt out as a frequent one; there are
#: at most as many frequent payloads, so that they can be broadcast.
FREQUENT = 1000

# Fixed values of the seekable format: the magic numbers of a skippable frame and of the seek table.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
# Fixed value of WARC 1.1: the profile of a revisit by payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, bundle string, frame long, start long, size long, part long"
RECORD = (
    "record_id string, record_type string, target_uri string, refers_to_id string, "
    "payload_bytes long, payload_digest string, payload string"
)


# ---- bundles: frames of bytes with a seek table ----


class BundleWriter:
    """Appends frames to an output stream and ends it with the seek table."""

    def __init__(self, out, level: int = LEVEL) -> None:
        self.out, self.sizes, self.written = out, [], 0
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)

    def frame(self, content: bytes) -> None:
        packed = self.compressor.compress(content)
        self.out.write(packed)
        self.sizes.append((len(packed), len(content)))
        self.written += len(packed)

    def close(self) -> None:
        """The seek table: a skippable frame of each frame's sizes, their number, no checksums."""
        table = b"".join(struct.pack("<II", *x) for x in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class BundleReader:
    """Frames of a bundle by number; only the footer and what is asked for are read."""

    def __init__(self, source) -> None:
        self.source = source
        end = source.size()
        n, flags, magic = struct.unpack("<IBI", self._read(end - 9, 9)) if end >= 17 else (0, 0, 0)
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a seekable bundle: the footer is missing")
        entry = 12 if flags & 0x80 else 8
        table = self._read(end - 9 - n * entry, n * entry)
        self.frames, at = [], 0
        for i in range(n):
            packed, content = struct.unpack_from("<II", table, i * entry)
            self.frames.append((at, packed, content))
            at += packed

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        found = self.source.read(size)
        if len(found) != size:
            raise ValueError("the bundle is cut off")
        return found

    def frame(self, number: int) -> bytes:
        at, packed, content = self.frames[number]
        found = zstandard.ZstdDecompressor().decompressobj().decompress(self._read(at, packed))
        if len(found) != content:
            raise ValueError("a frame is not as large as the seek table says")
        return found


# ---- records ----


def record_id(page: str | None) -> str:
    """The identifier of a page's record, a URI that holds the page's id; all null ids share one."""
    return "urn:page" if page is None else f"urn:page:{quote(page, safe='')}"


def page_of(identifier: str) -> str | None:
    """The page's id in a record's identifier."""
    return unquote(identifier.removeprefix("urn:page:")) if identifier.startswith("urn:page:") else None


def record_bytes(
    page: str | None, url: str | None, date: str, payload: bytes, digest: str, refers_to: str | None
) -> bytes:
    """One record: a response with its payload, or the revisit of another page's response, which keeps
    the head of the answer, with the payload's length, alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id(page)}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        # What can't stand in a URI, line ends above all, is escaped; a per cent sign too, to be undone.
        fields.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_id(refers_to)}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed_records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Start, size, fields and block of each record of a frame."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"not a record of WARC 1.1: {version[:20]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = end + 4
        after = block + int(fields["Content-Length"])
        if content[after : after + 4] != b"\r\n\r\n":
            raise ValueError(f"the record {fields['WARC-Record-ID']} does not end where it says")
        yield at, after + 4 - at, fields, content[block:after]
        at = after + 4


def read_record(fields: dict[str, str], block: bytes, with_payload: bool) -> dict:
    """The columns of a record. A response's payload is measured and hashed anew, and has to agree."""
    head, payload = block.split(b"\r\n\r\n", 1)
    length = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (length, digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what was written")
    url, other = fields.get("WARC-Target-URI"), fields.get("WARC-Refers-To")
    return {
        "record_id": fields["WARC-Record-ID"][1:-1],
        "record_type": kind,
        "target_uri": None if url is None else unquote(url),
        "refers_to_id": None if other is None else other[1:-1],
        "payload_bytes": length,
        "payload_digest": digest,
        "payload": payload.decode() if with_payload and kind == "response" else None,
    }


# ---- Spark: which pages revisit, writing, reading ----


def with_first(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``page``, ``url``, ``html``, ``digest`` and ``first``, the smallest page of those with the same
    payload where there are several of ``least`` bytes or more.

    Pages are counted by payload with a map-side combine. Payloads that more than one of ``FREQUENT``
    rows share are few and broadcast; the others are joined, and have few rows each. Where nothing is
    shared no page is shuffled.
    """
    keyed = pages.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    groups = keyed.filter(F.octet_length("html") >= least).groupBy("digest")
    groups = groups.agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = save_table(groups, "shared-payloads")
    # At most rows / (rows / FREQUENT) of them.
    most = (shared.agg(F.sum("c")).first()[0] or 0) // FREQUENT
    frequent = shared.filter(F.col("c") > most).select("digest", F.col("first").alias("hot"))
    rest = shared.filter(F.col("c") <= most).select("digest", F.col("first").alias("cold"))
    found = keyed.join(F.broadcast(frequent), "digest", "left")
    if most and rest.limit(1).count():
        found = found.join(broadcast_if_small(rest), "digest", "left")
    else:
        found = found.withColumn("cold", F.lit(None).cast(shared.schema["first"].dataType))
    return found.select("page", "url", "html", "digest", F.coalesce("hot", "cold").alias("first"))


def write_warc(
    pages: DataFrame,
    root: str,
    least: int = LEAST_BYTES,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    date: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write a record for each row of ``pages`` below ``root``; return the index of records.

    ``root`` is a folder that executors share, by a path or URI of which Arrow has the file system.
    Each task writes bundles of its own: frames of whole records, each compressed for itself, and a
    seek table at the end. The index has for each record its identifier, bundle, frame, and where it
    stands in the frame. A bundle is named by its part, number and the task's attempt and gets this
    name when it is whole: a repeated task writes other bundles, and only those that the index names
    count. A task holds one frame; a record larger than that is a frame of its own.

    Of rows with equal payloads of at least ``least`` bytes, those of the smallest id are responses
    and the others revisit them; smaller payloads are all responses. A null payload is empty. A null
    id is larger than every other; payloads of null ids alone are all responses. A null URL is left
    out. Repeated rows are records with one identifier. An empty table writes no bundle.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches):
        task = TaskContext.get()
        files, folder = arrow_fs.FileSystem.from_uri(f"{root}/data")
        part, number, bundle, out, temporary = task.partitionId(), 0, None, None, ""
        frame, size, places = [], 0, []

        def open_bundle():
            nonlocal bundle, out, temporary, name
            files.create_dir(folder, recursive=True)
            name = f"{part:08d}-{number:05d}-{task.taskAttemptId()}.warc.zst"
            temporary = f"{folder}/.{name}"
            out = files.open_output_stream(temporary, compression=None)  # not by the suffix
            bundle = BundleWriter(out)

        def end_frame() -> None:
            nonlocal frame, size
            if frame:
                bundle.frame(b"".join(frame))
                frame, size = [], 0

        def end_bundle() -> pa.RecordBatch:
            nonlocal bundle, places, number
            end_frame()
            bundle.close()
            out.close()
            files.move(temporary, f"{folder}/{name}")
            ids, frames, starts, sizes = zip(*places)
            n = len(places)
            columns = [ids, [name] * n, frames, starts, sizes, [part] * n]
            bundle, places, number = None, [], number + 1
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["record_id", "bundle", "frame", "start", "size", "part"])

        name = ""
        for batch in batches:
            columns = [batch.column(k) for k in ("page_text", "url", "html", "digest", "first_text")]
            for page, url, html, digest, first in zip(*columns):
                if bundle is None:
                    open_bundle()
                payload = html.as_buffer().to_pybytes()
                page, first = page.as_py(), first.as_py()
                record = record_bytes(page, url.as_py(), date, payload, digest.as_py(), None if first == page else first)
                places.append((record_id(page), len(bundle.sizes), size, len(record)))
                frame.append(record)
                size += len(record)
                if size >= frame_bytes:
                    end_frame()
                    if bundle.written >= bundle_bytes:
                        yield end_bundle()
        if bundle is not None:
            yield end_bundle()

    rows = pages.select(
        pages[id_col].alias("page"), pages[url_col].alias("url"), F.coalesce(pages[html_col], F.lit("")).alias("html")
    )
    named = with_first(rows, least).select(
        F.col("page").cast("string").alias("page_text"), "url", "html", "digest", F.col("first").cast("string").alias("first_text")
    )
    listed = named.mapInArrow(write, INDEX)
    fs, data = hadoop_path(pages.sparkSession, f"{root}/data")
    fs.mkdirs(data)
    listed.write.parquet(f"{root}/index")
    return read_index(pages.sparkSession, root)


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """``record_id``, ``bundle``, ``frame``, ``start``, ``size`` of each record below ``root``."""
    return spark.read.schema(INDEX).parquet(f"{root}/index").drop("part")


def read_warc(spark: SparkSession, root: str, with_payload: bool = True) -> DataFrame:
    """All records of the bundles that the index names: identifier, type, URI, the identifier of what
    is revisited, the length and hash of the full payload, and a response's payload.

    Bundles are dealt out to tasks; a task holds one frame at a time. A response whose payload is not
    what its digest says fails the read.
    """
    bundles = save_table(read_index(spark, root).select("bundle").distinct(), "bundles")
    bundles = bundles.repartition(_tasks(spark, bundles.count() // TASK_BUNDLES))

    def read(batches):
        files, folder = arrow_fs.FileSystem.from_uri(f"{root}/data")
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                with files.open_input_file(f"{folder}/{name}") as source:
                    bundle = BundleReader(source)
                    for number in range(len(bundle.frames)):
                        yield _record_batch(read_record(f, b, with_payload) for _, _, f, b in parsed_records(bundle.frame(number)))

    return bundles.mapInArrow(read, RECORD)


def fetch_records(index: DataFrame, root: str, with_payload: bool = True) -> DataFrame:
    """The records that ``index``, rows of ``read_index``, names: of each bundle only the footer and
    the frames that hold one are read. A record named twice comes twice."""
    frames = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias("places"))
    frames = frames.repartition(_tasks(index.sparkSession))

    def read(batches):
        files, folder = arrow_fs.FileSystem.from_uri(f"{root}/data")
        for batch in batches:
            for name, number, places in zip(*(batch.column(k).to_pylist() for k in ("bundle", "frame", "places"))):
                with files.open_input_file(f"{folder}/{name}") as source:
                    content = BundleReader(source).frame(number)
                found = (next(parsed_records(content[x["start"] : x["start"] + x["size"]])) for x in places)
                yield _record_batch(read_record(f, b, with_payload) for _, _, f, b in found)

    return frames.mapInArrow(read, RECORD)


def _tasks(spark: SparkSession, wanted: int = 0) -> int:
    """So many tasks, and no fewer than a shuffle has; a short list of large files is not put together."""
    return max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _record_batch(records) -> pa.RecordBatch:
    kinds = {k: pa.int64() if t == "long" else pa.string() for k, t in (x.split() for x in RECORD.split(", "))}
    return pa.RecordBatch.from_pylist(list(records), schema=pa.schema(kinds))


def warc_round_trip(pages: DataFrame, root: str | None = None, id_col: str = "page_id") -> DataFrame:
    """Write ``pages`` below ``root``, by default in the shared folder, and read all records back."""
    spark = pages.sparkSession
    root = root or fresh_path(spark, "warc")
    write_warc(pages, root, id_col=id_col)
    kind = pages.schema[id_col].dataType
    page = lambda c: F.url_decode(F.regexp_extract(c, "^urn:page:(.*)$", 1))
    number = lambda c: F.when(F.col(c).startswith("urn:page:"), page(c)).cast(kind)
    return read_warc(spark, root, with_payload=False).select(
        number("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", number("refers_to_id").alias("refers_to")
    )
