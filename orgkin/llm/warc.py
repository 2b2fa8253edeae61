"""WARC archives as seekable Zstandard bundles.

Every task writes one archive: records are grouped into frames of about FRAME bytes, each
compressed on its own, and a seek table (a skippable frame of the seekable format) at the end
lists their sizes. Records never span frames. An index maps each record identifier to its
archive, frame and the offset in the frame, so one record is read by decompressing one frame.

Pages with the payload of another one become revisit records: the page with the smallest id
keeps the payload, the others name it. Each distinct payload travels once at most, whatever
the number of its copies.

Archives are written through Arrow's file systems, into the folder given or the shared
scratch folder. Names are unique per attempt; an archive counts when the index, which Spark
commits, names it. Files of attempts that were lost or repeated are never read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgkin.llm.common import documents, written
from orgkin.session import scratch_dir

FRAME = 1 << 20  # bytes of records from which a frame is closed
REVISITED = 100  # bytes from which a payload is stored once
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # pages carry no time
STRETCH = 16  # frames of an archive that a task reads in a row
READ_AT_ONCE = 64  # records of a batch that is handed back

# Fixed values of the seekable format and of the two record types.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_NOT_IN_URI = re.compile(r"[\x00-\x20\x7f]")

INDEX = "record_id string, archive string, frame int, offset long, length long"
RECORDS = (
    "record_id string, page_id long, url string, record_type string, refers_to_record string, refers_to long, "
    "payload_bytes long, payload_digest string, stored boolean, payload binary"
)


def _record_id(page: Column, url: Column, digest: Column, copy: Column) -> Column:
    """Names the page, and tells rows of the same page apart by what they hold."""
    own = F.substring(F.md5(F.concat_ws("|", F.coalesce(url, F.lit("")), url.isNull().cast("string"), digest)), 1, 16)
    return F.concat(
        F.lit("urn:x-page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), own, F.lit(":"), copy.cast("string")
    )


def records(pages: DataFrame, least: int = REVISITED) -> DataFrame:
    """``record_id, page_id, url, digest, bytes, refers_to, payload``: a row for each page.

    Of rows with equal payloads of ``least`` bytes and more the one with the smallest page_id
    (null after all ids, then the smallest url) has the payload, the others name it in
    ``refers_to``. Smaller payloads always stay.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})
    large = rows.filter(F.col("bytes") >= least)
    place = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNotNull().alias("has_url"), "url")

    def first_id(c: str) -> Column:
        return _record_id(F.col(f"{c}.page_id"), F.col(f"{c}.url"), F.col("digest"), F.lit(1))

    # a maximum of payloads that are all the same: copies fall together before the shuffle
    stored = large.groupBy("digest", "bytes").agg(F.min(place).alias("first"), F.max("payload").alias("payload")).select(
        first_id("first").alias("record_id"), F.col("first.page_id").alias("page_id"), F.col("first.url").alias("url"),
        "digest", "bytes", F.lit(None).cast("string").alias("refers_to"), "payload",
    )
    # without payloads; equal rows are told apart by their number
    equal = written(
        large.groupBy("digest", "bytes", "page_id", "url").agg(F.count(F.lit(1)).alias("n")), "warc-pages"
    )
    target = equal.groupBy("digest").agg(F.min(place).alias("first"), F.sum("n").alias("times")).filter(
        "times > 1"
    ).select("digest", first_id("first").alias("refers_to"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
    own_id = _record_id(F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy"))
    again = equal.join(target, "digest").withColumn("copy", copies).withColumn("record_id", own_id).filter(
        "record_id != refers_to"
    ).select(
        "record_id", "page_id", "url", "digest", "bytes", "refers_to", F.lit(None).cast("binary").alias("payload")
    )
    # a payload this short travels with its row
    small = rows.filter(F.col("bytes") < least).groupBy("digest", "bytes", "page_id", "url", "payload").agg(
        F.count(F.lit(1)).alias("n")
    ).withColumn("copy", copies).select(
        own_id.alias("record_id"),
        "page_id", "url", "digest", "bytes", F.lit(None).cast("string").alias("refers_to"), "payload",
    )
    return stored.unionByName(again).unionByName(small)


def _record(row: dict) -> bytes:
    """The bytes of one record: a response with its payload, or a revisit with its header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    again = row["refers_to"] is not None
    block = http if again else http + row["payload"]
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if again else 'response'}", f"WARC-Record-ID: <{row['record_id']}>",
        f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
    ]
    if row["url"] is not None:
        uri = _NOT_IN_URI.sub(lambda m: f"%{ord(m[0]):02X}", row["url"])
        head.append(f"WARC-Target-URI: {uri}")
    if again:
        head += [f"WARC-Refers-To: <{row['refers_to']}>", f"WARC-Profile: {SAME_PAYLOAD}"]
    head += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


class Bundle:
    """Writes frames and, at the end, the seek table."""

    def __init__(self, out, frame: int = FRAME):
        self.out, self.least = out, frame
        self.press = zstandard.ZstdCompressor(level=LEVEL)
        self.sizes: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.length = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame of the record and its offset there."""
        place = len(self.sizes), self.length
        self.held.append(record)
        self.length += len(record)
        if self.length >= self.least:
            self.close_frame()
        return place

    def close_frame(self) -> None:
        if self.held:
            packed = self.press.compress(b"".join(self.held))
            self.out.write(packed)
            self.sizes.append((len(packed), self.length))
            self.held, self.length = [], 0

    def finish(self) -> None:
        self.close_frame()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)


def frames(file, size: int) -> list[tuple[int, int, int]]:
    """Offset, packed size and size of each frame, from the seek table at the end of a file."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    entries = file.read(8 * count)
    out, at = [], 0
    for packed, whole in struct.iter_unpack("<II", entries):
        out.append((at, packed, whole))
        at += packed
    return out


def _written_by_task(folder: str, frame: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        out = bundle = None
        name = f"{uuid.uuid4().hex}.warc.zst"
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if bundle is None:
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{name}", compression=None)  # not by its name
                    bundle = Bundle(out, frame)
                record = _record(row)
                found.append((row["record_id"], name, *bundle.add(record), len(record)))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*found), (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                    ["record_id", "archive", "frame", "offset", "length"],
                )
        if bundle is not None:
            bundle.finish()
            out.close()

    return made


def write_archives(pages: DataFrame, folder: str | None = None, frame: int = FRAME) -> tuple[str, DataFrame]:
    """Archives of all pages; their folder and the index ``record_id, archive, frame, offset, length``.

    Null pages have an empty payload, a null url is left out of its record, ids may be null or
    repeat, and equal rows make a record each. Other columns are ignored. A page of any length is one
    record. An empty table makes no archive.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    uri = re.sub("^(?:file:)?/+", "file:///", folder)
    index = records(pages).mapInArrow(_written_by_task(uri, frame), INDEX)
    return uri, written(index, "warc-index")


def _parsed(record: bytes, payload: bool) -> tuple:
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    again = fields["WARC-Type"] == "revisit"
    claimed = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if not again and (len(body) != claimed or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")

    def named(field: str) -> tuple[str | None, int | None]:
        urn = fields.get(field, "<>")[1:-1]
        page = urn.split(":")[2] if urn else ""
        return urn or None, int(page) if page else None

    return (
        *named("WARC-Record-ID"), fields.get("WARC-Target-URI"), fields["WARC-Type"], *named("WARC-Refers-To"),
        claimed, digest, not again, body if payload and not again else None,
    )


_TYPES = (
    pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()
)
_NAMES = [c.split()[0] for c in RECORDS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES, strict=True)], _NAMES)


def _read_by_task(folder: str, payload: bool):
    """Reads the asked records (``offset, length`` of a frame) by decompressing each frame once."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        last = file = table = None
        for batch in batches:
            out = []
            for asked in batch.to_pylist():
                if asked["archive"] != last:
                    last = asked["archive"]
                    if file is not None:
                        file.close()
                    file = system.open_input_file(f"{path}/{last}")
                    table = frames(file, file.size())
                at, packed, whole = table[asked["frame"]]
                file.seek(at)
                data = unpack.decompress(file.read(packed), max_output_size=whole)
                for start, length in sorted(zip(asked["offsets"], asked["lengths"], strict=True)):
                    out.append(_parsed(data[start: start + length], payload))
                    if len(out) >= READ_AT_ONCE:
                        yield _batch(out)
                        out = []
            if out:
                yield _batch(out)
        if file is not None:
            file.close()

    return made


def read_records(folder: str, index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that ``index`` (or a part of it) names: page, type, digest and payload.

    Each frame is fetched by its place in the seek table and decompressed once; frames are
    bounded, so no task holds more than one frame, its offsets and one archive's seek table. Payloads are
    held against their digest and length.
    """
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by number, as the index is far smaller than what it names
    dealt = index.withColumn("stretch", F.expr(f"frame DIV {STRETCH}")).repartition(tasks, "archive", "stretch")
    asked = dealt.groupBy("archive", "stretch", "frame").agg(
        F.collect_list(F.struct("offset", "length")).alias("places")
    ).select("archive", "frame", F.col("places.offset").alias("offsets"), F.col("places.length").alias("lengths"))
    asked = asked.sortWithinPartitions("archive", "frame")
    return asked.mapInArrow(_read_by_task(folder, payload), RECORDS)


def page_digests(pages: DataFrame) -> DataFrame:
    """Every page as its archive record tells: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to, record_id, url``."""
    folder, index = write_archives(pages)
    return read_records(folder, index, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def query(spark, sf_dir):
    return page_digests(documents(spark, sf_dir, "pages"))


ORACLE = f"""
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM sized)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {REVISITED} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {REVISITED} AND page_id <> first THEN first END AS refers_to
FROM firsts
"""
