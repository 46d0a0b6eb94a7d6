"""WARC archives as seekable Zstandard bundles, with an index from record ids to frames.

A bundle is a run of independent Zstandard frames, each holding whole WARC
records, and a last skippable frame with the seek table: the compressed and
plain size of every frame. Any Zstandard reader can read a bundle from front to
back; with the index, one record costs one frame.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import shared_path, small_batches

# Fixed values of the seekable format: skippable frame, end mark, sizes in bytes.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
SKIP_HEADER = 8
SEEK_FOOTER = 9
SEEK_ENTRY = 8

# Stands for the date of capture where the caller names none.
UNKNOWN_DATE = "1970-01-01T00:00:00Z"

# Plain bytes gathered before a frame, and a bundle, is closed.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20

INDEX = (
    "bundle string, frame int, frame_offset long, frame_size long, "
    "records array<struct<record_id string, page_id long, start long, length long>>"
)
RECORDS = (
    "record_id string, page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer for frames of the given (compressed, plain) sizes."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(path: str) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, read from the end of a bundle."""
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as f:
        end = f.size()
        f.seek(end - SEEK_FOOTER)
        count, _, magic = struct.unpack("<IBI", f.read(SEEK_FOOTER))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        f.seek(end - SEEK_FOOTER - count * SEEK_ENTRY)
        sizes = struct.iter_unpack("<II", f.read(count * SEEK_ENTRY))
        frames, at = [], 0
        for packed, plain in sizes:
            frames.append((at, packed, plain))
            at += packed
    return frames


def _clean(value: str) -> str:
    """A header value on one line: white space and control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", value)


def _record_id(page_id: int | None, digest: str) -> str:
    # Repeated rows share an id and are found together.
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _record(row: dict, date: str = UNKNOWN_DATE) -> tuple[str, bytes]:
    """Record id and bytes of one record; a revisit keeps the HTTP headers only."""
    payload = row["payload"] or b""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()
    record_id = _record_id(row["page_id"], row["digest"])
    revisit = row["first"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id}"]
    head.append(f"WARC-Date: {date}")
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {_clean(row['url'])}")
    if row["page_id"] is not None:
        head.append(f"X-Page-ID: {row['page_id']}")
    head.append(f"WARC-Payload-Digest: {digest}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_record_id(row['first'], row['digest'])}")
        head.append(f"X-Refers-To-Page-ID: {row['first']}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return record_id, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}, rest


def parse_record(data: bytes) -> dict:
    """The fields of one record; the digest of a response is computed anew from its payload."""
    head, rest = _headers(data)
    http, payload = _headers(rest[: int(head["content-length"])])
    revisit = head["warc-type"] == "revisit"
    page, first = head.get("x-page-id"), head.get("x-refers-to-page-id")
    said = head["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and said != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise ValueError(f"{head['warc-record-id']}: payload and digest differ")
    return {
        "record_id": head["warc-record-id"],
        "page_id": None if page is None else int(page),
        "url": head.get("warc-target-uri"),
        "payload_bytes": int(http["content-length"]) if revisit else len(payload),
        "payload_digest": said,
        "record_type": head["warc-type"],
        "refers_to": None if first is None else int(first),
        "payload": None if revisit else payload,
    }


class _Bundle:
    """Writes one bundle frame by frame and keeps what the index needs."""

    def __init__(self, folder: str):
        # Each attempt of a task has a name of its own; only those in the index count.
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, name = fs.FileSystem.from_uri(folder)
        system.create_dir(name, recursive=True)
        system, name = fs.FileSystem.from_uri(self.path)
        self.out = system.open_output_stream(name, compression=None)
        self.packer = zstandard.ZstdCompressor()
        self.frames: list[tuple[int, int]] = []
        self.at = self.total = self.held = 0
        self.parts: list[bytes] = []
        self.records: list[dict] = []

    def add(self, record_id: str, page_id: int | None, data: bytes) -> None:
        self.records.append({"record_id": record_id, "page_id": page_id, "start": self.held, "length": len(data)})
        self.parts.append(data)
        self.held += len(data)

    def close_frame(self) -> dict:
        packed = self.packer.compress(b"".join(self.parts))
        self.out.write(packed)
        row = {
            "bundle": self.path,
            "frame": len(self.frames),
            "frame_offset": self.at,
            "frame_size": len(packed),
            "records": self.records,
        }
        self.frames.append((len(packed), self.held))
        self.at += len(packed)
        self.total += self.held
        self.held, self.parts, self.records = 0, [], []
        return row

    def close(self) -> None:
        self.out.write(seek_table(self.frames))
        self.out.close()


def with_first(pages: DataFrame, payload: Column, page_id: str = "page_id", min_bytes: int = 0) -> DataFrame:
    """``pages`` with (``_payload``, ``_digest``, ``_first``): the page that holds the payload, null for itself.

    Of the rows with equal payloads of at least ``min_bytes`` bytes those with the smallest id hold it;
    repeated rows of that id hold it each. A null id comes last; rows without any id to refer to hold their own.
    Digests are reduced to one row each before the shuffle, and a digest that many pages share can be split in the join.
    """
    body = F.coalesce(payload, F.lit("")).cast("binary")
    keyed = pages.withColumn("_payload", body).withColumn("_digest", F.sha1(body))
    large = F.octet_length("_payload") >= min_bytes
    firsts = keyed.where(large).groupBy("_digest").agg(F.min(page_id).alias("_low"), F.count(F.lit(1)).alias("_n"))
    repeated = firsts.where((F.col("_n") > 1) & F.col("_low").isNotNull()).select("_digest", "_low")
    linked = keyed.join(repeated, "_digest", "left")
    other = F.col(page_id).isNull() | (F.col(page_id) != F.col("_low"))
    return linked.withColumn("_first", F.when(large & other, F.col("_low"))).drop("_low")


def write_bundles(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    date: str = UNKNOWN_DATE,
) -> DataFrame:
    """Write one record per row to bundles in ``folder``; returns the stored index, one row per frame.

    ``date`` is the time of capture (``2024-05-01T12:00:00Z``), so that a task that is tried again writes the same.

    Null html is an empty payload, a null url or id leaves its header out, and
    control characters of a url are percent-encoded. A task holds one frame;
    a record longer than a frame has a frame of its own. A task that is tried
    again writes new bundles, and the index, committed by Spark, names only
    those of the attempts that counted. Other columns are ignored.
    """
    spark = pages.sparkSession
    small_batches(spark)
    rows = with_first(
        pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"), F.col(html).alias("_html")),
        F.col("_html"), "_id", min_bytes,
    ).select(
        F.col("_id").cast("long").alias("page_id"),
        F.col("_url").alias("url"),
        F.col("_payload").alias("payload"),
        F.col("_digest").alias("digest"),
        F.col("_first").cast("long").alias("first"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("bundle", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("frame_size", pa.int64()),
            ("records", pa.list_(pa.struct([
                ("record_id", pa.string()), ("page_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
            ]))),
        ])
        bundle = None
        for batch in batches:
            closed = []
            for row in batch.to_pylist():
                bundle = bundle or _Bundle(folder)
                record_id, data = _record(row, date)
                bundle.add(record_id, row["page_id"], data)
                if bundle.held >= frame_bytes:
                    closed.append(bundle.close_frame())
                    if bundle.total >= bundle_bytes:
                        bundle.close()
                        bundle = None
            if closed:
                yield pa.RecordBatch.from_pylist(closed, schema)
        if bundle:
            if bundle.held:
                yield pa.RecordBatch.from_pylist([bundle.close_frame()], schema)
            bundle.close()

    index = f"{folder}/index"
    rows.mapInArrow(write, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the index rows name, each cut out of its frame.

    Pass the whole index to read everything, or the rows of ``find`` to read a
    few records: a frame is fetched by its offset and nothing else is read.
    """
    small_batches(index.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpacker = zstandard.ZstdDecompressor()
        path = source = None
        for batch in batches:
            for frame in batch.itertuples():
                if frame.bundle != path:
                    if source:
                        source.close()
                    path = frame.bundle
                    system, name = fs.FileSystem.from_uri(path)
                    source = system.open_input_file(name)
                source.seek(frame.frame_offset)
                plain = unpacker.decompress(source.read(frame.frame_size))
                found = [parse_record(plain[r["start"] : r["start"] + r["length"]]) for r in frame.records]
                if not payloads:
                    found = [f | {"payload": None} for f in found]
                out = pd.DataFrame(found)
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})
        if source:
            source.close()

    return index.mapInPandas(read, RECORDS)


def _places(plain: bytes) -> list[dict]:
    """Where the records of a frame lie."""
    places, at = [], 0
    while at < len(plain):
        body = plain.index(b"\r\n\r\n", at) + 4
        head, _ = _headers(plain[at:body])
        end = body + int(head["content-length"]) + 4
        page = head.get("x-page-id")
        places.append({
            "record_id": head["warc-record-id"], "page_id": None if page is None else int(page), "start": at, "length": end - at,
        })
        at = end
    return places


def rebuild_index(bundles: DataFrame) -> DataFrame:
    """The index of bundles (a column ``bundle``) whose index is lost, out of their seek tables.

    A task holds one frame; a null path gives no row, a path that is named twice gives its frames once, and a file
    without a seek table is an error.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for path in batch.bundle:
                frames = read_seek_table(path)
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as source:
                    for number, (at, size, plain_size) in enumerate(frames):
                        source.seek(at)
                        plain = unpacker.decompress(source.read(size), max_output_size=plain_size)
                        yield pd.DataFrame([{
                            "bundle": path, "frame": number, "frame_offset": at, "frame_size": size, "records": _places(plain),
                        }])

    return bundles.select("bundle").where(F.col("bundle").isNotNull()).distinct().mapInPandas(read, INDEX)


def find(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """Index rows cut down to the records with the given ids (a column ``record_id``)."""
    flat = index.select("bundle", "frame", "frame_offset", "frame_size", F.explode("records").alias("r"))
    hit = flat.withColumn("record_id", F.col("r.record_id")).join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    return hit.groupBy("bundle", "frame", "frame_offset", "frame_size").agg(F.collect_list("r").alias("records"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to new bundles in the shared folder and read every record back."""
    index = write_bundles(pages, shared_path(pages.sparkSession, "warc"))
    return read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
