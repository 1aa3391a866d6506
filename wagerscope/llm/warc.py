"""WARC records in seekable Zstandard bundles.

Every task writes one bundle: records are grouped into independent frames of
about ``frame_bytes``, and a seek table (a skippable frame with the packed and
raw size of each frame) ends the file.  An index table maps record identifiers
to their frame and their offset inside it, so one record costs one read of one
frame.  Bundles of attempts that did not commit are not in the index, so a
retried task leaves nothing behind that readers see.

Records with equal payloads are kept once: the others are revisit records that
name it, with the payload's digest and length.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerscope.llm.common import stored, table
from wagerscope.session import work_folder

# Fixed values of the seekable Zstandard format: the skippable frame's magic
# number, the seek table's own, and the layout of its entries and footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
ENTRY, FOOTER = "<II", "<IBI"

INDEX = "record_id string, bundle string, frame int, frame_offset long, frame_size long, offset long, length long"
RECORDS = (
    "record_id string, page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, payload binary"
)


def _location(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    value = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "null" else int(value)


def record(page_id, url, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of ``refers_to`` (a record id).

    A revisit holds the HTTP header only, whose Content-Length is the payload's.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    lines.append(f"WARC-Record-ID: {_record_id(page_id)}")
    lines.append(f"WARC-Date: {date}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {urllib.parse.quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: {refers_to}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[dict]:
    """The records of one unpacked frame, payload digests of responses verified."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no WARC record at offset {at}")
        fields = dict(x.split(": ", 1) for x in lines)
        size = int(fields["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4
        http, _, body = block.partition(b"\r\n\r\n")
        length = int(http.rpartition(b"Content-Length: ")[2])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response":
            length, own = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
            if own != digest:
                raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        yield {
            "record_id": fields["WARC-Record-ID"],
            "page_id": _page_id(fields["WARC-Record-ID"]),
            "url": fields.get("WARC-Target-URI"),
            "record_type": kind,
            "payload_bytes": length,
            "payload_digest": digest,
            "refers_to": _page_id(fields["WARC-Refers-To"]) if kind == "revisit" else None,
            "payload": body if kind == "response" else None,
        }


def write_bundles(
    pages: DataFrame,
    folder: str,
    min_payload: int = 0,
    frame_bytes: int = 1 << 18,
    level: int = 3,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id, url, html``); returns the index table.

    The payload is the html in UTF-8 (null: empty).  Among payloads of at least
    ``min_payload`` bytes, equal ones are stored once, with the largest page id;
    rows that repeat that id are responses too, as nothing tells them apart.  A
    null id counts as smallest, a null url is left out, and characters that a
    header cannot hold are percent-encoded.  Other columns are ignored.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    copies = (
        rows.filter(F.length("payload") >= min_payload)
        .groupBy("sha")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
        .filter("n > 1")
        .select(F.col("sha").alias("copied"), "first")
    )
    large = F.length("payload") >= min_payload
    revisit = F.col("copied").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = rows.join(copies, (F.col("sha") == F.col("copied")) & large, "left").select(
        "page_id", "url", "payload", "sha", revisit.alias("revisit"), "first"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _location(folder)
        packer = zstandard.ZstdCompressor(level=level)
        name = f"{uuid.uuid4().hex}.warc.zst"
        out, sizes, waiting, raw, position = None, [], [], 0, 0

        def close_frame() -> pa.RecordBatch:
            nonlocal waiting, raw, position
            packed = packer.compress(b"".join(data for _, data in waiting))
            out.write(packed)
            ids, offset, lines = [], 0, []
            for key, data in waiting:
                ids.append(key)
                lines.append((key, name, len(sizes), position, len(packed), offset, len(data)))
                offset += len(data)
            sizes.append((len(packed), raw))
            position += len(packed)
            waiting, raw = [], 0
            return _batch(lines, INDEX)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page_id, url, body, sha, again, first = row
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                data = record(page_id, url, body, digest, _record_id(first) if again else None, date)
                waiting.append((_record_id(page_id), data))
                raw += len(data)
                if raw >= frame_bytes:
                    yield close_frame()
        if waiting:
            yield close_frame()
        if out is not None:
            entries = b"".join(struct.pack(ENTRY, *x) for x in sizes) + struct.pack(FOOTER, len(sizes), 0, SEEKABLE)
            out.write(struct.pack("<II", SKIPPABLE, len(entries)) + entries)
            out.close()

    return stored(marked.mapInArrow(run, INDEX), folder, "index")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def seek_table(source) -> list[tuple[int, int, int]]:
    """``offset, packed size, raw size`` of each frame, from the end of an open bundle."""
    end = source.size()
    entry, footer = struct.calcsize(ENTRY), struct.calcsize(FOOTER)
    count, flags, magic = struct.unpack(FOOTER, source.read_at(footer, end - footer))
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table, or one of another kind")
    entries = source.read_at(count * entry, end - footer - count * entry)
    table_, at = [], 0
    for packed, raw in struct.iter_unpack(ENTRY, entries):
        table_.append((at, packed, raw))
        at += packed
    return table_


def frames(index: DataFrame, folder: str) -> DataFrame:
    """``bundle, frame, offset, packed, raw`` of all bundles in the index, from their seek tables."""

    def run(batches):
        for batch in batches:
            fs, root = _location(folder)
            for name in batch.column(0).to_pylist():
                with fs.open_input_file(f"{root}/{name}") as source:
                    rows = [(name, i, *x) for i, x in enumerate(seek_table(source))]
                yield _batch(rows, schema)

    schema = "bundle string, frame int, offset long, packed long, raw long"
    return index.select("bundle").distinct().mapInArrow(run, schema)


def read_bundles(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """All records of the bundles, frame by frame in parallel.

    Without ``payload`` that column stays null; digests are verified either way.
    """
    spark = index.sparkSession
    found = stored(frames(index, folder), name="frames")
    total = found.agg(F.sum("raw")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total >> 25)

    def run(batches):
        fs, root = _location(folder)
        unpacker, opened, source = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            for name, offset, packed, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != opened:
                    opened, source = name, fs.open_input_file(f"{root}/{name}")
                data = unpacker.decompress(source.read_at(packed, offset), max_output_size=raw)
                rows = [tuple(r.values()) for r in parse(data)]
                yield _batch(rows if payload else [(*r[:-1], None) for r in rows], RECORDS)

    dealt = found.repartition(parts, "bundle", "frame").sortWithinPartitions("bundle", "frame")
    return dealt.select("bundle", "offset", "packed", "raw").mapInArrow(run, RECORDS)


def lookup(index: DataFrame, folder: str, page_ids: list[int | None]) -> DataFrame:
    """The records of the given pages, each by one read of its frame."""
    wanted = index.filter(F.col("record_id").isin([_record_id(p) for p in page_ids]))

    def run(batches):
        fs, root = _location(folder)
        for batch in batches:
            rows = []
            for name, start, packed, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_file(f"{root}/{name}") as source:
                    data = zstandard.ZstdDecompressor().decompress(source.read_at(packed, start))
                rows += [tuple(r.values()) for r in parse(data[offset : offset + length])]
            yield _batch(rows, RECORDS)

    return wanted.select("bundle", "frame_offset", "frame_size", "offset", "length").mapInArrow(run, RECORDS)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_folder(spark)}/warc"
    index = write_bundles(table(spark, sf_dir, "pages"), folder)
    return read_bundles(index, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP1_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), q AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS first,
    list_transform(generate_series(0, 7), lambda g: CAST('0x' || substr(h, g * 5 + 1, 5) AS BIGINT)) AS v FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(v, lambda x:
    substr('{ALPHABET}', CAST((x >> 15) & 31 AS BIGINT) + 1, 1) || substr('{ALPHABET}', CAST((x >> 10) & 31 AS BIGINT) + 1, 1) ||
    substr('{ALPHABET}', CAST((x >> 5) & 31 AS BIGINT) + 1, 1) || substr('{ALPHABET}', CAST(x & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM q
"""
