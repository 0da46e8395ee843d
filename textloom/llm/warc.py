"""WARC archives with an index first, and reading back by coalesced byte ranges.

``write_archives`` gives every record its place: the tasks write gzip members to archives in the shared folder and
return an index row for each record (path, offset, length, url, digest). ``read_records`` takes any selection of index
rows, sorts it by place, joins neighbouring byte ranges into one read and parses the records. Archives
are named anew by each attempt of a task and only the index of committed tasks is read, so lost executors leave no
broken record. Of equal payloads of at least ``least`` bytes the row with the largest page_id is a response, the others
are revisits of it.

Defined results: null html is an empty payload; a null url is left out of the record; control characters in urls are
percent-encoded; rows without page_id are responses; rows that repeat the largest page_id are all responses; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import filesystem, open_new, scratch, stored

INDEX = "page_id long, url string, digest string, record_type string, path string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
ARCHIVE_BYTES = 64 << 20
READ_BYTES, READ_GAP = 8 << 20, 64 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the table has no capture time; one fixed date keeps archives the same on every run


def with_roles(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, html, digest, and refers_to for revisits. Groups are aggregated before any page moves."""
    html = F.coalesce(F.col("html"), F.lit(""))
    facts = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    large = facts.where(F.octet_length("html") >= least)
    groups = large.groupBy("digest").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = facts.join(stored(groups, "groups"), "digest", "left")
    return joined.select("page_id", "url", "html", "digest", F.when(F.col("newest") != F.col("page_id"), F.col("newest")).alias("refers_to"))


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _clean(url: str) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _head(lines: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; a revisit holds the HTTP head but no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _uri(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        lines.append(("WARC-Target-URI", _clean(url)))
    lines.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if revisit:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _uri(refers_to))]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    return pack.compress(_head(lines) + block + b"\r\n\r\n") + pack.flush()


def parse_record(member: bytes) -> dict:
    """Headers, HTTP head and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: "))
    return fields | {"payload": payload, "payload_length": length}


def _page(uri: str) -> int | None:
    return int(uri[len("<urn:x-page:") : -1]) if uri.startswith("<urn:x-page:") else None


def write_archives(pages: DataFrame, folder: str, least: int = 1000) -> DataFrame:
    """Write a record for each page below ``folder``; returns the stored index."""

    def run(batches: Iterator[pa.RecordBatch]):
        out = path = None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None or out.tell() >= ARCHIVE_BYTES:
                    if out:
                        out.close()
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out = open_new(path)
                record = make_record(row["page_id"], row["url"], row["html"].encode(), row["digest"], row["refers_to"])
                kind = "revisit" if row["refers_to"] is not None else "response"
                rows.append((row["page_id"], row["url"], row["digest"], kind, path, out.tell(), len(record)))
                out.write(record)
            if rows:
                yield _batch(rows, [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64()], INDEX)
        if out:
            out.close()

    return stored(with_roles(pages, least).mapInArrow(run, INDEX), "warc-index")


def _batch(rows: list[tuple], types: list, schema: str) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def read_ranges(places: Iterator[tuple[str, int, int]]) -> Iterator[bytes]:
    """The bytes of places sorted by (path, offset); near ones share a read."""
    held: list[tuple[str, int, int]] = []
    source: tuple[str, object] | None = None

    def fetch():
        nonlocal source
        path = held[0][0]
        if source is None or source[0] != path:
            if source:
                source[1].close()
            fs, inner = filesystem(path)
            source = path, fs.open_input_file(inner)
        begin, end = held[0][1], max(o + n for _, o, n in held)
        data = source[1].read_at(end - begin, begin)
        for _, o, n in held:
            yield data[o - begin : o - begin + n]

    for path, offset, length in places:
        if held and (path != held[0][0] or offset - (held[-1][1] + held[-1][2]) > READ_GAP or offset + length - held[0][1] > READ_BYTES):
            yield from fetch()
            held = []
        held.append((path, offset, length))
    if held:
        yield from fetch()
    if source:
        source[1].close()


def read_records(index: DataFrame, bytes_per_task: int = 64 << 20) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to), parsed from the archives."""
    total = index.agg(F.sum("length").alias("n")).first().n or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // bytes_per_task))
    placed = index.select("path", "offset", "length").repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset")

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("path", "offset", "length"))
            rows = []
            for member in read_ranges(zip(*columns)):
                r = parse_record(member)
                kind = r["WARC-Type"]
                stated = base64.b32decode(r["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                digest = hashlib.sha1(r["payload"]).hexdigest() if kind == "response" else stated
                if digest != stated or (kind == "response" and len(r["payload"]) != r["payload_length"]):
                    raise ValueError(f"record {r['WARC-Record-ID']} does not match its digest or length")
                refers = _page(r["WARC-Refers-To"]) if kind == "revisit" else None
                rows.append((_page(r["WARC-Record-ID"]), r.get("WARC-Target-URI"), r["payload_length"], digest, kind, refers))
            if rows:
                yield _batch(rows, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()], RECORD)

    return placed.mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write all pages, then read every record of the index."""
    index = write_archives(pages, scratch(pages.sparkSession, "warc"), least)
    return read_records(index).drop("url")
