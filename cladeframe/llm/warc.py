"""WARC archives, index first.

Pages are written as gzip members, one for each record, into files of the shared folder. The index (file, offset, length, url,
digest, ...) is a table that only committed tasks add to, so files that a lost executor left behind are never read. A reader
takes rows of the index, sorts them by place, joins neighbouring byte ranges into larger reads and parses the records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keep, shared_path

#: Payloads under this many bytes are never revisited.
LEAST = 1000
#: Bytes after which a new file begins, of one read at most, of a gap that a read may run over, and that a reading task gets.
FILE, READ, GAP, TASK = 256 << 20, 8 << 20, 64 << 10, 64 << 20
_DATE = "1970-01-01T00:00:00Z"
_ID, _NO_ID = 0x7061676500004000, 0x6E6F706167654000


def record_id(page_id: int | None) -> str:
    """A urn that holds the page's id."""
    return uuid.UUID(int=((_NO_ID if page_id is None else _ID) << 64) | ((page_id or 0) & ((1 << 64) - 1))).urn


def page_of(urn: str) -> int | None:
    n = uuid.UUID(urn).int
    low = n & ((1 << 64) - 1)
    return None if n >> 64 == _NO_ID else low - (1 << 64) if low >> 63 else low


def _sha1(hexed: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexed)).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member. A revisit holds the HTTP header, whose Content-Length is that of the full payload, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id)}>", f"WARC-Date: {_DATE}"]
    head += [f"WARC-Target-URI: {target}"] if target else []
    head += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: {_sha1(digest)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{record_id(refers_to)}>"]
    head += [f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + pack.flush()


def parse_record(member: bytes) -> dict:
    """page_id, record_type, refers_to, url, payload (None for revisits), payload_bytes and payload_digest of a gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    told = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = h["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != told):
        raise ValueError(f"damaged record {h['WARC-Record-ID']}")
    return {
        "page_id": page_of(h["WARC-Record-ID"].strip("<>")), "record_type": h["WARC-Type"], "refers_to": page_of(h["WARC-Refers-To"].strip("<>")) if revisit else None,
        "url": h.get("WARC-Target-URI"), "payload": None if revisit else payload, "payload_bytes": size, "payload_digest": told,
    }


_INDEX = "page_id long, file string, offset long, length long, url string, digest string, record_type string"


def _written(folder: str):
    def run(batches):
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        task = TaskContext.get()
        n, at, name, sink = 0, 0, "", None
        for b in batches:
            out = []
            for page_id, url, html, digest, refers_to, revisit in zip(*(b.column(i).to_pylist() for i in range(6))):
                if sink is None or at >= FILE:
                    if sink is not None:
                        sink.close()
                    name, n, at = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{n}-{uuid.uuid4().hex[:8]}.warc.gz", n + 1, 0
                    sink = store.open_output_stream(f"{top}/{name}", compression=None)
                record = make_record(page_id, url, html, digest, refers_to, revisit)
                sink.write(record)
                out.append((page_id, name, at, len(record), url, digest, "revisit" if revisit else "response"))
                at += len(record)
            if out:
                cols = list(zip(*out))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["page_id", "file", "offset", "length", "url", "digest", "record_type"])
        if sink is not None:
            sink.close()

    return run


def write_archives(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html) and returns the index, a written table.

    Of records with equal payloads of ``least`` bytes or more the one with the largest page_id is the response and the others
    revisit it; rows that repeat that page_id are responses too, and so are rows with a null page_id if no other row has their payload.
    Null html: an empty payload. Null url: no target. Empty table: an empty index.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html")).withColumn("digest", F.sha1("html"))
    seen = p.select("page_id", "digest", F.octet_length("html").alias("n")).where(F.col("n") >= least).groupBy("digest", "n").agg(F.max("page_id").alias("top"), F.count("*").alias("k"))
    tops = keep(seen.where("k > 1 and top is not null").select(F.col("digest").alias("d"), "top"), "tops")
    rows = p.join(tops, F.col("digest") == F.col("d"), "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    rows = rows.select("page_id", "url", "html", "digest", F.when(revisit, F.col("top")).alias("refers_to"), revisit.alias("revisit"))
    return keep(rows.mapInArrow(_written(folder), _INDEX), "warc-index")


def _ranges(places: list[tuple[str, int, int]]):
    """Indices of ordered (file, offset, length), cut into reads."""
    group: list[int] = []
    for i, (f, o, n) in enumerate(places):
        if group:
            f0, o0, _ = places[group[0]]
            f1, o1, n1 = places[group[-1]]
            if f != f1 or o - (o1 + n1) > GAP or o + n - o0 > READ:
                yield group
                group = []
        group.append(i)
    if group:
        yield group


def _read(folder: str):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        store, top = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for b in batches:
            places = list(zip(*(b.column(i).to_pylist() for i in range(3))))
            for group in _ranges(places):
                f, start, _ = places[group[0]]
                if f != name:
                    if source is not None:
                        source.close()
                    name, source = f, store.open_input_file(f"{top}/{f}")
                end = sum(places[group[-1]][1:])
                data = source.read_at(end - start, start)
                out = [parse_record(data[o - start : o - start + n]) for _, o, n in (places[i] for i in group)]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], k) for c, k in zip(names, kinds)], names=names)

    return run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given rows of the index: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload (null for revisits).

    Archives are cut into stretches of ``READ`` bytes; a stretch's records are one task's, read in one piece. Tasks follow the bytes of the records, not those of the index.
    One row per row of the index: a record named twice is read twice. Records of any length are read whole. An empty index: no rows. Other columns of the index aren't used.
    """
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-size // TASK))
    placed = index.select("file", "offset", "length").repartition(tasks, "file", F.floor(F.col("offset") / READ)).sortWithinPartitions("file", "offset")
    return placed.mapInArrow(_read(folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def archive_report(pages: DataFrame) -> DataFrame:
    folder = shared_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder)
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
