"""WARC archives: writing captures, reading records, assembling transactions.

A capture is written as three gzip members: the response (or a revisit record
that refers to an earlier response of the same payload), its request and its
metadata, the latter two naming the first in WARC-Concurrent-To. Reading gives a
row per record. ``captures`` joins the records again through the concurrent-to
identifiers, whichever side names the other, directly or through one further
record, and emits one nested row per response, revisit or resource record.

Files go to the shared folder (see ``files``), a new one after ``FILE_BYTES``;
records are streamed both ways, so a task holds one record and a small batch.

Null html is the empty payload. A null url gives no target header. Of equal
payloads of at least ``least`` bytes that with the smallest page_id is stored;
rows that repeat its page_id too are stored as well; null page_ids come last.
Archives without records give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from contextlib import closing

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.llm.files import locate, new_name, open_file, own_folder
from wearlog.session import materialize

LEAST = 100
FILE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
RECORD = "record_id string, type string, concurrent_to array<string>, refers_to string, url string, date string, digest string, about string, payload binary"
SCHEMA = pa.schema(
    [(n, pa.string()) for n in ("record_id", "type")] + [("concurrent_to", pa.list_(pa.string()))]
    + [(n, pa.string()) for n in ("refers_to", "url", "date", "digest", "about")] + [("payload", pa.binary())]
)


def record_id(kind: str, page_id: int | None, digest: str) -> str:
    h = hashlib.blake2b(f"{kind} {page_id} {digest}".encode(), digest_size=16).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def record(kind: str, own_id: str, fields: list[tuple[str, str]], content: str, block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [("WARC-Type", kind), ("WARC-Record-ID", own_id), *fields, ("Content-Type", content), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines)
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def _capture(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool, date: str) -> bytes:
    uri = [("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A"))] if url else []
    when = [("WARC-Date", date)]
    kind = "revisit" if revisit else "response"
    own = record_id(kind, page_id, digest)
    extra = [("WARC-Payload-Digest", f"sha256:{digest}")]
    if revisit:
        extra += [("WARC-Refers-To", record_id("response", first, digest)), ("WARC-Profile", PROFILE)]
    body = HTTP % len(payload) + (b"" if revisit else payload)
    link = [("WARC-Concurrent-To", own)]
    ask = f"GET {uri[0][1] if uri else '/'} HTTP/1.1\r\n\r\n".encode()
    about = f"page-id: {'' if page_id is None else page_id}\r\n".encode()
    return (
        record(kind, own, uri + when + extra, "application/http;msgtype=response", body)
        + record("request", record_id("request", page_id, digest), uri + when + link, "application/http;msgtype=request", ask)
        + record("metadata", record_id("metadata", page_id, digest), uri + when + link, "application/warc-fields", about)
    )


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes all pages; returns one row per file: path, captures."""
    folder = folder or own_folder(pages.sparkSession, "warc")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    base = base.withColumn("digest", F.sha2("html", 256))
    # payloads that occur once need no partner: only the repeated ones' digests are joined
    again = base.where(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first", F.lit(True).alias("repeated"))
    rows = base.join(again, "digest", "left").select(
        "page_id", "url", "html", "digest", "first", (F.coalesce("repeated", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit")
    )

    def write(batches):
        part, k, out, size, n, name = TaskContext.get().partitionId(), 0, None, 0, 0, ""
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns[:2]] + [batch.column(2).cast(pa.binary()).to_pylist()] + [c.to_pylist() for c in batch.columns[3:]]
            for page_id, url, payload, digest, first, revisit in zip(*cols, strict=True):
                if out is None:
                    name = new_name(folder, f"part-{part:06d}-{k:04d}", "warc.gz")
                    system, place = locate(name)
                    out, size, n, k = system.open_output_stream(place, compression=None), 0, 0, k + 1
                data = _capture(page_id, url, payload, digest, first, revisit, date)
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [name], "captures": [n]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "captures": [n]})

    return materialize(rows.mapInArrow(write, "path string, captures long"), "warc-files")


def parse(stream) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(headers, block) of the records of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not at the start of a WARC record")
        heads = []
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and heads:
                heads[-1] = (heads[-1][0], heads[-1][1] + " " + line.strip().decode("utf-8", "replace"))
            else:
                k, _, v = line.decode("utf-8", "replace").partition(":")
                heads.append((k.strip().lower(), v.strip()))
        size = int(next((v for k, v in heads if k == "content-length"), "0"))
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record ends early")
        yield heads, block


def _row(heads: list[tuple[str, str]], block: bytes) -> tuple:
    one = dict(reversed(heads))
    kind = one.get("warc-type")
    http = kind in ("response", "revisit") and "msgtype=response" in one.get("content-type", "")
    payload = block.partition(b"\r\n\r\n")[2] if http else block if kind in ("response", "resource") else None
    about = None if payload is not None else block.decode("utf-8", "replace")
    links = [v for k, v in heads if k == "warc-concurrent-to"]
    return one.get("warc-record-id"), kind, links, one.get("warc-refers-to"), one.get("warc-target-uri"), one.get("warc-date"), one.get("warc-payload-digest"), about, payload


def read_archives(files: DataFrame) -> DataFrame:
    """One row per record of the files in column ``path`` (gzip or plain)."""

    def read(batches):
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)

        for paths in batches:
            for path in paths.column(0).to_pylist():
                with open_file(path) as raw:
                    packed = raw.read(2) == b"\x1f\x8b"
                    raw.seek(0)
                    with closing(gzip.GzipFile(fileobj=raw)) if packed else raw as stream:
                        for heads, block in parse(stream):
                            rows.append(_row(heads, block))
                            size += len(block)
                            if size >= BATCH_BYTES or len(rows) >= 4096:
                                yield batch()
                                rows, size = [], 0
        if rows:
            yield batch()

    paths = files.select("path")
    spread = max(1, min(files.count(), 8 * files.sparkSession.sparkContext.defaultParallelism))
    return paths.repartition(spread).mapInArrow(read, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: the fields of its main record, requests and metadata (arrays of records by id).

    ``records`` is read several times; write it first. Its columns other than
    type, record_id and concurrent_to are carried along as they are. Requests and
    metadata records that lead to no capture appear in none.
    """
    side = F.col("type").isin("request", "metadata")
    mains = records.where(F.col("type").isin("response", "revisit", "resource"))
    named = records.select("record_id", F.explode("concurrent_to").alias("to"), side.alias("side"))
    links = named.where("side").select("record_id", "to").unionByName(named.where("NOT side").select(F.col("to").alias("record_id"), F.col("record_id").alias("to"))).distinct()
    ends = mains.select(F.col("record_id").alias("capture")).distinct()
    direct = links.join(ends, links["to"] == ends["capture"]).select("record_id", "capture")
    far = links.join(direct.withColumnRenamed("record_id", "to"), "to").join(direct.select("record_id").distinct(), "record_id", "left_anti").select("record_id", "capture")
    owner = direct.unionByName(far).distinct()
    rows = records.where(side).select("record_id", "type", "url", "date", "about").join(owner, "record_id")
    of = lambda kind: F.sort_array(F.collect_list(F.when(F.col("type") == kind, F.struct("record_id", "url", "date", "about"))))
    nested = rows.groupBy("capture").agg(of("request").alias("requests"), of("metadata").alias("metadata"))
    return mains.drop("concurrent_to", "about").join(nested, F.col("record_id") == F.col("capture"), "left").drop("capture")


def page_captures(pages: DataFrame) -> DataFrame:
    """Writes the pages, reads the archives back and returns one row per capture, revisits with what they refer to."""
    files = write_archives(pages)
    read = read_archives(files).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)}).drop("payload")
    nested = captures(materialize(read, "warc-records"))
    page = F.regexp_extract(F.col("metadata")[0]["about"], r"page-id: (-?\d+)", 1)
    nested = nested.withColumn("page_id", F.when(page != "", page.cast("long")))
    nested = materialize(nested, "warc-captures")
    stored = nested.where("type = 'response'")
    target = stored.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min("page_id").alias("refers_page"), F.first("payload_bytes").alias("full_bytes"), F.first("payload_digest").alias("full_digest")
    )
    seen = nested.where("type = 'revisit'").join(target, "refers_to", "left")
    seen = seen.withColumns({"payload_bytes": F.col("full_bytes"), "payload_digest": F.col("full_digest")}).drop("full_bytes", "full_digest")
    return stored.withColumn("refers_page", F.lit(None).cast("long")).unionByName(seen)
