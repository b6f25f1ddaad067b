"""WARC archives: writing segmented records, and putting them together again.

Archives are ordinary WARC/1.1 files, written by Spark's text writer (a record's closing blank lines are its line
separator) and read as binary files, record by record. Segmented records are grouped by the record they continue,
ordered by segment number and checked against their total length; then chunked transfer framing is undone.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialise, shared_dir

VERSION = b"WARC/1.1"
END = "\r\n\r\n"
FIELDS = "record_id string, record_type string, url string, refers_to string, origin string, segment long, total_length long, declared_digest string, damage string, block binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, chunk: int) -> bytes:
    """payload in chunked transfer framing."""
    parts = [payload[i : i + chunk] for i in range(0, len(payload), chunk)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size is missing")
        n = int(body[at:line].split(b";")[0].strip(), 16)
        if n == 0:
            return b"".join(out)
        if n < 0 or line + 2 + n + 2 > len(body) or body[line + 2 + n : line + 4 + n] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(body[line + 2 : line + 2 + n])
        at = line + 4 + n


def decode_block(block: bytes) -> tuple[bytes | None, str]:
    """Payload of an HTTP response, and ok or what is wrong with it."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None, "no http header"
    names = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if b"chunked" not in names.get(b"transfer-encoding", b""):
        return body, "ok"
    try:
        return unchunked(body), "ok"
    except ValueError:
        return None, "broken chunks"


def records_of(record_id: str, url: str, payload: bytes, refers_to: str | None, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The WARC records of one capture, without their closing blank lines: a revisit, or a response and its continuations."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    # A URL goes on one line: what would end it or isn't printable is percent-encoded.
    target = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    common = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]

    def record(kind: str, own_id: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
        fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{own_id}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), *fields, ("Content-Length", str(len(block)))]
        return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block

    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield record("revisit", record_id, [*common, ("WARC-Profile", profile), ("WARC-Refers-To", f"<{refers_to}>"), ("Content-Type", "application/http;msgtype=response")], http)
        return
    block = http + chunked(payload, chunk_bytes)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    for n, part in enumerate(parts, 1):
        segment = [("WARC-Segment-Number", str(n))] if len(parts) > 1 else []
        if n == 1:
            yield record("response", record_id, [*common, *segment, ("Content-Type", "application/http;msgtype=response")], part)
        else:
            total = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
            yield record("continuation", f"{record_id}:{n}", [("WARC-Segment-Origin-ID", f"<{record_id}>"), *segment, *total], part)


def write_archives(captures: DataFrame, path: str | None = None, min_revisit_bytes: int = 0, segment_bytes: int = 16_384, chunk_bytes: int = 4_096, records_per_file: int = 4_000) -> str:
    """Writes (capture_id long, url, payload binary) as gzip WARC files below path and returns the path.

    Of captures with equal payloads of at least min_revisit_bytes, the one with the largest id is a response and the
    others are revisits of it; smaller payloads are all responses. Each row makes a record of its own: rows equal in id
    and payload are numbered in order of their urls, and the first of them is the response. A null payload is empty, a
    null url too; a null id is smaller than any other. An archive holds at most records_per_file records of
    segment_bytes each."""
    path = path or f"{shared_dir(captures.sparkSession)}/warc-{uuid.uuid4().hex}"
    rows = captures.select(F.col("capture_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("payload", F.lit(b"")).alias("payload")).withColumn("digest", F.sha1("payload"))
    # What many captures may have in common is joined from tables on both sides, so that Spark can split a hot payload.
    same = rows.where(F.length("payload") >= min_revisit_bytes).groupBy("digest").agg(F.max("capture_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = materialise(same.select("digest", "last", F.lit(True).alias("shared")), "payloads")
    key = [F.col("capture_id").isNull().alias("no_id"), F.coalesce("capture_id", F.lit(0)).alias("id"), "digest"]
    may_repeat = rows if min_revisit_bytes > 0 else rows.join(same.select("digest"), "digest", "left_semi")
    again = materialise(may_repeat.groupBy(*key).count().where("count > 1").drop("count"), "repeated")
    marked = rows.join(same, "digest", "left").select("capture_id", "url", "payload", "digest", "last", F.coalesce("shared", F.lit(False)).alias("shared"))
    marked = numbered(marked, again) if not again.isEmpty() else marked.withColumn("number", F.lit(0).cast("long"))
    response = ~F.col("shared") | (F.col("capture_id").eqNullSafe(F.col("last")) & (F.col("number") == 0))
    marked = marked.select("capture_id", "url", "payload", "digest", "number", "last", response.alias("response"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = lambda i, digest, number: f"urn:capture:{i if i is not None else ''}:{digest}:{number}"
        for batch in batches:
            for capture, url, payload, digest, number, last, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                target = None if response else name(last, digest, 0)
                own = list(records_of(name(capture, digest, number), url, payload, target, segment_bytes, chunk_bytes))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], ["value"])

    lines = marked.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)
    return path


def numbered(marked: DataFrame, again: DataFrame) -> DataFrame:
    """marked with number: 0 but for rows equal in id and digest (no_id, id, digest of again), which count from 0.

    Only the counts of such rows are put in order; equal rows are one, with its count, while they move."""
    key = [F.col("capture_id").isNull().alias("no_id"), F.coalesce("capture_id", F.lit(0)).alias("id")]
    marked = marked.select("*", *key)
    on = ["no_id", "id", "digest"]
    single = marked.join(again, on, "left_anti").withColumn("number", F.lit(0).cast("long"))
    counts = marked.join(again, on, "left_semi").groupBy(*on, "url", "last", "shared").agg(F.count(F.lit(1)).alias("n"), F.first("payload").alias("payload"))
    before = Window.partitionBy(*on).orderBy("url").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    repeated = starts.withColumn("number", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)))
    return single.unionByName(repeated.select(*on, "url", "last", "shared", "payload", "number", F.when(~F.col("no_id"), F.col("id")).alias("capture_id"))).drop("no_id", "id")


def parse_archive(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Header fields (names in lower case), block and damage of each record of an archive.

    A record without a proper length has no block, and the next one is looked for behind it; one that is cut off has
    what is there of it, and ends the archive. So damage costs one record, and is never silent."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip().lower()] = v.strip()
        declared = fields.get("content-length", "")
        if not (declared.isascii() and declared.isdigit() and len(declared) <= 18):
            yield fields, b"", "malformed length"
            continue
        block = stream.read(int(declared))
        yield fields, block, None if len(block) == int(declared) else "cut off"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives (plain or gzip) below path. Blocks are as they are stored; damage says
    what is wrong with a record itself: a malformed length, or a cut-off block."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()), ("origin", pa.string()), ("segment", pa.int64()), ("total_length", pa.int64()), ("declared_digest", pa.string()), ("damage", pa.string()), ("block", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_buffer()
                stream = io.BufferedReader(pa.BufferReader(raw)) if raw[:2].to_pybytes() != b"\x1f\x8b" else gzip.GzipFile(fileobj=pa.BufferReader(raw))
                rows, held = [], 0
                for f, block, damage in parse_archive(io.BufferedReader(stream) if isinstance(stream, gzip.GzipFile) else stream):
                    bare = lambda k: f[k].strip("<>") if k in f else None  # noqa: B023, E731
                    number = lambda k: int(f[k]) if f.get(k, "").isascii() and f.get(k, "").isdigit() and len(f[k]) <= 18 else None  # noqa: B023, E731
                    own = bare("warc-record-id")
                    rows.append((own, f.get("warc-type"), f.get("warc-target-uri"), bare("warc-refers-to"), bare("warc-segment-origin-id") or own, number("warc-segment-number"), number("warc-segment-total-length"), f.get("warc-payload-digest"), damage, block))
                    held += len(block)
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return files.mapInArrow(parse, FIELDS)


def reassemble(records: DataFrame) -> DataFrame:
    """Responses and revisits of read_archives, whole: record_id, record_type, url, refers_to, payload, status.

    Only segmented records are shuffled, by the record they continue. A repeated segment counts once; a record that is
    stored more than once in one piece comes back as often. status is ok, or says what is wrong, with a null payload:
    damage of a record or segment, a missing segment or first record, two different segments of one number, a total
    length that doesn't fit, broken chunks, or a digest that differs from the declared one. Revisits have no payload of
    their own. Segments are put together once, in the step that decodes them."""
    ok = F.lit("ok")
    single = records.where("segment is null and record_type in ('response', 'revisit')").select("record_id", "record_type", "url", "refers_to", "declared_digest", F.array("block").alias("blocks"), F.lit(None).cast("long").alias("total"), F.coalesce("damage", ok).alias("status"))
    parts = F.struct("segment", "record_id", "record_type", "url", "refers_to", "declared_digest", "total_length", "block", "damage")
    once = records.where("segment is not null").withColumn("same", F.struct(F.length("block"), F.xxhash64("block"), F.crc32("block"))).dropDuplicates(["origin", "segment", "same", "damage"])
    grouped = once.groupBy("origin").agg(F.array_sort(F.collect_list(parts)).alias("parts"), F.max("total_length").alias("total"), F.max("damage").alias("damage"))
    first, numbers = F.col("parts")[0], F.transform("parts", lambda p: p.segment)
    fits = (first["segment"] == 1) & (F.element_at("parts", -1)["segment"] == F.size("parts")) & F.element_at("parts", -1)["total_length"].isNotNull()
    status = F.when(F.col("damage").isNotNull(), F.col("damage")).when(F.size(F.array_distinct(numbers)) < F.size(numbers), "two segments of one number").when(~fits, "missing segment").otherwise(ok)
    joined = grouped.select(
        F.col("origin").alias("record_id"), first["record_type"].alias("record_type"), first["url"].alias("url"), first["refers_to"].alias("refers_to"), first["declared_digest"].alias("declared_digest"), F.transform("parts", lambda p: p.block).alias("blocks"), "total", status.alias("status")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, states = [], []
            for at, (kind, declared, total, status) in enumerate(zip(*(batch.column(i).to_pylist() for i in (1, 4, 6, 7)), strict=True)):
                payload = None
                if status == "ok" and (kind == "response" or total is not None):
                    block = b"".join(batch.column(5)[at].as_py())
                    if total is not None and len(block) != total:
                        status = "wrong total length"
                    elif kind == "response":
                        payload, status = decode_block(block)
                    if payload is not None and declared and declared.startswith("sha1:") and declared[5:] != base32_sha1(payload):
                        payload, status = None, "wrong digest"
                payloads.append(payload)
                states.append(status)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(payloads, pa.binary()), pa.array(states, pa.string())], ["record_id", "record_type", "url", "refers_to", "declared_digest", "payload", "status"])

    return single.unionByName(joined).mapInArrow(decode, "record_id string, record_type string, url string, refers_to string, declared_digest string, payload binary, status string")
