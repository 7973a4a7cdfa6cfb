"""Legacy archive conversion: ARC records read and rewritten as WARC.

ARC files open with a version block whose last line names the fields of every
record header.  Version 1 headers hold five fields, version 2 ten; both end
with the declared length of the body.  Records are parsed by those lengths,
never by searching for a separator, and rewritten as WARC records with
synthesised identifiers, timestamps, types and digests.

WARC bytes are written with Spark's text writer (it stores bytes as they are)
under the cluster's shared folder and read back with its binary file reader,
so archives can live in any store Spark reaches.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haven.llm.common import scratch_root, written

# Header fields by ARC version, as the version block names them.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
CRLF = b"\r\n"
END = "\r\n\r\n"
MIN_REVISIT = 100
#: Readers hold a compressed file and one record of it at a time.
RECORDS_PER_FILE = 1000
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "arc-to-warc")


@dataclass
class ArcRecord:
    fields: dict[str, str]
    body: bytes
    is_version_block: bool = False


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 converter\n{' '.join(ARC_FIELDS[version])}\n".encode()
    head = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain",
            "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": name,
            "Archive-length": str(len(body))}
    return " ".join(head[f] for f in ARC_FIELDS[version]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: str, date: str, payload: bytes, content_type: str = "text/html",
               offset: int = 0, name: str = "-") -> bytes:
    """A record as crawlers wrote it: the HTTP response with its headers is the body."""
    body = b"HTTP/1.0 200 OK\r\nContent-Type: %s\r\nContent-Length: %d\r\n\r\n" % (content_type.encode(), len(payload)) + payload
    head = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": content_type,
            "Result-code": "200", "Checksum": hashlib.md5(body).hexdigest(), "Location": "-", "Offset": str(offset),
            "Filename": name, "Archive-length": str(len(body))}
    return " ".join(head[f] for f in ARC_FIELDS[version]).encode() + b"\n" + body + b"\n"


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of one ARC file by its own version block, which is the record at
    byte 0; elsewhere a URL may well begin with ``filedesc://``.

    A URL may hold spaces in old files, so a header is cut from the right: all
    fields but the first are free of spaces.
    """
    at, fields = 0, ARC_FIELDS[1]
    while at < len(data):
        eol = data.index(b"\n", at)
        line = data[at:eol].rstrip(b"\r").decode("utf-8", "replace")
        if not line:  # blank lines between records
            at = eol + 1
            continue
        block = at == 0 and line.startswith("filedesc://")
        if block:
            n = int(line.rsplit(" ", 1)[1])
            body = data[eol + 1: eol + 1 + n]
            rows = body.decode("latin-1").splitlines()
            fields = rows[1].split(" ") if len(rows) > 1 else ARC_FIELDS[int(rows[0].split(" ")[0])]
        values = line.rsplit(" ", len(fields) - 1)
        if len(values) != len(fields):
            raise ValueError(f"an ARC header has {len(values)} of {len(fields)} fields at byte {at}")
        n = int(values[-1])
        body = data[eol + 1: eol + 1 + n]
        if len(body) != n:
            raise ValueError(f"an ARC body ends {n - len(body)} bytes early at byte {at}")
        yield ArcRecord(dict(zip(fields, values, strict=True)), body, block)
        at = eol + 1 + n


def warc_type(body: bytes) -> str:
    return "response" if body.startswith(b"HTTP/") else "resource"


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """(headers with their blank line, payload); bodies without HTTP headers are all payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    end = body.find(b"\r\n\r\n")
    return (body, b"") if end < 0 else (body[: end + 4], body[end + 4:])


def warc_date(arc_date: str) -> str:
    d = arc_date.ljust(14, "0")[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, digest: str, key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, '|'.join((url, date, digest, key)))}>"


def warc_record(kind: str, url: str, date: str, digest: str, key: str, block: bytes, refers_to: str | None) -> bytes:
    """A whole record but for the two line ends that close it."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(url, date, digest, key)), ("WARC-Date", date),
            ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Source-Key", key),
            ("Content-Type", "application/http; msgtype=response" if kind != "resource" else "text/html")]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", refers_to)]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1" + CRLF + b"".join(f"{k}: {v}".encode() + CRLF for k, v in head) + CRLF + block


def unzipped(data: bytes, size: int = 1 << 16) -> Iterator[bytes]:
    """The content of gzip members, piece by piece."""
    member = zlib.decompressobj(47)
    for at in range(0, len(data), size):
        piece = data[at: at + size]
        while piece:
            yield member.decompress(piece)
            piece = member.unused_data
            if member.eof:
                member = zlib.decompressobj(47)


def parse_warc(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, by declared lengths; holds one record at a time."""
    held, at = bytearray(), 0
    pieces = iter(pieces)

    def more() -> bool:
        nonlocal at
        piece = next(pieces, None)
        if piece is not None and at:
            del held[:at]
            at = 0
        held.extend(piece or b"")
        return piece is not None

    while len(held) > at or more():
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if held[at:]:
                    raise ValueError("a WARC header is cut off")
                return
        lines = held[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record where one should begin: {lines[0][:80]}")
        head = {k: v for k, v in (x.split(": ", 1) for x in lines[1:])}
        n, start = int(head["Content-Length"]), end + 4 - at
        while len(held) - at < start + n + 4 and more():
            pass
        if len(held) - at < start + n:
            raise ValueError("a WARC block is cut off")
        yield head, bytes(held[at + start: at + start + n])
        at += start + n + 4


def pages_to_arc(pages: DataFrame) -> DataFrame:
    """(page_id, arc): each page as the bytes of a small ARC file (a version
    block and one record), versions 1 and 2 in turn.  Stands in for a crawl."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arcs = []
            for i, (url, html) in enumerate(zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True)):
                version, payload = 1 + i % 2, (html or "").encode()
                url = "".join(c if c > " " and c != "\x7f" else "%20" for c in url or "") or "unknown:"
                arcs.append(arc_version_block(version, "pages.arc", "20240101000000")
                            + arc_record(version, url, "20240101000000", payload))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(arcs, pa.binary())], names=["page_id", "arc"])
    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {id_type}, arc binary")


def arc_records(arcs: DataFrame, key: str, extra: Column | None = None) -> DataFrame:
    """(key, url, date, digest, n_bytes, body) of every record but the version blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for i, data in enumerate(batch.column("arc").to_pylist()):
                for r in parse_arc(data):
                    if r.is_version_block:
                        continue
                    payload = split_http(r.body)[1]
                    rows.append(i)
                    out.append((r.fields["URL"], warc_date(r.fields["Archive-date"]),
                                hashlib.sha256(payload).hexdigest(), len(payload), r.body))
            if rows:
                url, date, digest, n, body = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).take(pa.array(rows)), pa.array(url), pa.array(date), pa.array(digest),
                     pa.array(n, pa.int64()), pa.array(body, pa.binary())],
                    names=[key, "url", "date", "digest", "n_bytes", "body"])
    id_type = arcs.schema[key].dataType.simpleString()
    return arcs.mapInArrow(run, f"{key} {id_type}, url string, date string, digest string, n_bytes long, body binary")


def convert(arcs: DataFrame, key: str, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Write every ARC record as a WARC record below ``path`` (gzip files).

    Of records with equal payloads of at least ``min_revisit`` bytes the one with
    the smallest key holds the payload; the others are revisits that name it.
    """
    records = arc_records(arcs, key)
    id_type = arcs.schema[key].dataType
    lean = written(records.select(key, "url", "date", "digest", "n_bytes"), "arc-index")
    first = (lean.filter(F.col("n_bytes") >= min_revisit).groupBy("digest")
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(key, "url", "date")).alias("first")).filter("n > 1"))
    again = (lean.join(first, "digest").filter(~F.col(key).eqNullSafe(F.col("first")[key]))
             .select(F.col(key).alias("_k"), F.col("digest").alias("_d"), "first").distinct())
    joined = records.join(again, records[key].eqNullSafe(again["_k"]) & (records["digest"] == again["_d"]), "left")
    is_text = isinstance(id_type, T.StringType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = lambda k: "" if k is None else (k if is_text else str(k))
        for batch in batches:
            out = []
            for k, url, date, digest, body, first in zip(*(batch.column(c).to_pylist() for c in (
                    "_key", "url", "date", "digest", "body", "first")), strict=True):
                if first is None:
                    out.append(warc_record(warc_type(body), url, date, digest, text(k), body, None))
                else:
                    refers = record_id(first["url"], first["date"], digest, text(first["k"]))
                    out.append(warc_record("revisit", url, date, digest, text(k), split_http(body)[0], refers))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    ready = joined.select(F.col(key).alias("_key"), "url", "date", "digest", "body", F.when(
        F.col("first").isNotNull(), F.struct(F.col("first")[key].alias("k"), F.col("first.url").alias("url"),
                                             F.col("first.date").alias("date"))).alias("first"))
    (ready.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(key, record_type, record_id, refers_to_id, payload_digest, payload_bytes, payload) per record.

    A revisit keeps its HTTP headers, so its Content-Length tells the size of
    the full payload; elsewhere digest and length are computed from the bytes read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "record_type", "record_id", "refers_to_id", "payload_digest", "payload_bytes", "payload"]
        for batch in batches:
            for data in batch.column("content").to_pylist():
                out = []
                for head, block in parse_warc(unzipped(data)):
                    http, payload = split_http(block)
                    kind, said = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:")
                    n = len(payload)
                    if kind == "revisit":
                        n = next(int(x.split(b":")[1]) for x in http.split(CRLF) if x.lower().startswith(b"content-length:"))
                    elif hashlib.sha256(payload).hexdigest() != said:
                        raise ValueError(f"digest mismatch in {head['WARC-Record-ID']}")
                    out.append((head["X-Source-Key"], kind, head["WARC-Record-ID"], head.get("WARC-Refers-To"), said, n, payload))
                    if len(out) >= 500:
                        yield _batch(out, names)
                        out = []
                if out:
                    yield _batch(out, names)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, "key string, record_type string, record_id string, refers_to_id string, "
                                 "payload_digest string, payload_bytes long, payload binary")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def pages_through_warc(pages: DataFrame) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Pages become ARC records, are converted and written as WARC, and the result
    comes from reading those archives.  Null html counts as empty, null urls as
    ``unknown:``; payloads under 100 bytes are never revisits; a null page_id
    is smaller than any other and reads back as null; rows alike in page_id and
    payload share one decision; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = f"{scratch_root(spark)}/warc-{uuid.uuid4().hex[:12]}"
    convert(pages_to_arc(pages), "page_id", path)
    id_type = pages.schema["page_id"].dataType
    key = F.when(F.col("key") != "", F.col("key")).cast(id_type)
    lean = written(read_warc(spark, path).select(key.alias("page_id"), "record_type", "record_id", "refers_to_id",
                                                 "payload_digest", "payload_bytes"), "warc-index")
    ids = (lean.filter(F.col("record_type") != "revisit")
           .groupBy(F.col("record_id").alias("refers_to_id")).agg(F.min("page_id").alias("refers_to")))
    return lean.join(ids, "refers_to_id", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
