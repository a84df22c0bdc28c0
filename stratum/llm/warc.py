"""WARC archives: writing segmented, chunked records and reading them back.

Writing. Each page becomes a ``response`` record whose block is an HTTP message in chunked transfer framing, its
payload the HTML in UTF-8. A block longer than ``segment`` bytes is split: the first part stays a response record
with ``WARC-Segment-Number: 1``, the others are ``continuation`` records that name the first in
``WARC-Segment-Origin-ID``; the last gives the ``WARC-Segment-Total-Length``. Of records with equal payloads (SHA-256)
of at least ``min_revisit`` bytes, the one with the smallest page_id is the response; the others are ``revisit``
records without payload. Records end with two line breaks, which is the line separator Spark's text writer is
given, so the files are (gzip-compressed) WARC files on whatever store the session writes to. Parts end between
characters, because that writer takes text.

Reading. The files, each bounded by ``RECORDS_PER_FILE`` records, are read whole and walked by Content-Length. Records
in one part are decoded where they are read. Parts of segmented records are grouped by origin, ordered by segment
number, checked against the total length, joined and then decoded; a group is one record's block, never more.

Defined results: a null html is an empty payload. Rows with equal page_id are archived one by one; all rows of the
smallest page_id with a payload are responses. Rows with a null page_id are written, count as larger than any other,
and come back with a null page_id. Missing or repeated segments, or a length that does not match, raise an error
that names the record. An empty table gives an empty result.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, scratch_path, written

SEGMENT, CHUNK, MIN_REVISIT, RECORDS_PER_FILE = 1 << 15, 1 << 13, 100, 2000
CRLF = "\r\n"


def between_characters(data: bytes, at: int) -> int:
    """The last place up to ``at`` where no UTF-8 character is cut."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def parts_of(data: bytes, size: int) -> list[bytes]:
    """``data`` in parts of at most ``size`` bytes (at least 4), cut between characters."""
    out, at = [], 0
    while at < len(data):
        end = between_characters(data, min(at + size, len(data)))
        out.append(data[at:end])
        at = end
    return out


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing of ``payload``."""
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts_of(payload, size)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload in ``body``; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";", 1)[0].strip(), 16)
        if not size:
            return b"".join(out)
        at = end + 2
        out.append(body[at:at + size])
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it should")
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of a whole HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(line.lower().split(b":", 1) for line in head.split(b"\r\n")[1:] if b":" in line)
    return unchunked(body) if b"chunked" in fields.get(b"transfer-encoding", b"") else body


def _record(fields: dict[str, object], block: bytes) -> str:
    fields = {**fields, "Content-Length": len(block)}
    head = "WARC/1.1" + CRLF + "".join(f"{k}: {v}{CRLF}" for k, v in fields.items() if v is not None)
    return head + CRLF + block.decode("utf-8")


def _field(text: str | None) -> str | None:
    """A value that stays on one header line."""
    return None if text is None else "".join(f"%{ord(c):02X}" if c in "\r\n\x00" else c for c in text)


def _records(segment: int, chunk: int):
    """Rows (page_id, url, html, digest, number, first) to WARC records."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                out = []
                for r in whole.slice(at, 128).to_pylist():
                    payload = (r["html"] or "").encode("utf-8")
                    name = hashlib.md5(f"{r['page_id']}:{r['number']}".encode()).hexdigest()
                    uid = lambda k: f"<urn:x-record:{name}:{k}>"  # noqa: B023, E731
                    fields = {"WARC-Record-ID": uid(1), "WARC-Date": "2024-01-01T00:00:00Z",
                              "WARC-Target-URI": _field(r["url"]), "WARC-Payload-Digest": f"sha256:{r['digest']}",
                              "X-Page-ID": r["page_id"], "Content-Type": "application/http; msgtype=response"}
                    if r["first"] is not None and r["first"] != r["page_id"]:
                        out.append(_record({"WARC-Type": "revisit", **fields, "X-Refers-To-Page-ID": r["first"],
                                            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                                            "X-Payload-Length": len(payload)}, (http + CRLF).encode()))
                        continue
                    block = (http + "Transfer-Encoding: chunked\r\n\r\n").encode() + chunked(payload, chunk)
                    parts = parts_of(block, segment)
                    for k, part in enumerate(parts, 1):
                        more = {"WARC-Segment-Number": k if len(parts) > 1 else None}
                        if k > 1:
                            more |= {"WARC-Record-ID": uid(k), "WARC-Segment-Origin-ID": uid(1)}
                            if k == len(parts):
                                more["WARC-Segment-Total-Length"] = len(block)
                        out.append(_record({"WARC-Type": "continuation" if k > 1 else "response", **fields, **more}, part))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
    return run


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT, chunk: int = CHUNK,
                   min_revisit: int = MIN_REVISIT) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files under ``path``."""
    if segment < 4 or chunk < 4:
        raise ValueError("segment and chunk must hold any character: 4 bytes")
    html = F.coalesce("html", F.lit(""))
    numbered = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html",
                            F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size"))
    equal = (numbered.filter(F.col("size") >= min_revisit).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select(F.col("digest").alias("d"), "first"))
    equal = written(equal, "equal")
    ready = (numbered.join(equal, F.col("digest") == F.col("d"), "left")
             .select("page_id", "url", "html", "digest", F.monotonically_increasing_id().alias("number"), "first"))
    (map_arrow(ready, _records(segment, chunk), "value string").write.mode("overwrite")
     .option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse(data: bytes):
    """(fields, block) of each record of a WARC file, compressed or not; field names in lower case."""
    data, at = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data, 0
    while at < len(data):
        if data[at:at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(CRLF)[1:]
        fields = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}
        size = int(fields["content-length"])
        yield fields, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


PARTS = ("page_id long, url string, type string, refers_to long, digest string, length long, origin string, number int, "
         "total long, payload binary, block binary")


def _parts(batches):
    """Rows of files to rows of records; whole records already decoded."""
    number = lambda x: None if x is None else int(x)
    for batch in batches:
        for content in batch.column(0):
            out = []
            for f, block in parse(content.as_py()):
                n = number(f.get("warc-segment-number"))
                whole = n is None
                payload = payload_of(block) if whole and f["warc-type"] == "response" else None
                out.append({"page_id": number(f.get("x-page-id") if f.get("x-page-id") != "None" else None),
                            "url": f.get("warc-target-uri"), "type": f["warc-type"],
                            "refers_to": number(f.get("x-refers-to-page-id")),
                            "digest": f.get("warc-payload-digest", "").removeprefix("sha256:"),
                            "length": number(f.get("x-payload-length")) if payload is None else len(payload),
                            "origin": f.get("warc-segment-origin-id") or f["warc-record-id"], "number": n,
                            "total": number(f.get("warc-segment-total-length")), "payload": payload,
                            "block": None if whole else block})
            schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("type", pa.string()),
                                ("refers_to", pa.int64()), ("digest", pa.string()), ("length", pa.int64()),
                                ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
                                ("payload", pa.binary()), ("block", pa.binary())])
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def _joined(batches):
    """Groups of segments (sorted) to whole payloads."""
    for batch in batches:
        for r in batch.to_pylist():
            numbers = [s["number"] for s in r["segments"]]
            block = b"".join(s["block"] for s in r["segments"])
            if numbers != list(range(1, len(numbers) + 1)) or r["total"] != len(block):
                raise ValueError(f"record {r['origin']}: segments {numbers}, {len(block)} bytes of {r['total']}")
            payload = payload_of(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["page_id"]], pa.int64()), pa.array([r["url"]], pa.string()), pa.array([r["digest"]], pa.string()),
                 pa.array([len(payload)], pa.int64()), pa.array([payload], pa.binary())],
                names=["page_id", "url", "digest", "length", "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, declared digest, payload_bytes, payload) of all records under ``path``.

    ``payload`` is null for revisits; their ``payload_bytes`` is the full payload's length."""
    files = spark.read.format("binaryFile").load(path).filter(F.col("length") > 0).select("content")
    parts = map_arrow(files, _parts, PARTS)
    whole = parts.filter("number IS NULL").select("page_id", "url", "type", "refers_to", "digest", "length", "payload")
    grouped = (parts.filter("number IS NOT NULL").groupBy("origin")
               .agg(F.sort_array(F.collect_list(F.struct("number", "block"))).alias("segments"),
                    F.max("total").alias("total"), F.min("page_id").alias("page_id"), F.min("url").alias("url"),
                    F.min("digest").alias("digest")))
    joined = map_arrow(grouped, _joined, "page_id long, url string, digest string, length long, payload binary")
    out = whole.unionByName(joined.selectExpr("page_id", "url", "'response' AS type", "cast(null AS long) AS refers_to",
                                              "digest", "length", "payload"))
    return out.select("page_id", "url", F.col("type").alias("record_type"), "refers_to", "digest",
                      F.col("length").alias("payload_bytes"), "payload")


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """``pages`` written as archives on shared storage and read back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, **how)
    return read_archives(pages.sparkSession, path)
