"""WARC archives: writing with segmentation, reading with segment reassembly.

A page becomes a record: a response whose HTTP body is in chunked transfer coding,
or a revisit that refers to the response with the same payload.  A block longer
than ``SEGMENT`` bytes is cut: the first record keeps its type, continuation
records name it as their origin and carry their segment number, and the last one
the total length.

Archives are read with Spark's binary file source, decompressed member by member
(an archive may hold one a record, or one for all) and parsed by content length as the
bytes come, so a task holds a compressed file and the record that it is at.  The parsed
records are stored once.  Segments are grouped by origin (a group is one page's block),
put in order of segment number, checked against the total length, and the chunked
framing is decoded.  Files are gzip-compressed, written by Spark into the shared folder,
and bounded by ``FILE_RECORDS`` records of at most ``SEGMENT`` bytes and their heads.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ROW, addressed, map_arrow, slices, store, table

SEGMENT = 8 * 1024        # longest block of one record
CHUNK = 2 * 1024          # longest chunk of the transfer coding
FILE_RECORDS = 2000       # records of one archive file, at most 16 MB of blocks
LEAST_REVISIT = 100       # shortest payload that is revisited
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
PIECE = 256 * 1024        # bytes decompressed at a time
BATCH_BYTES = 4 * 1024 ** 2   # blocks of one batch of parsed records
PAYLOADS = ("response", "resource", "conversion")
HTTP = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Transfer-Encoding: chunked\r\n\r\n")


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(c), c)
             for c in (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(data: bytes) -> bytes:
    """Decode chunked transfer coding, with extensions and trailers."""
    parts, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        n = int(data[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if n == 0:
            return b"".join(parts)
        if data[at + n:at + n + 2] != b"\r\n":
            raise ValueError("broken chunk")
        parts.append(data[at:at + n])
        at += n + 2


def _record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{k}: {v}" for k, v in fields if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def records(row: dict) -> Iterator[bytes]:
    """Records of one page: a revisit, or a response and its continuations."""
    uri = row["url"] and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])
    page = None if row["page_id"] is None else str(row["page_id"])
    own = f"<urn:uuid:{row['record']}>"
    fields = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
              ("WARC-Page-ID", page), ("WARC-Payload-Digest", f"sha256:{row['digest']}"),
              ("Content-Type", "application/http;msgtype=response")]
    if row["origin"] != row["record"]:
        yield _record("revisit", [*fields, ("WARC-Refers-To", f"<urn:uuid:{row['origin']}>"),
                                  ("WARC-Profile", PROFILE)], HTTP)
        return
    block = HTTP + chunked(row["payload"])
    if len(block) <= SEGMENT:
        yield _record("response", fields, block)
        return
    cuts = range(0, len(block), SEGMENT)
    for number, at in enumerate(cuts, 1):
        part = block[at:at + SEGMENT]
        if number == 1:
            yield _record("response", [*fields, ("WARC-Segment-Number", "1")], part)
            continue
        name = hashlib.md5(f"{row['record']}/{number}".encode()).hexdigest()
        yield _record("continuation", [
            ("WARC-Record-ID", f"<urn:uuid:{_uuid(name)}>"), ("WARC-Date", DATE),
            ("WARC-Target-URI", uri), ("WARC-Segment-Number", str(number)),
            ("WARC-Segment-Origin-ID", own),
            ("WARC-Segment-Total-Length", str(len(block)) if number == len(cuts) else None)], part)


def _uuid(digest: str) -> str:
    return "-".join(digest[a:b] for a, b in ((0, 8), (8, 12), (12, 16), (16, 20), (20, 32)))


def encode_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "payload"):
        out = [r for row in batch.to_pylist() for r in records(row)]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_archive(df: DataFrame, path: str, key: str = "page_id", url: str = "url",
                  page: str = "html") -> None:
    """Write a record for every page into gzip files below ``path``.

    Of pages with equal payloads of ``LEAST_REVISIT`` bytes or more, the one with
    the smallest key (the first by address among repeated rows) is a response and
    the others revisit it; shorter ones are all responses.  Null pages have an empty
    payload; null URLs and keys leave their field out; control characters and
    spaces of a URL are percent-encoded.  Other columns are ignored, so none can
    clash.  An empty table gives an archive without records.
    """
    digits = F.md5(F.col(ROW))
    pages = addressed(df).select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(page), F.lit("")).cast("binary").alias("payload"),
        F.concat_ws("-", *[F.substring(digits, a, n) for a, n in
                           ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]).alias("record"))
    pages = pages.withColumn("digest", F.sha2("payload", 256))
    # copies meet as counts and a least row; only groups of several are stored
    firsts = store(
        pages.where(F.length("payload") >= LEAST_REVISIT).groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(
            F.col("page_id").isNull().alias("none"), "page_id", "record")).alias("first"))
        .where("n > 1").select("digest", F.col("first.record").alias("first")), "warc-first")
    rows = pages.join(firsts, "digest", "left") \
        .withColumn("origin", F.coalesce("first", "record")).drop("first")
    (map_arrow(rows, encode_records, "value binary")
     .select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


_RECORD = pa.schema([
    ("record", pa.string()), ("kind", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("digest", pa.string()), ("refers", pa.string()), ("segment", pa.int32()),
    ("origin", pa.string()), ("total", pa.int64()), ("block", pa.binary())])
RECORD = ("record string, kind string, page_id long, url string, digest string, refers string, "
          "segment int, origin string, total long, block binary")


def decompressed(content: bytes) -> Iterator[bytes]:
    """The bytes of a file, a piece at a time: every member of a gzip file, or a plain
    file as it is.  Zero bytes after a member are padding; a member that is cut off or
    followed by anything else raises."""
    if not content or content.startswith(b"WARC/"):
        yield content
        return
    member, data = zlib.decompressobj(wbits=47), content
    while True:
        yield member.decompress(data, PIECE)
        if member.eof:
            data = member.unused_data.lstrip(b"\0")
            if not data:
                return
            member = zlib.decompressobj(wbits=47)
        else:
            data = member.unconsumed_tail
            if not data:
                yield member.flush()
                if member.eof:
                    data = member.unused_data.lstrip(b"\0")
                    if not data:
                        return
                    member = zlib.decompressobj(wbits=47)
                    continue
                raise ValueError("archive is cut off")


def _head(data: bytes) -> dict[str, str]:
    """Fields of a record's head by their names in lower case; a line that starts with
    white space goes on with the one before."""
    lines = re.sub(r"\r\n[ \t]+", " ", data.decode("utf-8")).split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse_records(pieces: Iterator[bytes] | bytes) -> Iterator[tuple]:
    """Records of one decompressed file, by their content lengths."""
    held, at = bytearray(), 0
    done = False
    pieces = iter([pieces] if isinstance(pieces, bytes) else pieces)

    def more() -> bool:
        nonlocal at, done
        del held[:at]
        at = 0
        piece = next(pieces, None)
        done = piece is None
        held.extend(piece or b"")
        return not done

    while True:
        while len(held) - at < 5 and not done:
            more()
        if at == len(held):
            return
        if not held.startswith(b"WARC/", at):
            raise ValueError("no record where one should start")
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                raise ValueError("a record's head is cut off")
        head = _head(bytes(held[at:end]))
        body, length = end + 4 - at, int(head["content-length"])
        while len(held) - at < body + length + 4:
            if not more():
                raise ValueError("a record is cut off")
        block = bytes(held[at + body:at + body + length])
        at += body + length
        if held[at:at + 4] != b"\r\n\r\n":
            raise ValueError("a record doesn't end at its length")
        at += 4

        def number(name: str) -> int | None:
            return int(head[name]) if name in head else None

        yield (head["warc-record-id"], head["warc-type"], number("warc-page-id"),
               head.get("warc-target-uri"), head.get("warc-payload-digest"),
               head.get("warc-refers-to"), number("warc-segment-number"),
               head.get("warc-segment-origin-id", head["warc-record-id"]),
               number("warc-segment-total-length"), block)


def decode_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)

    for batch in slices(batches, "content", 1):
        for content in batch.column("content").to_pylist():
            rows, size = [], 0
            for row in parse_records(decompressed(content)):
                rows.append(row)
                size += len(row[-1]) + 512
                if size > BATCH_BYTES:
                    yield rows_batch(rows)
                    rows, size = [], 0
            if rows:
                yield rows_batch(rows)


def matches(digest: str, *payloads: bytes) -> bool:
    """Whether one of the payloads has this labelled digest (``sha256:...``, in hex or
    base 32); true for labels that ``hashlib`` doesn't know."""
    name, _, value = digest.partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in hashlib.algorithms_available:
        return True
    for payload in payloads:
        found = hashlib.new(name, payload).digest()
        if value.lower() == found.hex() or value.upper() == base64.b32encode(found).decode():
            return True
    return False


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each origin in order -> the payload, checked.  A response's payload is
    its HTTP body, that of other records their block."""
    for batch in batches:
        payloads = []
        for name, kind, parts, total, digest in zip(*[
                batch.column(c).to_pylist() for c in ("record", "kind", "parts", "total", "digest")]):
            block = b"".join(p["block"] for p in parts)
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) \
                    or total is not None and total != len(block) \
                    or total is None and len(parts) > 1:
                raise ValueError(f"segments of {name} are not complete")
            head, _, body = block.partition(b"\r\n\r\n") if kind == "response" else (b"", b"", block)
            payload = unchunked(body) if re.search(
                rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body
            if digest is not None and not matches(digest, payload, body):
                raise ValueError(f"payload of {name} doesn't match its digest")
            payloads.append(payload)
        rest = batch.drop_columns(["parts", "total", "digest"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(payloads, pa.binary())],
                                         names=[*rest.schema.names, "payload"])


def stored_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``, parsed once and stored."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return store(map_arrow(files, decode_files, RECORD), "warc-records")


def payloads(found: DataFrame) -> DataFrame:
    """Payloads (record, page_id, url, kind, payload) of the records that carry one:
    responses, resources and conversions, segmented or not."""
    part = F.struct(F.coalesce("segment", F.lit(1)).alias("segment"), "block")
    carries = F.col("kind").isin(*PAYLOADS)
    whole = found.where(carries & F.col("segment").isNull()).select(
        "record", "page_id", "url", "kind", "digest", F.array(part).alias("parts"),
        F.lit(None).cast("long").alias("total"))
    cut = found.where((carries | (F.col("kind") == "continuation")) & F.col("segment").isNotNull()) \
        .groupBy("origin").agg(
            F.array_sort(F.collect_list(part)).alias("parts"), F.max("total").alias("total"),
            *[F.max(F.when(carries, F.col(c))).alias(c)
              for c in ("page_id", "url", "kind", "digest")])
    return map_arrow(whole.unionByName(cut.withColumnRenamed("origin", "record")), assemble,
                     "record string, page_id long, url string, kind string, payload binary")


def read_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Payloads (record, page_id, url, kind, payload) and revisits (record, page_id, url,
    refers, digest) of the archives below ``path``; ``kind`` is response, resource or
    conversion.  ``other_records`` gives the rest.

    Raises where a file or a record is cut off, a segment is missing or repeated, a
    total length or a payload digest does not match, or a chunk is broken.  A revisit is
    returned whether or not the response that it refers to is there.  An archive without
    records gives two empty tables; a target without a page id has a null one.
    """
    found = stored_records(spark, path)
    return payloads(found), found.where("kind = 'revisit'").select(
        "record", "page_id", "url", "refers", "digest")


def other_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of all other kinds (warcinfo, request, metadata, unknown ones) as they are:
    record, kind, url, refers, segment, origin, block."""
    return stored_records(spark, path).where(~F.col("kind").isin(*PAYLOADS, "revisit", "continuation")) \
        .select("record", "kind", "url", "refers", "segment", "origin", "block")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    responses, revisits = read_archive(spark, path)
    none = F.lit(None).cast("long")
    read = store(responses.select(
        "record", "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest")), "warc-read")
    # a revisit whose response is not there keeps its own digest; its length is unknown
    again = revisits.select("page_id", F.col("refers").alias("record"), "digest").join(
        read.withColumnRenamed("page_id", "refers_to"), "record", "left") \
        .withColumn("payload_digest", F.coalesce("payload_digest", F.substring_index("digest", ":", -1)))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (read.withColumns({"record_type": F.lit("response"), "refers_to": none})
            .select(*columns)
            .unionByName(again.withColumn("record_type", F.lit("revisit")).select(*columns)))


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""
