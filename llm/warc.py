"""WARC archives of pages: writing with revisits, reading, and transaction assembly.

Each page becomes a transaction of three records: a request, a response (or a revisit, if
its payload is that of another page) and metadata. Request and metadata name the response
in ``WARC-Concurrent-To``; `assemble` joins them again by these identifiers into one nested
row per capture.

Records are built from column expressions and written by Spark's text writer, whose line
end is the last byte of a record's closing CR LF CR LF, so every file is a plain
WARC (compressed as a whole), lost tasks leave none behind, and any store will do.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Records of a file, so that a reader's task can hold one file.
RECORDS_PER_FILE = 30_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORDS = "record_id string, record_type string, concurrent_to string, target_uri string, refers_to string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary"


def base32_of_hex(hexed: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits."""
    parts = [F.lpad(F.conv(F.substring(hexed, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), BASE32HEX, BASE32)


def urn(*parts: Column | str) -> Column:
    """A record identifier that depends on the parts only."""
    digest = F.md5(F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in ((F.lit("-"),) if a > 1 else ()) + (F.substring(digest, a, n),)], F.lit(">"))


def marked(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, its size and digest, the response's record_id, and for a copy the page and record that it revisits.

    The record is named by the row's place in the table too, so repeated rows are transactions
    of their own. Of pages with the same payload of at least ``least_bytes`` bytes the one with the largest
    page_id stays; smaller payloads all stay. Only digests are grouped, and the join is one
    that Spark splits where a payload is very frequent.
    """
    read = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"), F.monotonically_increasing_id().alias("row"))
    read = read.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    read = read.withColumn("own", urn("response", F.col("page_id"), F.col("digest"), F.col("row"))).drop("row")
    groups = read.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.max(F.struct("page_id", "own")).alias("keeper"), F.count("*").alias("copies"))
    joined = read.join(groups.where("copies > 1").drop("copies"), "digest", "left")
    copied = (F.col("size") >= least_bytes) & (F.col("keeper.page_id") != F.col("page_id"))
    marks = {"refers_to": F.when(copied, F.col("keeper.page_id")), "revisited": F.when(copied, F.col("keeper.own"))}
    return joined.withColumns(marks).drop("keeper")


def records_of(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records as text, three rows per page."""
    uri = F.coalesce("url", F.lit(""))
    for sign, code in ((" ", "%20"), ("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        uri = F.replace(uri, F.lit(sign), F.lit(code))
    page = marked(pages, least_bytes).withColumns({"uri": uri, "digest32": base32_of_hex(F.col("digest"))})
    revisit = F.col("refers_to").isNotNull()

    def headers(kind: Column, record_id: Column, content: str, *more: Column) -> Column:
        return F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), record_id, F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.col("uri"), F.lit(f"\r\nContent-Type: {content}\r\n"), *more)

    def record(head: Column, *block: Column) -> Column:
        body = F.concat(*[b.cast("binary") for b in block])
        length = F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
        return F.concat(head.cast("binary"), length.cast("binary"), body, F.lit("\r\n\r").cast("binary")).cast("string")

    path = F.concat(F.lit("/"), F.regexp_extract("uri", "^[^:/]*://[^/]*/(.*)$", 1))
    host = F.regexp_extract("uri", "^[^:/]*://([^/]*)", 1)
    request = record(
        headers(F.lit("request"), urn("request", F.col("own")), "application/http; msgtype=request", F.lit("WARC-Concurrent-To: "), F.col("own"), F.lit("\r\n")),
        F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")),
    )
    profile = F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), F.col("revisited"), F.lit("\r\n"))).otherwise("")
    response = record(
        headers(F.when(revisit, "revisit").otherwise("response"), F.col("own"), "application/http; msgtype=response", F.lit("WARC-Payload-Digest: sha1:"), F.col("digest32"), F.lit("\r\n"), profile),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n")),
        F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload")),
    )
    field = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))
    metadata = record(
        headers(F.lit("metadata"), urn("metadata", F.col("own")), "application/warc-fields", F.lit("WARC-Concurrent-To: "), F.col("own"), F.lit("\r\n")),
        F.concat(field("pageId", F.col("page_id")), field("payloadLength", F.col("size")), field("refersToPageId", F.col("refers_to"))),
    )
    return page.select(F.explode(F.array(request, response, metadata)).alias("value"))


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write page_id, url and html of every page as WARC files.

    Null html is an empty payload, a null url an empty target. White space in a url is
    percent-encoded. A page without page_id is a response, or a revisit if another page with
    its payload has one. Repeated rows are transactions each for itself. An empty table
    gives files without records.
    """
    records_of(pages, least_bytes).write.option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(path)


def parsed(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of a WARC, held one at a time."""
    data, at = bytearray(), 0

    def more() -> bool:
        nonlocal at
        piece = next(stream, None)
        if piece is None:
            return False
        del data[:at]
        at = 0
        data.extend(piece)
        return True

    while True:
        while (end := data.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if data[at:].strip():
                    raise ValueError("the archive ends within a record")
                return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins with {lines[0][:40]!r}")
        head = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            head[name.strip().lower()] = value.strip()
        at = end + 4
        length = int(head["content-length"])
        while len(data) - at < length + 4:
            if not more():
                raise ValueError("the archive ends within a record")
        yield head, bytes(data[at : at + length])
        at += length + 4


def inflated(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a plain or gzip file, in steps."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[k : k + step] for k in range(0, len(content), step))
        return
    while content:
        unzip = zlib.decompressobj(31)
        piece = unzip.decompress(content, step)
        while piece or unzip.unconsumed_tail:
            yield piece
            piece = unzip.decompress(unzip.unconsumed_tail, step)
        content = unzip.unused_data


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the files below ``path``.

    Digest and size are those of the payload itself where the record holds one, else those
    that the record names. The fields are those of a metadata record's body. Without
    ``payloads`` that column is null.
    """

    def row(head: dict[str, str], block: bytes) -> tuple:
        kind = head.get("warc-type")
        payload = fields = size = None
        digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        elif kind == "metadata":
            fields = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if ":" in x)]
        return head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-target-uri"), head.get("warc-refers-to"), digest, size, fields, payload if payloads else None

    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.string()] * 6 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for head, block in parsed(inflated(content.as_py())):
                    rows.append(row(head, block))
                    held += len(block) + 500
                    if held > 8 << 20:
                        yield table_of(rows)
                        rows, held = [], 0
                if rows:
                    yield table_of(rows)

    def table_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """Join the records of each transaction: one nested row per response or revisit.

    Columns: capture_id, response, requests, metadata (arrays). A revisit's response names the
    record it revisits in refers_to. Records that name no known
    response are rows whose response is null; records of other types are left out.
    """
    main = records.where("record_type IN ('response', 'revisit')")
    rest = records.where("record_type IN ('request', 'metadata')")
    capture = main.select(F.col("record_id").alias("capture_id"), F.struct("record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload").alias("response"))
    request = F.when(F.col("record_type") == "request", F.struct("record_id", "target_uri"))
    metadata = F.when(F.col("record_type") == "metadata", F.struct("record_id", "fields"))
    beside = rest.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(F.collect_list(request).alias("requests"), F.collect_list(metadata).alias("metadata"))
    return capture.join(beside, "capture_id", "full")


def capture_digests(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of assembled captures."""
    fields = F.col("metadata")[0]["fields"]
    return captures.where("response IS NOT NULL").select(
        fields["pageId"].cast("long").alias("page_id"),
        F.coalesce("response.payload_bytes", fields["payloadLength"].cast("long")).alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.try_element_at(fields, F.lit("refersToPageId")).cast("long").alias("refers_to"),
        F.size("requests").alias("requests"),
        F.col("response.target_uri").alias("target_uri"),
    )
