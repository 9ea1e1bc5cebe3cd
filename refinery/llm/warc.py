"""WARC archives: write, read back and assemble transactions.

Every capture is three records: the response (or a revisit of an equal payload), the
request and a metadata record; the latter two name the first in
``WARC-Concurrent-To``. Archives are written by Spark's text writer, one record per
row with the record separator between rows, gzip-compressed, to the shared folder;
they are read as whole files of bounded size and parsed by ``Content-Length``. Request and
metadata records are joined to their response through the concurrent-to
identifier, wherever in the archives they stand, into one nested row per capture.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm.common import stored, tune
from refinery.session import work_dir

#: Payloads below this many bytes are always stored.
LEAST_SHARED = 100
#: Records per archive file: bounds what one task reads at a time.
FILE_RECORDS = 2000
CRLF = "\r\n"
STAMP = "2024-01-01T00:00:00Z"
_RECORD = ("record_id string, type string, concurrent_to string, refers_to string, uri string, "
           "page_id long, digest string, payload binary, payload_bytes long, payload_digest string, content string")


def _record(kind: Column | str, fields: list[tuple[str, Column]], block: Column) -> Column:
    """Text of a record without its closing blank lines; null fields are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def _header_value(c: Column) -> Column:
    """A value that stays on one header line (percent-encoded line breaks)."""
    return F.replace(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")),
                     F.lit("\n"), F.lit("%0A"))


def classified(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, html (null as empty), digest, first: smallest page_id of an equal payload, if shared."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    # digests that occur twice or more; only they take part in the join
    shared = stored(p.where(F.octet_length("html") >= least_shared).groupBy("digest")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).where("n > 1").drop("n"),
                    "warc-shared")
    return p.join(shared, "digest", "left")


def write_warc(pages: DataFrame, path: str) -> None:
    """Write the archives of ``pages`` (page_id, url, html) to ``path``."""
    p = classified(pages)
    key = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("-")), "digest")

    def ident(kind: str, of: Column = key) -> Column:
        return F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat(F.lit(kind + "|"), of), 256), F.lit(">"))

    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    uri = _header_value(F.coalesce("url", F.lit("")))
    page = F.col("page_id").cast("string")
    http = F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + CRLF)
    shown = [("WARC-Target-URI", uri), ("WARC-Date", F.lit(STAMP))]
    response = _record(
        F.when(revisit, "revisit").otherwise("response"),
        [("WARC-Record-ID", ident("response")), *shown, ("WARC-Page-ID", page),
         ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
         ("WARC-Refers-To-Page", F.when(revisit, F.col("first").cast("string"))),
         ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
         ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.when(revisit, http).otherwise(F.concat(http, "html")))
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-z]+://([^/?#\s]*)", 1)
    request = _record("request", [
        ("WARC-Record-ID", ident("request")), *shown, ("WARC-Concurrent-To", ident("response")),
        ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1" + CRLF + "Host: "), host, F.lit(CRLF + CRLF)))
    metadata = _record("metadata", [
        ("WARC-Record-ID", ident("metadata")), *shown, ("WARC-Concurrent-To", ident("response")),
        ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("payload-bytes: "), F.octet_length("html").cast("string"), F.lit(CRLF)))
    (p.select(F.explode(F.array(metadata, request, response)).alias("value"))
     .write.option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def _records(chunks: Iterator[bytes]) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of the records of one archive, read piece by piece."""
    buf, at = bytearray(), 0

    def fill(n: int) -> bool:
        nonlocal at
        while len(buf) - at < n:
            piece = next(chunks, None)
            if piece is None:
                return False
            if at > 1 << 20:
                del buf[:at]
                at = 0
            buf.extend(piece)
        return True

    while True:
        end = buf.find(b"\r\n\r\n", at)
        while end < 0 and fill(len(buf) - at + 1):
            end = buf.find(b"\r\n\r\n", at)
        if end < 0:
            if bytes(buf[at:]).strip():
                raise ValueError("archive ends inside a record")
            return
        lines = bytes(buf[at:end]).decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        at, size = end + 4, int(head["Content-Length"])
        if not fill(size):
            raise ValueError("archive ends inside a record")
        yield head, bytes(buf[at:at + size])
        at += size
        fill(4)
        at = min(at + 4, len(buf))


def _gunzip(data: bytes, piece: int = 1 << 18) -> Iterator[bytes]:
    """Decompressed pieces of one or several gzip members."""
    rest = data
    while rest:
        z = zlib.decompressobj(31)
        while not z.eof:
            out = z.decompress(rest, piece)
            rest = z.unconsumed_tail if not z.eof else z.unused_data
            if out:
                yield out
            elif not z.eof and not rest:
                raise ValueError("truncated gzip member")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``.

    Payloads are hashed and measured in full; with ``payloads`` false they are not
    passed on.
    """
    tune(spark)

    def run(batches):
        for batch in batches:
            for data in batch.column("content"):
                rows, held = [], 0
                for head, block in _records(_gunzip(data.as_py())):
                    kind = head["WARC-Type"]
                    http = kind in ("response", "revisit")
                    body = block.partition(b"\r\n\r\n")[2] if http else None
                    stored_body = kind == "response"
                    page = head.get("WARC-Page-ID")
                    rows.append((
                        head["WARC-Record-ID"], kind, head.get("WARC-Concurrent-To"), head.get("WARC-Refers-To-Page"),
                        head.get("WARC-Target-URI"), int(page) if page else None,
                        head.get("WARC-Payload-Digest", "").removeprefix("sha256:") or None,
                        body if stored_body and payloads else None, len(body) if stored_body else None,
                        hashlib.sha256(body).hexdigest() if stored_body else None,
                        None if http else block.decode("utf-8", "replace")))
                    held += len(block)
                    if held > 4 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")     # files, not rows
    return files.mapInArrow(run, _RECORD)


_TYPES = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
_NAMES = [x.split()[0] for x in _RECORD.split(", ")]


def _batch(rows: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: response (or revisit), requests and metadata (arrays).

    Request and metadata records meet their response by the identifier they are
    concurrent to; all of them are kept, by record id, identical repeated ones once. A
    capture without one of them has null there. A revisit takes length and digest of
    its payload from the response with that digest and page.
    """
    def side(kind: str) -> DataFrame:
        s = F.struct("record_id", "uri", "content")
        return (records.where(F.col("type") == kind).groupBy(F.col("concurrent_to").alias(f"_{kind}"))
                .agg(F.sort_array(F.collect_set(s)).alias(kind)))

    main = records.where("type in ('response', 'revisit')")
    whole = (main.where("type = 'response'")
             .select(F.col("digest").alias("_d"), F.col("page_id").alias("_p"),
                     F.col("payload_bytes").alias("_n"), F.col("payload_digest").alias("_h"))
             .join(main.where("type = 'revisit'").select(F.col("digest").alias("_d"),
                                                         F.col("refers_to").cast("long").alias("_p")).distinct(),
                   ["_d", "_p"], "left_semi").distinct())
    whole = stored(whole, "warc-originals")
    j = (main.join(whole, (F.col("type") == "revisit") & (F.col("digest") == F.col("_d"))
                   & (F.col("refers_to").cast("long") == F.col("_p")), "left")
         .join(side("request"), F.col("record_id") == F.col("_request"), "left")
         .join(side("metadata"), F.col("record_id") == F.col("_metadata"), "left"))
    return j.select(
        "page_id", "uri", F.struct(
            "record_id", "type", F.coalesce("payload_bytes", "_n").alias("payload_bytes"),
            F.coalesce("payload_digest", "_h").alias("payload_digest"), F.col("digest").alias("declared_digest"),
            F.col("refers_to").cast("long").alias("refers_to"), "payload").alias("response"),
        F.col("request").alias("requests"), "metadata")


def warc_roundtrip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, read them back and return one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to, and the records'
    identifiers. Null html is an empty payload; a null url or page_id stays null.
    Equal payloads of at least 100 bytes are stored once, with the smallest
    page_id; repeated rows of that page_id are all responses. An empty table gives
    no rows.
    """
    spark = pages.sparkSession
    path = path or work_dir(spark, "warc")
    write_warc(pages, path)
    records = stored(read_warc(spark, path, payloads=False), "warc-records")
    return assemble(records).select(
        "page_id", "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"),
        "response.refers_to", F.col("requests")[0]["record_id"].alias("request_id"),
        F.col("metadata")[0]["record_id"].alias("metadata_id"))
