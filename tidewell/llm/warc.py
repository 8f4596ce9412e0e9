"""WARC archives with revisit records: write pages, read archives, resolve revisits.

Headers (record, payload digest, length) are shuffled by digest and the original of each payload is elected;
every other record of that payload becomes a revisit of it, without a payload of its own, and archives are
written with fresh headers. After reading, revisits are joined to the originals they refer to.

Archives are gzipped WARC/1.1, written by Spark's text sink: a record ends with an empty line, which is the
sink's line separator. So files are committed as Spark commits them, on any file system it can write.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import batches, lookup_join
from tidewell.session import materialize, scratch_path

#: Payloads shorter than this are always written in full.
LEAST_BYTES = 1000
#: Bytes an archive is meant to hold, before compression.
ARCHIVE_BYTES = 32 * 1024 * 1024
#: Payload bytes that leave a Python worker at a time, besides one record.
FRAME_BYTES = 16 * 1024 * 1024
CRLF = "\r\n"
RECORD_ID = "urn:tidewell:page:"
READ = (
    "record_type string, page_id long, target_uri string, refers_to long, payload_digest string, "
    "stored_bytes long, stored_digest string, payload binary"
)


def elect(headers: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``digest, original, n``: the largest ``page_id`` of each payload that occurs more than once."""
    return headers.filter(F.col("bytes") >= least).groupBy("digest").agg(
        F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def _record(date: str) -> Column:
    """Text of a record: WARC header, HTTP header, and the payload unless it is a revisit."""
    revisit = F.col("record_type") == "revisit"
    name = lambda page: F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value)
    return F.concat(
        F.concat_ws(
            CRLF, F.lit("WARC/1.1"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", name(F.col("page_id"))),
            F.lit(f"WARC-Date: {date}"), line("WARC-Target-URI", uri),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            F.when(revisit, line("WARC-Refers-To", name(F.col("original")))),
            F.lit("Content-Type: application/http; msgtype=response"),
            line("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string"))),
        F.lit(CRLF + CRLF), http, F.when(revisit, F.lit("")).otherwise(F.col("html")))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, date: str = "2020-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` (``page_id, url, html``) to gzipped archives under ``path``.

    A null ``html`` is an empty payload, a null ``url`` leaves the target out. Of payloads of at least
    ``least`` bytes that are equal, the record with the largest ``page_id`` is the response and the others
    are revisits; rows that repeat that ``page_id`` too are all responses. A null ``page_id`` is never the
    largest unless there is no other. Other columns are not read. An empty table gives no record.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumns({
        "digest": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html").cast("long")})
    headers = materialize(rows.select("page_id", "digest", "bytes"), "headers")
    originals = materialize(elect(headers, least), "originals")
    size = headers.agg(F.avg("bytes").alias("mean")).first()["mean"] or 0.0
    known = lookup_join(rows, originals, "digest", "n", how="left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    typed = known.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    typed.select(_record(date).alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option(
        "maxRecordsPerFile", max(1, int(ARCHIVE_BYTES // (size + 500)))).text(path)


def inflated(content: bytes, piece: int = 1 << 20) -> Iterator[bytes]:
    """Contents of a gzip file, all its members one after the other, about ``piece`` bytes at a time."""
    waiting = memoryview(content)
    while len(waiting):
        member = zlib.decompressobj(31)
        while not member.eof and (len(waiting) or member.unconsumed_tail):
            # What a step leaves over is fed again; a small step keeps what is copied small.
            step, waiting = (member.unconsumed_tail, waiting) if member.unconsumed_tail else (waiting[:piece], waiting[piece:])
            yield member.decompress(step, piece)
        if not member.eof:
            raise ValueError("an archive breaks off within a member")
        waiting = memoryview(content)[len(content) - len(waiting) - len(member.unused_data):]


def records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an archive; holds one record and one piece at a time."""
    source, held = iter(pieces), bytearray()

    def fill(n: int) -> None:
        while len(held) < n:
            held.extend(next(source))

    while True:
        while (stop := held.find(b"\r\n\r\n")) < 0:
            more = next(source, None)
            if more is None:
                if held.strip():
                    raise ValueError("an archive breaks off within a record")
                return
            held.extend(more)
        lines = held[:stop].decode("utf-8").split(CRLF)
        header = {key.lower(): value for key, _, value in (line.partition(": ") for line in lines[1:])}
        start = stop + 4
        end = start + int(header["content-length"])
        try:
            fill(end + 4)
        except StopIteration:
            raise ValueError("an archive breaks off within a record") from None
        yield header, bytes(held[start:end])
        del held[:end + 4]


def _page(name: str | None) -> int | None:
    """The page in a record's name."""
    number = name[len(RECORD_ID) + 1:-1] if name else "none"
    return None if number == "none" else int(number)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of all archives under ``path``: headers, length and SHA-1 of the stored payload, and the payload.

    ``payload_digest`` is the one in the header; ``stored_*`` describe what the record holds itself, nothing for
    a revisit. The result is stored; without ``payload`` that column is null. No archive gives no rows. Archives may have
    any number of gzip members and are inflated piece by piece; one that breaks off is an error.
    """

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                rows, held = [], 0
                for header, block in records(inflated(content)):
                    body = block[block.index(CRLF.encode() * 2) + 4:]
                    rows.append((
                        header["warc-type"], _page(header["warc-record-id"]), header.get("warc-target-uri"),
                        _page(header.get("warc-refers-to")), header["warc-payload-digest"].partition(":")[2], len(body),
                        hashlib.sha1(body).hexdigest(), body if payload else None))
                    held += len(body) if payload else 0
                    if len(rows) == 1000 or held > FRAME_BYTES:
                        yield _frame(rows)
                        rows, held = [], 0
                yield _frame(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    with batches(spark, 1):
        return materialize(files.mapInPandas(parse, READ), "records")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = ["record_type", "page_id", "target_uri", "refers_to", "payload_digest", "stored_bytes", "stored_digest", "payload"]
    return pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "refers_to": "Int64"})


def resolve(found: DataFrame, payload: bool = True) -> DataFrame:
    """Records with ``payload_bytes``, ``payload_digest`` and ``payload`` of the full payload, as SHA-1 of what is stored.

    A revisit takes them from the response that it refers to, by page and digest. Only numbers are looked up by broadcast
    of hot keys; payloads are joined by shuffle, in which a key that many revisits refer to is split.
    """
    key = F.concat_ws(":", "refers_to", "payload_digest")
    revisits = found.filter("record_type = 'revisit'").select("record_type", "page_id", "target_uri", "refers_to", key.alias("key"))
    counts = revisits.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    own = [F.col("stored_bytes").alias("payload_bytes"), F.col("stored_digest").alias("payload_digest")]
    responses = found.filter("record_type = 'response'")
    named = responses.select(F.concat_ws(":", "page_id", "payload_digest").alias("key"), *own, "payload").join(counts, "key")
    originals = materialize(named.dropDuplicates(["key"]), "originals")
    resolved = lookup_join(revisits, originals.drop("payload"), "key", "n")
    if payload:
        resolved = resolved.join(originals.select("key", "payload").hint("merge"), "key")
    else:
        resolved = resolved.withColumn("payload", F.lit(None).cast("binary"))
    columns = ["record_type", "page_id", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload"]
    return responses.select("record_type", "page_id", "target_uri", "refers_to", *own, "payload").unionByName(resolved.select(columns))


def archive(pages: DataFrame, path: str | None = None, payload: bool = False) -> DataFrame:
    """Write ``pages`` to deduplicated archives, read them back and resolve the revisits; a row per page."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    return resolve(read_archives(spark, path, payload), payload)
