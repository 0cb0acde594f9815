"""WARC archives with revisit records.

Headers only (id, payload digest, length) are shuffled by digest; of equal payloads of `min_bytes` or more the record
with the smallest id is the original. Later ones are joined to it and written as revisit records with fresh headers and
no payload, the others as responses. Archives are plain WARC/1.1, written by Spark's text writer: a record ends with two
CRLF, which is the writer's line separator. Every record carries the archive's random name in its first header line, so
that a splitting reader can find record starts even where a payload quotes another archive.

Null html is an empty payload. A null id is never an original unless all ids of that payload are null, in which case all
its records are responses. Rows with the original's own id are responses too, so repeated rows repeat. Further columns
are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom.llm.common import checkpointed, own_folder, text_or_empty

CRLF = "\r\n"
BREAK = CRLF + CRLF
PREFIX = "urn:skuloom:page:"
DATE = "2024-01-01T00:00:00Z"
#: Revisits are sent to all executors up to this many rows (about 100 bytes each); beyond it they are shuffled.
BROADCAST_ROWS = 50_000


@dataclass(frozen=True)
class Archive:
    """Folder of the files and the name that marks the record starts."""

    folder: str
    name: str

    @property
    def start(self) -> str:
        return f"WARC/1.1{CRLF}X-Archive: {self.name}{CRLF}"


def payloads(pages: DataFrame) -> DataFrame:
    """Id, url, payload, its digest and length."""
    html = text_or_empty("html")
    return pages.select(
        F.col("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"),
        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("length"),
    )


def revisits(headers: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, digest, original) of the records whose payload a record with a smaller id has."""
    large = headers.filter(F.col("length") >= min_bytes)
    originals = (
        large.groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("original").isNotNull())
        .drop("n")
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("original"))
    return large.join(originals, "digest").filter(later).select("page_id", "digest", "original").distinct()


def typed(pages: DataFrame, min_bytes: int, broadcast_rows: int) -> DataFrame:
    """The payloads with the original's id where they are revisits, else null."""
    rows = payloads(pages)
    later = checkpointed(revisits(checkpointed(rows.select("page_id", "digest", "length")), min_bytes))
    found = later.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "original")
    if later.count() <= broadcast_rows:
        found = F.broadcast(found)
    return rows.join(found, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")


def header(name: str, value: Column | str) -> Column:
    """A header line; nothing where the value is null."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def record(archive: Archive) -> Column:
    """A whole record but for the two CRLF at its end."""
    revisit = F.col("original").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("length").cast("string"), F.lit(BREAK),
    )
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    urn = F.concat(F.lit(f"<{PREFIX}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    return F.concat(
        F.lit(archive.start),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", urn),
        header("WARC-Date", DATE),
        header("WARC-Target-URI", F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        header("WARC-Refers-To", F.concat(F.lit(f"<{PREFIX}"), F.col("original").cast("string"), F.lit(">"))),
        header("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        header("Content-Type", "application/http; msgtype=response"),
        header("Content-Length", F.octet_length(body).cast("string")),
        F.lit(CRLF),
        body,
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 100, broadcast_rows: int = BROADCAST_ROWS) -> Archive:
    """Write a record per row of (page_id, url, html), one archive per task."""
    archive = Archive(folder, uuid.uuid4().hex)
    rows = typed(pages, min_bytes, broadcast_rows)
    rows.select(record(archive).alias("value")).write.option("lineSep", BREAK).text(folder)
    return archive


def field(name: str) -> Column:
    """Value of a header line, null if there is none."""
    value = F.regexp_extract("headers", f"(?:^|{CRLF}){name}: ([^\\r]*)", 1)
    return F.when(value != "", value)


def before(column: str) -> Column:
    """What stands before the first empty line."""
    return F.substring(F.col(column), F.lit(1), F.instr(column, BREAK) - 1)


def after(column: str) -> Column:
    return F.substring(F.col(column), F.instr(column, BREAK) + len(BREAK), F.length(column))


def read_archives(spark: SparkSession, archive: Archive) -> DataFrame:
    """(record_id, record_type, url, refers_to, digest, http, payload) of every record; payload is null for revisits.

    The digest of a response is taken from its payload as read, that of a revisit from its header. A record whose
    length differs from its Content-Length raises.
    """
    lines = spark.read.option("lineSep", archive.start).text(archive.folder).filter(F.col("value") != "")
    parts = lines.select(before("value").alias("headers"), after("value").alias("rest"))
    size = field("Content-Length").cast("int")
    # behind the body stand the two CRLF that end the record
    whole = F.octet_length("rest") == size + len(BREAK)
    parts = parts.withColumn(
        "rest", F.when(whole, F.col("rest")).otherwise(F.raise_error(F.lit("a WARC record is cut or malformed")))
    )
    parts = parts.withColumn("block", F.substring(F.col("rest"), F.lit(1), F.length("rest") - len(BREAK)))
    response = field("WARC-Type") == "response"
    payload = F.when(response, after("block"))
    return parts.select(
        field("WARC-Record-ID").alias("record_id"), field("WARC-Type").alias("record_type"),
        field("WARC-Target-URI").alias("url"), field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Payload-Digest").alias("header_digest"),
        before("block").alias("http"), payload.alias("payload"),
    ).withColumn("digest", F.coalesce(F.concat(F.lit("sha256:"), F.sha2("payload", 256)), F.col("header_digest")))


def number(urn: str, kind: str) -> Column:
    text = F.regexp_extract(urn, f"<{PREFIX}(.*)>", 1)
    return F.when(text != "", text).cast(kind)


def revisit_table(pages: DataFrame, min_bytes: int = 100, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write the archives into the shared folder, read them back, and describe every record."""
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    archive = write_archives(pages, own_folder(spark, "warc"), min_bytes, broadcast_rows)
    told = F.regexp_extract("http", r"Content-Length: (\d+)", 1).cast("long")
    return read_archives(spark, archive).select(
        number("record_id", kind).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), told).alias("payload_bytes"),
        F.substring_index("digest", ":", -1).alias("payload_digest"),
        "record_type",
        number("refers_to", kind).alias("refers_to"),
    )
