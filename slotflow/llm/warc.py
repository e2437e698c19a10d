"""A content-addressed web archive: each payload once by its digest, the exact headers of every record beside it.

An archive is a folder with two tables. ``payloads`` has digest and bytes, a row per distinct payload. ``records`` has the
exact bytes that stand before the payload in the WARC file (record header, and the HTTP header of the block) and the
payload's digest, a row per record. A join gives the original records back, byte for byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slotflow.llm.common import store

CRLF = "\r\n"
#: Payloads below this size are stored as responses of their own: a revisit record would hardly be smaller.
LEAST_REVISIT = 100
#: The profile that the WARC standard names for a repeated payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(key: Column, number: Column | None = None) -> Column:
    """The name of a key's record, its text escaped; a record without a key is named by ``number``."""
    named = F.concat(F.lit("<urn:page:"), F.url_encode(key.cast("string")), F.lit(">"))
    return named if number is None else F.coalesce(named, F.concat(F.lit("<urn:unnamed:"), number.cast("string"), F.lit(">")))


def http_header(length: Column) -> Column:
    return F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), length.cast("string"), F.lit(CRLF * 2))


def headers(date: str) -> Column:
    """What stands before the payload, from ``key``, ``number``, ``url``, ``digest``, ``length`` and ``refers_to`` (null: a response).

    A revisit's block is the HTTP header alone. Line ends within a URL are dropped, as they would end its line.
    """
    revisit = F.col("refers_to").isNotNull()
    http = http_header(F.col("length"))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("length"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("key"), F.col("number"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {SAME_PAYLOAD}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    return F.encode(F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), http), "UTF-8")


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for every row of ``pages`` to the new archive at ``path``.

    Of records with equal payloads of at least 100 bytes the one with the smallest key is the response, the others revisit
    it; smaller payloads are responses each. Null pages have an empty payload. Rows that repeat the smallest key are all
    responses. Null keys come last; a payload that only null keys have is a response each time. Record names hold the escaped key; rows
    without one are numbered. Very long pages are payloads like others, an empty table makes an empty archive. Only the three
    columns are read. What is shuffled besides one copy of each payload are digests and headers.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows.groupBy("digest").agg(F.any_value("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{path}/payloads")
    narrow = rows.select("key", "url", "digest", F.octet_length("payload").cast("long").alias("length"))
    first = store(narrow.where(F.col("length") >= LEAST_REVISIT).groupBy("digest").agg(F.min("key").alias("first")))
    typed = narrow.join(first, "digest", "left").withColumn("refers_to", F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")))
    typed = typed.withColumn("number", F.monotonically_increasing_id())
    typed.select("key", "digest", headers(date).alias("header")).write.option("compression", "zstd").parquet(f"{path}/records")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """``digest``, ``payload`` and ``payload_bytes``; a payload whose SHA-256 is not its digest stops the job."""
    kept = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    found = F.sha2("payload", 256)
    wrong = F.raise_error(F.concat(F.lit("payload damaged: "), F.col("digest"))).cast("string")
    return kept.select(F.when(found == F.col("digest"), found).otherwise(wrong).alias("digest"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records: ``key``, ``record_type``, ``digest``, ``refers_to`` (text), ``header``, ``payload``, ``payload_bytes``, ``content_length``.

    Type, digest and reference are read from the stored header. The payload is the full one also for revisits.
    Columns that the caller leaves out are not read: a caller without ``payload`` joins digests and sizes only.
    """
    kept = spark.read.parquet(f"{path}/records")
    text = F.decode("header", "UTF-8")
    field = lambda name, value: F.nullif(F.regexp_extract(text, rf"\r\n{name}: {value}\r\n", 1), F.lit(""))
    parsed = kept.select(
        "key",
        "header",
        field("WARC-Type", "([a-z]+)").alias("record_type"),
        field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("digest"),
        # an empty key is a key: only a missing field is null
        F.when(text.contains("\r\nWARC-Refers-To: "), F.url_decode(F.regexp_extract(text, r"\r\nWARC-Refers-To: <urn:page:([^>]*)>\r\n", 1))).alias("refers_to"),
        field("Content-Length", "([0-9]+)").cast("long").alias("content_length"),
    )
    return parsed.join(payloads(spark, path), "digest")


def record_bytes() -> Column:
    """The bytes of a record of ``read_archive`` as they stand in a WARC file."""
    own = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return F.concat(F.col("header"), own, F.lit((CRLF * 2).encode()))


def rebuilt(spark: SparkSession, path: str) -> DataFrame:
    """The records as ``read_archive`` gives them, without ``payload``, and ``record``, their bytes as they stand in a WARC file.

    A record whose block is not as long as its header says stops the job. Payloads are joined to responses alone, as revisits
    hold none; what revisits need of them are digest and size.
    """
    kept = read_archive(spark, path)
    responses = kept.where("record_type = 'response'")
    others = kept.where("record_type <> 'response'").withColumn("payload", F.lit(b""))
    both = responses.unionByName(others).withColumn("record", record_bytes())
    # the block lies between the record's header and the two line ends after it
    head = F.locate("\r\n\r\n", F.decode("header", "UTF-8"))
    before = F.octet_length(F.encode(F.substring(F.decode("header", "UTF-8"), F.lit(1), head - 1), "UTF-8")) + 4
    block = F.octet_length("record") - before - 4
    wrong = F.raise_error(F.concat(F.lit("record damaged: "), F.col("digest"))).cast("bigint")
    return both.withColumn("content_length", F.when(block == F.col("content_length"), F.col("content_length")).otherwise(wrong)).drop("payload")


def export_warc(spark: SparkSession, path: str, to: str) -> None:
    """Write the archive as WARC files: records one after the other, each followed by two line ends.

    Spark's text writer does it, as every record ends with what it puts between lines; payloads must be UTF-8.
    """
    record = F.when(F.col("record_type") == "response", F.concat("header", "payload")).otherwise(F.col("header"))
    lines = read_archive(spark, path).select(F.decode(record, "UTF-8").alias("value"))
    lines.write.option("lineSep", CRLF * 2).text(to)
