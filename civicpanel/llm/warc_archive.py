"""A content-addressed archive of WARC records.

The payload bytes of all records are stored once for each SHA-256 digest; the exact header
bytes of every record are stored apart, with the digest.  Records are put together again by
a join on the digest, and each payload is verified against it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicpanel.lineage import checkpoint_folder

#: Equal payloads of fewer bytes are not referred to; each is a response.
LEAST_SHARED = 100
DATE = "1970-01-01T00:00:00Z"
#: Fixed value: what a revisit record says about its payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def page_headers(pages: DataFrame) -> DataFrame:
    """page_id, header (bytes, with the empty line) and digest of the record of every page.

    Record ids are made of the page's id and digest, and a number where both repeat.

    Of the pages with an equal payload of at least 100 bytes the one with the smallest id is
    the response; the others revisit it.  Equal smallest ids are all responses; a null id is
    a response only if all ids of its payload are null.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", F.sha2(payload, 256).alias("digest"), F.length(payload).alias("size"))
    # Whole rows that repeat; one id with one payload is rare beyond that.
    keyed = keyed.withColumn("number", F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url")))
    first = keyed.where(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.lit(True).alias("shared")
    )
    rows = keyed.join(first, "digest", "left")
    revisit = F.coalesce(F.col("shared"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    again = F.when(F.col("number") > 1, F.concat(F.lit(":"), F.col("number").cast("string"))).otherwise(F.lit(""))

    def name(c: str, number: Column) -> Column:
        page = F.coalesce(F.col(c).cast("string"), F.lit("none"))
        return F.concat(F.lit("<urn:page:"), page, F.lit(":"), F.col("digest"), number, F.lit(">"))

    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name("page_id", again)),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", target), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name("first_id", F.lit(""))))).otherwise(
            F.lit("")
        ),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select("page_id", header.cast("binary").alias("header"), "digest")


def write_archive(headers: DataFrame, payloads: DataFrame, folder: str) -> None:
    """Writes ``headers`` (header, digest, ...) and each distinct one of ``payloads`` (payload).

    Digests are computed here from the bytes.  Two different payloads with one digest stop
    the job: their lengths or second hashes differ.
    """
    stored = payloads.select(F.sha2("payload", 256).alias("digest"), "payload")
    stored = stored.groupBy("digest").agg(
        F.first("payload").alias("payload"),
        F.min(F.xxhash64("payload")).alias("low"),
        F.max(F.xxhash64("payload")).alias("high"),
    )
    same = F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(
        F.raise_error(F.lit("two payloads have one digest")).cast("binary")
    )
    stored.select("digest", same.alias("payload")).write.option("compression", "zstd").parquet(f"{folder}/payloads")
    headers.write.option("compression", "zstd").parquet(f"{folder}/headers")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All records: the stored columns of the headers, payload, ``record`` and ``warc``.

    ``record`` is the header with the payload, that of a revisit too.  ``warc`` is the record as
    it stands in a WARC file: the block, which a revisit leaves empty, as its header says,
    and the closing empty lines.  The records of an archive put together are a file.

    A payload that is missing or does not have its digest stops the job.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads").withColumnRenamed("digest", "stored_digest")
    whole = headers.join(payloads, F.col("digest") == F.col("stored_digest"), "left").drop("stored_digest")
    good = F.coalesce(F.sha2("payload", 256) == F.col("digest"), F.lit(False))
    verified = F.when(good, F.col("payload")).otherwise(F.raise_error(F.lit("payload without its digest")).cast("binary"))
    whole = whole.withColumn("payload", verified)
    empty = header_field(F.col("header"), "Content-Length") == "0"
    block = F.when(empty, F.lit(b"")).otherwise(F.col("payload"))
    return whole.withColumns(
        {"record": F.concat("header", "payload"), "warc": F.concat("header", block, F.lit(b"\r\n\r\n"))}
    )


def header_field(header: Column, name: str) -> Column:
    """The value of one header line, empty where there is none."""
    return F.regexp_extract(header.cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Archives ``pages`` (page_id, url, html), reads the archive back and describes each record.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to.  A null html is an
    empty payload; a null url leaves its header line out; repeated rows are records of their
    own; an empty table gives no rows; further columns are ignored.
    """
    folder = f"{checkpoint_folder(pages.sparkSession)}/archive-{uuid.uuid4().hex}"
    payloads = pages.select(F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    write_archive(page_headers(pages), payloads, folder)
    records = read_archive(pages.sparkSession, folder)
    refers = F.regexp_extract(header_field(F.col("header"), "WARC-Refers-To"), "urn:page:(-?[0-9]+)", 1)
    return records.select(
        "page_id",
        F.length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        header_field(F.col("header"), "WARC-Type").alias("record_type"),
        F.when(refers != "", refers).cast("bigint").alias("refers_to"),
    )
