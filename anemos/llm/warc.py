"""A content-addressed WARC archive.

Two tables: ``blobs`` stores each payload once under its SHA-256; ``headers`` keeps every
record's WARC header and HTTP header as exact text, with the digest of its payload.
``records`` checks each stored payload against its digest and its lengths and joins the
original records together again; ``record_text`` gives the bytes of a .warc file.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with the largest
id (then the smallest url) is a response, the others revisit it; below that all are
responses. Defined results: a null payload is empty; a null id sorts lowest and is
written as an empty name; of repeated rows one is the response; a null url gives a
record without a target; line ends in urls are percent-encoded; an empty table gives an
empty archive; columns other than the three named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The alphabet of base32 (a fixed value), and the profile of records that repeat a payload.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
END = "\r\n"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base32: five hexadecimal digits are four letters, without padding."""
    digest = F.sha1(data)
    letters = []
    for at in range(1, 41, 5):
        value = F.conv(F.substring(digest, at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substr(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def record_name(page: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(END))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", least_bytes: int = 0, date: str = DATE) -> None:
    """Write ``blobs`` and ``headers`` below ``path``."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("sha256", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    # The largest id, then the smallest url, as the smallest of (-id, url); a null id comes last.
    rank = F.struct(F.col("page").isNull().alias("none"), (-F.col("page")).alias("minus"),
                    F.coalesce("url", F.lit("")).alias("url"))
    # Copies shrink to one payload per digest on the map side, so a payload of very many pages is moved a few times only.
    stored = keyed.groupBy("sha256", "bytes").agg(F.min(rank).alias("first"), F.first("payload").alias("payload"))
    stored.select("sha256", "bytes", "payload", (-F.col("first.minus")).alias("response"),
                  F.col("first.url").alias("response_url"), base32_sha1(F.col("payload")).alias("sha1")
                  ).write.parquet(f"{path}/blobs")
    blobs = spark.read.parquet(f"{path}/blobs").drop("payload", "bytes")
    # Repeated rows are counted and dealt out again, so exactly one of them can be the response.
    each = keyed.groupBy("sha256", "bytes", "page", "url").agg(F.count("*").alias("n")).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    joined = each.join(blobs, "sha256")
    response = (F.col("bytes") < least_bytes) | ((F.col("copy") == 1) & F.col("page").eqNullSafe(F.col("response"))
                                                 & (F.coalesce("url", F.lit("")) == F.col("response_url")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(END + END))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(F.col("is_response"), "response").otherwise("revisit")),
        _line("WARC-Record-ID", record_name(F.col("page"))), _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", target), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(F.col("is_response"), F.lit("")).otherwise(F.concat(
            _line("WARC-Profile", F.lit(REVISIT)), _line("WARC-Refers-To", record_name(F.col("response"))))),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", (F.octet_length("http") + F.when(F.col("is_response"), F.col("bytes")).otherwise(0))
              .cast("string")))
    joined.withColumn("is_response", response).withColumn("http", http).select(
        "sha256", header.alias("header"), "http").write.parquet(f"{path}/headers")


def field(header: Column, name: str) -> Column:
    """A field of a WARC header; null if it is missing."""
    value = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains(header, F.lit(f"{END}{name}: ")), value)


def blobs(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads with their length and SHA-1, taken from the bytes; a payload that doesn't fit its digest fails."""
    stored = spark.read.parquet(f"{path}/blobs")
    intact = (F.sha2("payload", 256) == F.col("sha256")) & (F.octet_length("payload") == F.col("bytes"))
    return stored.select("sha256", "payload", F.when(intact, F.octet_length("payload").cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), "sha256")).cast("long")).alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records: header, http, payload, payload_bytes, payload_digest and the fields of the header.

    A revisit carries the payload of the record it refers to. A digest in a header that
    doesn't fit the payload fails.
    """
    kept = spark.read.parquet(f"{path}/headers")
    page = lambda name: F.regexp_extract(field(F.col("header"), name), "^<urn:x-page:(.*)>$", 1)
    number = lambda c: F.when(c != "", c.cast("long"))
    fits = field(F.col("header"), "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), "payload_digest")
    return kept.join(blobs(spark, path), "sha256").select(
        number(page("WARC-Record-ID")).alias("page_id"), "payload_bytes",
        F.when(fits, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a header names another digest")))
        .alias("payload_digest"),
        field(F.col("header"), "WARC-Type").alias("record_type"), number(page("WARC-Refers-To")).alias("refers_to"),
        field(F.col("header"), "WARC-Target-URI").alias("url"), "header", "http", "payload")


def record_text(rows: DataFrame) -> DataFrame:
    """The bytes of each record as in a .warc file, in column ``record``."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    return rows.withColumn("record", F.concat(
        F.col("header").cast("binary"), F.lit(END).cast("binary"), F.col("http").cast("binary"), body,
        F.lit(END + END).cast("binary")))
