"""Operator 10: content-addressed web archive.

An archive is two tables below one folder. ``payloads`` is bucketed by digest
and holds every distinct payload once, under its SHA-256; ``records`` holds one
row per record with the exact bytes of its WARC and HTTP headers. Equal
payloads are one response (the record with the largest page_id) and revisits
that refer to it; payloads under ``min_revisit_bytes`` are all responses. An
original record is its header bytes joined with the payload
(:func:`reconstruct`); :func:`read_back` parses the stored headers and checks
payload digests and lengths against the stored bytes.

Copies of a payload are reduced per task before the one shuffle that carries
payload bytes, and the bucketed store is joined without moving them again.

Defined results: null html counts as an empty payload, a null url becomes
``urn:none:`` in the header (its column stays null); control characters of a
url are percent-encoded; repeated rows are records of their own, one of the
rows with the largest page_id being the response; a null page_id sorts below
all others; an empty table gives an empty archive; other columns are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwise.llm.common import cut, shuffle_width
from legwise.session import scratch_path

CRLF = "\r\n"
#: Fixed values of the format (WARC 1.1, RFC 4648).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hex40: Column) -> Column:
    """Upper-case base32 of a 160-bit digest given as 40 hex digits."""
    chars = []
    for g in range(8):
        v = F.conv(F.substring(hex40, 5 * g + 1, 5), 16, 10).cast("int")
        chars += [F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
                  for s in (15, 10, 5, 0)]
    return F.concat(*chars)


def record_id(key: Column) -> Column:
    h = F.md5(key)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in
                    ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


@dataclass(frozen=True)
class Archive:
    payload_table: str
    records_path: str

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.payload_table)

    def records(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.records_path)


def _lines(*parts) -> Column:
    return F.concat(*[F.concat(p if isinstance(p, Column) else F.lit(p), F.lit(CRLF)) for p in parts])


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> Archive:
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = cut(base.select("page_id", "url", F.monotonically_increasing_id().alias("row_key"),
                           F.octet_length("payload").cast("long").alias("payload_bytes"),
                           F.unhex(F.sha2("payload", 256)).alias("strong"),
                           F.sha1("payload").alias("sha1")), "warc-rows")

    best = (rows.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("strong")
            .agg(F.max(F.struct("page_id", "row_key")).alias("win")))
    typed = rows.join(best, "strong", "left").withColumn(
        "is_response", F.col("win").isNull() | (F.col("row_key") == F.col("win.row_key")))
    uri = F.coalesce(F.regexp_replace(F.regexp_replace("url", "[\\r\\n]", "%0A"), "[\\x00-\\x20]", "%20"),
                     F.lit("urn:none:"))
    http = _lines(
        "HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8",
        F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")), "")
    own = F.concat(F.lit("record "), F.col("row_key").cast("string"))
    target = F.concat(F.lit("record "), F.col("win.row_key").cast("string"))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("sha1")))

    def head(kind: str, length: Column, *more) -> Column:
        return _lines("WARC/1.1", f"WARC-Type: {kind}", F.concat(F.lit("WARC-Record-ID: "), record_id(own)),
                      F.concat(F.lit("WARC-Target-URI: "), uri), f"WARC-Date: {date}", digest, *more,
                      "Content-Type: application/http; msgtype=response",
                      F.concat(F.lit("Content-Length: "), length.cast("string")), "")

    block = F.octet_length("http").cast("long")
    records = typed.withColumn("http", http).select(
        "page_id", "url", "row_key", "strong", F.encode("http", "UTF-8").alias("http"),
        F.encode(F.when(F.col("is_response"), head("response", block + F.col("payload_bytes")))
                 .otherwise(head("revisit", block, f"WARC-Profile: {PROFILE}",
                                 F.concat(F.lit("WARC-Refers-To: "), record_id(target)),
                                 F.concat(F.lit("X-Refers-To-Page: "),
                                          F.coalesce(F.col("win.page_id").cast("string"), F.lit(""))))),
                 "UTF-8").alias("head"))
    records_path = scratch_path(spark, "warc-records")
    records.write.option("compression", "zstd").parquet(records_path)

    store = (base.select(F.unhex(F.sha2("payload", 256)).alias("strong"), "payload")
             .groupBy("strong").agg(F.first("payload").alias("payload")))
    name = f"warc_payloads_{uuid.uuid4().hex[:12]}"
    (store.write.bucketBy(shuffle_width(spark), "strong").option("compression", "zstd")
     .option("path", scratch_path(spark, "warc-payloads")).saveAsTable(name))
    return Archive(name, records_path)


def reconstruct(spark: SparkSession, archive: Archive) -> DataFrame:
    """(page_id, row_key, record, payload): the bytes of every record as one WARC
    file would hold them, and its full payload, also for revisits."""
    joined = archive.records(spark).join(archive.payloads(spark), "strong")
    is_response = _field(F.col("head"), "WARC-Type") == "response"
    body = F.when(is_response, F.concat("http", "payload")).otherwise(F.col("http"))
    end = F.encode(F.lit(CRLF + CRLF), "UTF-8")
    return joined.select("page_id", "row_key", F.concat("head", body, end).alias("record"), "payload")


def _field(head: Column, name: str) -> Column:
    return F.regexp_extract(F.decode(head, "UTF-8"), f"\\r\\n{name}: ([^\\r\\n]*)", 1)


def read_back(spark: SparkSession, archive: Archive) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type,
    refers_to, verified. Digest and length come from the stored payload bytes;
    ``verified`` tells whether they agree with the record's own headers."""
    stored = archive.payloads(spark).select(
        "strong", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("payload_digest"),
        (F.unhex(F.sha2("payload", 256)) == F.col("strong")).alias("whole"))
    stored = cut(stored, "warc-stored")
    head, page_id = F.col("head"), archive.records(spark).schema["page_id"].dataType
    parsed = archive.records(spark).select(
        "page_id", "strong", _field(head, "WARC-Type").alias("record_type"),
        _field(head, "WARC-Payload-Digest").alias("said_digest"),
        _field(F.col("http"), "Content-Length").cast("long").alias("said_bytes"),
        _field(head, "Content-Length").cast("long").alias("said_block"),
        F.octet_length("http").cast("long").alias("http_bytes"),
        F.nullif(_field(head, "X-Refers-To-Page"), F.lit("")).cast(page_id).alias("refers_to"))
    body = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    return parsed.join(stored, "strong").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        (F.col("whole") & (F.col("said_digest") == F.concat(F.lit("sha1:"), F.col("payload_digest")))
         & (F.col("said_bytes") == F.col("payload_bytes"))
         & (F.col("said_block") == F.col("http_bytes") + body)).alias("verified"))
