"""Content-addressed WARC archive.

Payload bytes are stored once under their SHA-256, in one table; the exact
bytes of every record's header block are stored in another, with the address of
the payload. A record is put together again by joining the two. Of records with
equal payloads (of at least ``min_bytes``), that with the largest id is the
response, and the others are revisits that refer to it.

* Writing: payloads are grouped by address with a combine on the map side, so
  each task sends a payload that it holds many times once. Headers then join the
  light columns of the stored payloads; an address that a third of all rows
  share is split by AQE's skew join (no payload moves in that join).
* Reading: the payload table is verified as it is read (address, length and the
  SHA-1 label are recomputed from the stored bytes), and every header must find
  its payload with the length and label that it states; otherwise the read fails.

Only DataFrame functions are used. Defined results: a null payload counts as
empty. Rows that repeat the largest id are all responses. A null id refers to
the response like any other, and is a response itself only if no row of the
group has an id; a missing target is left out of the header, and a missing date is the
epoch's. Line ends in a target are percent-encoded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import col, shared_path, utf8

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
RESPONSE, REVISIT = "response", "revisit"
EPOCH = "1970-01-01 00:00:00"  # the date of a record without one; WARC 1.1 requires a date
# The profile that WARC 1.1 names for revisits of an identical payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(digest: Column) -> Column:
    """Hexadecimal digits (a multiple of five) as upper-case base32: five hex
    digits are 20 bits, four characters."""
    groups = F.transform(
        F.sequence(F.lit(0), F.floor(F.length(digest) / 5).cast("int") - 1),
        lambda g: F.conv(F.substring(digest, g * 5 + 1, F.lit(5)), 16, 10).cast("int"),
    )
    chars = F.transform(
        groups,
        lambda v: F.concat(
            *[F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        ),
    )
    return F.array_join(chars, "")


def sha1_label(payload: Column) -> Column:
    """The bare base32 SHA-1 that WARC headers carry."""
    return base32_of_hex(F.sha1(payload))


@dataclass(frozen=True)
class Archive:
    """Where an archive's two tables are."""

    payloads: str
    headers: str


def _on_one_line(target: Column) -> Column:
    """The target with line ends percent-encoded, as a URI writes them; a percent sign
    stays, so a target without line ends is written exactly."""
    return F.replace(F.replace(target, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(record: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(record.cast("string"), F.lit("none")), F.lit(">"))


def _header(record: Column, target: Column, date: Column, refers_to: Column, kind: Column, label: Column, length: Column) -> Column:
    """The header block, with the empty line that ends it."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    is_revisit = kind == REVISIT
    lines = [
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", kind),
        line("WARC-Record-ID", _record_id(record)),
        line("WARC-Date", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(line("WARC-Target-URI", _on_one_line(target)), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), label)),
        F.when(is_revisit, F.concat(line("WARC-Refers-To", _record_id(refers_to)), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/octet-stream")),
        line("Content-Length", F.when(is_revisit, F.lit(0)).otherwise(length).cast("string")),
        line("X-Payload-Length", length.cast("string")),
        F.lit(CRLF),
    ]
    return F.concat(*lines)


def write_archive(
    records: DataFrame, id_col: str, target_col: str, payload_col: str, min_bytes: int = 0, archive: Archive | None = None,
    date_col: str | None = None,
) -> Archive:
    """Write a record for every row; returns where the archive is (by default
    new folders in the shared folder). ``date_col`` (a timestamp without zone, in UTC)
    gives the capture's date; without one, or where it is null, it is ``EPOCH``."""
    spark = records.sparkSession
    archive = archive or Archive(shared_path(spark, "payloads"), shared_path(spark, "headers"))
    date = F.coalesce(col(date_col).cast("timestamp_ntz") if date_col else F.lit(None).cast("timestamp_ntz"), F.lit(EPOCH).cast("timestamp_ntz"))
    rows = records.select(
        col(id_col).alias("id"), col(target_col).cast("string").alias("target"), date.alias("date"), utf8(col(payload_col)).alias("payload")
    )
    addressed = rows.withColumn("address", F.sha2("payload", 256))
    # Equal addresses with unequal lengths would be a broken digest: max and min must agree.
    payloads = addressed.groupBy("address").agg(
        F.first("payload").alias("payload"), F.max("id").alias("last_id"),
        F.max(F.length("payload")).alias("length"), F.min(F.length("payload")).alias("least"),
    ).select(
        "address", "payload", "last_id", F.col("length").cast("long").alias("length"),
        F.when(F.col("length") != F.col("least"), F.raise_error(F.lit("unequal payloads share an address"))).otherwise(sha1_label(F.col("payload"))).alias("label"),
    )
    payloads.write.parquet(archive.payloads)
    known = spark.read.parquet(archive.payloads).select("address", "last_id", "length", "label")
    headed = addressed.select("id", "target", "date", "address").join(known, "address")
    is_revisit = (F.col("length") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("last_id"))
    kind = F.when(is_revisit, F.lit(REVISIT)).otherwise(F.lit(RESPONSE))
    header = _header(F.col("id"), F.col("target"), F.col("date"), F.col("last_id"), kind, F.col("label"), F.col("length"))
    headed.select("id", "address", utf8(header).alias("header")).write.parquet(archive.headers)
    return archive


def read_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """(address, payload, length, label), length and label recomputed from the
    stored bytes; a payload that does not have its address fails the read."""
    stored = spark.read.parquet(archive.payloads).select("address", "payload")
    sound = F.when(F.sha2("payload", 256) == F.col("address"), F.length("payload").cast("long"))
    return stored.select(
        "address", "payload",
        F.coalesce(sound, F.raise_error(F.lit("a payload does not have its digest")).cast("long")).alias("length"),
        sha1_label(F.col("payload")).alias("label"),
    )


def _field(header: Column, name: str) -> Column:
    value = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def read_headers(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every header block with the fields that it states."""
    text = F.col("header").cast("string")
    return spark.read.parquet(archive.headers).select(
        "id", "header", "address",
        _field(text, "WARC-Type").alias("record_type"),
        _field(text, "WARC-Date").alias("date"),
        F.regexp_extract(F.coalesce(_field(text, "WARC-Refers-To"), F.lit("")), "^<urn:record:(.*)>$", 1).alias("refers_to"),
        F.regexp_extract(F.coalesce(_field(text, "WARC-Payload-Digest"), F.lit("")), "^sha1:(.*)$", 1).alias("stated_label"),
        _field(text, "X-Payload-Length").cast("long").alias("stated_length"),
    )


def read_records(spark: SparkSession, archive: Archive, with_bytes: bool = True) -> DataFrame:
    """Every record: id, header fields, the verified length and label, and (with
    ``with_bytes``) the exact record bytes and the payload that it stands for."""
    payloads = read_payloads(spark, archive)
    if not with_bytes:
        payloads = payloads.drop("payload")
    joined = read_headers(spark, archive).join(payloads, "address", "left")
    agrees = (F.col("label") == F.col("stated_label")) & (F.col("length") == F.col("stated_length"))
    verified = joined.withColumn(
        "length", F.when(agrees, F.col("length")).otherwise(F.raise_error(F.lit("a header does not agree with its payload")).cast("long"))
    ).withColumn("refers_to", F.when((F.col("record_type") == REVISIT) & ~F.col("refers_to").isin("", "none"), F.col("refers_to")))
    if not with_bytes:
        return verified.select("id", "record_type", "refers_to", "length", "label")
    block = F.when(F.col("record_type") == RESPONSE, F.col("payload")).otherwise(F.lit(b"").cast("binary"))
    record = F.concat("header", block, utf8(F.lit(CRLF + CRLF)))
    return verified.select("id", "record_type", "refers_to", "length", "label", "payload", record.alias("record"))
