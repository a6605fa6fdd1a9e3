"""Content-addressed WARC archive: every payload stored once under its SHA-256, headers apart.

``write`` makes two tables in one archive folder:

* ``payloads``: ``address`` (SHA-256 of the bytes), ``payload`` - each distinct payload once;
* ``records``: one row per page with ``header`` (the exact WARC and HTTP header bytes of its
  record), the ``address`` of its payload, and ``page_id``.

The first page of a payload (smallest ``page_id``) is a ``response``; the others are ``revisit``
records that name it.  ``restore`` joins both tables: a response is header + payload + two line
ends, a revisit is header + two line ends, and ``payload`` always holds the full payload.  The
strong digest is verified twice: writing fails if two payloads of one address differ in bytes
length, SHA-1 or a further hash, and reading fails if a stored payload has not the address it is
kept under or does not have the length that the header states.

A payload shared by a third of all pages is one stored row; the pages that share it meet only in
aggregates that combine before the shuffle and in joins that adaptive execution may split.

Null payloads are empty.  Pages smaller than ``least_bytes`` are always responses.  Pages that
repeat the smallest ``page_id`` of their payload are responses as well; a null ``page_id`` comes
after all others.  Null urls give an empty target.  A payload of any length is one row, hashed and
written whole.  An empty table gives an archive without records.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_path

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n"
#: Date that every record carries unless one is given; a fixed one keeps archives reproducible.
DATE = "2020-01-01T00:00:00Z"


def base32(digest_hex: Column) -> Column:
    """Bare upper-case base32 of a 20-byte digest given as hex."""
    signs = []
    for group in range(0, 40, 5):  # 20 bits: four signs
        value = F.conv(F.substring(digest_hex, group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            signs.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*signs)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _header(date: str) -> Column:
    """Header bytes of a record up to and including the empty line before its block's body."""
    sha1 = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(_END + _END))
    revisit = F.col("record_type") == "revisit"
    block_bytes = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    refers = F.when(revisit, F.concat(
        F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")), F.lit(_END),
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + _END)),
    ).otherwise(F.lit(""))
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", "")
    return F.concat(
        F.lit(f"WARC/1.1{_END}WARC-Type: "), F.col("record_type"), F.lit(_END),
        F.lit("WARC-Record-ID: "), _record_id(F.col("page_id")), F.lit(_END),
        F.lit(f"WARC-Date: {date}{_END}WARC-Target-URI: "), uri, F.lit(_END),
        F.lit("WARC-Payload-Digest: "), sha1, F.lit(_END), refers,
        F.lit(f"Content-Type: application/http; msgtype=response{_END}Content-Length: "),
        block_bytes.cast("string"), F.lit(_END + _END), http)


def write(pages: DataFrame, path: str, *, payload: str = "html", least_bytes: int = 0, date: str = DATE) -> None:
    """Write the archive of ``pages`` (``page_id``, ``url`` and the payload column) under ``path``."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    raw = pages.select("page_id", "url", body.alias("payload")) \
        .withColumn("address", F.sha2("payload", 256)) \
        .withColumn("payload_bytes", F.octet_length("payload").cast("long")) \
        .withColumn("sha1_hex", F.sha1("payload"))
    proof = F.concat_ws(":", "payload_bytes", "sha1_hex", F.xxhash64("payload"))
    # Addresses of two pages or more, once their pages agree; no bytes are carried here.
    several = raw.groupBy("address").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("pages"),
        F.min(proof).alias("proof"), F.max(proof).alias("other_proof")).filter("pages > 1")
    several = several.withColumn("pages", F.when(F.col("proof") == F.col("other_proof"), F.col("pages")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads share the address "), F.col("address"))).cast("long")))
    id_type = pages.schema["page_id"].dataType.simpleString()
    several.select("address", "first_id", "pages").write.parquet(f"{path}/repeated")
    # read back: a table under the session's broadcast threshold is broadcast, a larger one joined by shuffle
    repeated = spark.read.schema(f"address string, first_id {id_type}, pages long").parquet(f"{path}/repeated")

    narrow = raw.withColumn("payload_digest", base32(F.col("sha1_hex"))).select(
        "page_id", "url", "address", "payload_bytes", "payload_digest")
    records = narrow.join(repeated, "address", "left")
    is_first = F.col("pages").isNull() | F.col("page_id").eqNullSafe(F.col("first_id")) \
        | (F.col("payload_bytes") < least_bytes)
    records = records.withColumn("record_type", F.when(is_first, "response").otherwise("revisit")) \
        .withColumn("refers_to", F.when(~is_first, F.col("first_id")))
    records.select("page_id", "address", _header(date).alias("header")).write.parquet(f"{path}/records")

    # Payloads of one page are written where they are read.  All pages of a repeated address hold the
    # same bytes, so any of them gives the payload; repeats go within each task before bytes are shuffled.
    bodies = raw.select("address", "payload")
    single = bodies.join(repeated, "address", "left_anti")
    shared = bodies.join(repeated, "address", "left_semi").dropDuplicates(["address"])
    single.union(shared).write.parquet(f"{path}/payloads")


def read(spark: SparkSession, path: str, id_type: str = "bigint") -> tuple[DataFrame, DataFrame]:
    """The two tables of an archive: records and payloads."""
    records = spark.read.schema(f"page_id {id_type}, address string, header string").parquet(f"{path}/records")
    payloads = spark.read.schema("address string, payload binary").parquet(f"{path}/payloads")
    return records, payloads


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\n{name}: ([^\r]*)\r\n", 1)


def restore(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Every record again: ``page_id, record_type, refers_to, payload, record`` (its exact bytes)."""
    records, payloads = read(spark, path, id_type)
    stored = payloads.withColumn("payload", F.when(
        F.sha2("payload", 256) == F.col("address"), F.col("payload")
    ).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("address"))).cast("binary")))
    joined = records.join(stored, "address", "left").withColumn("payload", F.coalesce(
        "payload", F.raise_error(F.concat(F.lit("missing payload "), F.col("address"))).cast("binary")))
    kind = _field("WARC-Type")
    target = F.regexp_extract(_field("WARC-Refers-To"), r"^<urn:page:(.*)>$", 1)
    stated = F.regexp_extract("header", r"(?s)HTTP/1\.1 .*Content-Length: ([0-9]+)\r\n\r\n\z", 1).cast("long")
    body = F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select(
        "page_id", kind.alias("record_type"),
        F.when(kind == "revisit", target.try_cast(id_type)).alias("refers_to"),
        F.when(stated == F.octet_length("payload"), F.col("payload")).otherwise(
            F.raise_error(F.lit("a record's length differs from its payload's")).cast("binary")).alias("payload"),
        F.concat(F.col("header").cast("binary"), body, F.lit(b"\r\n\r\n")).alias("record"))


def archive_digest(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` into the shared folder, read the archive back and describe every record."""
    spark, id_type = pages.sparkSession, pages.schema["page_id"].dataType.simpleString()
    path = new_path(spark, "warc")
    write(pages, path)
    return restore(spark, path, id_type).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("payload_digest"), "record_type", "refers_to")
