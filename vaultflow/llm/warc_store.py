"""A content-addressed WARC archive: payload bytes once by SHA-256, exact record headers apart, records rebuilt by joins.

``write`` leaves two tables in a folder: ``payloads`` (sha256, payload) and ``headers`` (one row per record with its exact header
text). A record is header, payload and two line ends; a revisit has no payload of its own and names the record that has. Reading
verifies every stored payload against its digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.session import stage

#: Date in the headers, a parameter so that a repeated run writes the same bytes.
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the WARC and base32 formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex40: Column) -> Column:
    """Upper-case base32 of 160 bits given as 40 hexadecimal digits, ten digits at a time."""
    parts = [F.lpad(F.conv(F.substring(hex40, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), BASE32HEX, BASE32)


def _uuid(*of: Column) -> Column:
    return F.regexp_replace(F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in of])),
                            "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _head(date: str) -> Column:
    """Header of a record: WARC fields, an empty line, and the HTTP header that begins its block."""
    revisit = F.col("record_type") == "revisit"
    uri = F.regexp_replace("url", r"[\s\p{Cntrl}]", "")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    _line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    block = F.length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), _uuid(F.col("page_id"), F.col("sha256")), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", uri), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), _uuid(F.col("refers_to"), F.col("sha256")), F.lit(">"))),
                                 _line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), _line("Content-Length", block.cast("string")), F.lit("\r\n"), http)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          least_bytes: int = 0, date: str = DATE) -> None:
    """Archive every row of ``pages``.

    Of records with equal payloads of ``least_bytes`` or more, that with the largest id is the response and the others
    revisit it; shorter ones are all responses. A null payload is empty, a null id sorts below all others, a null url gives
    no target. Rows that repeat an id and its payload are each a record of the same type. The bytes are stored once in any case.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    every = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    narrow = stage(every.select("page_id", "url", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
                                F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha256")), "digests")
    # equal payloads may be any share of the rows: counts and maxima are added up before the shuffle
    top = stage(narrow.groupBy("sha256", "page_id").agg(F.count("*").alias("n"))
                .groupBy(F.col("sha256").alias("_sha")).agg(F.max("page_id").alias("top"), F.max(F.struct("page_id", "n"))["n"].alias("rows")), "top")
    first = F.col("page_id").eqNullSafe(F.col("top")) | (F.col("payload_bytes") < least_bytes)
    (narrow.join(top, F.col("sha256") == F.col("_sha"))
     .withColumn("record_type", F.when(first, "response").otherwise("revisit"))
     .withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("top")))
     .select("page_id", "refers_to", "sha256", _head(date).alias("head")).write.parquet(f"{path}/headers"))
    same = F.col("page_id").eqNullSafe(F.col("top")) & (F.sha2("payload", 256) == F.col("_sha"))
    bytes_of = every.select("page_id", "payload")
    once = bytes_of.join(top.where("rows = 1"), same).select(F.col("_sha").alias("sha256"), "payload")
    again = bytes_of.join(top.where("rows > 1"), same).select(F.col("_sha").alias("sha256"), "payload").dropDuplicates(["sha256"])
    once.unionByName(again).write.option("compression", "zstd").parquet(f"{path}/payloads")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, payload), every payload verified: bytes that do not have their digest end the job."""
    sure = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("stored payload does not match its digest "), F.col("sha256"))).cast("binary"))
    return spark.read.parquet(f"{path}/payloads").select("sha256", sure.alias("payload"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, refers_to, record_type, head, payload, record): every record as it was written.

    ``payload`` is the full payload, of a revisit that of the record it refers to; ``record`` is the exact bytes.
    """
    heads = spark.read.parquet(f"{path}/headers").drop("refers_to")
    urn = lambda name: F.regexp_extract("head", f"\r\n{name}: <urn:uuid:([0-9a-f-]+)>\r\n", 1)
    kind = F.regexp_extract("head", "\r\nWARC-Type: ([a-z]+)\r\n", 1)
    # a record that others refer to, found by its id as a reader of the archive would; rows that are equal in all share one
    known = heads.where(kind == "response").select(urn("WARC-Record-ID").alias("_record"), F.col("page_id").alias("refers_to")).distinct()
    heads = heads.withColumn("_to", F.when(kind == "revisit", urn("WARC-Refers-To"))).join(known, F.col("_to") == F.col("_record"), "left")
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return (heads.join(payloads(spark, path), "sha256").withColumn("record_type", kind)
            .select("page_id", "refers_to", "record_type", "head", "payload",
                    F.concat(F.col("head").cast("binary"), body, F.lit(b"\r\n\r\n")).alias("record")))


def summary(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, from the archive alone.

    Length and digest are taken from the stored bytes, once per payload, before the join, so no bytes are shuffled.
    """
    known = payloads(spark, path).select("sha256", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
                                         base32(F.sha1("payload")).alias("payload_digest"))
    told = F.regexp_extract("head", "\r\nWARC-Payload-Digest: sha1:([A-Z2-7]+)\r\n", 1)
    sure = F.when(told == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a record header has another digest than its payload")).cast("string"))
    return (spark.read.parquet(f"{path}/headers").join(known, "sha256")
            .select("page_id", "payload_bytes", sure.alias("payload_digest"),
                    F.regexp_extract("head", "\r\nWARC-Type: ([a-z]+)\r\n", 1).alias("record_type"), "refers_to"))


def described(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record as it is rebuilt from the archive.

    The digest is that of the rebuilt payload; a header that names another one ends the job.
    """
    told = F.regexp_extract("head", "\r\nWARC-Payload-Digest: sha1:([A-Z2-7]+)\r\n", 1)
    rebuilt = F.col("record").substr(F.length(F.col("head").cast("binary")) + 1, F.length("record") - F.length(F.col("head").cast("binary")) - 4)
    # a response is measured by the bytes behind its header, a revisit by the payload that it refers to
    payload = F.when(F.col("record_type") == "response", rebuilt).otherwise(F.col("payload"))
    digest = base32(F.sha1("_payload"))
    sure = F.when(told == digest, digest).otherwise(F.raise_error(F.lit("a record header has another digest than its payload")).cast("string"))
    return (records(spark, path).withColumn("_payload", payload)
            .select("page_id", F.octet_length("_payload").cast("bigint").alias("payload_bytes"), sure.alias("payload_digest"), "record_type", "refers_to"))


ORACLE = """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, octet_length(encode(body)) as payload_bytes, sha1(encode(body)) as hex,
             max(page_id) over (partition by body) as top from p)
select page_id, payload_bytes::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (k // 4)::int, 5))::int >> (15 - 5 * (k % 4))::int) & 31)::int, 1)), '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to from d"""
