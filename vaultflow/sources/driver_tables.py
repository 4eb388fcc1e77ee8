"""Banking records derived from the star-schema tables ``events``, ``customer`` and ``nation``.

``events`` become transaction requests, ``customer`` becomes accounts and customers. The mapping
covers every validation outcome; see FIXTURES.md part C.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.functions import headers, times
from vaultflow.schemas import REQUESTED

PARTITIONS = 3


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partition_of(key: Column, partitions: int = PARTITIONS) -> Column:
    """Stream partition of a key: equal keys always land together."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(partitions)).cast("int")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return (read(spark, sf_dir, "customer")
            .join(read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
            .select(F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string")).alias("customerId"),
                    F.col("c_name").alias("fullName"),
                    F.concat(F.lower(segment), F.lit("@example.com")).alias("email"),
                    F.lit(None).cast("string").alias("phone"),
                    F.col("n_name").alias("homeCountry"),
                    F.when(segment == "MACHINERY", "GOLD").when(segment == "BUILDING", "SILVER")
                    .otherwise("STANDARD").alias("tier"),
                    (F.col("c_custkey") % 10 == 9).alias("erased")))


def customer_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer once, then a tombstone (null value) for each one that asked to be erased."""
    fields = ("customerId", "fullName", "email", "phone", "homeCountry", "tier")
    rows = customers(spark, sf_dir)
    written = rows.select("customerId", F.lit(0).cast("bigint").alias("offset"), F.struct(*fields).alias("value"))
    erased = rows.where("erased").select("customerId", F.lit(1).cast("bigint").alias("offset"),
                                         F.lit(None).cast(written.schema["value"].dataType).alias("value"))
    return written.unionByName(erased)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        F.concat(F.lit("ACC-"), key.cast("string")).alias("accountId"),
        F.concat(F.lit("CUST-"), F.floor(key / 2).cast("string")).alias("customerId"),
        F.when(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), "CHECKING").otherwise("SAVINGS")
        .alias("accountType"),
        F.when(key % 11 == 3, "EUR").otherwise("USD").alias("currency"),
        F.when(key % 23 == 7, "FROZEN").when(key % 41 == 5, "CLOSED").otherwise("ACTIVE").alias("status"))


def account_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every account opens ACTIVE at 0; frozen and closed ones change in mid-stream."""
    rows = accounts(spark, sf_dir)
    opened = rows.withColumn("status", F.lit("ACTIVE")).withColumn("seq", F.lit(0).cast("bigint"))
    changed = (rows.where(F.col("status") != "ACTIVE")
               .withColumn("seq", (F.lit(500) + F.length("accountId")).cast("bigint")))
    return opened.unionByName(changed)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction requests with the amount as written (``amountRaw``) and their order (``seq``)."""
    return requests_from_events(read(spark, sf_dir, "events"))


def requests_from_events(events: DataFrame) -> DataFrame:
    """Row-wise mapping, usable on a table or a stream of events."""
    e = events.select(
        F.col("event_id").alias("seq"), "user_id", "event_type", "value", times.millis(F.col("ts")).alias("timestamp"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"))
    seq, user, kind, k = F.col("seq"), F.col("user_id"), F.col("event_type"), F.col("k")

    three_places = seq % 223 == 8
    money = F.round(F.col("value") * F.when(three_places, 1).otherwise(100), 2).cast("decimal(18,2)").cast("string")
    named = F.create_map(*map(F.lit, ("signup", "DEPOSIT", "purchase", "PAYMENT", "click", "WITHDRAWAL",
                                      "view", "TRANSFER")))
    number = F.when(seq % 50 == 49, seq - 1).otherwise(seq)
    account = F.concat(F.when(user % 29 == 13, "ACC-X").otherwise("ACC-"), user.cast("string"))
    return e.select(
        "seq",
        F.concat(F.lit("T-"), number.cast("string")).alias("transactionId"),
        account.alias("accountId"),
        F.coalesce(F.element_at(named, kind), F.when(k % 10 == 0, "TRANSFER_IN").otherwise("REFUND")).alias("type"),
        F.when(seq % 199 == 5, F.lit(None).cast("string"))
        .when(seq % 211 == 6, "0.00")
        .otherwise(F.concat(money, F.when(three_places, "1").otherwise(""))).alias("amountRaw"),
        F.when(k >= 97, "JPY").when(k >= 92, "EUR").otherwise("USD").alias("currency"),
        F.when((kind == "view") & (k % 20 != 19), F.concat(F.lit("ACC-"), (user + k % 7).cast("string")))
        .alias("counterpartyAccountId"),
        F.element_at(F.array(*map(F.lit, ("ATM", "MOBILE", "ONLINE", "BRANCH", None))), k % 5 + 1).alias("channel"),
        F.when((k % 4 != 3) | (k % 3 != 0), F.element_at(F.array(*map(F.lit, ("US", "GB", "SG", "FR"))), k % 4 + 1))
        .alias("country"),
        F.lit(None).cast("string").alias("merchant"),
        "timestamp")


def carried(requests: DataFrame) -> DataFrame:
    """Requests with the stream partition and the headers of their records, which outcomes take along."""
    seq = F.col("seq")
    no_headers = F.array().cast("array<struct<key:string,value:binary>>")
    stamped = headers.stamp(F.concat(F.lit("C-"), seq.cast("string")), F.lit("web"), F.lit("TransactionRequested"))
    return requests.withColumns({"partition": partition_of(F.col("accountId")),
                                 "headers": F.when(seq % 7 == 0, no_headers).otherwise(stamped)})


def request_records(requests: DataFrame) -> DataFrame:
    """Requests as stream records: JSON bytes, headers, partition and offset. Some are broken."""

    def quoted(column: str) -> Column:
        return F.coalesce(F.concat(F.lit('"'), F.col(column), F.lit('"')), F.lit("null"))

    json = F.concat(
        F.lit('{"transactionId":'), quoted("transactionId"), F.lit(',"accountId":'), quoted("accountId"),
        F.lit(',"type":'), quoted("type"), F.lit(',"amount":'), F.coalesce("amountRaw", F.lit("null")),
        F.lit(',"currency":'), quoted("currency"), F.lit(',"counterpartyAccountId":'),
        quoted("counterpartyAccountId"), F.lit(',"channel":'), quoted("channel"), F.lit(',"country":'),
        quoted("country"), F.lit(',"unknownField":1}'))
    seq = F.col("seq")
    return carried(requests).select(
        F.col("accountId").alias("key"),
        F.when(seq % 101 == 7, F.lit("{not json")).otherwise(json).cast("binary").alias("value"),
        F.lit(REQUESTED).alias("topic"), "partition", seq.alias("offset"), "timestamp", "headers")


# -- commands, as channels send them --------------------------------------------------------------

def transaction_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction commands, some without an id, some with a blank account or currency; 20 per batch."""
    seq = F.col("seq")
    return (requests(spark, sf_dir)
            .withColumn("transactionId", F.when(seq % 5 != 0, F.col("transactionId")))
            .withColumn("accountId", F.when(seq % 97 == 11, F.lit(" ")).otherwise(F.col("accountId")))
            .withColumn("currency", F.when(seq % 89 == 13, F.lit("")).otherwise(F.col("currency")))
            .withColumn("batchId", F.expr("seq div 20")))


def transfer_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (requests(spark, sf_dir).where(F.col("type") == "TRANSFER")
            .withColumn("transactionId", F.when(F.col("seq") % 5 != 0, F.col("transactionId")))
            .withColumnsRenamed({"accountId": "fromAccountId", "counterpartyAccountId": "toAccountId"}))


def customer_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.regexp_extract("customerId", "([0-9]+)", 1).cast("bigint")
    return (customers(spark, sf_dir).drop("erased").withColumn("seq", key)
            .withColumn("customerId", F.when(F.col("seq") % 4 != 0, F.col("customerId")))
            .withColumn("email", F.when(F.col("seq") % 13 == 5, F.lit("no-at-sign")).otherwise(F.col("email")))
            .withColumn("homeCountry", F.when(F.col("seq") % 19 != 4, F.col("homeCountry")))
            .withColumn("tier", F.when(F.col("seq") % 3 != 0, F.col("tier"))))


def account_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.regexp_extract("accountId", "([0-9]+)", 1).cast("bigint")
    return (accounts(spark, sf_dir).withColumn("seq", key)
            .withColumn("accountId", F.when(F.col("seq") % 4 != 0, F.col("accountId")))
            .withColumn("accountType", F.when(F.col("seq") % 17 == 2, F.lit("")).otherwise(F.col("accountType")))
            .withColumn("timestamp", F.timestamp_seconds(F.lit(1_767_261_600) + F.col("seq"))))


def account_opens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that were opened here; one in seven was not."""
    return (accounts(spark, sf_dir)
            .where(F.regexp_extract("accountId", "([0-9]+)", 1).cast("bigint") % 7 != 0)
            .withColumn("seq", F.lit(0).cast("bigint")))


def status_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freeze and close commands, and some unfreeze commands after them."""
    stopped = accounts(spark, sf_dir).where(F.col("status") != "ACTIVE")
    first = stopped.select("accountId", "status", (F.lit(500) + F.length("accountId")).cast("bigint").alias("seq"))
    even = F.regexp_extract("accountId", "([0-9]+)", 1).cast("bigint") % 2 == 0
    again = stopped.where(even).select("accountId", F.lit("ACTIVE").alias("status"),
                                       (F.lit(600) + F.length("accountId")).cast("bigint").alias("seq"))
    return first.unionByName(again)
