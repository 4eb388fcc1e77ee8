"""JSON records to typed rows, and what to do with records that cannot be decoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultflow.functions import money
from vaultflow.operators.slices import running_max_before
from vaultflow.operators.validation import dead_letters
from vaultflow.schemas import (ACCOUNT_STATUSES, SEVERITIES, TRANSACTION_STATUSES, TRANSACTION_TYPES)

# Allowed texts of enumerated fields, per record type.
TRANSACTION_ENUMS = {"type": TRANSACTION_TYPES, "status": TRANSACTION_STATUSES}
ACCOUNT_ENUMS = {"status": ACCOUNT_STATUSES}
ALERT_ENUMS = {"severity": SEVERITIES}

_RAW_AMOUNT = r'"amount"\s*:\s*"?(-?[0-9][0-9.eE+-]*)'
# A text, with the number or text behind it if it is a key, or a bracket. Possessive, as Java recurses for each repetition of
# a group that it may have to give back, and a long text would overflow the stack.
_STRING = r'"[^"\\]*+(?:\\(?s:.)[^"\\]*+)*+"'
_TOKEN = rf'{_STRING}(?:\s*:\s*(?:-?[0-9][0-9.eE+-]*|{_STRING}))?|[{{}}\[\]]'


def written_amount(text: Column) -> Column:
    """The ``amount`` of the outermost object as it is written, the last one if it is there twice.

    A text with one "amount" needs no more than a pattern; otherwise the brackets are counted, and texts are skipped whole.
    """
    def step(state: Column, token: Column) -> Column:
        depth = state["depth"] + F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)
        here = (state["depth"] == 1) & token.rlike("^" + _RAW_AMOUNT)
        return F.struct(depth.alias("depth"), F.when(here, F.regexp_extract(token, _RAW_AMOUNT, 1)).otherwise(state["amount"]).alias("amount"))

    walked = F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)),
                         F.struct(F.lit(0).alias("depth"), F.lit(None).cast("string").alias("amount")), step)["amount"]
    return F.when(F.regexp_count(text, F.lit('"amount"')) > 1, walked).otherwise(F.regexp_extract(text, _RAW_AMOUNT, 1))


def decode(records: DataFrame, ddl: str, enums: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Add ``payload`` (null for a tombstone) and ``decodeError`` (null for a good record).

    Unknown fields are ignored and missing ones become null. An unknown enumeration text, a value
    of the wrong kind or text that is no JSON object is an error. An ``amount`` keeps its written
    form in ``amountRaw``: JSON parsing would drop trailing zeros.
    """
    wanted = T.StructType.fromDDL(ddl)
    parsed_as = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DecimalType) else f.dataType)
        for f in wanted.fields] + [T.StructField("_corrupt", T.StringType())])
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    rows = records.withColumn("_p", F.from_json(text, parsed_as, options))
    problems = [F.col("_p._corrupt").isNotNull() & (F.trim(text) != "null")]
    for name, allowed in (enums or {}).items():
        problems.append(~F.col(f"_p.{name}").isin(*allowed))
    fields: list[Column] = []
    for f in wanted.fields:
        value = F.col(f"_p.{f.name}")
        if isinstance(f.dataType, T.DecimalType):
            problems.append(value.isNotNull() & ~value.rlike(money.NUMBER))
            fields.append(value.try_cast(f.dataType.simpleString()).alias(f.name))
        else:
            fields.append(value.alias(f.name))
    if "amount" in wanted.fieldNames():
        written = F.when(F.col("_p.amount").isNotNull(), written_amount(text))
        fields.append(written.alias("amountRaw"))
    bad = F.lit(False)
    for problem in problems:
        bad = bad | F.coalesce(problem, F.lit(False))
    present = F.col("value").isNotNull() & (F.trim(text) != "null")
    return (rows
            .withColumn("decodeError", F.when(F.col("value").isNotNull() & bad, F.lit("DeserializationException")))
            .withColumn("payload", F.when(present & F.col("decodeError").isNull(), F.struct(*fields)))
            .drop("_p"))


def drop_undecodable(decoded: DataFrame) -> DataFrame:
    """Policy of the ledger and fraud jobs: skip a bad record and go on."""
    return decoded.where(F.col("decodeError").isNull())


def undecodable(decoded: DataFrame) -> DataFrame:
    """Policy of the validation job: bad records, and records without a payload, are kept aside."""
    return decoded.where(F.col("decodeError").isNotNull() | F.col("payload").isNull())


def requests_of(decoded: DataFrame) -> DataFrame:
    """Typed requests of the good records, with what they carry along; ``seq`` is the record's place in its stream.

    The time is the payload's, else the record's. A record whose key is not its account would be booked under one and
    alerted under the other, so it is none.
    """
    good = drop_undecodable(decoded).where(F.col("payload").isNotNull() & ~misplaced())
    fields = [F.col(f"payload.{f}").alias(f) for f in decoded.schema["payload"].dataType.fieldNames() if f != "timestamp"]
    return good.select(F.col("offset").alias("seq"), *fields, F.coalesce("payload.timestamp", "timestamp").alias("timestamp"),
                       F.struct("key", "value", "topic", "partition", "offset").alias("record"))


def misplaced() -> Column:
    return F.coalesce(F.col("payload.accountId") != F.col("key"), F.lit(False))


def poison_letters(decoded: DataFrame) -> DataFrame:
    """Dead letters of the records that are no requests, bytes untouched."""
    wrong = F.when(F.col("decodeError").isNull() & F.col("payload").isNotNull(), F.lit("KeyMismatchException"))
    bad = decoded.where(F.col("decodeError").isNotNull() | F.col("payload").isNull() | misplaced())
    return dead_letters(bad, F.coalesce("decodeError", wrong, F.lit("NullPointerException")),
                        F.when(wrong.isNotNull(), F.lit("Record key is not its account")).otherwise(F.lit("Cannot deserialize record")))


def event_time(records: DataFrame, payload_ts: Column, record_ts: Column, partition: str = "partition",
               order: str = "offset", slice_rows: int = 1_000_000) -> DataFrame:
    """Add ``eventTime``: payload time, else record time, else the latest time seen in the partition."""
    own = F.date_trunc("MILLISECOND", F.coalesce(payload_ts, F.when(F.unix_millis(record_ts) >= 0, record_ts)))
    return (running_max_before(records, partition, order, own, "_seen", slice_rows, split_all=True)
            .withColumn("eventTime", F.coalesce(own, "_seen")).drop("_seen"))
