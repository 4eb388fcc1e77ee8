"""Commands from channels: constraint checks, defaults, and the events they publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.operators.lookups import Lookup, lookup_join
from vaultflow.operators.slices import running_max_before
from vaultflow.session import stage

# Messages of a failed constraint.
NOT_BLANK = "must not be blank"
NOT_NULL = "must not be null"
MIN_AMOUNT = "must be greater than or equal to 0.01"
BAD_EMAIL = "must be a well-formed email address"

_HOST = "[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
# possessive over the parts of a host name: no recursion in Java, however many there are
_EMAIL = rf"^[A-Za-z0-9!#$%&'*+/=?^_{{|}}~.-]+@{_HOST}(?:\.{_HOST})*+$"


def not_blank(field: str) -> Column:
    blank = F.coalesce(F.trim(field) == "", F.lit(True))
    return F.when(blank, F.lit(f"{field}: {NOT_BLANK}"))


def not_null(field: str) -> Column:
    return F.when(F.col(field).isNull(), F.lit(f"{field}: {NOT_NULL}"))


def at_least_a_cent(field: str) -> Column:
    return F.when(F.col(field).try_cast("decimal(38,10)") < F.lit("0.01").cast("decimal(38,10)"),
                  F.lit(f"{field}: {MIN_AMOUNT}"))


def email_form(field: str) -> Column:
    return F.when((F.col(field) != "") & ~F.col(field).rlike(_EMAIL), F.lit(f"{field}: {BAD_EMAIL}"))


def transaction_constraints() -> list[Column]:
    return [not_blank("accountId"), not_null("type"), not_null("amountRaw"), at_least_a_cent("amountRaw"),
            not_blank("currency")]


def transfer_constraints() -> list[Column]:
    return [not_blank("fromAccountId"), not_blank("toAccountId"), not_null("amountRaw"),
            at_least_a_cent("amountRaw"), not_blank("currency")]


def customer_constraints() -> list[Column]:
    return [not_blank("fullName"), email_form("email"), not_blank("homeCountry")]


def account_constraints() -> list[Column]:
    return [not_blank("customerId"), not_blank("accountType"), not_blank("currency")]


def check(commands: DataFrame, constraints: list[Column]) -> DataFrame:
    """Add ``violations`` (in rule order) and ``accepted``."""
    return (commands.withColumn("violations", F.array_compact(F.array(*constraints)))
            .withColumn("accepted", F.size("violations") == 0))


#: Name of the source whose commands are numbered by ``seq``, where a caller has only one.
SOURCE = "web"


def stable_id(source: str, *parts: str) -> Column:
    """32 hex digits that a replay of the same command produces again; ``source`` says what is named, and by whom."""
    return F.substring(F.sha2(F.concat_ws("~", F.lit(source), *[F.col(p).cast("string") for p in parts]), 256), 1, 32)


def short_id(prefix: str, source: str, *parts: str) -> Column:
    return F.concat(F.lit(prefix), F.upper(F.substring(stable_id(source, *parts), 1, 8)))


def transaction_events(commands: DataFrame, order: str = "seq", source: str = SOURCE) -> DataFrame:
    """Transaction commands as REQUESTED events; a missing id is derived, the channel defaults to ONLINE."""
    return commands.select(
        order, F.coalesce("transactionId", stable_id(f"transaction~{source}", order)).alias("transactionId"), "accountId",
        "type", "amountRaw", "currency", F.lit(None).cast("string").alias("counterpartyAccountId"),
        F.coalesce("channel", F.lit("ONLINE")).alias("channel"), "country", "merchant", "timestamp",
        F.lit("REQUESTED").alias("status"))


def transfer_events(commands: DataFrame, order: str = "seq", source: str = SOURCE) -> DataFrame:
    """Transfer commands as TRANSFER events of the paying account."""
    return commands.select(
        order, F.coalesce("transactionId", stable_id(f"transfer~{source}", order)).alias("transactionId"),
        F.col("fromAccountId").alias("accountId"), F.lit("TRANSFER").alias("type"), "amountRaw", "currency",
        F.col("toAccountId").alias("counterpartyAccountId"), F.coalesce("channel", F.lit("ONLINE")).alias("channel"),
        "country", F.lit(None).cast("string").alias("merchant"), "timestamp", F.lit("REQUESTED").alias("status"))


def customer_events(commands: DataFrame, order: str = "seq", source: str = SOURCE) -> DataFrame:
    said = [F.array_join("violations", "; ").alias("violations")] if "violations" in commands.columns else []
    return commands.select(
        *said, order, F.coalesce("customerId", short_id("CUST-", f"customer~{source}", order)).alias("customerId"), "fullName",
        "email", "phone", "homeCountry", F.coalesce("tier", F.lit("STANDARD")).alias("tier"))


def account_events(commands: DataFrame, order: str = "seq", source: str = SOURCE) -> DataFrame:
    return commands.select(
        order, F.coalesce("accountId", short_id("ACC-", f"account~{source}", order)).alias("accountId"), "customerId",
        "accountType", "currency", F.lit("ACTIVE").alias("status"), F.col("timestamp").alias("updatedAt"))


def tombstones(commands: DataFrame, key: str) -> DataFrame:
    """Delete commands as change-log rows without a value."""
    return commands.select(key, F.lit(None).cast("string").alias("value"))


def status_changes(opens: DataFrame, commands: DataFrame, slice_rows: int = 1_000_000) -> DataFrame:
    """Republish the whole account with its new status; ``error`` is set where the account is unknown.

    ``opens`` has the account columns and ``seq``; ``commands`` has accountId, status and ``seq``.
    """
    entity = ("customerId", "accountType", "currency")
    mixed = (opens.select("seq", "accountId", *entity, F.lit("ACTIVE").alias("status"), F.lit(True).alias("_open"))
             .unionByName(commands.select("seq", "accountId", "status", F.lit(False).alias("_open")),
                          allowMissingColumns=True))
    value = F.when(F.col("_open"), F.struct("seq", *entity))
    known = running_max_before(mixed, "accountId", "seq", value, "_known", slice_rows)
    unknown = ~F.col("_open") & F.col("_known").isNull()
    return known.select(
        "seq", "accountId", *[F.coalesce(f, f"_known.{f}").alias(f) for f in entity],
        F.when(~unknown, F.col("status")).alias("status"),
        F.when(unknown, F.concat(F.lit("Unknown account "), F.col("accountId"))).alias("error"))


def gate_batches(checked: DataFrame, batch: str) -> DataFrame:
    """Members of the batches whose every member is accepted, with one correlation id per batch.

    The verdict on a batch is an aggregate that combines before its shuffle; a batch of any size is
    then only looked up, never held together.
    """
    verdict = checked.groupBy(F.col(batch).alias("_batch")).agg(F.bool_and("accepted").alias("whole"))
    gate = Lookup(stage(verdict, "batch-verdicts"), "_batch")
    return (lookup_join(checked, gate, batch, "_gate").where("_gate.whole").drop("_gate")
            .withColumn("correlationId", stable_id("batch", batch)))
