"""Messages to account owners, the recent list, and what becomes of a delivery."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.functions import times
from vaultflow.functions.money import text
from vaultflow.operators.activity import with_net_flow
from vaultflow.operators.lookups import Lookup, lookup_join
from vaultflow.schemas import RetryPolicy
from vaultflow.session import stage


def _message(rows: DataFrame, channel: str, sent: Column, *parts) -> DataFrame:
    words = F.concat(*[text(p) if isinstance(p, Column) else F.lit(p) for p in parts])
    return rows.select(F.lit(channel).alias("channel"), F.concat(F.lit("owner-of-"), "accountId").alias("recipient"),
                       "accountId", words.alias("message"), sent.alias("sentAt"))


# Channels and texts of the four messages.

def receipts(posted: DataFrame) -> DataFrame:
    c = F.col
    return _message(posted, "PUSH", c("timestamp"), c("type"), " of ", c("amount"), " ", c("currency"),
                    " posted. New balance: ", c("balanceAfter"), " ", c("currency"))


def declines(rejected: DataFrame) -> DataFrame:
    """``amount`` is shown as it was requested where the written form is known."""
    c = F.col
    return _message(rejected, "EMAIL", c("timestamp"), "Your ", c("type"), " of ", c("amountRaw"), " ",
                    c("currency"), " was declined: ", c("reason"))


def security_alerts(alerts: DataFrame) -> DataFrame:
    c = F.col
    return _message(alerts, "SMS", c("detectedAt"), "Security alert [", c("severity"), "] ", c("description"),
                    ". Reply NO if this was not you.")


def digests(summaries: DataFrame) -> DataFrame:
    c = F.col
    return _message(with_net_flow(summaries), "EMAIL", c("windowEnd"), "Activity ", times.iso(c("windowStart")),
                    " - ", times.iso(c("windowEnd")), ": ", c("transactionCount"), " transactions, in ",
                    c("totalCredits"), ", out ", c("totalDebits"), ", net ", c("netFlow"))


def all_messages(posted: DataFrame, rejected: DataFrame, alerts: DataFrame, summaries: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  [receipts(posted), declines(rejected), security_alerts(alerts), digests(summaries)])


def recent(messages: DataFrame, account: str | None = None, kept: int = 500) -> DataFrame:
    """The newest messages; an account filter applies to that list, not before it."""
    newest = messages.orderBy(F.desc("sentAt"), "accountId", "channel", "message").limit(kept)
    return newest if account is None else newest.where(F.col("accountId") == account)


def _wait_ms(attempt: Column, policy: RetryPolicy) -> Column:
    wait = F.lit(policy.first_ms) * F.pow(F.lit(policy.factor), attempt - 1)
    if policy.longest_ms is not None:
        wait = F.least(wait, F.lit(float(policy.longest_ms)))
    return wait.cast("bigint")


def route_attempts(attempts: DataFrame, policy: RetryPolicy, fatal: tuple[str, ...] = ("IllegalArgumentException",),
                   give_up: str = "DEAD_LETTER") -> DataFrame:
    """Add ``action`` and ``nextAt`` to delivery attempts (``attempt`` from 1, ``error`` null = delivered).

    A failed attempt is tried again after a growing wait until the policy is used up; fatal errors
    are given up at once.
    """
    last = (F.col("attempt") >= policy.attempts) | F.col("error").isin(*fatal)
    action = (F.when(F.col("error").isNull(), "DELIVERED").when(last, give_up).otherwise("RETRY"))
    wait = _wait_ms(F.col("attempt"), policy)
    return (attempts.withColumn("action", action)
            .withColumn("nextAt", F.when(F.col("action") == "RETRY",
                                         F.timestamp_millis(F.unix_millis("at") + wait))))


def commit_prefix(receipts: DataFrame, batch: tuple[str, ...], order: str, failed: Column) -> DataFrame:
    """Add ``committed``: rows of a batch before its first failure; the rest is delivered again.

    Only the first failing position of each batch is looked up.
    """
    key = F.concat_ws("~", *batch)
    first = (receipts.where(failed).groupBy(key.alias("_batch")).agg(F.min(order).alias("failedAt")))
    stops = Lookup(stage(first, "failed-batches"), "_batch")
    return (lookup_join(receipts.withColumn("_of", key), stops, "_of", "_stop", spread_by=order)
            .withColumn("committed", F.coalesce(F.col(order) < F.col("_stop.failedAt"), F.lit(True)))
            .drop("_of", "_stop"))
