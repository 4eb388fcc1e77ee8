"""Activity of an account per time window, and rows that came too late for theirs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.functions import money
from vaultflow.operators.lookups import Lookup, lookup_join
from vaultflow.operators.slices import running_max_before
from vaultflow.schemas import ActivityRules


def summarize(posted: DataFrame, rules: ActivityRules = ActivityRules(), *by: str) -> DataFrame:
    """Count, credits and debits per account and tumbling window (and columns ``by``), on a table or a stream."""
    credit = money.is_credit(F.col("type"))

    def total(condition: Column) -> Column:
        # On the amount itself, so that partial sums run in the map tasks at the narrow type.
        return F.coalesce(F.sum(F.when(condition, F.col("amount"))), F.lit(0)).cast("decimal(38,2)")

    return (posted.groupBy(*by, "accountId", F.window("timestamp", rules.window).alias("w"))
            .agg(F.count("*").alias("transactionCount"), total(credit).alias("totalCredits"),
                 total(~credit).alias("totalDebits"))
            .select(*by, "accountId", F.col("w.start").alias("windowStart"), F.col("w.end").alias("windowEnd"),
                    "transactionCount", "totalCredits", "totalDebits"))


def with_net_flow(summary: DataFrame) -> DataFrame:
    return summary.withColumn("netFlow", (F.col("totalCredits") - F.col("totalDebits")).cast("decimal(38,2)"))


def final(summary: DataFrame, clock, rules: ActivityRules = ActivityRules()) -> DataFrame:
    """Summaries whose window and grace have passed at ``clock``; none if there is no clock yet."""
    return summary.where(F.col("windowEnd") + F.expr(f"INTERVAL {rules.grace}") <= F.lit(clock).cast("timestamp"))


def look_back(posted: DataFrame, account: str, now: Column, span: Column,
              rules: ActivityRules = ActivityRules()) -> DataFrame:
    """Windows of one account that start in [now - span, now], open ones too; their end is not given.

    Rows of such windows lie in [now - span, now + window): plain bounds, which reach the files.
    """
    near = (F.col("timestamp") >= now - span) & (F.col("timestamp") < now + F.expr(f"INTERVAL {rules.window}"))
    rows = summarize(posted.where((F.col("accountId") == account) & near), rules)
    return (rows.where(F.col("windowStart").between(now - span, now))
            .withColumn("windowEnd", F.lit(None).cast("timestamp")))


def late_rows(records: DataFrame, partition: str, order: str, rules: ActivityRules = ActivityRules(),
              slice_rows: int = 1_000_000, clocks: Lookup | None = None) -> DataFrame:
    """Add ``late``: the row's window had closed (end + grace) before the row arrived.

    Time moves with the latest timestamp seen in the row's stream partition. ``clocks`` (partition, ``clock``) is where it stood
    before the first of these rows.
    """
    seen = running_max_before(records, partition, order, F.col("timestamp"), "_clock", slice_rows, split_all=True)
    if clocks is not None:
        seen = (lookup_join(seen, clocks, partition, "_earlier", spread_by=order)
                .withColumn("_clock", F.greatest("_clock", "_earlier.clock")).drop("_earlier"))
    closes = F.window("timestamp", rules.window)["end"] + F.expr(f"INTERVAL {rules.grace}")
    return (seen.withColumn("_closes", closes)
            .withColumn("late", F.coalesce(F.col("_closes") <= F.col("_clock"), F.lit(False)))
            .drop("_clock", "_closes"))
