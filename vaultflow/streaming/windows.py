"""Activity windows kept in tables: served while they are open, final by the clock of their stream partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.operators import activity
from vaultflow.operators.lookups import Lookup
from vaultflow.schemas import ActivityRules
from vaultflow.session import stage
from vaultflow.streaming.state import StateTable, commit_batch, last_committed, read_output, run_batches, write_batch

_WINDOW = ("accountId", "windowStart", "windowEnd", "transactionCount", "totalCredits", "totalDebits")
_WINDOW_DDL = """spot STRING, stream INT, accountId STRING, windowStart TIMESTAMP, windowEnd TIMESTAMP, transactionCount BIGINT,
    totalCredits DECIMAL(38,2), totalDebits DECIMAL(38,2), done BOOLEAN"""
_CLOCK_DDL = "stream INT, clock TIMESTAMP"


class ActivityWindows:
    """Windows per account with one clock per stream partition, the latest timestamp that it has delivered.

    ``partition`` is the stream partition of a row, not null, and ``order`` its unique, non-negative place. A row is late if its window and
    grace had passed on the clock of its partition before it arrived, in an earlier micro-batch or in its own. Late rows are set
    aside in ``late``. A window is final, and written to ``final`` once, in the micro-batch that takes the clock past its end and
    grace; a partition that stands still closes nothing, however far the others are. Rows without a timestamp are in no window.

    Two tables of state: ``open`` has the windows that are not final, so a micro-batch reads no more than those and the changes
    since the last full copy; ``windows`` has final ones too, for ``served`` beyond their end, in folders by account for lookups.
    """

    def __init__(self, home: str, partition: Column, order: Column, rules: ActivityRules = ActivityRules(),
                 served: str = "30 days", slice_rows: int = 1_000_000, compact_every: int = 20):
        self.home = home
        self.partition = partition
        self.order = order
        self.rules = rules
        self.served = served
        self.slice_rows = slice_rows
        self.open = StateTable(f"{home}/open", "spot", compact_every)
        self.windows = StateTable(f"{home}/windows", "spot", compact_every, place="accountId")

    def _clocks(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Clock of every partition after a micro-batch; a row per partition."""
        if batch_id < 0:
            return spark.createDataFrame([], _CLOCK_DDL)
        return spark.read.schema(_CLOCK_DDL).parquet(f"{self.home}/clocks/batch_id={batch_id}")

    def step(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._clocks(spark, batch_id - 1)
        placed = batch.withColumn("stream", self.partition.cast("int")).withColumn("_place", self.order.cast("bigint"))
        rows = stage(activity.late_rows(placed, "stream", "_place", self.rules, self.slice_rows, Lookup(before, "stream"))
                     .drop("_place"), "stream-windows")
        write_batch(rows.where("late").drop("stream", "late"), f"{self.home}/late", batch_id)
        moved = rows.groupBy("stream").agg(F.max("timestamp").alias("clock"))
        write_batch(before.unionByName(moved).groupBy("stream").agg(F.max("clock").alias("clock")), f"{self.home}/clocks", batch_id)
        clocks = self._clocks(spark, batch_id)

        fresh = activity.summarize(rows.where(~F.col("late")), self.rules, "stream").withColumn("fresh", F.lit(True))
        known = self.open.before(spark, batch_id, _WINDOW_DDL).where(~F.col("done")).withColumn("fresh", F.lit(False))
        total = [F.sum("transactionCount").alias("transactionCount")] + [
            F.sum(c).cast("decimal(38,2)").alias(c) for c in ("totalCredits", "totalDebits")]
        merged = (known.select("stream", *_WINDOW, "fresh").unionByName(fresh.select("stream", *_WINDOW, "fresh"))
                  .groupBy("stream", "accountId", "windowStart", "windowEnd").agg(*total, F.max("fresh").alias("fresh")))
        closes = F.col("windowEnd") + F.expr(f"INTERVAL {self.rules.grace}")
        spot = F.concat_ws("~", "stream", F.unix_micros("windowStart").cast("string"), "accountId")
        told = (merged.join(clocks, "stream", "left").withColumn("done", F.coalesce(closes <= F.col("clock"), F.lit(False)))
                .where(F.col("done") | F.col("fresh")).withColumn("spot", spot))
        changed = stage(told.select("spot", "stream", *_WINDOW, "done"), "stream-changed")
        write_batch(changed.where("done").select(*_WINDOW), f"{self.home}/final", batch_id)

        self.open.save(spark, batch_id, _WINDOW_DDL, changed, keep=~F.col("done"))
        newest = clocks.agg(F.max("clock")).first()[0]
        recent = F.lit(True) if newest is None else F.col("windowEnd") >= F.lit(newest) - F.expr(f"INTERVAL {self.served}")
        self.windows.save(spark, batch_id, _WINDOW_DDL, changed, keep=~F.col("done") | recent)
        commit_batch(spark, self.home, batch_id)

    def run(self, posted: DataFrame) -> DataFrame:
        """Work off what has arrived; the final windows so far."""
        run_batches(posted, self.step, f"{self.home}/checkpoint")
        return self.output(posted.sparkSession, "final")

    def output(self, spark: SparkSession, table: str) -> DataFrame:
        """``final`` or ``late``."""
        return read_output(spark, f"{self.home}/{table}", self.home)

    def look_back(self, spark: SparkSession, account: str, now: Column, span: Column) -> DataFrame:
        """Windows of one account that start in [now - span, now], open ones too, from the kept state; their end is not given.

        Only the folders of the account are opened, and nothing is added up again.
        """
        last = last_committed(spark, self.home)
        keys = spark.createDataFrame([(account,)], "accountId STRING")
        kept = self.windows.before(spark, 0 if last is None else last + 1, _WINDOW_DDL, keys)
        return (kept.where(F.col("windowStart").between(now - span, now)).select(*_WINDOW)
                .withColumn("windowEnd", F.lit(None).cast("timestamp")))
