"""Deliveries as streams: receipts in order with redelivery, and messages that are tried again when they are due.

What the receiver answers is not known here: ``answer`` is an expression over a row and its ``attempt`` (from 1) that gives the error of
that try, null if it was taken. Both jobs keep their state in tables below ``home``; a micro-batch reads what the one before
left and may be run twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.operators.notify import route_attempts
from vaultflow.operators.slices import running_sum_before
from vaultflow.schemas import ALERT_RETRY, RECEIPT_RETRY, RetryPolicy
from vaultflow.session import stage
from vaultflow.streaming.state import commit_batch, last_committed, read_output, run_batches, write_batch

DELIVERED, SKIPPED, RETRY, DEAD_LETTER = "DELIVERED", "SKIPPED", "RETRY", "DEAD_LETTER"
# Folders of one micro-batch's queue; minutes share a folder where there are more of them.
FOLDERS = 200
# Polls of a micro-batch that nothing comes after.
_ALL_POLLS = 2 ** 31 - 1


class Receipts:
    """Rows of a stream delivered per partition, in order, in polls that end at the first failure.

    What a poll delivered before its failure is committed; the failing row and all behind it are delivered again, before any new
    row. After ``policy.attempts`` tries the failing row is skipped and committed. A micro-batch makes up to ``polls`` polls of
    each partition; what is left is the backlog of the next one.

    ``answer(attempt)`` gives the error of a try; rows have ``partition`` and ``place``, unique and ascending in a partition.
    Output: the rows with ``outcome``, ``attempts`` and ``number``, the row's number among all that its partition has committed.
    """

    def __init__(self, home: str, answer: Callable[[Column], Column], policy: RetryPolicy = RECEIPT_RETRY, polls: int = 10, slice_rows: int = 1_000_000):
        self.home = home
        self.answer = answer
        self.policy = policy
        self.polls = polls
        self.slice_rows = slice_rows

    def step(self, batch: DataFrame, batch_id: int, polls: int | None = None) -> None:
        spark = batch.sparkSession
        polls = self.polls if polls is None else polls
        rows = batch.withColumn("tried", F.lit(0))
        done = spark.createDataFrame([], "partition INT, committed BIGINT")
        if batch_id > 0:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{self.home}/waiting/batch_id={batch_id - 1}"))
            done = spark.read.schema(done.schema).parquet(f"{self.home}/positions/batch_id={batch_id - 1}")
        # failures still to come before the row is taken or skipped; each ends a poll
        tries = F.sequence(F.col("tried") + 1, F.lit(self.policy.attempts))
        taken = F.array_position(F.transform(tries, lambda n: self.answer(n).isNull()), True)
        left = F.lit(self.policy.attempts) - F.col("tried")
        failures = F.when(taken > 0, taken - 1).otherwise(left).cast("bigint")
        counted = stage(rows.withColumn("failures", failures).withColumn("skipped", taken == 0), "receipts")
        placed = running_sum_before(counted, "place", F.col("failures"), "earlier", self.slice_rows, key="partition")
        # a row is reached in one of this batch's polls, and settled in one: a skip ends its poll
        reached = F.col("earlier") < polls
        settled = reached & F.when(F.col("skipped"), F.col("earlier") + F.col("failures") <= polls).otherwise(F.col("earlier") + F.col("failures") < polls)
        placed = stage(placed.withColumn("settled", settled).withColumn("reached", reached), "receipts-placed")
        out = running_sum_before(placed.where("settled"), "place", F.lit(1), "number", self.slice_rows, key="partition")
        positions = stage(done.unionByName(placed.where("settled").groupBy("partition").agg(F.count("*").alias("committed")))
                          .groupBy("partition").agg(F.sum("committed").alias("committed")), "positions")
        before = done.select(F.col("partition").alias("_p"), F.col("committed").alias("_c"))
        out = (out.join(before, F.col("partition") == F.col("_p"), "left")
               .withColumn("number", F.col("number") + F.coalesce("_c", F.lit(0)) + 1)
               .withColumn("attempts", F.col("tried") + F.col("failures").cast("int") + F.when(F.col("skipped"), 0).otherwise(1))
               .withColumn("outcome", F.when(F.col("skipped"), SKIPPED).otherwise(DELIVERED)))
        write_batch(out.select(*batch.columns, "outcome", "attempts", "number"), f"{self.home}/delivered", batch_id)
        # the row that the last poll ended at has used up the rest of the polls
        used = F.when(F.col("reached"), F.lit(polls) - F.col("earlier")).otherwise(0).cast("int")
        waiting = placed.where(~F.col("settled")).withColumn("tried", F.col("tried") + used)
        write_batch(waiting.select(*batch.columns, "tried"), f"{self.home}/waiting", batch_id)
        write_batch(positions, f"{self.home}/positions", batch_id)
        commit_batch(spark, self.home, batch_id)

    def run(self, rows: DataFrame) -> DataFrame:
        """Work off what has arrived; a backlog may be left."""
        run_batches(rows, self.step, f"{self.home}/checkpoint")
        return self.output(rows.sparkSession)

    def finish(self, spark: SparkSession) -> "Receipts":
        """After the stream has ended for good: polls until there is no backlog. No new row waits for their end, so one micro-batch makes them all."""
        batch_id = last_committed(spark, self.home)
        while batch_id is not None and not (waiting := spark.read.parquet(f"{self.home}/waiting/batch_id={batch_id}")).isEmpty():
            batch_id += 1
            self.step(waiting.drop("tried").where("false"), batch_id, _ALL_POLLS)
        return self

    def output(self, spark: SparkSession) -> DataFrame:
        return read_output(spark, f"{self.home}/delivered", self.home)


class DueQueue:
    """Messages that are tried when they arrive and, after a failure, again when they are due; nothing waits behind them.

    What has to be tried again lies in folders by the minute that it is due in (``bucket_seconds``); a micro-batch with rows for more than
    ``folders`` minutes puts neighbouring ones together, about as many rows in each folder, named by its first minute. A micro-batch opens the folders
    that have come due and no others, tries what is due in them, puts back the rest, and adds what failed to the folder of its next time. ``now`` of a
    micro-batch is the latest time ``at`` that arrived so far. Fatal errors, and the last try that the policy allows, end in ``give_up``.

    Rows have ``at``, the time of their first try. Output: a row per try with ``attempt``, ``at``, ``error``, ``action`` and ``nextAt``.
    """

    def __init__(self, home: str, answer: Callable[[Column], Column], policy: RetryPolicy = ALERT_RETRY, fatal: tuple[str, ...] = ("IllegalArgumentException",),
                 give_up: str = DEAD_LETTER, bucket_seconds: int = 60, folders: int = FOLDERS):
        self.home = home
        self.answer = answer
        self.policy = policy
        self.fatal = fatal
        self.give_up = give_up
        self.bucket_seconds = bucket_seconds
        self.folders = folders

    def _bucket(self, ts: Column) -> Column:
        return F.floor(F.unix_millis(ts) / (1000 * self.bucket_seconds)).cast("bigint")

    def _clock(self, spark: SparkSession, batch_id: int):
        """``now`` of a micro-batch, and the minute that it falls into; None before the first row."""
        if batch_id < 0:
            return None, None
        row = spark.read.schema("now TIMESTAMP, minute BIGINT").parquet(f"{self.home}/clock/batch_id={batch_id}").first()
        return row["now"], row["minute"]

    def _queued(self, spark: SparkSession, row_ddl: str, batch_id: int) -> DataFrame:
        """The queue as a micro-batch finds it: what the last one put there, and of earlier ones the minutes that have not come due.

        Both are names of folders, so others are not opened: a batch puts back what it opened too early.
        """
        _, minute = self._clock(spark, batch_id - 1)
        stored = (spark.read.schema(f"{row_ddl}, bucket BIGINT, batch_id BIGINT").option("basePath", f"{self.home}/queue")
                  .parquet(*[f"{self.home}/queue/batch_id={k}" for k in range(batch_id)]))
        return stored if minute is None else stored.where((F.col("batch_id") == batch_id - 1) | (F.col("bucket") > minute))

    def _put(self, rows: DataFrame, path: str) -> None:
        """Write rows in folders by the minute they are due in, at most ``folders`` of them; rows of a folder come from few tasks."""
        timed = stage(rows.withColumn("bucket", self._bucket(F.col("at"))), "due-again")
        shares = [k / self.folders for k in range(self.folders)]
        low, high, starts = timed.agg(F.min("bucket"), F.max("bucket"), F.percentile_approx("bucket", shares)).first()
        if low is not None and high - low >= self.folders:
            # the folder that is named by the last start up to the minute
            starts = F.lit(sorted({low, *starts}))
            timed = timed.withColumn("bucket", F.array_max(F.filter(starts, lambda s: s <= F.col("bucket"))))
        timed.repartitionByRange("bucket", "at").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def step(self, batch: DataFrame, batch_id: int, until: Column | None = None) -> None:
        spark = batch.sparkSession
        new = stage(batch.withColumn("attempt", F.lit(1)), "due-new")
        times = new.select(F.col("at").alias("t"))
        if batch_id > 0:
            times = times.unionByName(spark.createDataFrame([self._clock(spark, batch_id - 1)[:1]], "t TIMESTAMP"))
        latest = F.max("t") if until is None else F.greatest(F.max("t"), until)
        now, minute = stage(times.agg(latest.alias("now")).withColumn("minute", self._bucket(F.col("now"))), "due-clock").first()
        todo, kept = new, new.where("false")
        if batch_id > 0 and now is not None:
            found = stage(self._queued(spark, _ddl(new), batch_id).where(F.col("bucket") <= minute).select(*new.columns), "due-opened")
            due = F.col("at") <= F.lit(now)
            todo, kept = new.unionByName(found.where(due)), found.where(~due)
        tried = stage(route_attempts(todo.withColumn("error", self.answer(F.col("attempt"))), self.policy, self.fatal, self.give_up), "due-tried")
        write_batch(tried, f"{self.home}/tries", batch_id)
        again = (tried.where(F.col("action") == RETRY).withColumn("at", F.col("nextAt")).withColumn("attempt", F.col("attempt") + 1).select(*new.columns)
                 .unionByName(kept))
        # what the last batch put into a minute further on stays in its folder, as long as that minute has not come
        self._put(again, f"{self.home}/queue/batch_id={batch_id}")
        write_batch(spark.createDataFrame([(now, minute)], "now TIMESTAMP, minute BIGINT"), f"{self.home}/clock", batch_id)
        commit_batch(spark, self.home, batch_id)

    def run(self, rows: DataFrame) -> DataFrame:
        run_batches(rows, self.step, f"{self.home}/checkpoint")
        return self.output(rows.sparkSession)

    def finish(self, spark: SparkSession) -> "DueQueue":
        """After the stream has ended for good: the clock moves on until the queue is empty."""
        batch_id = last_committed(spark, self.home)
        while batch_id is not None:
            last = spark.read.parquet(f"{self.home}/tries/batch_id={batch_id}").drop("error", "action", "nextAt")
            latest = self._queued(spark, _ddl(last), batch_id + 1).agg(F.max("at")).first()[0]
            if latest is None:
                break
            batch_id += 1
            self.step(last.drop("attempt").where("false"), batch_id, F.lit(latest))
        return self

    def output(self, spark: SparkSession) -> DataFrame:
        return read_output(spark, f"{self.home}/tries", self.home)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
