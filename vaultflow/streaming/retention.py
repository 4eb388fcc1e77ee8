"""An event table kept for a number of days: rows lie in folders by day, and what has expired is dropped by the folder.

Micro-batches go to ``day=.../batch_id=...`` and become visible when they are committed. Expiry notes the first day that is still
kept, which takes effect at once, and readers neither list nor open an older one as long as they ask for their table after it. The
folders themselves go with the next expiry that moves the note, so a reader that began just before does not lose its files.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.sources.tables import retain
from vaultflow.streaming.state import commit_batch, last_committed, run_batches


class RetainedTable:
    """Rows with the columns ``schema`` (DDL, without ``day`` and ``batch_id``), kept for ``days`` by their time ``ts``.

    None and -1 days keep everything, rows without a time included; any other number keeps no row without a time, as ``retain``
    has it. Days are those of the session's time zone, which must not change.
    """

    def __init__(self, home: str, schema: str, ts: str, days: int | None):
        self.home = home
        self.schema = schema
        self.ts = ts
        self.days = None if days is None or days < 0 else days

    def _noted(self, spark: SparkSession) -> list[date]:
        """First days kept that were noted so far, oldest first; one for each expiry that moved it."""
        try:
            notes = spark.read.schema("first DATE").parquet(f"{self.home}/kept")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [r[0] for r in notes.distinct().sort("first").collect()]

    def step(self, batch: DataFrame, batch_id: int) -> None:
        """Add a micro-batch; run again it replaces its own folders."""
        spark = batch.sparkSession
        placed = batch.withColumn("day", F.to_date(self.ts)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        # rows of a day together, and a day with very many rows cut into several files
        (placed.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch_id").parquet(f"{self.home}/rows"))
        commit_batch(spark, self.home, batch_id)

    def run(self, rows: DataFrame) -> None:
        run_batches(rows, self.step, f"{self.home}/checkpoint")

    def expire(self, spark: SparkSession, now: Column) -> int:
        """Let the days go that lie wholly outside of what is kept at ``now``; how many folders were deleted.

        A ``now`` before that of an earlier call changes nothing. Safe to run again after a failure at any point.
        """
        if self.days is None:
            return 0
        first = spark.range(1).select(F.to_date(now.cast("timestamp") - F.make_dt_interval(F.lit(self.days)))).first()[0]
        noted = self._noted(spark)
        if noted and first < noted[-1]:
            return 0
        if not noted or first > noted[-1]:
            spark.range(1).select(F.lit(first).alias("first")).write.mode("overwrite").parquet(f"{self.home}/kept/to={first}")
        before = [d for d in noted if d < first]
        return self._delete_before(spark, before[-1]) if before else 0

    def _delete_before(self, spark: SparkSession, first: date) -> int:
        """Delete the folders of the days before ``first``. The driver lists days, of which there are few, and no files."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.home}/rows")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return 0
        gone = 0
        for entry in files.listStatus(path):
            name, _, value = entry.getPath().getName().partition("=")
            if name == "day" and value[:1].isdigit() and date.fromisoformat(value) < first:
                gone += files.delete(entry.getPath(), True)
        return gone

    def rows(self, spark: SparkSession, now: Column | None = None) -> DataFrame:
        """Committed rows of the days that are kept; with ``now`` exactly those kept at that time.

        The day and the time both reach the scan: folders of other days are not opened.
        """
        stored = f"{self.schema}, day DATE, batch_id BIGINT"
        try:
            kept = spark.read.schema(stored).parquet(f"{self.home}/rows")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            kept = spark.createDataFrame([], stored)
        last = last_committed(spark, self.home)
        kept = kept.where(F.col("batch_id") <= F.lit(-1 if last is None else last))
        noted = self._noted(spark)
        if noted:
            kept = kept.where(F.col("day") >= F.lit(noted[-1]))
        if now is not None and self.days is not None:
            now = now.cast("timestamp")
            kept = retain(kept.where(F.col("day") >= F.to_date(now - F.make_dt_interval(F.lit(self.days)))), self.ts, self.days, now)
        return kept.drop("day", "batch_id")
