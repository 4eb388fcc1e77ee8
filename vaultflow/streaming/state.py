"""State that foreachBatch jobs keep in tables, safe to replay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.session import stage
from vaultflow.sources.tables import PART_ROWS, PARTS, latest, part_of, write_keyed, write_sized

# One full copy of the state per this many micro-batches; between copies only changes are written.
COMPACT_EVERY = 20
# A micro-batch that touches more folders of a full copy than this opens all of them.
OPENED = 1_000


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    """Write one micro-batch of an output table; a replay replaces exactly its own folder."""
    df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def commit_batch(spark: SparkSession, home: str, batch_id: int) -> None:
    """Note, after all tables of a micro-batch are written, that they are: readers see a batch in all of its tables or in none."""
    write_batch(spark.range(1).select(F.lit(batch_id).cast("bigint").alias("n")), f"{home}/commits", batch_id)


def last_committed(spark: SparkSession, home: str) -> int | None:
    """The newest micro-batch that is whole. Batches come one after another, so all before it are whole as well."""
    try:
        return spark.read.schema("n BIGINT").parquet(f"{home}/commits").agg(F.max("n")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_output(spark: SparkSession, folder: str, home: str | None = None) -> DataFrame:
    """All micro-batches of an output table; with ``home`` those that are committed there."""
    rows = spark.read.option("basePath", folder).parquet(f"{folder}/batch_id=*")
    if home is None:
        return rows
    last = last_committed(spark, home)
    return rows.where(F.col("batch_id") <= F.lit(-1 if last is None else last))


class StateTable:
    """Latest row per key as of a micro-batch.

    Micro-batch n reads the last full copy before it and the changes since, so running it twice
    reads the same state twice. Every ``compact_every`` batches the merged state is written as the
    next full copy, which bounds what is read; older folders are then no longer needed.

    Rows lie in folders by the hash of ``place`` (the key, if not given). A full copy has as many folders as its rows call for, about
    ``part_rows`` in each, noted beside it; so what a few keys open does not grow with the state. Changes, which grow with the last
    micro-batches only, always have 16.
    """

    def __init__(self, folder: str, key: str, compact_every: int = COMPACT_EVERY, place: str | None = None, part_rows: int = PART_ROWS):
        self.folder = folder
        self.key = key
        self.compact_every = compact_every
        self.place = place or key
        self.part_rows = part_rows

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.folder}/kind={kind}/batch={batch_id}"

    def _copy_before(self, batch_id: int) -> int | None:
        """Batch of the last full copy that batch ``batch_id`` may read."""
        last = batch_id // self.compact_every * self.compact_every - 1
        return last if last >= 0 else None

    def _parts(self, spark: SparkSession, copy: int) -> int:
        """Folders of the full copy written in batch ``copy``."""
        return spark.read.schema("parts INT").parquet(f"{self.folder}-parts/batch={copy}").first()[0]

    def _rows(self, spark: SparkSession, stored: str, paths: list[str], parts: int, keys: DataFrame | None) -> DataFrame:
        """Rows in folders of one layout; with ``keys`` those folders only that keys fall into."""
        if not paths:
            return spark.createDataFrame([], stored)
        rows = spark.read.schema(stored).option("basePath", self.folder).parquet(*paths)
        if keys is None:
            return rows
        touched = keys.select(part_of(F.col(self.place), parts)).distinct().limit(OPENED + 1).collect()
        return rows if len(touched) > OPENED else rows.where(F.col("part").isin([r[0] for r in touched]))

    def before(self, spark: SparkSession, batch_id: int, schema: str, keys: DataFrame | None = None) -> DataFrame:
        """State left by all batches before ``batch_id``, for ``keys`` (a column ``place``, no nulls) only if given.

        With keys only the folders that they fall into are opened, and the rest of those is dropped where it is read; it takes
        no part in a shuffle as long as Spark finds the keys of one batch small enough to broadcast.
        """
        copy = self._copy_before(batch_id)
        stored = f"{schema}, version BIGINT, kind STRING, batch BIGINT, part INT"
        changes = [self._path("changes", i) for i in range(0 if copy is None else copy + 1, batch_id)]
        rows = self._rows(spark, stored, changes, PARTS, keys)
        if copy is not None:
            rows = rows.unionByName(self._rows(spark, stored, [self._path("copy", copy)], self._parts(spark, copy), keys))
        rows = rows.drop("kind", "batch")
        if keys is not None:
            rows = rows.join(keys, self.place, "left_semi")
        fields = [f for f in rows.columns if f not in ("version", "part")]
        return latest(rows, self.key, F.struct(*fields), "version")

    def save(self, spark: SparkSession, batch_id: int, schema: str, changes: DataFrame,
             keep: Column | None = None) -> None:
        """Write the rows that changed in ``batch_id``; a full copy keeps the rows where ``keep`` holds."""
        stamped = changes.withColumn("version", F.lit(batch_id).cast("bigint"))
        write_keyed(stamped, self.place, self._path("changes", batch_id), mode="overwrite")
        if (batch_id + 1) % self.compact_every:
            return
        written = spark.read.schema(f"{schema}, version BIGINT, part INT").parquet(self._path("changes", batch_id)).drop("part")
        earlier = self.before(spark, batch_id, schema).withColumn("version", F.lit(-1).cast("bigint"))
        merged = latest(earlier.unionByName(written), self.key, F.struct(*written.columns), "version")
        kept = stage(merged if keep is None else merged.where(keep), "state-copy")
        parts = write_sized(kept, self.place, self._path("copy", batch_id), self.part_rows, mode="overwrite")
        note = spark.range(1).select(F.lit(parts).cast("int").alias("parts"))
        note.write.mode("overwrite").parquet(f"{self.folder}-parts/batch={batch_id}")


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Apply ``step`` to every micro-batch of what has arrived, then stop."""
    (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def run_append(stream: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """Append finished rows to a file table, exactly once, until all that has arrived is done."""
    (stream.writeStream.format("parquet").outputMode("append").option("path", folder)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).parquet(folder)
