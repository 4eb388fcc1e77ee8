"""Latest-state tables from change logs, and retention of event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultflow.operators.slices import running_max_before


# Folders that a small keyed table is spread over by the hash of its key.
PARTS = 16
# A keyed table of unknown size gets as many folders as keep about this many rows in each.
PART_ROWS = 200_000


def parts_for(rows: int, part_rows: int = PART_ROWS) -> int:
    """Folders for a table of so many rows: a power of two, so that the table doubles them as it grows."""
    return 1 << max(0, -(-rows // part_rows) - 1).bit_length()


def part_of(key: Column, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def write_keyed(df: DataFrame, key: str, path: str, parts: int = PARTS, mode: str = "error") -> None:
    """Write a table in folders by the hash of its key, so that a lookup opens the folder of its key only."""
    df.withColumn("part", part_of(F.col(key), parts)).write.mode(mode).partitionBy("part").parquet(path)


def write_sized(df: DataFrame, key: str, path: str, part_rows: int = PART_ROWS, mode: str = "error") -> int:
    """Write a table in as many folders as its number of rows calls for, each by one task and in order of the key; how many.

    What a lookup opens is then bounded by ``part_rows``, not by the table. Keys should be nearly unique: one key is in one folder.
    ``df`` is read twice, so it should be a written table.
    """
    parts = parts_for(df.count(), part_rows)
    (df.withColumn("part", part_of(F.col(key), parts)).repartition(parts, "part").sortWithinPartitions("part", key)
     .write.mode(mode).partitionBy("part").parquet(path))
    return parts


def one_key(spark: SparkSession, path: str, schema, key: str, value: str, parts: int = PARTS) -> DataFrame:
    """The row of one key of a keyed table; folder and key are both pushed down to the scan."""
    rows = spark.read.schema(T.StructType(list(schema.fields) + [T.StructField("part", T.IntegerType())])).parquet(path)
    part = spark.range(1).select(part_of(F.lit(value), parts)).first()[0]
    return rows.where((F.col("part") == part) & (F.col(key) == value)).drop("part")


def latest(changelog: DataFrame, key: str, value: Column, order: str) -> DataFrame:
    """Last value per key; a key whose last value is null (a tombstone) is gone.

    ``max_by`` keeps one candidate per key on each map task, so a hot key shuffles few rows.
    """
    return (changelog.groupBy(key).agg(F.max_by(value, F.col(order)).alias("_value"))
            .where(F.col("_value").isNotNull()).select("_value.*"))


def as_of(facts: DataFrame, changelog: DataFrame, key: str, order: str, fields: tuple[str, ...],
          out: str, slice_rows: int = 1_000_000) -> DataFrame:
    """Add the version of the key's entity that was current when each fact arrived.

    Versions and facts share one sort by (key, order); no range join. A change with the order of a
    fact comes first.
    """
    spot = F.col(order) * 2
    versions = changelog.select(
        F.col(key).alias("_key"), spot.alias("_spot"),
        F.struct(spot.alias("_at"), *fields).alias("_version"))
    arrivals = facts.select(F.col(key).alias("_key"), (spot + 1).alias("_spot"), F.struct("*").alias("_fact"))
    mixed = arrivals.unionByName(versions, allowMissingColumns=True)
    seen = running_max_before(mixed, "_key", "_spot", F.col("_version"), "_current", slice_rows)
    current = F.when(F.col("_current").isNotNull(), F.struct(*[F.col(f"_current.{f}") for f in fields]))
    return seen.where(F.col("_fact").isNotNull()).select("_fact.*", current.alias(out))


def retain(events: DataFrame, ts: str, days: int | None, now: Column) -> DataFrame:
    """Rows still kept at ``now``; None and -1 keep everything."""
    if days is None or days < 0:
        return events
    return events.where(F.col(ts) >= now - F.make_dt_interval(F.lit(days)))


def erase(history: DataFrame, tombstones: DataFrame, key: str) -> DataFrame:
    """History without the keys that were erased."""
    return history.join(tombstones.select(key).distinct(), key, "left_anti")
