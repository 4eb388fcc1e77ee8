"""Hot keys, and running values that do not need a whole key in one task.

The order column must be unique. A hot key is cut into slices of consecutive order values, so a
slice never holds more than ``slice_rows`` rows, however the rows are spread. Other keys stay whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.operators.lookups import hot_table

WHOLE = -1  # slice number of a key that is not split


def hot_keys(df: DataFrame, key: str, slice_rows: int) -> DataFrame | None:
    """All keys with more than ``slice_rows`` rows, as column ``_hot``; None if there are none.

    Every one of them is split, however many there are (fewer than rows / ``slice_rows``).
    """
    hot = hot_table(df, [F.col(key)], ["_hot"], slice_rows)
    return None if hot is None else hot.select("_hot")


def slice_of(order: str, slice_rows: int) -> Column:
    return F.expr(f"`{order}` div {slice_rows}")


def with_slice(df: DataFrame, key: str, order: str, hot: DataFrame | None, slice_rows: int,
               out: str = "slice") -> DataFrame:
    """Add the slice number of every row."""
    if hot is None:
        return df.withColumn(out, F.lit(WHOLE).cast("bigint"))
    return (df.join(hot, F.col(key) == F.col("_hot"), "left")
            .withColumn(out, F.when(F.col("_hot").isNotNull(), slice_of(order, slice_rows))
                        .otherwise(F.lit(WHOLE)).cast("bigint"))
            .drop("_hot"))


def running_max_before(df: DataFrame, key: str, order: str, value: Column, out: str,
                       slice_rows: int = 1_000_000, split_all: bool = False) -> DataFrame:
    """Add ``max(value)`` over all earlier rows of the same key (null values are skipped).

    A maximum can be combined from parts, so a hot key is computed slice by slice: one maximum per
    slice, a running maximum over those few, and a window inside each slice. ``split_all`` treats
    every key as hot, for keys such as stream partitions that are all huge.
    """
    valued = df.withColumn("_value", value)
    if split_all:
        sliced = valued.withColumn("_slice", slice_of(order, slice_rows))
    else:
        hot = hot_keys(df, key, slice_rows)
        sliced = with_slice(valued, key, order, hot, slice_rows, "_slice")
    within = (Window.partitionBy(key, "_slice").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    result = sliced.withColumn(out, F.max("_value").over(within))
    if split_all or hot is not None:
        earlier = (Window.partitionBy("_k").orderBy("_s")
                   .rowsBetween(Window.unboundedPreceding, -1))
        carried = (sliced.where(F.col("_slice") != WHOLE)
                   .groupBy(F.col(key).alias("_k"), F.col("_slice").alias("_s"))
                   .agg(F.max("_value").alias("_top"))
                   .withColumn("_carry", F.max("_top").over(earlier)).drop("_top"))
        result = (result.join(carried, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_slice") == F.col("_s")), "left")
                  .withColumn(out, F.greatest(out, "_carry")).drop("_k", "_s", "_carry"))
    return result.drop("_value", "_slice")


def running_count(df: DataFrame, key: str, order: str, out: str, slice_rows: int = 1_000_000) -> DataFrame:
    """Add the number of rows of the key up to and including this one, hot keys slice by slice."""
    hot = hot_keys(df, key, slice_rows)
    sliced = with_slice(df, key, order, hot, slice_rows, "_slice")
    within = Window.partitionBy(key, "_slice").orderBy(order)
    result = sliced.withColumn(out, F.row_number().over(within).cast("bigint"))
    if hot is not None:
        earlier = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
        before = (sliced.where(F.col("_slice") != WHOLE)
                  .groupBy(F.col(key).alias("_k"), F.col("_slice").alias("_s")).agg(F.count("*").alias("_n"))
                  .withColumn("_before", F.sum("_n").over(earlier)).drop("_n"))
        result = (result.join(before, (F.col(key) == F.col("_k")) & (F.col("_slice") == F.col("_s")), "left")
                  .withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).drop("_k", "_s", "_before"))
    return result.drop("_slice")


def running_sum_before(df: DataFrame, order: str, value: Column, out: str, slice_rows: int = 1_000_000, key: str | None = None) -> DataFrame:
    """Add the sum of ``value`` over all rows that come earlier, of the same ``key`` if there is one (not null).

    One sum per slice of ``order``, a running sum over those few, and a window inside each slice, so neither the whole table nor a
    hot key is in one task. ``df`` is read twice.
    """
    keyed = df.withColumn("_key", F.lit(0) if key is None else F.col(key))
    sliced = keyed.withColumn("_value", value.cast("bigint")).withColumn("_slice", slice_of(order, slice_rows))
    earlier = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = (sliced.groupBy(F.col("_key").alias("_k"), F.col("_slice").alias("_s")).agg(F.sum("_value").alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"))
    within = Window.partitionBy("_key", "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (sliced.withColumn(out, F.coalesce(F.sum("_value").over(within), F.lit(0)))
            .join(carried, (F.col("_key") == F.col("_k")) & (F.col("_slice") == F.col("_s")))
            .withColumn(out, F.col(out) + F.col("_before")).drop("_value", "_slice", "_s", "_before", "_key", "_k"))
