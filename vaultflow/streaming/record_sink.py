"""A record stream in files: rows written as key, JSON bytes and headers, with gap-free offsets in each partition.

A broker numbers the records of a partition as they come. Here a micro-batch numbers its own rows with a running count per
partition and adds what earlier micro-batches wrote, which a table of a row per partition carries along. A micro-batch that is run
again gives the same offsets, and readers see it when all of it is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.functions import headers
from vaultflow.operators.slices import running_sum_before
from vaultflow.session import stage
from vaultflow.sources.streams import encode
from vaultflow.streaming.state import commit_batch, read_output, run_batches, write_batch

_NO_HEADERS = "array<struct<key:string,value:binary>>"


class RecordSink:
    """Rows of a stream appended to a record stream.

    ``fields`` become the JSON text, ``partition`` and ``order`` (unique and ascending in a partition) say where a row goes. Of the headers a row
    carries, those that outcomes inherit go on; a row without any gets none. A null key is kept as null. ``tombstone`` rows
    have a key and no value.
    """

    def __init__(self, home: str, topic: str, key: str, fields: tuple[str, ...], partition: Column, order: Column, tombstone: Column | None = None,
                 slice_rows: int = 1_000_000):
        self.home = home
        self.topic = topic
        self.key = key
        self.fields = fields
        self.partition = partition
        self.order = order
        self.tombstone = F.lit(False) if tombstone is None else tombstone
        self.slice_rows = slice_rows

    def step(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ends = "partition INT, written BIGINT"
        before = spark.createDataFrame([], ends)
        if batch_id > 0:
            before = spark.read.schema(ends).parquet(f"{self.home}/ends/batch_id={batch_id - 1}")
        carried = headers.propagate(F.col("headers")) if "headers" in batch.columns else F.array().cast(_NO_HEADERS)
        value = F.when(~F.coalesce(self.tombstone, F.lit(False)), encode(*self.fields).cast("binary"))
        rows = stage(batch.select(F.col(self.key).alias("key"), value.alias("value"), F.lit(self.topic).alias("topic"), self.partition.alias("partition"),
                                  F.col("timestamp").alias("timestamp"), F.coalesce(carried, F.array().cast(_NO_HEADERS)).alias("headers"),
                                  self.order.cast("bigint").alias("_order")), "records")
        counted = rows.groupBy("partition").agg(F.count("*").alias("written"))
        numbered = running_sum_before(rows, "_order", F.lit(1), "_here", self.slice_rows, key="partition")
        earlier = before.select(F.col("partition").alias("_p"), F.col("written").alias("_before"))
        placed = (numbered.join(earlier, F.col("partition") == F.col("_p"), "left")
                  .withColumn("offset", F.col("_here") + F.coalesce("_before", F.lit(0))))
        write_batch(placed.select("key", "value", "topic", "partition", "offset", "timestamp", "headers"), f"{self.home}/records", batch_id)
        write_batch(before.unionByName(counted).groupBy("partition").agg(F.sum("written").alias("written")), f"{self.home}/ends", batch_id)
        commit_batch(spark, self.home, batch_id)

    def run(self, rows: DataFrame) -> DataFrame:
        run_batches(rows, self.step, f"{self.home}/checkpoint")
        return self.records(rows.sparkSession)

    def records(self, spark: SparkSession) -> DataFrame:
        """What is written and committed, as a reader of the stream gets it."""
        return read_output(spark, f"{self.home}/records", self.home).drop("batch_id")
