"""Readers and writers of keyed record streams: files anywhere, Kafka where its connector is installed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.operators.slices import running_count
from vaultflow.schemas import ENVELOPE_DDL


def file_stream(spark: SparkSession, folder: str, schema=ENVELOPE_DDL, files_per_batch: int | None = None,
                pattern: str | None = None, format: str = "parquet") -> DataFrame:
    """Stream of the files that arrive in a folder, oldest first, a bounded number per micro-batch."""
    reader = spark.readStream.format(format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def kafka_options(servers: str, topic: str, records_per_batch: int | None = None) -> dict[str, str]:
    """Committed records only, from the earliest offset, with headers."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "includeHeaders": "true",
    }
    if records_per_batch:
        options["maxOffsetsPerTrigger"] = str(records_per_batch)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, records_per_batch: int | None = None) -> DataFrame:
    """Keyed record stream from Kafka; needs the Spark Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, records_per_batch)).load()
    return raw.select(F.col("key").cast("string").alias("key"), "value", "topic", "partition", "offset",
                      "timestamp", "headers")


def kafka_table(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a Kafka topic holds now, as a batch."""
    raw = spark.read.format("kafka").options(**kafka_options(servers, topic)).load()
    return raw.select(F.col("key").cast("string").alias("key"), "value", "topic", "partition", "offset",
                      "timestamp", "headers")


def sequence(partition: Column, offset: Column, partitions: int) -> Column:
    """A total order of the records of a stream that keeps the order within each partition.

    Offsets are unique within a partition only; there is no order between partitions, so they take turns.
    """
    return (offset.cast("bigint") * partitions + partition).cast("bigint")


def keyed_layout(df: DataFrame, key: str, order: str, partition) -> DataFrame:
    """Rows of a key together and in order, as a keyed stream stores them.

    ``partition`` is the logical stream partition of a row. Files are cut by range of
    (partition, key, order), so a key too large for one file continues in the next one.
    """
    placed = df.withColumn("partition", partition)
    return placed.repartitionByRange("partition", key, order).sortWithinPartitions("partition", key, order)


def place_in_files() -> Column:
    """Order of the rows of a written table, file by file; the parts of a file's name number the tasks that wrote it."""
    file = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    return F.shiftleft(file, 40) + F.col("_metadata.row_index")


def place_in_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Add ``place``: how many rows of the key come up to and including this one.

    A count adds up from parts: the window runs inside slices of a hot key, and each slice adds the
    number of rows in the slices before it.
    """
    return running_count(df, key, order, "place")


def encode(*fields: str) -> Column:
    """JSON text of a record: ISO times in milliseconds, nulls kept."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSX"})
