"""Sessions and staged tables.

A *staged* table is a Parquet copy of an intermediate result in the shared folder named by
``spark.checkpoint.dir``. It cuts lineage (a lost executor re-reads files instead of replaying the
whole pipeline) and lets several consumers read one result, as separate services read one stream.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def build_session(app: str = "vaultflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; extra settings win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # HotSpot leaves methods above 8,000 bytes interpreted; plain iterators are faster than that.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private folder only in local mode without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="vaultflow-")
    return _local_roots[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the checkpoint folder, never reused."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark).rstrip('/')}/vaultflow/{app}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the table that was written."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
