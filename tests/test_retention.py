"""Tables that drop what has expired by the folder."""

from __future__ import annotations

import os
import random
from datetime import timedelta

import pytest
from helpers import T0
from pyspark.sql import functions as F

from vaultflow.session import new_folder
from vaultflow.sources import tables
from vaultflow.streaming.replay import replay
from vaultflow.streaming.retention import RetainedTable

DDL = "seq BIGINT, at TIMESTAMP"


def days_of(home):
    return sorted(d for d in os.listdir(f"{home}/rows") if d.startswith("day="))


def seqs(df):
    return sorted(r.seq for r in df.collect())


def opened(df):
    """Folders that the scan of a plan opens."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return plan.collectLeaves().head().metrics().apply("numPartitions").value()


def history(spark, n=240, seed=1):
    """Rows over twelve days, in no order of time, some without a time."""
    r = random.Random(seed)
    rows = [(k, None if k % 40 == 7 else T0 + timedelta(minutes=r.randrange(12 * 24 * 60))) for k in range(n)]
    return spark.createDataFrame([*rows, (n, T0 + timedelta(days=5)), (n + 1, T0 + timedelta(days=5, microseconds=-1))], DDL)


def test_rows_kept_are_those_of_the_filter_and_old_days_are_not_opened(spark):
    df, table = history(spark), RetainedTable(new_folder(spark, "t"), DDL, "at", 7)
    now = F.lit(T0 + timedelta(days=12))
    replay(df, "seq", table.run)
    want = seqs(tables.retain(df, "at", 7, now))
    assert seqs(table.rows(spark, now)) == want and 241 not in want and 240 in want
    assert seqs(table.rows(spark)) == list(range(242))  # nothing expired yet
    whole = days_of(table.home)
    assert table.expire(spark, now) == 0 and days_of(table.home) == whole  # noted; a reader may still be at work
    kept = table.rows(spark, now)
    assert seqs(kept) == want
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "at#" in plan.split("PushedFilters: [")[0]
    assert opened(table.rows(spark)) == 3 * len([d for d in whole if d >= "day=2026-01-06" and d[4].isdigit()])


def test_folders_go_with_the_next_expiry(spark):
    df, table = history(spark), RetainedTable(new_folder(spark, "t"), DDL, "at", 3)
    replay(df, "seq", table.run, 2)
    later = [F.lit(T0 + timedelta(days=d)) for d in (6, 9, 7, 9)]
    assert table.expire(spark, later[0]) == 0
    before = table.rows(spark)
    assert table.expire(spark, later[1]) == 3
    assert min(days_of(table.home)) == "day=2026-01-04"
    assert seqs(before) == seqs(df.where(F.to_date("at") >= F.lit("2026-01-04")))  # asked for before, read after
    assert table.expire(spark, later[2]) == 0  # a clock that went back
    assert table.expire(spark, later[3]) == 0 and seqs(table.rows(spark, later[3])) == seqs(tables.retain(df, "at", 3, later[3]))
    # a late row of a day that is gone is written and never seen
    table.step(spark.createDataFrame([(900, T0), (901, T0 + timedelta(days=9))], DDL), 5)
    assert [s for s in seqs(table.rows(spark)) if s >= 900] == [901]
    assert table.expire(spark, F.lit(T0 + timedelta(days=30))) == 4  # that late day and days 4 to 6 lie before the last note
    assert seqs(table.rows(spark)) == []


@pytest.mark.parametrize("days", [None, -1])
def test_without_a_limit_all_rows_stay(spark, days):
    df, table = history(spark, 40), RetainedTable(new_folder(spark, "t"), DDL, "at", days)
    assert seqs(table.rows(spark)) == []
    replay(df, "seq", table.run, 2)
    assert table.expire(spark, F.lit(T0 + timedelta(days=400))) == 0
    assert seqs(table.rows(spark, F.lit(T0 + timedelta(days=400)))) == seqs(df)


def test_a_batch_run_again_and_one_that_was_not_finished(spark):
    table = RetainedTable(new_folder(spark, "t"), DDL, "at", 7)
    rows = spark.createDataFrame([(1, T0), (2, T0 + timedelta(days=1)), (3, None)], DDL)
    for batch_id in (0, 0):
        table.step(rows, batch_id)
    assert seqs(table.rows(spark)) == [1, 2, 3]
    rows.withColumn("day", F.to_date("at")).withColumn("batch_id", F.lit(1)).write.mode("append").partitionBy("day", "batch_id").parquet(f"{table.home}/rows")
    assert seqs(table.rows(spark)) == [1, 2, 3]  # written, not committed
    table.step(rows, 1)
    assert seqs(table.rows(spark)) == [1, 1, 2, 2, 3, 3]


def test_two_readers_with_bounded_polls_do_not_disturb_each_other(spark):
    """Each reader has its own checkpoint: one may be behind, and a poll takes a bounded number of files."""
    from vaultflow.sources.streams import file_stream
    from vaultflow.streaming.state import run_batches

    folder, polls = new_folder(spark, "t"), {"a": [], "b": []}
    for piece in range(4):
        spark.range(piece * 10, piece * 10 + 10).coalesce(1).write.parquet(f"{folder}/piece-{piece}")

    def read(name, per_poll):
        stream = file_stream(spark, f"{folder}/*", "id BIGINT", per_poll)
        run_batches(stream, lambda batch, batch_id: polls[name].append((batch_id, seqs(batch.withColumnRenamed("id", "seq")))), f"{folder}-{name}")

    read("a", 1)
    assert [len(rows) for _, rows in polls["a"]] == [10] * 4
    spark.range(40, 50).coalesce(1).write.parquet(f"{folder}/piece-4")
    read("b", 2)
    read("a", 1)
    assert [len(rows) for _, rows in polls["b"]] == [20, 20, 10] and polls["a"][4:] == [(4, list(range(40, 50)))]
    assert sorted(x for _, rows in polls["a"] for x in rows) == sorted(x for _, rows in polls["b"] for x in rows) == list(range(50))
