"""Receipts with redelivery, messages that are due later, and batches that are visible as a whole."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from helpers import ENTRY_DDL, T0, entries, entry
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vaultflow.schemas import ALERT_RETRY, FraudRules, RetryPolicy
from vaultflow.session import new_folder
from vaultflow.streaming import delivery, jobs
from vaultflow.streaming.replay import replay
from vaultflow.streaming.state import last_committed, read_output


def fails(n):
    return F.when(n <= F.col("fails"), "GatewayUnavailableException")


@pytest.mark.parametrize("polls", [1, 3, 50])
def test_receipts_keep_their_order_and_come_once(spark, polls):
    r = random.Random(polls)
    rows = [(k, r.choice([0, 0, 0, 1]), r.choice([0] * 12 + [1, 2, 4, 9]) if k < 20 or polls > 1 else 0) for k in range(90)]
    df = spark.createDataFrame([(k, k, p, f) for k, p, f in rows], "seq BIGINT, place BIGINT, partition INT, fails INT")
    job = delivery.Receipts(new_folder(spark, "t"), fails, RetryPolicy(attempts=4, first_ms=1000), polls, slice_rows=20)
    replay(df, "seq", job.run, 3)
    got = job.finish(spark).output(spark).collect()
    want = {}
    for part in (0, 1):
        for number, (k, _, f) in enumerate([x for x in rows if x[1] == part], 1):
            want[k] = (part, "SKIPPED" if f >= 4 else "DELIVERED", min(f, 3) + 1, number)
    assert {x.seq: (x.partition, x.outcome, x.attempts, x.number) for x in got} == want and len(got) == len(rows)
    # what comes later in a partition is never delivered in an earlier micro-batch
    for part in (0, 1):
        batches = [x.batch_id for x in sorted((x for x in got if x.partition == part), key=lambda x: x.seq)]
        assert batches == sorted(batches)


def test_new_receipts_wait_behind_the_backlog(spark):
    df = spark.createDataFrame([(1, 1, 0, 3), (2, 2, 0, 0), (3, 3, 1, 0)], "seq BIGINT, place BIGINT, partition INT, fails INT")
    job = delivery.Receipts(new_folder(spark, "t"), fails, polls=1)
    job.step(df.where("seq < 2 or seq = 3"), 0)
    assert [x.seq for x in job.output(spark).collect()] == [3]
    job.step(df.where("seq = 2"), 1)
    job.step(df.where("seq = 2"), 1)  # run again
    assert [x.seq for x in job.output(spark).collect()] == [3]
    assert sorted((x.seq, x.attempts, x.number) for x in job.finish(spark).output(spark).collect()) == [(1, 4, 1), (2, 1, 2), (3, 1, 1)]


def test_the_backlog_left_at_the_end_takes_one_micro_batch(spark):
    df = spark.range(60).select(F.col("id").alias("seq"), F.col("id").alias("place"), F.lit(0).alias("partition"), (F.col("id") % 6).cast("int").alias("fails"))
    job = delivery.Receipts(new_folder(spark, "t"), fails, polls=1)
    job.step(df, 0)
    got = job.finish(spark).output(spark).collect()
    assert last_committed(spark, job.home) == 1  # however many failures there are
    assert sorted((x.seq, x.outcome, x.attempts, x.number) for x in got) == [
        (k, "SKIPPED" if k % 6 >= 4 else "DELIVERED", min(k % 6, 3) + 1, k + 1) for k in range(60)]


def tries(rows, policy, fatal):
    out = []
    for id, at, f in rows:
        for n in range(1, policy.attempts + 1):
            error = "IllegalArgumentException" if f == 5 else "GatewayUnavailableException" if n <= f else None
            action = "DELIVERED" if error is None else "DEAD_LETTER" if n == policy.attempts or error in fatal else "RETRY"
            wait = min(policy.first_ms * policy.factor ** (n - 1), policy.longest_ms or 10 ** 9)
            following = at + timedelta(milliseconds=wait) if action == "RETRY" else None
            out.append((id, n, at, error, action, following))
            if action != "RETRY":
                break
            at = following
    return sorted(out)


@pytest.mark.parametrize("bucket", [1, 5, 3600])
def test_what_is_due_is_tried_again(spark, bucket):
    r = random.Random(bucket)
    rows = [(k, T0 + timedelta(seconds=k // 2, milliseconds=r.randrange(-3000, 900)), r.randrange(6)) for k in range(60)]
    df = spark.createDataFrame([(k, at, f) for k, at, f in rows], "id BIGINT, at TIMESTAMP, fails INT")
    job = delivery.DueQueue(new_folder(spark, "t"), lambda n: F.when(F.col("fails") == 5, "IllegalArgumentException").otherwise(fails(n)), ALERT_RETRY, bucket_seconds=bucket)
    replay(df, "id", job.run, 5)
    got = job.finish(spark).output(spark)
    assert sorted((x.id, x.attempt, x.at, x.error, x.action, x.nextAt) for x in got.collect()) == tries(rows, ALERT_RETRY, ("IllegalArgumentException",))
    if bucket == 1:
        # no try comes before it is due, though many were due while the stream ran
        clock = {x.batch_id: x.now for x in read_output(spark, f"{job.home}/clock").collect()}
        assert all(x.at <= clock[x.batch_id] for x in got.collect())
        assert got.where("attempt > 1 and batch_id < 5").count() > 20


def test_a_queue_of_many_minutes_lies_in_few_folders(spark):
    r = random.Random(1)
    rows = [(k, T0 + timedelta(seconds=97 * k, milliseconds=r.randrange(900)), r.randrange(5)) for k in range(300)] + [(300, T0 + timedelta(days=9000), 2)]
    df = spark.createDataFrame(rows, "id BIGINT, at TIMESTAMP, fails INT")
    policy = RetryPolicy(attempts=4, first_ms=3_000_000)
    job = delivery.DueQueue(new_folder(spark, "t"), fails, policy, fatal=(), folders=8)
    replay(df.where("id < 300"), "id", job.run, 4)
    replay(df.where("id >= 300"), "id", job.run, 1)
    got = job.finish(spark).output(spark)
    assert sorted((x.id, x.attempt, x.at, x.error, x.action, x.nextAt) for x in got.collect()) == tries(rows, policy, ())
    queue = read_output(spark, f"{job.home}/queue")
    assert queue.count() > 300 and queue.groupBy("batch_id").agg(F.count_distinct("bucket").alias("n")).where("n > 9").isEmpty()
    clock = {x.batch_id: x.now for x in read_output(spark, f"{job.home}/clock").collect()}
    assert all(x.at <= clock[x.batch_id] for x in got.collect())


def test_an_empty_queue(spark):
    none = spark.createDataFrame([], "id BIGINT, at TIMESTAMP, fails INT")
    job = delivery.DueQueue(new_folder(spark, "t"), fails)
    for k in range(2):
        job.step(none, k)
    job.step(spark.createDataFrame([(1, T0, 1)], none.schema), 2)
    assert [(x.attempt, x.action) for x in sorted(job.finish(spark).output(spark).collect(), key=lambda x: x.attempt)] == [(1, "RETRY"), (2, "DELIVERED")]


def test_a_batch_is_visible_in_all_tables_or_in_none(spark, monkeypatch):
    accounts = spark.createDataFrame([("A", "USD", "ACTIVE")], "accountId STRING, currency STRING, status STRING")
    rows = entries(spark, [entry(k, f"t{k}", "A" if k % 3 else "B", "DEPOSIT", "5") for k in range(12)])
    home = new_folder(spark, "t")
    job = jobs.Validation(lambda _: accounts, home)
    whole = jobs.Validation._deduplicate

    def dies(self, settled, batch_id):
        if batch_id == 1:
            raise RuntimeError("lost")
        whole(self, settled, batch_id)

    arrived = []

    def run(stream):
        arrived.append(stream)
        try:
            return job.run(stream)
        except StreamingQueryException:
            return None

    monkeypatch.setattr(jobs.Validation, "_deduplicate", dies)
    replay(rows, "seq", run, 2)
    assert last_committed(spark, home) == 0
    assert read_output(spark, f"{home}/settled").where("batch_id = 1").count() > 0  # written, but not visible
    for table in ("settled", "processed", "dead"):
        assert job.output(spark, table).where("batch_id > 0").isEmpty()
    monkeypatch.setattr(jobs.Validation, "_deduplicate", whole)
    job.run(arrived[-1])  # resumes with the batch that was lost
    job.finish(spark)
    other = jobs.Validation(lambda _: accounts, new_folder(spark, "t"))
    replay(rows, "seq", other.run, 2)
    other.finish(spark)
    for table in ("settled", "processed", "dead"):
        assert sorted(r.seq for r in job.output(spark, table).collect()) == sorted(r.seq for r in other.output(spark, table).collect())
    assert job.output(spark, "settled").count() == 12


def test_two_readers_of_one_stream_with_bounded_polls(spark):
    from vaultflow.sources.streams import file_stream
    folder = new_folder(spark, "t")
    for k in range(4):
        entries(spark, [entry(k, f"t{k}", "A", "DEPOSIT", "20000")]).withColumn("status", F.lit("POSTED")).coalesce(1).write.parquet(f"{folder}/p{k}")
    sizes = []
    for name, limit in (("one", 1), ("two", 3)):
        home = new_folder(spark, name)
        from vaultflow.streaming.state import run_batches
        run_batches(file_stream(spark, f"{folder}/*", ENTRY_DDL, limit), lambda b, k: sizes.append((name, b.count())), f"{home}/checkpoint")
    assert [n for who, n in sizes if who == "one"] == [1, 1, 1, 1] and [n for who, n in sizes if who == "two"] == [3, 1]
    again = []
    run_batches(file_stream(spark, f"{folder}/*", ENTRY_DDL, 1), lambda b, k: again.append(b.count()), f"{home}/checkpoint")
    assert again == []  # each reader has its own place


def test_counts_of_old_windows_leave_the_state(spark):
    rows = [entry(k, f"t{k}", f"A{k % 2}", "PAYMENT", "1", at=3 * 86_400 * k) for k in range(8)]
    from test_streams import posted
    home = new_folder(spark, "t")
    replay(posted(spark, rows), "seq", lambda s: jobs.velocity_alerts(s, home, FraudRules(), "7 days", compact_every=4), 8)
    from vaultflow.streaming.state import StateTable
    kept = StateTable(f"{home}/counts", "burst", 4).before(spark, 8, jobs._BURST_DDL)
    assert 2 <= kept.count() <= 4
