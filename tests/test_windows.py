"""Windows kept in tables against a row-by-row account, and state tables whose folders follow their size."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import timedelta
from decimal import Decimal

from helpers import CREDITS, T0, entry, posted
from pyspark.sql import functions as F

from vaultflow.session import new_folder
from vaultflow.sources import tables
from vaultflow.streaming.replay import replay
from vaultflow.streaming.state import StateTable
from vaultflow.streaming.windows import ActivityWindows

HOUR, GRACE = timedelta(hours=1), timedelta(minutes=5)


def job(home, **more):
    return ActivityWindows(home, F.crc32(F.coalesce("accountId", F.lit(""))) % 3, F.col("seq"), slice_rows=40, **more)


def by_hand(spark, rows):
    """(late places, {window: totals}, windows that are final) when rows arrive one by one."""
    streams = dict(spark.createDataFrame([(a,) for a in {r[2] for r in rows}], "a STRING")
                   .select("a", F.crc32(F.coalesce("a", F.lit(""))) % 3).collect())
    clock, late, sums = {}, set(), defaultdict(lambda: [0, Decimal(0), Decimal(0)])
    for seq, _, account, kind, amount, *rest in sorted(rows, key=lambda x: x[0]):
        at, stream = rest[6], streams[account]
        if at is None:
            continue
        start = at.replace(minute=0, second=0, microsecond=0)
        if stream in clock and start + HOUR + GRACE <= clock[stream]:
            late.add(seq)
        else:
            total = sums[account, start]
            total[0] += 1
            total[1 if kind in CREDITS else 2] += amount
        clock[stream] = max(clock.get(stream, at), at)
    final = {k for k in sums if k[1] + HOUR + GRACE <= clock[streams[k[0]]]}
    return late, {k: tuple(v) for k, v in sums.items()}, final


def found(df):
    out = df.collect()
    assert len({(r.accountId, r.windowStart) for r in out}) == len(out)
    return {(r.accountId, r.windowStart): (r.transactionCount, r.totalCredits, r.totalDebits) for r in out}


def random_rows(seed, n=400):
    r = random.Random(seed)
    rows = []
    for seq in range(n):
        at = seq * 90 - r.choice([0, 0, 0, 600, 9_000])
        account = r.choice(["hot", "hot", "a", "b", "c", "", None])
        row = entry(seq, f"t{seq}", account, r.choice(["DEPOSIT", "PAYMENT"]), Decimal(r.randrange(1, 999)) / 100, at=at)
        rows.append(row if r.random() > 0.05 else row[:11] + (None,) + row[12:])
    return rows


def test_windows_late_rows_and_final_summaries(spark):
    rows = random_rows(3)
    windows = job(new_folder(spark, "t"), compact_every=2)
    final = replay(posted(spark, rows), "seq", windows.run, 5)
    late, sums, closed = by_hand(spark, rows)
    assert late and closed and len(closed) < len(sums)
    assert {r.seq for r in windows.output(spark, "late").collect()} == late
    assert found(final) == {k: sums[k] for k in closed}
    for account in ("hot", "a", ""):
        kept = windows.look_back(spark, account, F.lit(T0 + timedelta(days=2)), F.expr("INTERVAL 9 DAYS"))
        assert found(kept) == {k: v for k, v in sums.items() if k[0] == account}
        assert {r.windowEnd for r in kept.collect()} == {None}


def test_look_back_is_between_its_bounds_and_empty_before_the_first_batch(spark):
    windows = job(new_folder(spark, "t"))
    assert windows.look_back(spark, "A", F.lit(T0), F.expr("INTERVAL 1 HOUR")).isEmpty()
    rows = [entry(i, f"t{i}", "A", "DEPOSIT", "1", at=3600 * i) for i in range(6)]
    replay(posted(spark, rows), "seq", windows.run, 2)
    seen = found(windows.look_back(spark, "A", F.lit(T0 + 4 * HOUR), F.expr("INTERVAL 2 HOURS")))
    assert sorted(k[1] for k in seen) == [T0 + 2 * HOUR, T0 + 3 * HOUR, T0 + 4 * HOUR]


def test_windows_no_longer_served_leave_the_state(spark):
    rows = [entry(i, f"t{i}", "A", "DEPOSIT", "1", at=3600 * i) for i in range(12)]
    windows = job(new_folder(spark, "t"), served="3 hours", compact_every=2)
    replay(posted(spark, rows), "seq", windows.run, 4)
    kept = found(windows.look_back(spark, "A", F.lit(T0 + 20 * HOUR), F.expr("INTERVAL 9 DAYS")))
    assert sorted(k[1] for k in kept) == [T0 + n * HOUR for n in range(7, 12)]
    assert windows.output(spark, "final").count() == 10  # the eleventh is over, its grace is not


def test_a_partition_that_stands_still_closes_nothing(spark):
    windows = ActivityWindows(new_folder(spark, "t"), F.when(F.col("accountId") == "A", 0).otherwise(1), F.col("seq"))
    rows = [entry(0, "x", "A", "DEPOSIT", "1", at=0)]
    rows += [entry(i, f"t{i}", "B", "DEPOSIT", "1", at=3600 * i) for i in range(1, 5)]
    rows += [entry(5, "y", "A", "DEPOSIT", "2", at=1800)]
    final = replay(posted(spark, rows), "seq", windows.run, 3)
    assert {r.accountId for r in final.collect()} == {"B"} and windows.output(spark, "late").isEmpty()
    [row] = windows.look_back(spark, "A", F.lit(T0 + HOUR), F.expr("INTERVAL 1 HOUR")).collect()
    assert (row.transactionCount, row.totalCredits) == (2, Decimal(3))


def test_a_replayed_micro_batch_changes_nothing(spark):
    rows = random_rows(8, 120)
    df = posted(spark, rows)
    once, twice = job(new_folder(spark, "t"), compact_every=2), job(new_folder(spark, "t"), compact_every=2)
    for batch in range(3):
        part = df.where(F.col("seq").between(40 * batch, 40 * batch + 39))
        for windows in (once, twice, twice):
            windows.step(part, batch)
    for table in ("final", "late"):
        assert sorted(map(repr, once.output(spark, table).collect())) == sorted(map(repr, twice.output(spark, table).collect()))


def test_folders_follow_the_number_of_rows():
    assert [tables.parts_for(n, 100) for n in (0, 1, 100, 101, 200, 201, 1000)] == [1, 1, 1, 2, 2, 4, 16]


def test_a_lookup_opens_as_much_of_a_large_table_as_of_a_small_one(spark):
    sizes = []
    for n in (1_000, 10_000):
        rows, path = spark.range(n).select(F.format_string("k%d", "id").alias("k"), F.col("id").alias("v")), new_folder(spark, "t")
        parts = tables.write_sized(rows, "k", path, part_rows=200)
        [row] = tables.one_key(spark, path, rows.schema, "k", "k77", parts).collect()
        assert row.v == 77
        assert tables.one_key(spark, path, rows.schema, "k", "no", parts).isEmpty()
        part = spark.range(1).select(tables.part_of(F.lit("k77"), parts)).first()[0]
        sizes.append(spark.read.parquet(f"{path}/part={part}").count())
    assert all(60 < s <= 260 for s in sizes)


def test_state_folders_grow_with_the_state(spark):
    ddl = "k STRING, v BIGINT"
    table = StateTable(new_folder(spark, "t"), "k", compact_every=2, part_rows=50)
    want = {}
    for batch, n in enumerate([20, 40, 300, 900, 10]):
        rows = [(f"k{i}", batch) for i in range(n)]
        table.save(spark, batch, ddl, spark.createDataFrame(rows, ddl))
        table.save(spark, batch, ddl, spark.createDataFrame(rows, ddl))  # again, after a failure
        want |= dict(rows)
        keys = spark.createDataFrame([("k3",), ("k899",), ("none",)], "k STRING")
        assert {r.k: r.v for r in table.before(spark, batch + 1, ddl, keys).collect()} == {k: want[k] for k in ("k3", "k899") if k in want}
    assert {r.k: r.v for r in table.before(spark, 5, ddl).collect()} == want
    assert [table._parts(spark, b) for b in (1, 3)] == [1, 32]
    plan = table.before(spark, 4, ddl, spark.createDataFrame([("k3",)], ddl.split(",")[0]))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "part#" in text


def test_state_by_another_column_than_its_key(spark):
    ddl = "k STRING, owner STRING, v BIGINT"
    table = StateTable(new_folder(spark, "t"), "k", compact_every=2, place="owner", part_rows=5)
    for batch in range(3):
        table.save(spark, batch, ddl, spark.createDataFrame([(f"k{i}", f"o{i % 4}" if i else None, batch) for i in range(batch, 40)], ddl))
    mine = table.before(spark, 3, ddl, spark.createDataFrame([("o1",)], "owner STRING")).collect()
    assert {r.k: r.v for r in mine} == {f"k{i}": min(i, 2) for i in range(1, 40, 4)}
