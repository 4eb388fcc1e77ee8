"""Slices, lookups, change logs, ingest, windows, notifications and deliveries."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from helpers import T0, entry, posted
from pyspark.sql import functions as F

from vaultflow.operators import activity, enrich, ingest, notify
from vaultflow.operators.lookups import Lookup, lookup_join
from vaultflow.operators.slices import hot_keys, running_max_before
from vaultflow.schemas import ALERT_RETRY, RECEIPT_RETRY, VALIDATION_RETRY
from vaultflow.session import new_folder
from vaultflow.sources import decode, driver_tables, streams, tables


def random_rows(seed=1, n=400):
    r = random.Random(seed)
    return [("hot" if r.random() < 0.4 else f"k{r.randrange(6)}", i * 7, r.choice([None, r.randrange(1000)]))
            for i in range(n)]


@pytest.mark.parametrize("slice_rows, split_all", [(10_000, False), (100, False), (100, True)])
def test_running_max(spark, slice_rows, split_all):
    rows = random_rows()
    df = spark.createDataFrame(rows, "k STRING, o BIGINT, v INT")
    got = {(r.k, r.o): r.m for r in running_max_before(df, "k", "o", F.col("v"), "m", slice_rows, split_all).collect()}
    top, want = {}, {}
    for k, o, v in rows:
        want[k, o] = top.get(k)
        if v is not None:
            top[k] = max(v, top.get(k, v))
    assert got == want


@pytest.mark.parametrize("slice_rows", [10_000, 100])
def test_place_in_key(spark, slice_rows):
    rows = random_rows(2)
    df = spark.createDataFrame(rows, "k STRING, o BIGINT, v INT").repartition(5)
    got = {(r.k, r.o): r.place for r in streams.running_count(df, "k", "o", "place", slice_rows).collect()}
    n, want = {}, {}
    for k, o, _ in rows:
        n[k] = n.get(k, 0) + 1
        want[k, o] = n[k]
    assert got == want


def test_every_hot_key_is_found(spark):
    df = spark.createDataFrame([(f"k{i % 10}",) for i in range(200)] + [("hot",)] * 50 + [(None,)] * 90, "k STRING")
    assert sorted(r[0] for r in hot_keys(df, "k", 19).collect()) == sorted(["hot", *(f"k{i}" for i in range(10))])
    assert [r[0] for r in hot_keys(df, "k", 20).collect()] == ["hot"]
    assert hot_keys(df, "k", 100) is None


def test_no_task_of_a_lookup_holds_a_hot_key(spark):
    """Four fifths of the facts have no key, most others one key; the table counts as too large to broadcast."""
    facts = spark.createDataFrame([(i, None if i % 5 else ("hot" if i % 50 else f"k{i}")) for i in range(20000)], "seq BIGINT, f STRING")
    keys = ["hot", *(f"k{i}" for i in range(0, 20000, 50))]
    table = Lookup(spark.createDataFrame([(k, 1) for k in keys], "k STRING, v INT"), "k", 0, spread_rows=100)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for c, v in zip(before, ("20", "false", "-1")):
        spark.conf.set(c, v)
    try:
        joined = lookup_join(facts, table, "f", "hit")
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 20000 and max(sizes) < 20000 / 20 * 1.5
        assert joined.where("hit is not null").count() == 4000
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_facts_without_a_key_do_not_come_to_one_task(spark):
    facts = spark.range(2000).select(F.col("id").alias("seq"), F.when(F.col("id") % 20 == 0, F.concat(F.lit("k"), F.col("id") % 100)).alias("k"))
    table = Lookup(spark.createDataFrame([(f"k{i}", i) for i in range(100)], "k STRING, v INT"), "k", 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup_join(facts, table, "k", "found")
        # no guess of Spark makes each task hold a table that was measured as large
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(t.n for t in tasks) == 2000 and max(t.n for t in tasks) < 1500
    assert joined.where("found.v is not null").count() == 100


@pytest.mark.parametrize("broadcast_bytes", [1000, 0])
def test_lookup_join(spark, broadcast_bytes):
    facts = spark.createDataFrame([(i, None if i % 4 == 0 else f"k{i % 7}") for i in range(300)], "seq BIGINT, k STRING")
    table = Lookup(spark.createDataFrame([(f"k{i}", i) for i in range(5)], "k STRING, v INT"), "k", broadcast_bytes, 20)
    rows = lookup_join(facts.withColumnRenamed("k", "f"), table, "f", "hit").collect()
    assert len(rows) == 300
    assert all((r.hit.v if r.hit else None) == (int(r.f[1]) if r.f and int(r.f[1]) < 5 else None) for r in rows)
    missing = lookup_join(facts.withColumnRenamed("k", "f"), table, "f", "hit", "left_anti")
    assert missing.columns == ["seq", "f"]
    assert missing.count() == sum(r.hit is None for r in rows)


def test_latest_and_tombstones(spark):
    changes = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y"), ("b", 5, "z"), ("c", 1, None),
                                     ("c", 9, "w")], "k STRING, o BIGINT, v STRING")
    value = F.when(F.col("v").isNotNull(), F.struct("k", "v"))
    assert sorted(tuple(r) for r in tables.latest(changes, "k", value, "o").collect()) == [("b", "z"), ("c", "w")]


@pytest.mark.parametrize("slice_rows", [1_000_000, 50])
def test_as_of(spark, slice_rows):
    r = random.Random(3)
    changes = [("hot" if i % 2 else f"k{i % 5}", i * 9, f"v{i}") for i in range(30)]
    facts = [(i, "hot" if r.random() < 0.6 else f"k{r.randrange(6)}") for i in range(300)]
    got = tables.as_of(spark.createDataFrame(facts, "seq BIGINT, k STRING"),
                       spark.createDataFrame(changes, "k STRING, seq BIGINT, v STRING"), "k", "seq", ("v",), "now",
                       slice_rows).collect()
    want = {s: max(((o, v) for kk, o, v in changes if kk == k and o <= s), default=(0, None))[1] for s, k in facts}
    assert {r.seq: (r.now.v if r.now else None) for r in got} == want and len(got) == 300


def test_event_time_falls_back(spark):
    t = [T0 + timedelta(seconds=s) for s in range(10)]
    rows = [(0, 0, t[3], t[1]), (0, 1, None, t[2]), (0, 2, None, None), (0, 3, None, datetime(1960, 1, 1)), (1, 4, None, None)]
    df = spark.createDataFrame(rows, "partition INT, offset BIGINT, p TIMESTAMP, r TIMESTAMP")
    got = {r.offset: r.eventTime for r in decode.event_time(df, F.col("p"), F.col("r")).collect()}
    assert got == {0: t[3], 1: t[2], 2: t[3], 3: t[3], 4: None}


def test_retention(spark):
    df = spark.createDataFrame([(T0,), (T0 - timedelta(days=7),), (T0 - timedelta(days=7, milliseconds=1),)], "ts TIMESTAMP")
    assert tables.retain(df, "ts", 7, F.lit(T0)).count() == 2
    assert tables.retain(df, "ts", -1, F.lit(T0)).count() == tables.retain(df, "ts", None, F.lit(T0)).count() == 3


def test_same_key_same_partition(spark):
    df = spark.createDataFrame([(f"k{i % 9}", i) for i in range(90)], "k STRING, o BIGINT")
    laid = streams.keyed_layout(df, "k", "o", driver_tables.partition_of(F.col("k")))
    per_key = laid.groupBy("k").agg(F.countDistinct("partition").alias("n")).collect()
    assert {r.n for r in per_key} == {1}
    for part in laid.rdd.glom().collect():
        places = [(r.partition, r.k, r.o) for r in part]
        assert places == sorted(places)


def test_kafka_options():
    options = streams.kafka_options("h:9092", "bank.accounts", 100)
    assert options["kafka.isolation.level"] == "read_committed" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "100" and options["includeHeaders"] == "true"


def test_constraints(spark):
    rows = [(1, "A", "DEPOSIT", "0.01", "USD"), (2, " ", None, None, ""), (3, None, "DEPOSIT", "0.009", "USD")]
    df = spark.createDataFrame(rows, "seq BIGINT, accountId STRING, type STRING, amountRaw STRING, currency STRING")
    got = {r.seq: r.violations for r in ingest.check(df, ingest.transaction_constraints()).collect()}
    assert got == {1: [], 2: ["accountId: must not be blank", "type: must not be null", "amountRaw: must not be null",
                              "currency: must not be blank"],
                   3: ["accountId: must not be blank", "amountRaw: must be greater than or equal to 0.01"]}
    mails = [("a@b.c",), ("a.b+c@host",), (None,), ("no",), ("a@",), ("a b@c",), ("a@-x.com",)]
    people = spark.createDataFrame(mails, "email STRING")
    ok = [r.email for r in ingest.check(people, [ingest.email_form("email")]).where("accepted").collect()]
    assert ok == ["a@b.c", "a.b+c@host", None]


def test_batch_gate_is_all_or_nothing(spark):
    rows = [(i, i // 10, "A", "DEPOSIT", "0" if i == 13 else "5", "USD") for i in range(30)]
    df = spark.createDataFrame(rows, "seq BIGINT, b BIGINT, accountId STRING, type STRING, amountRaw STRING, currency STRING")
    out = ingest.gate_batches(ingest.check(df, ingest.transaction_constraints()), "b").collect()
    assert sorted(r.seq for r in out) == [*range(10), *range(20, 30)]
    assert len({r.correlationId for r in out}) == 2


def test_status_changes(spark):
    opens = spark.createDataFrame([(0, "A", "C1", "CHECKING", "USD"), (5, "A", "C2", "SAVINGS", "EUR")],
                                  "seq BIGINT, accountId STRING, customerId STRING, accountType STRING, currency STRING")
    commands = spark.createDataFrame([(1, "A", "FROZEN"), (2, "A", "ACTIVE"), (6, "A", "CLOSED"), (1, "B", "FROZEN")],
                                     "seq BIGINT, accountId STRING, status STRING")
    rows = {(r.accountId, r.seq): (r.customerId, r.status, r.error) for r in
            ingest.status_changes(opens, commands).collect()}
    assert rows == {("A", 0): ("C1", "ACTIVE", None), ("A", 1): ("C1", "FROZEN", None), ("A", 2): ("C1", "ACTIVE", None),
                    ("A", 5): ("C2", "ACTIVE", None), ("A", 6): ("C2", "CLOSED", None),
                    ("B", 1): (None, None, "Unknown account B")}


def test_enrichment(spark):
    rows = posted(spark, [entry(1, "t1", "ACC-1", "DEPOSIT", "42"), entry(2, "t2", "ACC-9", "DEPOSIT", "1"),
                          entry(3, "t3", "ACC-2", "DEPOSIT", "1")])
    accounts = spark.createDataFrame([("ACC-1", "CUST-1", "CHECKING"), ("ACC-2", "CUST-2", "SAVINGS")],
                                     "accountId STRING, customerId STRING, accountType STRING")
    customers = spark.createDataFrame([("CUST-1", "Ada Lovelace", "ada@example.com", "GOLD")],
                                      "customerId STRING, fullName STRING, email STRING, tier STRING")
    out = {r.transactionId: r for r in enrich.flat(
        enrich.enrich(rows, Lookup(accounts, "accountId"), Lookup(customers, "customerId"))).collect()}
    assert sorted(out) == ["t1", "t3"]
    t1, t3 = out["t1"], out["t3"]
    assert (t1.customerId, t1.accountType, t1.customerName, t1.customerTier) == ("CUST-1", "CHECKING", "Ada Lovelace", "GOLD")
    assert (t3.customerId, t3.accountType, t3.customerName, t3.customerTier) == ("CUST-2", "SAVINGS", None, None)


ACTIVITY = [entry(1, "a", "A", "DEPOSIT", "1000", at=60), entry(2, "b", "A", "WITHDRAWAL", "100", at=120),
            entry(3, "c", "A", "PAYMENT", "50", at=180), entry(4, "d", "A", "DEPOSIT", "1", at=66 * 60)]


def test_activity(spark):
    rows = posted(spark, ACTIVITY)
    first = activity.with_net_flow(activity.summarize(rows)).orderBy("windowStart").first()
    assert (first.windowStart, first.transactionCount, first.totalCredits, first.totalDebits, first.netFlow) == (
        T0, 3, Decimal(1000), Decimal(150), Decimal(850))
    seen = activity.look_back(rows, "A", F.lit(T0 + timedelta(hours=1)), F.expr("INTERVAL 1 HOUR")).collect()
    assert sorted(r.windowStart for r in seen) == [T0, T0 + timedelta(hours=1)]  # both ends count
    assert all(r.windowEnd is None for r in seen)


@pytest.mark.parametrize("slice_rows", [1_000_000, 2])
def test_late_rows(spark, slice_rows):
    rows = [(0, 1, T0), (0, 2, T0 + timedelta(minutes=65)), (0, 3, T0 + timedelta(minutes=59)),
            (1, 4, T0 + timedelta(minutes=64, seconds=59)), (1, 5, T0)]
    df = spark.createDataFrame(rows, "p INT, o BIGINT, timestamp TIMESTAMP")
    got = {r.o: r.late for r in activity.late_rows(df, "p", "o", slice_rows=slice_rows).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False, 5: False}


def test_messages(spark):
    row = (posted(spark, [entry(1, "t1", "ACC-N", "PAYMENT", "20", at=0)])
           .withColumn("balanceAfter", F.lit(80).cast("decimal(38,2)")).withColumn("reason", F.lit("INSUFFICIENT_FUNDS: x")))
    assert notify.receipts(row).first().message == "PAYMENT of 20.00 USD posted. New balance: 80.00 USD"
    declined = notify.declines(row).first()
    assert (declined.channel, declined.recipient) == ("EMAIL", "owner-of-ACC-N")
    assert declined.message == "Your PAYMENT of 20 USD was declined: INSUFFICIENT_FUNDS: x"
    alert = spark.createDataFrame([("A", "HIGH", "too big", T0)], "accountId STRING, severity STRING, description STRING, detectedAt TIMESTAMP")
    assert notify.security_alerts(alert).first().message == "Security alert [HIGH] too big. Reply NO if this was not you."
    digest = notify.digests(activity.summarize(posted(spark, ACTIVITY[:3]))).first()
    assert digest.message == ("Activity 2026-01-01T10:00:00Z - 2026-01-01T11:00:00Z: 3 transactions, in 1000.00, "
                              "out 150.00, net 850.00")


def test_recent_filters_after_the_limit(spark):
    rows = [("PUSH", "r", "A" if i < 5 else "B", f"m{i}", T0 + timedelta(seconds=i)) for i in range(10)]
    df = spark.createDataFrame(rows, "channel STRING, recipient STRING, accountId STRING, message STRING, sentAt TIMESTAMP")
    assert [r.message for r in notify.recent(df, kept=3).collect()] == ["m9", "m8", "m7"]
    assert notify.recent(df, "A", kept=3).count() == 0
    assert notify.recent(df, "A", kept=6).count() == 1


@pytest.mark.parametrize("policy, give_up, waits", [
    (ALERT_RETRY, "DEAD_LETTER", [1000, 2000, 4000]), (VALIDATION_RETRY, "DEAD_LETTER", [500, 1000, 2000]),
    (RECEIPT_RETRY, "SKIPPED", [1000, 1000, 1000])])
def test_retry_policies(spark, policy, give_up, waits):
    rows = [(i, "GatewayUnavailableException", T0) for i in range(1, 5)] + [(1, None, T0), (1, "IllegalArgumentException", T0)]
    df = spark.createDataFrame(rows, "attempt INT, error STRING, at TIMESTAMP")
    out = notify.route_attempts(df, policy, give_up=give_up).collect()
    assert [r.action for r in out] == ["RETRY"] * 3 + [give_up, "DELIVERED", give_up]
    assert [(r.nextAt - T0) / timedelta(milliseconds=1) for r in out[:3]] == waits
    assert all(r.nextAt is None for r in out[3:])


def test_prefix_commit(spark):
    rows = [(p, i, (p, i) in {(0, 4), (0, 6)}) for p in range(2) for i in range(8)]
    df = spark.createDataFrame(rows, "p INT, o BIGINT, failed BOOLEAN")
    done = {(r.p, r.o) for r in notify.commit_prefix(df, ("p",), "o", F.col("failed")).where("committed").collect()}
    assert done == {(0, i) for i in range(4)} | {(1, i) for i in range(8)}


@pytest.mark.parametrize("text, raw", [
    ('{"meta":{"amount":1.001},"amount":5.00}', "5.00"), ('{"amount":5.10,"meta":{"amount":1}}', "5.10"),
    ('{"note":"\\"amount\\": 9","amount":2.500}', "2.500"), ('{"list":[{"amount":3}],"amount":"4.0"}', "4.0"),
    ('{"amount" : 7.0 }', "7.0"), ('{"amount":1.0,"amount":2.00}', "2.00"), ('{"a":"{","amount":6.0,"b":{"amount":8}}', "6.0"),
    ('{"meta":{"amount":1.001}}', None)])
def test_written_amount_is_the_outer_one(spark, text, raw):
    from vaultflow.schemas import TRANSACTION_DDL
    rows = spark.createDataFrame([(bytearray(text.encode()),)], "value BINARY")
    assert decode.decode(rows, TRANSACTION_DDL).select("payload.amountRaw").first()[0] == raw


def test_records_under_another_key_are_set_aside(spark):
    from vaultflow.schemas import ENVELOPE_DDL, TRANSACTION_DDL
    text = '{"transactionId":"t","accountId":"A","type":"DEPOSIT","amount":1,"currency":"USD"}'
    rows = spark.createDataFrame([(k, bytearray(v.encode()) if v else None, "t", 0, i, T0, []) for i, (k, v) in
                                  enumerate([("A", text), ("B", text), ("A", "{"), ("A", None)])], ENVELOPE_DDL)
    decoded = decode.decode(rows, TRANSACTION_DDL)
    assert [(r.seq, r.timestamp) for r in decode.requests_of(decoded).collect()] == [(0, T0)]
    assert {(r.origOffset, r.errorClass) for r in decode.poison_letters(decoded).collect()} == {
        (1, "KeyMismatchException"), (2, "DeserializationException"), (3, "NullPointerException")}


def test_keyed_tables_open_one_folder(spark):
    path = new_folder(spark, "t")
    df = spark.createDataFrame([(f"k{i}", i) for i in range(200)], "k STRING, v INT")
    tables.write_keyed(df, "k", path)
    one = tables.one_key(spark, path, df.schema, "k", "k7")
    assert [tuple(r) for r in one.collect()] == [("k7", 7)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*part#\d+ = \d+", plan) and "EqualTo(k,k7)" in plan


def test_look_back_bounds_reach_the_files(spark):
    path = new_folder(spark, "t")
    posted(spark, [entry(1, "a", "A", "DEPOSIT", "1")]).write.parquet(path)
    rows = activity.look_back(spark.read.parquet(path), "A", F.lit(T0), F.expr("INTERVAL 1 HOUR"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan
