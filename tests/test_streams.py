from __future__ import annotations

import random
from decimal import Decimal

import pytest
from helpers import ENTRY_DDL, T0, booked, entries, entry, posted, random_entries, replay_ledger
from pyspark.sql import functions as F

from vaultflow.operators import stops, validation
from vaultflow.operators.lookups import Lookup
from vaultflow.schemas import BALANCE_DDL, FraudRules
from vaultflow.session import new_folder, stage
from vaultflow.streaming import jobs
from vaultflow.streaming import replay as replay_module
from vaultflow.streaming.replay import replay
from vaultflow.streaming.state import StateTable, read_output, write_batch


def test_one_final_summary_per_window(spark):
    rows = [entry(1, "a", "A", "DEPOSIT", "1000", at=60), entry(2, "b", "A", "WITHDRAWAL", "100", at=120),
            entry(3, "c", "A", "PAYMENT", "50", at=180), entry(4, "d", "A", "DEPOSIT", "1", at=66 * 60)]
    early, home = new_folder(spark, "t"), new_folder(spark, "t")
    assert replay(posted(spark, rows[:3]), "seq", lambda s: jobs.activity_summaries(s, early), 1).count() == 0
    [row] = replay(posted(spark, rows), "seq", lambda s: jobs.activity_summaries(s, home), 2).collect()
    assert (row.windowStart, row.transactionCount, row.totalCredits, row.totalDebits) == (
        T0, 3, Decimal(1000), Decimal(150))


def test_rows_later_than_the_grace_are_dropped(spark):
    rows = [entry(1, "a", "A", "DEPOSIT", "1", at=0), entry(2, "b", "A", "DEPOSIT", "1", at=64 * 60),
            # Inside the grace of the first window: still counted. The next piece moves time on.
            entry(3, "c", "A", "DEPOSIT", "1", at=59 * 60), entry(4, "d", "A", "DEPOSIT", "1", at=66 * 60),
            entry(5, "e", "A", "DEPOSIT", "1", at=30 * 60), entry(6, "f", "A", "DEPOSIT", "1", at=67 * 60)]
    home = new_folder(spark, "t")
    out = replay(posted(spark, rows), "seq", lambda s: jobs.activity_summaries(s, home), 3).collect()
    assert [(r.windowStart, r.transactionCount) for r in out] == [(T0, 2)]


def test_a_burst_in_one_batch_is_one_alert(spark):
    rows = [entry(i, f"t{i}", "A", "PAYMENT", "10", at=5 * i) for i in range(8)]
    rows.append(entry(99, "z", "B", "PAYMENT", "1", at=300))
    home = new_folder(spark, "t")
    out = replay(posted(spark, rows), "seq", lambda s: jobs.velocity_alerts(s, home), 1).collect()
    assert [(r.accountId, r.rule) for r in out] == [("A", "VELOCITY")]


def test_travel_across_batches(spark):
    from test_fraud import found, travel_by_hand
    r = random.Random(6)
    rows = [entry(i, f"t{i}", f"a{r.randrange(4)}", r.choice(["PAYMENT", "TRANSFER_IN"]), "1",
                  at=60 * (i + r.randrange(-40, 40)), country=r.choice(["US", "FR", None])) for i in range(200)]
    home = new_folder(spark, "t")
    out = replay(posted(spark, rows), "seq", lambda s: jobs.travel_alerts(s, home, FraudRules(), 20), 3)
    assert found(out) == travel_by_hand(rows)


def test_ledger_across_batches(spark):
    rows = random_entries(12, 200, 5)
    home = new_folder(spark, "t")
    out = replay(entries(spark, rows), "seq", lambda s: jobs.book(s, home), 2)
    want, balances = replay_ledger(rows)
    assert booked(out) == want
    state = StateTable(f"{home}/balances", "accountId").before(spark, 2, BALANCE_DDL)
    assert {r.accountId: r.balance for r in state.collect()} == balances


def test_state_table_replay_and_copies(spark):
    """Running a batch twice changes nothing; copies every two batches lose nothing."""
    ddl = "k STRING, v BIGINT"
    table = StateTable(new_folder(spark, "t"), "k", compact_every=2)
    for batch in (0, 1, 1, 2, 3, 4, 4):
        assert {r.k: r.v for r in table.before(spark, batch, ddl).collect()} == (
            {} if batch == 0 else {"all": batch - 1, **{f"k{i}": i for i in range(batch)}})
        table.save(spark, batch, ddl, spark.createDataFrame([("all", batch), (f"k{batch}", batch)], ddl))
    table = StateTable(new_folder(spark, "t"), "k", compact_every=2)
    for batch in range(4):
        table.save(spark, batch, ddl, spark.createDataFrame([(f"k{batch}", batch)], ddl), keep=F.col("v") >= 2)
    assert sorted(r.v for r in table.before(spark, 4, ddl).collect()) == [2, 3]


def test_output_batches_are_idempotent(spark):
    folder = new_folder(spark, "t")
    for batch in (0, 1, 1):
        write_batch(spark.range(3), folder, batch)
    assert read_output(spark, folder).count() == 6


def test_moving_accounts_are_merged_once(spark, monkeypatch):
    """With more customers than may be sent to the tasks, owners are counted over written rows, not by merging the versions again."""
    facts = posted(spark, [entry(10 * i, f"t{i}", f"A{i % 3}", "DEPOSIT", "5", at=i) for i in range(1, 7)])
    versions = [("A0", 0, "C0", "CHECKING", "USD", "ACTIVE"), ("A1", 0, "C1", "CHECKING", "USD", "ACTIVE"), ("A1", 50, "C2", "SAVINGS", "USD", "ACTIVE")]
    changes = spark.createDataFrame(versions, "accountId STRING, seq BIGINT, customerId STRING, accountType STRING, currency STRING, status STRING")
    customers = spark.createDataFrame([("C0", "Ann", "a@x", "GOLD"), ("C2", "Bo", "b@x", "STANDARD")], "customerId STRING, fullName STRING, email STRING, tier STRING")
    mixed = facts.select("seq", F.struct("*").alias("fact")).unionByName(changes.select("seq", F.struct("*").alias("version")), allowMissingColumns=True)
    merged, join = [], jobs.enrich.with_customer

    def with_customer(rows, owners):
        merged.append("Window" in rows._jdf.queryExecution().optimizedPlan().toString())
        return join(rows, owners)

    monkeypatch.setattr(jobs.enrich, "with_customer", with_customer)
    got = []
    for size in (1 << 20, 0):
        monkeypatch.setattr(jobs, "Lookup", lambda df, key: Lookup(df, key, broadcast_bytes=size))
        home = new_folder(spark, "t")
        rows = replay(mixed, "seq", lambda stream: jobs.enrich_moving(stream, customers, home), 2)
        got.append(sorted((r.seq, r.customerId, r.accountType, r.customerName) for r in rows.collect()))
    assert got[0] == got[1] == [(10, "C1", "CHECKING", None), (30, "C0", "CHECKING", "Ann"), (40, "C1", "CHECKING", None), (60, "C0", "CHECKING", "Ann")]
    assert merged == [True, True, False, False]


def test_resubmissions_across_batches(spark):
    def request(seq, id, account="A", amount="5"):
        row = list(entry(seq, id, account, "DEPOSIT", "0", at=seq))
        row[4], row[5] = None, amount
        return tuple(row)

    rows = [request(0, "x", "GHOST"), request(1, "x"), request(2, "y", amount="0"), request(10, "x"), request(11, "y"),
            request(12, "x", "GHOST"), request(13, "z", "GHOST"), request(20, "z"), request(21, "w")]
    accounts = spark.createDataFrame([("A", "USD", "ACTIVE")], "accountId STRING, currency STRING, status STRING")
    df = spark.createDataFrame(rows, ENTRY_DDL)
    home = new_folder(spark, "t")
    job = jobs.Validation(lambda _: accounts, home)
    replay(df, "seq", job.run, 2)
    out = job.finish(spark).output(spark, "processed")
    batch = validation.first_processed(validation.verdicts(df, Lookup(accounts, "accountId")))
    want = {(1, "VALIDATED"), (2, "REJECTED"), (20, "VALIDATED"), (21, "VALIDATED")}
    assert {(r.seq, r.outcome) for r in out.collect()} == want == {(r.seq, r.outcome) for r in batch.collect()}
    assert sorted(r.seq for r in read_output(spark, f"{home}/dead").collect()) == [0, 13]


def test_waiting_requests_keep_their_order(spark):
    """B becomes known with the second batch; GHOST never does and is given up after four tries."""
    def request(seq, account):
        row = list(entry(seq, f"t{seq}", account, "DEPOSIT", "0", at=seq))
        row[4], row[5] = None, "5"
        return tuple(row)

    rows = [request(0, "A"), request(1, "B"), request(2, "GHOST"), request(3, "B"), request(10, "B"), request(11, "A")]
    known = spark.createDataFrame([("A", "USD", "ACTIVE"), ("B", "USD", "ACTIVE")],
                                  "accountId STRING, currency STRING, status STRING")
    home = new_folder(spark, "t")
    job = jobs.Validation(lambda batch: known if batch > 0 else known.where("accountId = 'A'"), home)
    df = spark.createDataFrame(rows, ENTRY_DDL)
    first = {r.seq for r in replay(df.where("seq < 10"), "seq", job.run, 1).collect()}
    assert first == {0}
    home2 = new_folder(spark, "t")
    job = jobs.Validation(lambda batch: known if batch > 0 else known.where("accountId = 'A'"), home2)
    replay(df, "seq", job.run, 2)
    out = {r.seq: (r.batch_id, r.outcome, r.attempt) for r in job.finish(spark).output(spark, "settled").collect()}
    assert out == {0: (0, "VALIDATED", 0), 1: (1, "VALIDATED", 1), 3: (1, "VALIDATED", 1), 10: (1, "VALIDATED", 0),
                   11: (1, "VALIDATED", 0), 2: (3, "DEAD_LETTER", 4)}


@pytest.mark.parametrize("seed, accounts, ids", [(1, 4, 30), (2, 12, 12), (3, 40, 25)])
def test_what_waits_equals_a_walk_in_order(spark, seed, accounts, ids):
    """Stops reach other accounts through repeated ids, over any number of accounts."""
    r = random.Random(seed)
    rows = [(seq, r.choice([None, *(f"t{k}" for k in range(ids))]), r.choice([None, *(f"a{k}" for k in range(accounts))]), r.random() < 0.03, r.choice([1, 4]))
            for seq in range(150)]
    rows += [(1000 + k, f"chain{(k + 1) // 2}", f"c{k // 2}", k == 0, 1) for k in range(14)]
    job = jobs.Validation(lambda _: None, new_folder(spark, "t"))
    held = job._held(spark.createDataFrame(rows, "seq BIGINT, transactionId STRING, accountId STRING, lost BOOLEAN, attempt INT"))
    stopped, waiting, want = set(), set(), set()
    for seq, id, account, lost, attempt in rows:
        if account is not None and (lost and attempt < job.policy.attempts or account in stopped or id in waiting):
            want.add(seq)
            stopped.add(account)
            waiting |= {id} - {None}
    assert {x.seq for x in held.where("waits").collect()} == want and held.count() == len(rows)
    assert {1000 + k for k in range(14)} <= want


@pytest.mark.parametrize("slice_rows", [10 ** 6, 40, 7])
def test_stops_spread_in_few_rounds(spark, monkeypatch, slice_rows):
    """A chain over 30 accounts, ids in any order, two rows in one place: as a walk in order, and a round sees more than one link of it."""
    r = random.Random(slice_rows)
    links = [(2 * k + 5, f"a{(k + 1) // 2}", f"t{k // 2}") for k in range(60)]
    links += [(r.randrange(300), f"b{r.randrange(30)}", f"u{r.randrange(60)}") for _ in range(300)]
    first = {"a0": 3, "b1": 20, "b2": 100}
    rounds = []
    monkeypatch.setattr(stops, "stage", lambda df, label: (rounds.append(label), stage(df, label))[1])
    got = {x["_account"]: x.stopAt for x in stops.spread(
        spark.createDataFrame(links, "seq BIGINT, accountId STRING, transactionId STRING"),
        spark.createDataFrame(list(first.items()), "_account STRING, stopAt BIGINT"), slice_rows).collect()}
    want, since, moved = dict(first), {}, True
    while moved:
        moved = False
        for seq, account, id in links:
            if seq >= want.get(account, seq + 1) or seq > since.get(id, seq):
                moved |= want.get(account, seq + 1) > seq or since.get(id, seq + 1) > seq
                want[account], since[id] = min(want.get(account, seq), seq), min(since.get(id, seq), seq)
    assert got == want and len(want) > 30
    assert rounds.count("stream-met") <= {10 ** 6: 1, 40: 10, 7: 25}[slice_rows]


def test_a_piece_of_a_table_in_one_file_is_read_by_several_tasks(spark, monkeypatch):
    files = []
    monkeypatch.setattr(replay_module, "file_stream", lambda s, folder, schema: s.read.schema(schema).parquet(folder))
    out = replay(spark.range(300_000).coalesce(1), "id", lambda df: (files.append(len(df.inputFiles())), df)[1], 3)
    assert files == [2, 4, 6] and out.agg(F.count("*"), F.countDistinct("id")).first()[:] == (300_000, 300_000)


def test_a_batch_of_dead_letters_stops_nothing(spark):
    """Valid, then only dead letters, then a resubmission and rows without an id."""
    def request(seq, id, account):
        row = list(entry(seq, id, account, "DEPOSIT", "0", at=seq))
        row[4], row[5] = None, "5"
        return tuple(row)

    rows = [request(0, "x", "A"), request(10, "g", "GHOST"), request(20, "x", "A"), request(21, None, "A"), request(22, None, "A"), request(25, "g", "A")]
    accounts = spark.createDataFrame([("A", "USD", "ACTIVE")], "accountId STRING, currency STRING, status STRING")
    df = spark.createDataFrame(rows, ENTRY_DDL)
    for memory in (None, "1 day"):
        job = jobs.Validation(lambda _: accounts, new_folder(spark, "t"), memory=memory)
        replay(df, "seq", job.run, 3)
        job.finish(spark)
        assert sorted(r.seq for r in job.output(spark, "processed").collect()) == [0, 25]
        assert sorted(r.seq for r in job.output(spark, "dead").collect()) == [10, 21, 22]
    batch = validation.verdicts(df, Lookup(accounts, "accountId"))
    assert sorted(r.seq for r in validation.first_processed(batch).collect()) == [0, 25]
    assert sorted(r.seq for r in validation.dispositions(batch).where("outcome = 'DEAD_LETTER'").collect()) == [10, 21, 22]


def test_a_burst_over_batches_alerts_at_the_crossing(spark):
    rows = [entry(i, f"t{i}", "A", "PAYMENT", "10", at=i) for i in range(9)]
    home = new_folder(spark, "t")
    out = replay(posted(spark, rows), "seq", lambda s: jobs.velocity_alerts(s, home), 3).collect()
    assert [(r.accountId, r.batch_id) for r in out] == [("A", 1)]


def test_state_opens_only_the_folders_of_its_keys(spark):
    table = StateTable(new_folder(spark, "t"), "k")
    ddl = "k STRING, v BIGINT"
    table.save(spark, 0, ddl, spark.createDataFrame([(f"k{i}", i) for i in range(100)], ddl))
    some = table.before(spark, 1, ddl, spark.createDataFrame([("k5",), ("new",)], "k STRING"))
    assert [tuple(r) for r in some.collect()] == [("k5", 5)]
    assert "part#" in some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
