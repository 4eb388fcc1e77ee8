"""The platform's jobs as streams.

Each job keeps its checkpoint, state and output below its own folder ``home``, so the consumers of
one stream are independent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.operators import activity, enrich, fraud, ledger, memory, validation
from vaultflow.operators.lookups import Lookup, lookup_join
from vaultflow.operators.slices import running_max_before
from vaultflow.operators.stops import spread
from vaultflow.schemas import (BALANCE_DDL, TRANSACTION_DDL, VALIDATION_RETRY, ActivityRules, FraudRules, LedgerRules,
                               RetryPolicy, ValidationRules)
from vaultflow.session import stage
from vaultflow.sources import decode, tables
from vaultflow.streaming.state import COMPACT_EVERY, StateTable, commit_batch, last_committed, read_output, run_append, run_batches, write_batch

_SEEN_DDL = "transactionId STRING, firstSeq BIGINT, seenAt TIMESTAMP"
_BURST_DDL = "burst STRING, n BIGINT, endsAt TIMESTAMP"
_MARK_DDL = "transactionId STRING, number BIGINT"
_VERSION_DDL = "accountId STRING, seq BIGINT, customerId STRING, accountType STRING, currency STRING, status STRING"
_PLACE_DDL = "accountId STRING, ts TIMESTAMP, seq BIGINT, country STRING"


# -- built on Spark's own streaming state ---------------------------------------------------------

def activity_summaries(posted: DataFrame, home: str, rules: ActivityRules = ActivityRules()) -> DataFrame:
    """Exactly one final summary per account and window, once the window and its grace have passed."""
    final = activity.summarize(posted.withWatermark("timestamp", rules.grace), rules)
    return run_append(final, f"{home}/output", f"{home}/checkpoint")


def mule_alerts(posted: DataFrame, home: str, rules: FraudRules = FraudRules(),
                grace: str = "0 seconds") -> DataFrame:
    """Stream-stream join of deposits and debits; the time range lets Spark drop what can no longer match."""
    return run_append(fraud.money_mule(posted.withWatermark("timestamp", grace), rules),
                      f"{home}/output", f"{home}/checkpoint")


def large_amount_alerts(posted: DataFrame, home: str, rules: FraudRules = FraudRules()) -> DataFrame:
    return run_append(fraud.large_amount(posted, rules), f"{home}/output", f"{home}/checkpoint")


# -- micro-batches with state in tables -----------------------------------------------------------

def book(validated: DataFrame, home: str, rules: LedgerRules = LedgerRules()) -> DataFrame:
    """Book each micro-batch on the balances the earlier ones left."""
    balances = StateTable(f"{home}/balances", "accountId")

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        accounts = (batch.select("accountId")
                    .union(batch.where(F.col("type") == "TRANSFER").select("counterpartyAccountId")).distinct())
        opening = balances.before(spark, batch_id, BALANCE_DDL, accounts)
        postings = ledger.book(batch, rules, opening)
        write_batch(postings, f"{home}/postings", batch_id)
        balances.save(spark, batch_id, BALANCE_DDL, ledger.balances_of(postings.where(F.col("status") == "POSTED")))
        commit_batch(spark, home, batch_id)

    run_batches(validated, step, f"{home}/checkpoint")
    return read_output(validated.sparkSession, f"{home}/postings", home)


def skipping(records: DataFrame) -> DataFrame:
    """Typed rows of a stream of JSON records; a record that cannot be decoded, or whose key is not its account, is skipped.

    The policy of the ledger and fraud jobs: their input was validated, so a broken record is dropped and the job goes on.
    """
    return decode.requests_of(decode.decode(records, TRANSACTION_DDL, decode.TRANSACTION_ENUMS)).drop("record")


def book_records(records: DataFrame, home: str, rules: LedgerRules = LedgerRules()) -> DataFrame:
    """``book`` on JSON records of validated transactions, broken ones skipped."""
    return book(skipping(records), home, rules)


def large_amount_records(records: DataFrame, home: str, rules: FraudRules = FraudRules()) -> DataFrame:
    """``large_amount_alerts`` on JSON records of posted transactions, broken ones skipped."""
    return large_amount_alerts(skipping(records), home, rules)


def travel_alerts(posted: DataFrame, home: str, rules: FraudRules = FraudRules(),
                  slice_rows: int = 1_000_000) -> DataFrame:
    """Compare each row with the newest location before it, in this batch or in the last-location table."""
    places = StateTable(f"{home}/places", "accountId")

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = fraud.located(batch)
        known = places.before(spark, batch_id, _PLACE_DDL, rows.select("accountId").distinct())
        carried = Lookup(stage(known, "stream-places"), "accountId")
        inside = running_max_before(rows, "accountId", "seq", fraud.location(), "_inside", slice_rows)
        looked = lookup_join(inside, carried, "accountId", "_state")
        earlier = F.when(F.col("_state").isNotNull(), F.struct("_state.ts", "_state.seq", "_state.country"))
        compared = looked.withColumn("previous", F.greatest("_inside", earlier))
        write_batch(fraud.travel_alerts(compared, "previous", rules), f"{home}/alerts", batch_id)
        newest = rows.groupBy("accountId").agg(F.max(fraud.location()).alias("place")).select("accountId", "place.*")
        places.save(spark, batch_id, _PLACE_DDL,
                    newest.unionByName(carried.df).groupBy("accountId")
                    .agg(F.max(F.struct("ts", "seq", "country")).alias("place")).select("accountId", "place.*"))

    run_batches(posted, step, f"{home}/checkpoint")
    return read_output(posted.sparkSession, f"{home}/alerts")


def velocity_alerts(posted: DataFrame, home: str, rules: FraudRules = FraudRules(), late: str = "7 days",
                    compact_every: int = COMPACT_EVERY) -> DataFrame:
    """One alert per account and window, in the micro-batch that takes its debits over the limit.

    Counts per account and window are kept in a table; a window alerts once, however its debits are spread over batches. A
    window that ended more than ``late`` before the oldest row of a micro-batch is forgotten with the next full copy of the state.
    """
    counts = StateTable(f"{home}/counts", "burst", compact_every)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        burst = F.concat_ws("~", F.unix_millis("start").cast("string"), "accountId")
        here = stage(fraud.debits_per_window(batch, rules).withColumn("burst", burst), "stream-bursts")
        before = stage(counts.before(spark, batch_id, _BURST_DDL, here.select("burst")), "stream-counted")
        rows = stage(lookup_join(here, Lookup(before, "burst"), "burst", "_state", spread_by="burst")
                     .withColumn("earlier", F.coalesce("_state.n", F.lit(0).cast("bigint"))), "stream-counts")
        crossed = rows.where((F.col("earlier") <= rules.velocity_max) & (F.col("earlier") + F.col("n") > rules.velocity_max))
        write_batch(fraud.velocity_of(crossed, rules), f"{home}/alerts", batch_id)
        oldest = batch.agg(F.min("timestamp")).first()[0]
        keep = None if oldest is None else F.col("endsAt") >= F.lit(oldest) - F.expr(f"INTERVAL {late}")
        counts.save(spark, batch_id, _BURST_DDL, rows.select("burst", (F.col("earlier") + F.col("n")).alias("n"), F.col("end").alias("endsAt")), keep)

    run_batches(posted, step, f"{home}/checkpoint")
    return read_output(posted.sparkSession, f"{home}/alerts")


def enrich_posted(posted: DataFrame, accounts: DataFrame, customers: DataFrame, home: str) -> DataFrame:
    """Join each micro-batch with the account and customer tables as they are when it is processed; they are measured once a run."""
    known, owners = Lookup(accounts, "accountId"), Lookup(customers, "customerId")

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = enrich.enrich(batch, known, owners)
        write_batch(enrich.flat(rows), f"{home}/enriched", batch_id)

    run_batches(posted, step, f"{home}/checkpoint")
    return read_output(posted.sparkSession, f"{home}/enriched")


def enrich_moving(mixed: DataFrame, customers: DataFrame, home: str, slice_rows: int = 1_000_000) -> DataFrame:
    """Join posted rows with the account table while it changes: each row with the version that was current when it arrived.

    ``mixed`` is one stream of posted rows (``fact``) and account versions (``version``), one of the two null, in the order ``seq``; a version
    comes before the facts of its place. Within a micro-batch both are merged in that order; the last version of each account is carried in state.
    """
    versions = StateTable(f"{home}/versions", "accountId")
    owners = Lookup(customers, "customerId")
    fields = ("customerId", "accountType", "currency", "status")

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = stage(batch, "stream-mixed")
        facts, changes = rows.where("fact is not null").select("fact.*"), rows.where("version is not null").select("version.*")
        touched = facts.select("accountId").unionByName(changes.select("accountId")).distinct()
        known = stage(versions.before(spark, batch_id, _VERSION_DDL, touched).select(*changes.columns), "stream-versions")
        current = tables.as_of(facts, known.unionByName(changes), "accountId", "seq", fields, "account", slice_rows).where("account is not null")
        if not owners.small:
            # read twice: owners are counted before the join
            current = stage(current, "stream-current")
        write_batch(enrich.flat(enrich.with_customer(current, owners)), f"{home}/enriched", batch_id)
        newest = tables.latest(changes, "accountId", F.struct("accountId", "seq", *fields), "seq")
        versions.save(spark, batch_id, _VERSION_DDL, newest)
        commit_batch(spark, home, batch_id)

    run_batches(mixed, step, f"{home}/checkpoint")
    return read_output(mixed.sparkSession, f"{home}/enriched", home)


class Validation:
    """Requests or their JSON records: judged, retried, de-duplicated, and set aside as dead letters.

    Requests on an account not known yet wait and are tried again with the next micro-batch; after ``policy.attempts``
    tries a request becomes a dead letter. Order per account is kept: requests behind a waiting one wait too, and so does a
    resubmission of one that waits.
    ``accounts_at(batch_id)`` gives the account table as of a micro-batch. Every micro-batch is judged once.

    Three output tables: ``settled`` has the verdict on every request, resubmissions judged like any other; ``processed`` has
    each id once, in its first validated or rejected occurrence; ``dead`` has the dead letters, as the bytes that arrived where
    the input is records. Ids are remembered for good, for ``memory`` of event time, or as the last ``memory_ids`` that were processed.
    The tables of a micro-batch become visible together, when the last of them is written.
    """

    _VERDICT = ("seq", "transactionId", "accountId", "outcome", "reason", "attempt")

    def __init__(self, accounts_at: Callable[[int], DataFrame], home: str, rules: ValidationRules = ValidationRules(),
                 policy: RetryPolicy = VALIDATION_RETRY, memory: str | None = None, memory_ids: int | None = None,
                 slice_rows: int = 1_000_000):
        self.accounts_at = accounts_at
        self.home = home
        self.rules = rules
        self.policy = policy
        self.memory = memory
        self.memory_ids = memory_ids
        self.slice_rows = slice_rows
        self.marks = StateTable(f"{home}/marks", "transactionId")
        self.seen = StateTable(f"{home}/seen", "transactionId")

    def step(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = batch.withColumn("attempt", F.lit(0))
        if batch_id > 0:
            arrived = arrived.unionByName(spark.read.schema(arrived.schema).parquet(f"{self.home}/waiting/batch_id={batch_id - 1}"))
        accounts = Lookup(self.accounts_at(batch_id), "accountId")
        # a request that lacks its id will not get one by waiting
        lost = (F.col("outcome") == validation.DEAD) & F.col("transactionId").isNotNull()
        judged = stage(validation.verdicts(arrived, accounts, self.rules).withColumn("lost", lost)
                       .withColumn("attempt", F.col("attempt") + F.col("lost").cast("int")), "stream-judged")
        held = self._held(judged)
        free = ~F.col("waits")
        settled = held.where(free).drop("waits")
        write_batch(held.where(~free).select(*arrived.columns), f"{self.home}/waiting", batch_id)
        write_batch(settled.select(*self._VERDICT), f"{self.home}/settled", batch_id)
        if self.memory_ids is None:
            self._deduplicate(settled, batch_id)
        else:
            self._deduplicate_by_number(settled, batch_id)
        commit_batch(spark, self.home, batch_id)

    def _held(self, judged: DataFrame) -> DataFrame:
        """Add ``waits``: the request is to be tried again, or comes after such a one of its account, or repeats the id of one
        that waits.

        An account stops at its first waiting request, so only an id with requests on several accounts can make another account stop.
        Those requests are written apart, narrow, and walked in order; all requests are read once before and once after.
        """
        again = F.col("lost") & (F.col("attempt") < self.policy.attempts)
        lost = judged.where(again & F.col("accountId").isNotNull() & F.col("seq").isNotNull())
        first = stage(lost.groupBy(F.col("accountId").alias("_account")).agg(F.min("seq").alias("stopAt")), "stream-stops")
        if first.isEmpty():
            return judged.withColumn("waits", F.lit(False))
        named = judged.where(F.col("accountId").isNotNull() & F.col("transactionId").isNotNull()).select("seq", "accountId", "transactionId")
        shared = (named.groupBy(F.col("transactionId").alias("_id")).agg(F.min("accountId").alias("_a"), F.max("accountId").alias("_b"))
                  .where("_a <> _b").select("_id"))
        links = named.where(F.col("seq").isNotNull()).join(shared, F.col("transactionId") == F.col("_id"), "left_semi")
        stops = spread(stage(links, "stream-links"), first, self.slice_rows)
        stopped = lookup_join(judged, Lookup(stops, "_account"), "accountId", "stop")
        return stage(stopped.withColumn("waits", F.coalesce(F.col("seq") >= F.col("stop.stopAt"), F.lit(False))).drop("stop"), "stream-held")

    def _deduplicate(self, settled: DataFrame, batch_id: int) -> None:
        spark = settled.sparkSession
        ids = settled.select("transactionId").distinct()
        remembered = self._remembered(settled)
        known = Lookup(stage(self.seen.before(spark, batch_id, _SEEN_DDL, ids).where(remembered), "stream-known"), "transactionId")
        first = validation.first_processed(settled)
        fresh = lookup_join(first, known, "transactionId", "known", "left_anti").drop("record", "lost", "attempt")
        write_batch(fresh, f"{self.home}/processed", batch_id)
        fresh = spark.read.schema(fresh.schema).parquet(f"{self.home}/processed/batch_id={batch_id}")
        dead = validation.dispositions(settled).where(F.col("outcome") == validation.DEAD)
        # a request that waited may come before the one that was processed under its id
        dead = lookup_join(dead, known, "transactionId", "known").where(~F.coalesce(F.col("known.firstSeq") < F.col("seq"), F.lit(False))).drop("known")
        self._write_dead(dead, batch_id)
        self.seen.save(spark, batch_id, _SEEN_DDL, fresh.select("transactionId", F.col("seq").alias("firstSeq"), F.col("timestamp").alias("seenAt")), keep=remembered)

    def _write_dead(self, dead: DataFrame, batch_id: int) -> None:
        if "record" in dead.columns:
            missing = F.col("reason").startswith("MISSING_ID")
            dead = validation.dead_letters(dead.select("record.*", "reason"),
                                           F.when(missing, "IllegalArgumentException").otherwise("AccountNotFoundException"), F.col("reason"))
        write_batch(dead, f"{self.home}/dead", batch_id)

    def _deduplicate_by_number(self, settled: DataFrame, batch_id: int) -> None:
        """As ``_deduplicate``, with the last ``memory_ids`` processed ids remembered; requests count in the order in which they are settled."""
        spark = settled.sparkSession
        before = 0
        if batch_id > 0:
            before = spark.read.schema("n BIGINT").parquet(f"{self.home}/marked/batch_id={batch_id - 1}").first()[0]
        alive = F.col("number") > before - self.memory_ids
        known = self.marks.before(spark, batch_id, _MARK_DDL, settled.select("transactionId").distinct()).where(alive)
        dead = F.col("outcome") == validation.DEAD
        found = memory.marked(settled.select("seq", "transactionId", dead.alias("dead")), self.memory_ids, known, before)
        fate = found.select(F.col("seq").alias("_seq"), "repeat", "mark")
        judged = stage(settled.join(fate, F.col("seq") == F.col("_seq")).drop("_seq"), "stream-marked")
        write_batch(judged.where("mark").drop("record", "lost", "attempt", "repeat", "mark"), f"{self.home}/processed", batch_id)
        self._write_dead(judged.where(dead & ~F.col("repeat")).drop("repeat", "mark"), batch_id)
        newest = found.where("mark").groupBy("transactionId").agg(F.max("number").alias("number"))
        after = before + found.where("mark").count()
        self.marks.save(spark, batch_id, _MARK_DDL, newest, keep=F.col("number") > after - self.memory_ids)
        write_batch(spark.range(1).select(F.lit(after).cast("bigint").alias("n")), f"{self.home}/marked", batch_id)

    def _remembered(self, settled: DataFrame) -> Column:
        """Which ids still count; an empty batch moves no time."""
        oldest = settled.agg(F.min("timestamp")).first()[0] if self.memory else None
        if oldest is None:
            return F.lit(True)
        return F.col("seenAt") >= F.lit(oldest) - F.expr(f"INTERVAL {self.memory}")

    def record_step(self, batch: DataFrame, batch_id: int) -> None:
        """A micro-batch of JSON records: broken ones, and those whose key is not their account, are dead letters at once."""
        decoded = stage(decode.decode(batch, TRANSACTION_DDL, decode.TRANSACTION_ENUMS), "stream-decoded")
        write_batch(decode.poison_letters(decoded), f"{self.home}/poison", batch_id)
        self.step(decode.requests_of(decoded), batch_id)

    def run(self, requests: DataFrame) -> DataFrame:
        """Work off what has arrived; requests may be left waiting."""
        run_batches(requests, self.step, f"{self.home}/checkpoint")
        return self.output(requests.sparkSession, "settled")

    def run_records(self, records: DataFrame) -> DataFrame:
        run_batches(records, self.record_step, f"{self.home}/checkpoint")
        return self.output(records.sparkSession, "settled")

    def finish(self, spark: SparkSession, records: bool = False) -> "Validation":
        """After the stream has ended for good: empty rounds until nothing waits."""
        batch_id = last_committed(spark, self.home)
        if batch_id is None:
            return self
        while not (waiting := spark.read.parquet(f"{self.home}/waiting/batch_id={batch_id}")).isEmpty():
            batch_id += 1
            self.step(waiting.drop("attempt").where("false"), batch_id)
        return self

    def output(self, spark: SparkSession, table: str) -> DataFrame:
        """``settled``, ``processed``, ``dead`` or ``poison``."""
        return read_output(spark, f"{self.home}/{table}", self.home)
