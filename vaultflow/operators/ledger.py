"""The ledger: balances per account, overdraft checks, and transfers that credit another account.

Rows are booked in sequence order. A debit that would take the balance below ``-overdraft`` is
rejected and changes nothing, so a balance is not a plain running sum. A booked transfer adds a
credit leg to its counterparty, placed right after the debit, so accounts depend on each other.

How it runs on Spark
* As long as no debit of an account is refused its balance is a running sum. The first round takes
  that from a window: rows before the first debit that would be refused are settled there, and an
  account (or slice) without one never leaves the JVM.
* The rows from there on, and chunks that a later round takes up again, are walked in ``mapInArrow``:
  rows of an account, including the credit leg of every transfer that might be booked, are shuffled and
  sorted, and the sorted stream is walked with one balance in hand. Nothing is grouped into memory.
  Only the columns the decision needs take part.
* Transfers: the first round supposes that every transfer is booked. Each later round folds again
  only the chunks whose incoming legs turned out different. The outcome of a row depends on
  earlier rows alone, so every round settles at least the earliest unsettled row; when nothing
  changes the result equals booking row by row.
* A hot account is cut into slices folded in parallel. Each slice starts from a guessed balance;
  slices whose true opening differs are folded again, in the same loop.
* The state between rounds is a written table, so a lost executor never replays earlier rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.functions import money
from vaultflow.operators.slices import WHOLE, hot_keys, with_slice
from vaultflow.schemas import LedgerRules
from vaultflow.session import new_folder, stage
from vaultflow.sources.tables import latest

# Kinds of rows in a fold: controls sort before the booking row they refer to.
_OPENING, _DEBIT_OFF, _LEG_OFF, _BOOKING = 0, 1, 2, 3
_FIRST = -(2 ** 63)

# The place of a row's record in its stream, and the record's headers.
CARRIED = ("partition", "headers")

_FOLD_COLUMNS = ("accountId", "slice", "seq", "leg", "kind", "transactionId", "cents", "currency", "target", "n")
_OUTCOME_DDL = ("accountId STRING, slice BIGINT, seq BIGINT, leg INT, target STRING, supposed BOOLEAN, "
                "outcome STRING, before BIGINT, after BIGINT, transactionId STRING, currency STRING, n BIGINT")
_SLICE_COLUMNS = ("accountId", "slice", "base", "baseCurrency", "baseLast", "baseN", "open", "openLast",
                  "openCurrency", "stale")
POSTED, REJECTED, REPEATED, ABSENT = "POSTED", "REJECTED", "REPEATED", "ABSENT"


def _folder(overdraft_cents: int):
    """Arrow function that books a stream of rows sorted by (account, slice, seq, leg, kind).

    Columns that do not change pass through as they are; the loop sees plain numbers and ids. For a
    rejected row ``after`` is the balance it would have left.
    """
    floor = -overdraft_cents
    names = pa.array([POSTED, REJECTED, REPEATED, ABSENT])

    def values(batch: pa.RecordBatch, column: str) -> list:
        return batch.column(column).to_numpy(zero_copy_only=False).tolist()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = (None, None)
        balance, currency, count, last = 0, None, 0, None
        debit_off = leg_off = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            account, part = batch.column("accountId"), batch.column("slice")
            same = pc.and_(pc.equal(account[1:], account[:-1]), pc.equal(part[1:], part[:-1]))
            starts = [chunk != (account[0].as_py(), part[0].as_py()),
                      *pc.invert(pc.fill_null(same, False)).to_numpy(zero_copy_only=False).tolist()]
            chunk = (account[-1].as_py(), part[-1].as_py())
            kinds = values(batch, "kind")
            carried = batch.column("n").to_pylist() if _OPENING in kinds else kinds
            supposed, outcomes, befores, afters, currencies, counts = [], [], [], [], [], []
            for start, kind, seq, leg, txn, amount, ccy, n in zip(
                    starts, kinds, values(batch, "seq"), values(batch, "leg"), values(batch, "transactionId"),
                    values(batch, "cents"), values(batch, "currency"), carried):
                if start:
                    balance, currency, count, last = 0, None, 0, None
                    debit_off = leg_off = None
                if kind == _BOOKING:
                    after = balance + amount
                    befores.append(balance)
                    if leg == 1 and leg_off == seq:
                        outcome = 3
                    elif txn is not None and txn == last:
                        outcome = 2
                    elif amount < 0 and after < floor:
                        outcome = 1
                    else:
                        outcome = 0
                        balance = after
                        currency = currency or ccy
                        count += 1
                        last = txn
                    outcomes.append(outcome)
                    afters.append(after)
                    supposed.append(debit_off != seq)
                    currencies.append(currency or ccy)
                    counts.append(count)
                elif kind == _OPENING:
                    balance, currency, count, last = amount, ccy, n, txn
                elif kind == _DEBIT_OFF:
                    debit_off = seq
                else:
                    leg_off = seq
            if len(outcomes) < batch.num_rows:
                batch = batch.filter(pc.equal(batch.column("kind"), _BOOKING))
            kept = [batch.column(c) for c in ("accountId", "slice", "seq", "leg", "target")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(supposed, pa.bool_()), names.take(pa.array(outcomes, pa.int32())),
                 pa.array(befores, pa.int64()), pa.array(afters, pa.int64()), batch.column("transactionId"),
                 pa.array(currencies, pa.string()), pa.array(counts, pa.int64())],
                names=["accountId", "slice", "seq", "leg", "target", "supposed", "outcome", "before", "after",
                       "transactionId", "currency", "n"])

    return fold


def _window_path(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Settle what a running balance can settle: (outcomes, rows that still have to be folded).

    ``rows`` are the booking rows and openings of a first round, where no transfer is known to be missing. A row is settled if
    no debit up to it, itself included, falls below ``floor`` (a column): then every row so far was booked, or repeats the id right
    before it. The first other row of a chunk takes along, as an opening, the state that the window left.
    """
    chunk = Window.partitionBy("accountId", "slice").orderBy("seq", "leg", "kind")
    booking = F.col("kind") == _BOOKING
    last_id = F.lag("transactionId").over(chunk)
    repeat = booking & F.coalesce(F.col("transactionId") == last_id, F.lit(False))
    marked = rows.withColumn("lastId", last_id).withColumn("repeat", repeat).withColumn(
        "moved", F.when(F.col("repeat"), F.lit(0)).otherwise(F.col("cents")).cast("bigint"))
    own = F.when(F.col("currency") != "", F.col("currency"))
    counted = F.when(~booking, F.coalesce("n", F.lit(0))).when(F.col("repeat"), 0).otherwise(1).cast("bigint")
    summed = (marked.withColumn("before", F.sum("moved").over(chunk) - F.col("moved"))
              .withColumn("stateCurrency", F.first(own, ignorenulls=True).over(chunk))
              .withColumn("stateN", F.sum(counted).over(chunk))
              .withColumn("earlierN", F.col("stateN") - counted)
              .withColumn("after", F.col("before") + F.col("cents")))
    short = booking & ~F.col("repeat") & (F.col("cents") < 0) & (F.col("after") < F.col("floor"))
    split = (summed.withColumn("short", short)
             .withColumn("shorts", F.sum(F.col("short").cast("bigint")).over(chunk))
             # the currency before this row; its own does not count yet
             .withColumn("earlierCurrency", F.lag("stateCurrency").over(chunk))
             .withColumn("clean", F.col("shorts") == 0)
             .where(booking | ~F.col("clean"))
             .select("accountId", "slice", "seq", "leg", "kind", "target", "transactionId", "cents", "currency", "repeat", "before", "after",
                     "stateCurrency", "stateN", "lastId", "earlierCurrency", "earlierN",
                     (F.col("short") & (F.col("shorts") == 1)).alias("first"), "clean"))
    path = new_folder(rows.sparkSession, "ledger-window")
    split.write.partitionBy("clean").parquet(path)
    done = rows.sparkSession.read.schema(split.schema).parquet(path)
    settled = done.where("clean").select(
        "accountId", "slice", "seq", "leg", "target", F.lit(True).alias("supposed"),
        F.when(F.col("repeat"), REPEATED).otherwise(POSTED).alias("outcome"), "before", "after", "transactionId",
        F.col("stateCurrency").alias("currency"), F.col("stateN").alias("n"))
    nothing = F.lit(None)
    row = F.struct("seq", "leg", "kind", "transactionId", "cents", "currency", "target", nothing.cast("bigint").alias("n"))
    opening = F.struct(*_control(_OPENING, F.col("lastId"), F.col("before"), F.col("earlierCurrency"), F.col("earlierN")))
    left = (done.where(~F.col("clean"))
            .select("accountId", "slice", F.explode(F.when(F.col("first"), F.array(opening, row)).otherwise(F.array(row))).alias("r"))
            .select("accountId", "slice", "r.*"))
    return settled, left


class _Book:
    """One ledger run: the narrow booking rows, and what the rounds so far have settled."""

    def __init__(self, entries: DataFrame, opening: DataFrame | None, rules: LedgerRules):
        self.rules = rules
        self.floor = -int(Decimal(rules.overdraft) * 100)
        self.fold = _folder(-self.floor)
        rows = _booking_rows(entries, rules.transfers)
        plain = stage(rows, "ledger-rows")
        _reject_ties(plain)
        self.hot = hot_keys(plain, "accountId", rules.slice_rows)
        self.rows = with_slice(plain, "accountId", "seq", self.hot, rules.slice_rows)
        self.opening = _opening_controls(opening, plain) if opening is not None else None
        self.outcomes: list[DataFrame] = []
        self.walked: list[DataFrame] = []  # of each round, the outcomes that were folded row by row
        self.refolded: list[DataFrame] = []
        self.missing: DataFrame | None = None  # transfers not booked as of the last round
        self.closings: DataFrame | None = None  # what the last fold of every slice did
        self.slices = self._guess_slices() if self.hot is not None else None

    def run(self) -> None:
        todo = None
        while True:
            self._fold_round(todo)
            todo = self._next_round(todo)
            if todo is None:
                return
            self.refolded.append(todo)

    # -- one round -------------------------------------------------------------------------------
    def _fold_round(self, todo: DataFrame | None) -> None:
        parts = [self.rows, *self._controls()]
        everything = reduce(DataFrame.unionByName, parts)
        settled = None
        if todo is None:
            settled, everything = _window_path(everything.select(*_FOLD_COLUMNS).withColumn("floor", F.lit(self.floor).cast("bigint")))
        else:
            everything = everything.join(todo, ["accountId", "slice"], "left_semi")
        order = ("accountId", "slice", "seq", "leg", "kind")
        folded = (everything.select(*_FOLD_COLUMNS).repartition("accountId", "slice")
                  .sortWithinPartitions(*order).mapInArrow(self.fold, _OUTCOME_DDL))
        self.walked.append(stage(folded, f"ledger-outcomes-{len(self.outcomes)}"))
        self.outcomes.append(self.walked[-1] if settled is None else settled.unionByName(self.walked[-1]))

    def rows_folded(self) -> list[tuple[int, int]]:
        """Of each round: rows that got an outcome, and how many of them had to be folded row by row."""
        return [(o.count(), w.count()) for o, w in zip(self.outcomes, self.walked)]

    def _controls(self) -> list[DataFrame]:
        """Opening balances and the legs known to be missing, as rows of the fold."""
        controls = []
        if self.slices is not None:
            controls.append(self.slices.select(
                "accountId", "slice",
                *_control(_OPENING, F.col("openLast"), F.col("open"), F.lit(None), F.lit(0))))
        if self.opening is not None:
            start = self.opening
            if self.hot is not None:
                start = start.join(self.hot, F.col("accountId") == F.col("_hot"), "left_anti")
            controls.append(start)
        if self.missing is not None:
            nothing = F.lit(None)
            sides = F.explode(F.array(
                F.struct(F.col("source").alias("accountId"), F.col("sourceSlice").alias("slice"),
                         *_control(_DEBIT_OFF, nothing, nothing, nothing, nothing, F.col("seq"), 0)),
                F.struct(F.col("target").alias("accountId"), F.col("targetSlice").alias("slice"),
                         *_control(_LEG_OFF, nothing, nothing, nothing, nothing, F.col("seq"), 1))))
            controls.append(self.missing.select(sides.alias("c")).select("c.*"))
        return controls

    def _next_round(self, folded: DataFrame | None) -> DataFrame | None:
        """Chunks to fold again after ``folded`` were, or None when every supposition held."""
        changed = []
        if self.rules.transfers:
            flips = self._flips()
            if not flips.isEmpty():
                self._note(flips)
                changed.append(flips.select(F.col("target").alias("accountId"), F.col("targetSlice").alias("slice")))
        if self.slices is not None:
            moved = self._move_slices(folded)
            if not moved.isEmpty():
                changed.append(moved)
        if not changed:
            return None
        # Both parts are written tables, so this small list is cheap to derive again.
        return reduce(DataFrame.unionByName, changed).distinct()

    def _flips(self) -> DataFrame:
        """Transfers whose outcome differs from what the last fold supposed."""
        booked = F.col("outcome") == POSTED
        flips = (self.outcomes[-1].where(F.col("target").isNotNull() & (booked != F.col("supposed")))
                 .select("seq", F.col("accountId").alias("source"), F.col("slice").alias("sourceSlice"),
                         "target", booked.alias("booked")))
        return stage(with_slice(flips, "target", "seq", self.hot, self.rules.slice_rows, "targetSlice"),
                     "ledger-flips")

    def _note(self, flips: DataFrame) -> None:
        """Bring the list of missing transfers up to date."""
        lost = flips.where(~F.col("booked")).drop("booked")
        if self.missing is not None:
            found = flips.where("booked").select("seq")
            lost = self.missing.join(found, "seq", "left_anti").unionByName(lost)
        self.missing = stage(lost, "ledger-missing")

    # -- slices of hot accounts ------------------------------------------------------------------
    def _first_opening(self) -> DataFrame:
        accounts = self.hot.select(F.col("_hot").alias("accountId"))
        nothing = F.lit(None).cast("string")
        if self.opening is None:
            known = accounts.select("accountId", F.lit(0).cast("bigint").alias("base"), nothing.alias("baseCurrency"),
                                    nothing.alias("baseLast"), F.lit(0).cast("bigint").alias("baseN"))
        else:
            known = self.opening.select("accountId", F.col("cents").alias("base"),
                                        F.col("currency").alias("baseCurrency"),
                                        F.col("transactionId").alias("baseLast"), F.col("n").alias("baseN"))
        zero = F.lit(0).cast("bigint")
        return (accounts.join(known, "accountId", "left")
                .withColumn("base", F.coalesce("base", zero)).withColumn("baseN", F.coalesce("baseN", zero)))

    def _guess_slices(self) -> DataFrame:
        """Opening of every slice if all its predecessors were booked in full."""
        earlier = Window.partitionBy("accountId").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        sums = (self.rows.where(F.col("slice") != WHOLE).groupBy("accountId", "slice")
                .agg(F.sum("cents").cast("bigint").alias("delta")))
        return stage(
            sums.join(F.broadcast(self._first_opening()), "accountId")
            .withColumn("open", F.col("base") + F.coalesce(F.sum("delta").over(earlier), F.lit(0)))
            .withColumn("openCurrency", F.col("baseCurrency")).withColumn("openLast", F.col("baseLast"))
            .withColumn("stale", F.lit(True))
            .select(*_SLICE_COLUMNS),
            "ledger-slices")

    def _move_slices(self, folded: DataFrame | None) -> DataFrame:
        """New openings of all slices; returns the slices that must be folded again for theirs."""
        done = F.col("outcome") == POSTED
        place = F.struct("seq", "leg")
        there = F.when(F.col("outcome") != ABSENT, place)
        closings = (self.outcomes[-1].where(F.col("slice") != WHOLE).groupBy("accountId", "slice")
                    .agg(F.max_by(F.when(done, F.col("after")), F.when(done, place)).alias("close"),
                         F.max_by(F.when(done, F.col("transactionId")), F.when(done, place)).alias("closeLast"),
                         F.min_by(F.when(done, F.col("currency")), F.when(done, place)).alias("firstCurrency"),
                         F.min_by("transactionId", there).alias("firstId"),
                         F.min_by(done, there).alias("firstPosted"),
                         F.count_if(done).alias("posted"),
                         F.min(F.when(done & (F.col("after") < F.col("before")), F.col("after"))).alias("lowest"),
                         F.max(F.when(F.col("outcome") == REJECTED, F.col("after"))).alias("short"))
                    .join(self.slices.select("accountId", "slice", F.col("open").alias("used"),
                                             F.col("openLast").alias("usedLast")), ["accountId", "slice"])
                    .withColumn("delta", F.coalesce(F.col("close") - F.col("used"), F.lit(0).cast("bigint"))))
        if folded is not None:
            kept = self.closings.join(folded, ["accountId", "slice"], "left_anti")
            closings = kept.unionByName(closings)
        self.closings = stage(closings, "ledger-closings")
        self.slices = stage(self._chain_slices(), "ledger-slices")
        return self.slices.where("stale").select("accountId", "slice")

    def _chain_slices(self) -> DataFrame:
        """Openings for the next round, and which slices are stale with theirs.

        A slice folded from another opening still stands if the shift turns no posted debit below
        the floor and no rejected one above it; only its balances move. So openings add up along
        the account as far as slices stand. Behind one that does not stand they are guesses: after
        a rejection its closing balance is taken to stay as it was.
        """
        floor = self.floor
        earlier = Window.partitionBy("accountId").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        since = Window.partitionBy("accountId", "run").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        none = F.lit(0).cast("bigint")

        def stands(opening) -> Column:
            shift = opening - F.col("used")
            return (F.coalesce(F.col("lowest") + shift >= floor, F.lit(True))
                    & F.coalesce(F.col("short") + shift < floor, F.lit(True)))

        state = (self.slices.drop("open", "openLast", "openCurrency", "stale")
                 .join(self.closings, ["accountId", "slice"])
                 .withColumn("sum", F.col("base") + F.coalesce(F.sum("delta").over(earlier), none))
                 .withColumn("forgets", F.col("short").isNotNull() & ~stands(F.col("sum"))))
        runs = (state
                .withColumn("run", F.coalesce(F.sum(F.col("forgets").cast("int")).over(earlier), F.lit(0)))
                .withColumn("anchor", F.coalesce(
                    F.last(F.when(F.col("forgets"), F.col("used") + F.col("delta")), ignorenulls=True).over(earlier),
                    F.col("base"))))
        # The slice right after a forgetting one starts its run, so changes add up from that closing.
        opened = (runs
                  .withColumn("open", F.col("anchor") + F.coalesce(F.sum("delta").over(since), none))
                  .withColumn("openLast", F.coalesce(
                      F.last("closeLast", ignorenulls=True).over(earlier), F.col("baseLast")))
                  .withColumn("openCurrency", F.coalesce(
                      F.col("baseCurrency"), F.first("firstCurrency", ignorenulls=True).over(earlier))))
        # The last id before the slice can only matter to its rows up to the first one posted.
        other_id = ~F.col("openLast").eqNullSafe(F.col("usedLast")) & F.col("firstPosted").isNotNull()
        harmless = (F.col("firstPosted") & ~F.col("firstId").eqNullSafe(F.col("openLast"))
                    & ~F.col("firstId").eqNullSafe(F.col("usedLast")))
        return opened.withColumn("stale", ~stands(F.col("open")) | (other_id & ~harmless)).select(*_SLICE_COLUMNS)

    # -- result ----------------------------------------------------------------------------------
    def settled(self) -> DataFrame:
        """Outcome rows of the last fold of every chunk."""
        if len(self.outcomes) == 1:
            return self.outcomes[0]
        tagged = [o.withColumn("round", F.lit(i)) for i, o in enumerate(self.outcomes)]
        last = (reduce(DataFrame.unionByName,
                       [r.withColumn("lastRound", F.lit(i + 1)) for i, r in enumerate(self.refolded)])
                .groupBy("accountId", "slice").agg(F.max("lastRound").alias("lastRound")))
        return (reduce(DataFrame.unionByName, tagged).join(last, ["accountId", "slice"], "left")
                .where(F.col("round") == F.coalesce("lastRound", F.lit(0))).drop("round", "lastRound"))

    def placed(self) -> DataFrame:
        """Settled rows; those of a slice get the balance, count and currency the account brought along."""
        rows = self.settled()
        if self.slices is None:
            return rows
        earlier = Window.partitionBy("accountId").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        brought = (self.closings.join(self.slices, ["accountId", "slice"])
                   .select("accountId", "slice", (F.col("open") - F.col("used")).alias("shift"), "openCurrency",
                           (F.col("baseN") + F.coalesce(F.sum("posted").over(earlier), F.lit(0))).alias("earlierN")))
        zero = F.lit(0)
        return (rows.join(brought, ["accountId", "slice"], "left")
                .withColumn("before", F.col("before") + F.coalesce("shift", zero))
                .withColumn("after", F.col("after") + F.coalesce("shift", zero))
                .withColumn("currency", F.coalesce("openCurrency", "currency"))
                .withColumn("n", F.col("n") + F.coalesce("earlierN", zero))
                .drop("shift", "openCurrency", "earlierN"))


def _control(kind: int, txn, amount, currency, n, seq=None, leg: int = -1) -> list:
    """Columns of a control row after account and slice; without a ``seq`` it sorts first."""
    seq = F.lit(_FIRST) if seq is None else seq
    return [seq.cast("bigint").alias("seq"), F.lit(leg).alias("leg"), F.lit(kind).alias("kind"),
            txn.cast("string").alias("transactionId"), F.coalesce(amount.cast("bigint"), F.lit(0)).alias("cents"),
            currency.cast("string").alias("currency"), F.lit(None).cast("string").alias("target"),
            n.cast("bigint").alias("n")]


def _booking_rows(entries: DataFrame, transfers: bool) -> DataFrame:
    """Input rows plus, for every transfer, the credit leg it would cause."""
    is_transfer = (F.col("type") == "TRANSFER") & F.col("counterpartyAccountId").isNotNull()
    target = F.when(is_transfer, F.col("counterpartyAccountId")) if transfers else F.lit(None).cast("string")
    rows = entries.select(
        "accountId", "seq", F.lit(0).alias("leg"), F.lit(_BOOKING).alias("kind"), "transactionId",
        money.cents(money.signed_amount(F.col("type"), F.col("amount"))).alias("cents"), "currency",
        target.alias("target"), F.lit(None).cast("bigint").alias("n"))
    if not transfers:
        return rows
    legs = rows.where(F.col("target").isNotNull()).select(
        F.col("target").alias("accountId"), "seq", F.lit(1).alias("leg"), "kind",
        F.concat("transactionId", F.lit("-IN")).alias("transactionId"),
        (-F.col("cents")).alias("cents"), "currency", F.lit(None).cast("string").alias("target"), "n")
    return rows.unionByName(legs)


def _reject_ties(rows: DataFrame) -> None:
    """Booking order has to be total: two entries with one ``seq`` would take each other's balances."""
    tied = (rows.where(F.col("leg") == 0).groupBy("seq").agg(F.count("*").alias("n"))
            .where((F.col("n") > 1) | F.col("seq").isNull()).limit(1).collect())
    if tied:
        raise ValueError(f"seq {tied[0]['seq']} is missing or not unique; derive it with streams.sequence from partition and offset")


def _opening_controls(opening: DataFrame, rows: DataFrame) -> DataFrame:
    """Balances carried in from earlier, for the accounts that have rows now."""
    accounts = rows.select("accountId").distinct()
    return stage(
        opening.join(accounts, "accountId", "left_semi").select(
            "accountId", F.lit(WHOLE).cast("bigint").alias("slice"),
            *_control(_OPENING, F.col("lastTransactionId"), money.cents(F.col("balance")), F.col("currency"),
                      F.col("transactionCount"))),
        "ledger-opening")


def book(entries: DataFrame, rules: LedgerRules = LedgerRules(), opening: DataFrame | None = None) -> DataFrame:
    """Book validated transactions; returns one row per posted or rejected booking, staged.

    ``entries`` has the transaction columns plus a unique ``seq``. ``opening`` holds the balances
    carried in from earlier (balance columns). The result has the transaction columns with status,
    reason and balanceAfter set, plus ``seq``, ``leg`` (1 = credit leg of a transfer),
    ``balanceBefore``, ``transactionCount`` and ``accountCurrency``. A row whose id equals the last
    one booked on its account is a repeat and leaves no trace.
    """
    run = _Book(entries, opening, rules)
    run.run()
    kept = run.placed().where(F.col("outcome").isin(POSTED, REJECTED)).select(
        "seq", "leg", "outcome", "before", "after", F.col("currency").alias("accountCurrency"),
        F.col("n").alias("booked"))
    return stage(_describe(entries.join(kept, "seq")), "ledger-postings")


def book_in_periods(entries: DataFrame, period_rows: int, rules: LedgerRules = LedgerRules()) -> DataFrame:
    """Book a long history period by period, each on the balances of the one before.

    Same result as ``book``. A period of ``period_rows`` sequence numbers needs few rounds, so most
    rows are folded once or twice however long the history is.
    """
    low, high = entries.agg(F.min("seq"), F.max("seq")).first()
    opening, parts = None, []
    for start in range(low, high + 1, period_rows):
        part = entries.where((F.col("seq") >= start) & (F.col("seq") < start + period_rows))
        postings = book(part, rules, opening)
        parts.append(postings)
        closing = balances_of(postings.where(F.col("status") == POSTED)).withColumn("period", F.lit(len(parts)))
        if opening is not None:
            closing = closing.unionByName(opening.withColumn("period", F.lit(0)))
        fields = [c for c in closing.columns if c != "period"]
        opening = stage(latest(closing, "accountId", F.struct(*fields), "period"), "ledger-closing")
    return reduce(DataFrame.unionByName, parts)


def balance_changes(posted: DataFrame) -> DataFrame:
    """One balance snapshot per posted row: the state right after it."""
    return posted.select(
        "seq", "leg", "accountId", F.col("balanceAfter").alias("balance"), F.col("accountCurrency").alias("currency"),
        "transactionCount", F.col("transactionId").alias("lastTransactionId"), F.col("timestamp").alias("updatedAt"))


def balances_of(posted: DataFrame) -> DataFrame:
    """Latest balance per account."""
    fields = ("accountId", "balance", "currency", "transactionCount", "lastTransactionId", "updatedAt")
    changes = balance_changes(posted).withColumn("_place", F.struct("seq", "leg"))
    return latest(changes, "accountId", F.struct(*fields), "_place")


def credit_legs(posted: DataFrame) -> DataFrame:
    """The credit leg each posted transfer sends to the other account: ids linked, accounts swapped."""
    return posted.where(F.col("type") == "TRANSFER").select(
        "seq", F.concat("transactionId", F.lit("-IN")).alias("transactionId"),
        F.col("counterpartyAccountId").alias("accountId"), F.lit("TRANSFER_IN").alias("type"), "amount", "currency",
        F.col("accountId").alias("counterpartyAccountId"), "channel", "country", "merchant", "timestamp",
        F.lit("VALIDATED").alias("status"))


def carried_columns(rows: DataFrame) -> list[str]:
    """Columns that a row takes along from its record, where it has them."""
    return [c for c in CARRIED if c in rows.columns]


def _describe(rows: DataFrame) -> DataFrame:
    """Turn outcomes back into full transactions; a credit leg swaps the two accounts."""
    leg = F.col("leg") == 1
    posted = F.col("outcome") == POSTED
    refusal = F.concat(F.lit("INSUFFICIENT_FUNDS: available "), money.text(money.from_cents(F.col("before"))),
                       F.lit(" "), money.text(F.col("accountCurrency")))
    # A rejected row keeps the balance it arrived with.
    kept_balance = F.col("balanceAfter").cast("decimal(38,2)")
    return rows.select(
        "seq", "leg",
        F.when(leg, F.concat("transactionId", F.lit("-IN"))).otherwise(F.col("transactionId")).alias("transactionId"),
        F.when(leg, F.col("counterpartyAccountId")).otherwise(F.col("accountId")).alias("accountId"),
        F.when(leg, F.lit("TRANSFER_IN")).otherwise(F.col("type")).alias("type"),
        "amount", "currency",
        F.when(leg, F.col("accountId")).otherwise(F.col("counterpartyAccountId")).alias("counterpartyAccountId"),
        "channel", "country", "merchant", "timestamp",
        F.col("outcome").alias("status"),
        F.when(~posted, refusal).alias("reason"),
        F.when(posted, money.from_cents(F.col("after"))).otherwise(kept_balance).alias("balanceAfter"),
        money.from_cents(F.col("before")).alias("balanceBefore"),
        F.col("booked").alias("transactionCount"), "accountCurrency", *carried_columns(rows))
