from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import T0, booked, entries, entry, random_entries, replay_ledger
from pyspark.sql import functions as F

from vaultflow.operators import ledger
from vaultflow.schemas import BALANCE_DDL, LedgerRules

# Every scenario uses its own accounts, so one run books them all.
SCENARIOS = [
    # deposit, then withdrawal
    entry(1, "t1", "ACC-1", "DEPOSIT", "1000.00"),
    entry(2, "t2", "ACC-1", "WITHDRAWAL", "250.50", at=10),
    # a debit without funds
    entry(3, "n1", "ACC-2", "DEPOSIT", "100"),
    entry(4, "n2", "ACC-2", "PAYMENT", "100.01", at=1),
    # the same id twice; only the last applied id counts; a refused row leaves no id behind
    entry(5, "a", "ACC-3", "DEPOSIT", "10"), entry(6, "a", "ACC-3", "DEPOSIT", "10"),
    entry(7, "b", "ACC-3", "DEPOSIT", "10"), entry(8, "a", "ACC-3", "DEPOSIT", "10"),
    entry(9, "x", "ACC-3", "PAYMENT", "99"), entry(10, "x", "ACC-3", "PAYMENT", "99"),
    entry(11, "a", "ACC-3", "DEPOSIT", "10"),
    # a transfer credits the other account
    entry(12, "u1", "ACC-4", "DEPOSIT", "500"),
    entry(13, "u2", "ACC-4", "TRANSFER", "200", "ACC-5", at=5),
    # the credit leg comes right after its debit; a refused transfer brings none
    entry(20, "d", "A", "DEPOSIT", "50"), entry(21, "p", "A", "TRANSFER", "50", "B"),
    entry(22, "q", "B", "TRANSFER", "50", "C"), entry(23, "r", "C", "PAYMENT", "50"),
    entry(24, "s", "A", "TRANSFER", "1", "D"), entry(25, "t", "D", "PAYMENT", "1"),
    # the account's currency is that of its first booked row
    entry(30, "e", "ACC-6", "PAYMENT", "5", currency="GBP"), entry(31, "f", "ACC-6", "DEPOSIT", "5", currency="EUR"),
    entry(32, "g", "ACC-6", "PAYMENT", "9", currency="USD"),
    # the edge of zero
    entry(40, "h", "ACC-7", "DEPOSIT", "7"), entry(41, "i", "ACC-7", "PAYMENT", "7.00"),
    entry(42, "j", "ACC-7", "PAYMENT", "0.01"),
]


@pytest.fixture(scope="module")
def book(spark):
    return ledger.book(entries(spark, SCENARIOS))


@pytest.fixture(scope="module")
def rows(book):
    return {(r.seq, r.leg): r for r in book.collect()}


@pytest.fixture(scope="module")
def balances(book):
    return {r.accountId: r for r in ledger.balances_of(book.where("status = 'POSTED'")).collect()}


def statuses(rows, low, high):
    return {k: r.status for k, r in rows.items() if low <= k[0] <= high}


def test_deposit_then_withdrawal(rows, balances):
    assert [(rows[k].status, rows[k].balanceAfter, rows[k].transactionCount) for k in ((1, 0), (2, 0))] == [
        ("POSTED", Decimal("1000.00"), 1), ("POSTED", Decimal("749.50"), 2)]
    assert rows[1, 0].reason is None
    assert balances["ACC-1"].balance == Decimal("749.50")


def test_debit_without_funds_changes_nothing(rows, balances):
    refused = rows[4, 0]
    assert (refused.status, refused.reason) == ("REJECTED", "INSUFFICIENT_FUNDS: available 100.00 USD")
    assert refused.balanceAfter is None
    state = balances["ACC-2"]
    assert (state.balance, state.transactionCount, state.lastTransactionId) == (Decimal("100.00"), 1, "n1")


def test_repeats(rows):
    assert statuses(rows, 5, 11) == {(5, 0): "POSTED", (7, 0): "POSTED", (8, 0): "POSTED", (9, 0): "REJECTED",
                                     (10, 0): "REJECTED"}


def test_transfer_credits_the_other_account(rows, balances):
    leg = rows[13, 1]
    assert (leg.transactionId, leg.accountId, leg.type, leg.counterpartyAccountId, leg.status) == (
        "u2-IN", "ACC-5", "TRANSFER_IN", "ACC-4", "POSTED")
    assert leg.timestamp == rows[13, 0].timestamp
    assert (balances["ACC-4"].balance, balances["ACC-5"].balance) == (Decimal("300.00"), Decimal("200.00"))


def test_the_credit_leg_comes_right_after_its_debit(rows):
    assert statuses(rows, 20, 25) == {
        (20, 0): "POSTED", (21, 0): "POSTED", (21, 1): "POSTED", (22, 0): "POSTED", (22, 1): "POSTED",
        (23, 0): "POSTED", (24, 0): "REJECTED", (25, 0): "REJECTED"}


def test_account_currency_is_that_of_the_first_booked_row(rows):
    assert rows[30, 0].reason == "INSUFFICIENT_FUNDS: available 0.00 GBP"
    assert rows[32, 0].reason == "INSUFFICIENT_FUNDS: available 5.00 EUR"


def test_a_debit_may_reach_zero(rows):
    assert statuses(rows, 40, 42) == {(40, 0): "POSTED", (41, 0): "POSTED", (42, 0): "REJECTED"}


def test_one_snapshot_per_posted_row(book, rows):
    posted = book.where("status = 'POSTED'")
    assert ledger.balance_changes(posted).count() == sum(r.status == "POSTED" for r in rows.values())
    assert {r.transactionId for r in ledger.credit_legs(posted).collect()} == {"u2-IN", "p-IN", "q-IN"}


def test_money_is_kept(book):
    posted = book.where("status = 'POSTED'")
    credit = F.col("type").isin("DEPOSIT", "REFUND", "TRANSFER_IN")
    moved = posted.agg(F.sum(F.when(credit, F.col("amount")).otherwise(-F.col("amount")))).first()[0]
    assert moved == ledger.balances_of(posted).agg(F.sum("balance")).first()[0]


def test_overdraft_edge(spark):
    rows = [entry(1, "a", "A", "DEPOSIT", "100"), entry(2, "b", "A", "PAYMENT", "150.00"),
            entry(3, "c", "B", "DEPOSIT", "100"), entry(4, "d", "B", "PAYMENT", "150.01")]
    out = booked(ledger.book(entries(spark, rows), LedgerRules(overdraft=Decimal("50"), transfers=False)))
    assert (out[2, 0][0], out[4, 0][0]) == ("POSTED", "REJECTED")


@pytest.mark.parametrize("seed, options, rules", [
    (2, {"repeats": True}, {}),
    (3, {"repeats": True}, {"transfers": False}),
    # An account with well over a third of the rows, cut into slices.
    (5, {"hot": 0.4, "repeats": True}, {"slice_rows": 400}),
    (6, {"hot": 0.4, "rich": True}, {"slice_rows": 150}),
    (7, {"hot": 0.3}, {"slice_rows": 300, "transfers": False, "overdraft": Decimal("75.25")}),
])
def test_equals_booking_row_by_row(spark, seed, options, rules):
    rows = random_entries(seed, 500, 8, **options)
    shuffled = entries(spark, rows).repartition(5, F.xxhash64("transactionId"))
    want, _ = replay_ledger(rows, rules.get("overdraft", Decimal(0)), rules.get("transfers", True))
    assert booked(ledger.book(shuffled, LedgerRules(**rules))) == want


def test_periods_give_the_same_ledger(spark):
    """The second period opens a hot account, cut into slices, on the balance of the first."""
    rows = random_entries(9, 400, 7, hot=0.3)
    got = booked(ledger.book_in_periods(entries(spark, rows), 600, LedgerRules(slice_rows=300)))
    assert got == replay_ledger(rows)[0]


def test_tied_order_is_refused(spark):
    rows = [entry(1, "a", "A", "DEPOSIT", "10"), entry(1, "b", "B", "DEPOSIT", "20")]
    with pytest.raises(ValueError, match="seq 1 is missing or not unique"):
        ledger.book(entries(spark, rows))


def test_equal_offsets_of_two_partitions(spark):
    from vaultflow.sources import streams
    rows = [entry(7, "a", "A", "DEPOSIT", "10"), entry(7, "b", "B", "DEPOSIT", "20"), entry(8, "c", "A", "PAYMENT", "3")]
    placed = entries(spark, rows).withColumn("partition", F.when(F.col("accountId") == "A", 0).otherwise(2))
    ordered = placed.withColumn("seq", streams.sequence(F.col("partition"), F.col("seq"), 3))
    got = {(r.transactionId, r.balanceAfter, r.partition) for r in ledger.book(ordered).collect()}
    assert got == {("a", Decimal(10), 0), ("b", Decimal(20), 2), ("c", Decimal(7), 0)}


def _rich(n):
    """A account that is never short, one that is short half-way, one that starts short and then is rich, and repeats."""
    rows = []
    for k in range(n):
        rows.append(entry(10 * k, f"a{k - k % 3 % 2}", "RICH", "DEPOSIT" if k % 2 == 0 else "PAYMENT", 100 if k % 2 == 0 else 40))
        rows.append(entry(10 * k + 1, f"b{k}", "HALF", "DEPOSIT" if k < n // 2 else "WITHDRAWAL", 10 if k < n // 2 else 30))
        rows.append(entry(10 * k + 2, f"c{k}", "LATE", "WITHDRAWAL" if k < 3 else "DEPOSIT", 5))
        rows.append(entry(10 * k + 3, None, "NOID", "DEPOSIT" if k else "PAYMENT", 1))
    return rows


@pytest.mark.parametrize("overdraft, opening", [(0, False), (25, True)])
def test_accounts_that_are_never_short_are_not_folded(spark, overdraft, opening):
    rows = _rich(40)
    carried = {"HALF": Decimal("50.00"), "RICH": Decimal("-3.00")} if opening else None
    start = spark.createDataFrame([(a, b, "USD", 4, "a0" if a == "RICH" else "zz", T0) for a, b in (carried or {}).items()], BALANCE_DDL) if opening else None
    book = ledger._Book(entries(spark, rows), start, LedgerRules(overdraft=Decimal(overdraft)))
    book.run()
    assert book.walked[0].where("accountId = 'RICH'").isEmpty()
    every, folded = book.rows_folded()[0]
    assert every == len(rows) and 0 < folded < 0.6 * every
    got = {(r.seq, r.leg): (r.outcome, r.before, r.after if r.outcome == "POSTED" else None) for r in book.placed().collect() if r.outcome in ("POSTED", "REJECTED")}
    balance, last, want = dict(carried or {}), {"RICH": "a0", "HALF": "zz"} if opening else {}, {}
    for r in sorted(rows):
        seq, id, account, kind, amount = r[0], r[1], r[2], r[3], r[4]
        if id is not None and last.get(account) == id:
            continue
        before = balance.get(account, Decimal(0))
        after = before + (amount if kind == "DEPOSIT" else -amount)
        if kind != "DEPOSIT" and after < -overdraft:
            want[seq, 0] = ("REJECTED", int(before * 100), None)
            continue
        balance[account], last[account] = after, id
        want[seq, 0] = ("POSTED", int(before * 100), int(after * 100))
    assert got == want


@pytest.mark.parametrize("seed, hot, slice_rows", [(1, 0.0, 10 ** 6), (2, 0.5, 60), (3, 0.3, 10 ** 6)])
def test_window_path_and_fold_together_equal_the_replay(spark, seed, hot, slice_rows):
    rows = random_entries(seed, 400, 5, hot, repeats=True, rich=True)
    got = ledger.book(entries(spark, rows), LedgerRules(slice_rows=slice_rows))
    assert booked(got) == replay_ledger(rows)[0]
