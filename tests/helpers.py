"""Small fixtures and sequential re-tellings of the rules."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

T0 = datetime(2026, 1, 1, 10, 0, 0)
ENTRY_DDL = """seq BIGINT, transactionId STRING, accountId STRING, type STRING, amount DECIMAL(28,2), amountRaw STRING,
    currency STRING, counterpartyAccountId STRING, channel STRING, country STRING, merchant STRING,
    timestamp TIMESTAMP, status STRING, reason STRING, balanceAfter DECIMAL(38,2)"""
CREDITS = {"DEPOSIT", "TRANSFER_IN", "REFUND"}


def entry(seq, id, account, type, amount, other=None, at=0, country="US", currency="USD", channel="ONLINE"):
    """One transaction; ``at`` is seconds after T0."""
    return (seq, id, account, type, Decimal(amount), str(amount), currency, other, channel, country, None,
            T0 + timedelta(seconds=at), "VALIDATED", None, None)


def entries(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), ENTRY_DDL)


def posted(spark: SparkSession, rows) -> DataFrame:
    """Rows as the ledger posts them."""
    from pyspark.sql import functions as F
    return entries(spark, rows).withColumn("leg", F.lit(0)).withColumn("status", F.lit("POSTED"))


def random_entries(seed: int, n: int, accounts: int, hot: float = 0.0, repeats: bool = False, rich: bool = False):
    """Random history; a share ``hot`` of the rows is on account A0."""
    r = random.Random(seed)
    rows = []
    for seq in range(n):
        account = "A0" if r.random() < hot else f"A{r.randrange(accounts)}"
        kind = r.choice(["DEPOSIT", "REFUND", "WITHDRAWAL", "PAYMENT", "TRANSFER", "TRANSFER"])
        other = f"A{(int(account[1:]) + 1 + r.randrange(accounts - 1)) % accounts}" if kind == "TRANSFER" else None
        low = 1 if not (rich and kind == "DEPOSIT") else 50_000
        id = rows[-1][1] if repeats and rows and r.random() < 0.2 else f"t{seq}"
        rows.append(entry(seq * 3, id, account, kind, Decimal(r.randrange(low, low + 20_000)) / 100, other, at=seq))
    return rows


def replay_ledger(rows, overdraft=Decimal(0), transfers=True, opening=None):
    """Book row by row: {(seq, leg): (status, before, after, count)} and the final balances."""
    balance, count, last = dict(opening or {}), {}, {}
    out = {}

    def one(seq, leg, id, account, kind, amount):
        before = balance.get(account, Decimal(0))
        if last.get(account) == id:
            return False
        signed = amount if kind in CREDITS else -amount
        if signed < 0 and before + signed < -overdraft:
            out[(seq, leg)] = ("REJECTED", before, None, count.get(account, 0))
            return False
        balance[account] = before + signed
        count[account] = count.get(account, 0) + 1
        last[account] = id
        out[(seq, leg)] = ("POSTED", before, before + signed, count[account])
        return True

    for row in sorted(rows, key=lambda x: x[0]):
        seq, id, account, kind, amount, other = row[0], row[1], row[2], row[3], row[4], row[7]
        if one(seq, 0, id, account, kind, amount) and transfers and kind == "TRANSFER" and other is not None:
            one(seq, 1, id + "-IN", other, "TRANSFER_IN", amount)
    return out, balance


def booked(df: DataFrame):
    """Ledger rows in the form of ``replay_ledger``."""
    return {(r.seq, r.leg): (r.status, r.balanceBefore, r.balanceAfter, r.transactionCount) for r in df.collect()}
