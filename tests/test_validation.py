from __future__ import annotations

import pytest
from helpers import ENTRY_DDL, T0, entry
from pyspark.sql import functions as F

from vaultflow.functions import headers, money
from vaultflow.operators import ingest, validation
from vaultflow.operators.lookups import Lookup
from vaultflow.schemas import TRANSACTION_DDL, ValidationRules
from vaultflow.sources import decode


RULES = ValidationRules(currencies=("USD", "EUR"), channel_limits={"ATM": 2000})
ACCOUNTS = [("ACC-1", "USD", "ACTIVE"), ("ACC-2", "USD", "ACTIVE"), ("ACC-EUR", "EUR", "ACTIVE"),
            ("ACC-FROZEN", "USD", "FROZEN")]


@pytest.fixture(scope="module")
def accounts(spark):
    df = spark.createDataFrame(ACCOUNTS, "accountId STRING, currency STRING, status STRING")
    return Lookup(df, "accountId")


def request(seq, account, type, amount, currency="USD", other=None, channel="ONLINE", id=None):
    row = list(entry(seq, id or f"r{seq}", account, type, "0", other, currency=currency, channel=channel))
    row[4], row[5], row[12] = None, amount, "REQUESTED"
    return tuple(row)


CASES = [
    (request(1, "ACC-1", "DEPOSIT", "100.25"), "VALIDATED", None),
    (request(2, "ACC-1", "DEPOSIT", "0"), "REJECTED", "INVALID_AMOUNT: amount must be positive"),
    (request(3, "ACC-1", "DEPOSIT", "1.001"), "REJECTED", "INVALID_AMOUNT: more than 2 decimal places"),
    (request(4, "ACC-1", "DEPOSIT", "1.100"), "REJECTED", "INVALID_AMOUNT: more than 2 decimal places"),
    (request(5, "ACC-1", "DEPOSIT", "1.10E+1"), "VALIDATED", None),
    (request(6, "ACC-1", "DEPOSIT", "1e-30"), "REJECTED", "INVALID_AMOUNT: more than 2 decimal places"),
    (request(7, "ACC-1", "DEPOSIT", "-5"), "REJECTED", "INVALID_AMOUNT: amount must be positive"),
    (request(8, "ACC-1", "DEPOSIT", "5", "JPY"), "REJECTED", "UNSUPPORTED_CURRENCY: JPY"),
    (request(9, "ACC-1", "DEPOSIT", "5", None), "REJECTED", "UNSUPPORTED_CURRENCY: null"),
    (request(10, "ACC-EUR", "DEPOSIT", "5"), "REJECTED", "CURRENCY_MISMATCH: account ACC-EUR is in EUR"),
    (request(11, "ACC-1", "WITHDRAWAL", "2500", channel="atm"), "REJECTED", "LIMIT_EXCEEDED: atm limit is 2000"),
    (request(12, "ACC-1", "WITHDRAWAL", "2000", channel="ATM"), "VALIDATED", None),
    (request(13, "ACC-1", "WITHDRAWAL", "2500", channel="BRANCH"), "VALIDATED", None),
    (request(14, "ACC-1", "WITHDRAWAL", "50000.01", channel=None), "REJECTED", "LIMIT_EXCEEDED: null limit is 50000"),
    (request(15, "ACC-1", "DEPOSIT", "9" * 45), "REJECTED", "LIMIT_EXCEEDED: ONLINE limit is 50000"),
    (request(16, "ACC-FROZEN", "PAYMENT", "5"), "REJECTED", "ACCOUNT_FROZEN: ACC-FROZEN"),
    (request(17, "ACC-404", "PAYMENT", "5"), "DEAD_LETTER", "Account ACC-404 not (yet) known"),
    (request(18, "ACC-404", "PAYMENT", "99999"), "REJECTED", "LIMIT_EXCEEDED: ONLINE limit is 50000"),
    (request(19, "ACC-1", "TRANSFER", "5", other="ACC-2"), "VALIDATED", None),
    (request(20, "ACC-1", "TRANSFER", "5", other="ACC-1"), "REJECTED",
     "INVALID_TRANSFER: counterparty must be a different account"),
    (request(21, "ACC-1", "TRANSFER", "5"), "REJECTED", "INVALID_TRANSFER: counterparty must be a different account"),
    (request(22, "ACC-1", "TRANSFER", "5", other="ACC-FROZEN"), "REJECTED",
     "COUNTERPARTY_ACCOUNT_FROZEN: ACC-FROZEN"),
    (request(23, "ACC-1", "TRANSFER", "5", other="ACC-EUR"), "REJECTED",
     "COUNTERPARTY_CURRENCY_MISMATCH: account ACC-EUR is in EUR"),
    (request(24, "ACC-1", "TRANSFER", "5", other="ACC-404"), "DEAD_LETTER", "Account ACC-404 not (yet) known"),
    (request(25, "ACC-1", "TRANSFER_IN", "5"), "REJECTED", "INVALID_TYPE: TRANSFER_IN is generated by the ledger only"),
    (request(26, "ACC-FROZEN", "TRANSFER_IN", "5"), "REJECTED", "ACCOUNT_FROZEN: ACC-FROZEN"),
    (request(27, None, "DEPOSIT", "5"), "REJECTED", "MALFORMED: accountId, type and amount are mandatory"),
    (request(28, "ACC-1", "DEPOSIT", None), "REJECTED", "MALFORMED: accountId, type and amount are mandatory"),
    (request(29, "ACC-1", None, "0"), "REJECTED", "MALFORMED: accountId, type and amount are mandatory"),
    # A counterparty on another type of transaction is not looked at.
    (request(30, "ACC-1", "PAYMENT", "5", other="ACC-404"), "VALIDATED", None),
]


@pytest.mark.parametrize("broadcast_bytes", [100000, 0])
def test_rules_in_order(spark, accounts, broadcast_bytes):
    """The same with a broadcast table and with salted keys."""
    table = Lookup(accounts.df, "accountId", broadcast_bytes=broadcast_bytes, spread_rows=3)
    rows = validation.verdicts(spark.createDataFrame([c[0] for c in CASES], ENTRY_DDL), table, RULES).collect()
    got = {r.seq: (r.outcome, r.reason) for r in rows}
    assert got == {c[0][0]: c[1:] for c in CASES}


def test_resubmission_and_dead_letters(spark, accounts):
    rows = [
        request(1, "ACC-404", "DEPOSIT", "5", id="a"),  # dead: its id is not marked
        request(2, "ACC-1", "DEPOSIT", "5", id="a"),  # processed
        request(3, "ACC-1", "DEPOSIT", "5", id="a"),  # duplicate
        request(4, "ACC-404", "DEPOSIT", "5", id="a"),  # duplicate, never looked up
        request(5, "ACC-1", "DEPOSIT", "0", id="b"),  # rejected, and that marks the id
        request(6, "ACC-1", "DEPOSIT", "5", id="b"),  # duplicate
        request(7, "ACC-404", "DEPOSIT", "5", id="c"),
        request(8, "ACC-404", "DEPOSIT", "5", id="c"),  # both dead
        request(9, "ACC-1", "DEPOSIT", "5", id="d"),
    ]
    judged = validation.verdicts(spark.createDataFrame(rows, ENTRY_DDL), accounts, RULES)
    final = {r.seq: r.outcome for r in validation.dispositions(judged).collect()}
    assert final == {1: "DEAD_LETTER", 2: "VALIDATED", 3: "DUPLICATE", 4: "DUPLICATE", 5: "REJECTED", 6: "DUPLICATE",
                     7: "DEAD_LETTER", 8: "DEAD_LETTER", 9: "VALIDATED"}
    processed = validation.first_processed(judged)
    assert sorted(r.seq for r in processed.collect()) == [2, 5, 9]
    assert [r.seq for r in validation.validated(processed).collect()] != []
    assert {r.reason for r in validation.rejected(processed).collect()} == {"INVALID_AMOUNT: amount must be positive"}


@pytest.mark.parametrize("broadcast", [True, False])
def test_only_resent_ids_are_ranked(spark, accounts, monkeypatch, broadcast):
    """The same rows as ranking all of them, with ids that come once, again, never alive, twice with one number, or are missing."""
    rows = [request(1, "ACC-404", "DEPOSIT", "5", id="a"), request(2, "ACC-1", "DEPOSIT", "5", id="a"), request(3, "ACC-1", "DEPOSIT", "5", id="a"),
            request(4, "ACC-1", "DEPOSIT", "0", id="b"), request(5, "ACC-1", "DEPOSIT", "5", id="b"), request(6, "ACC-404", "DEPOSIT", "5", id="c"),
            request(7, "ACC-1", "DEPOSIT", "5", id="d"), request(7, "ACC-1", "DEPOSIT", "5", id="d"),
            *[request(i, "ACC-1", "DEPOSIT", "5") for i in range(10, 40)]]
    nameless = [r[:1] + (None,) + r[2:] for r in (request(8, "ACC-1", "DEPOSIT", "5"), request(9, "ACC-1", "DEPOSIT", "5"))]
    requests = spark.createDataFrame(rows + nameless, ENTRY_DDL)
    judged = validation.verdicts(requests, accounts, RULES)
    want = sorted(map(tuple, validation.first_processed(judged).collect()))
    if not broadcast:
        monkeypatch.setattr(validation, "Lookup", lambda df, key: Lookup(df, key, broadcast_bytes=0))
    ranked, rank = [], validation.first_processed
    monkeypatch.setattr(validation, "first_processed", lambda df: ranked.append(df.count()) or rank(df))
    processed = validation.write_processed(judged, requests)
    assert sorted(map(tuple, processed.collect())) == want and processed.columns == judged.columns
    assert ranked == [9 if broadcast else len(rows) + 2]


def test_decoding(spark):
    good = '{"transactionId":"t1","accountId":"A","type":"DEPOSIT","amount":1.100,"currency":"USD","other":[1],' \
           '"timestamp":"2026-01-01T10:00:00.123Z"}'
    texts = [good, "{not json", '{"type":"NO_SUCH_TYPE","amount":1}', '{"amount":"abc"}', '{"amount":"12.50"}', None,
             "null", "[]", '{"amount":{"x":1}}', '{"merchant":"a\\"amount\\":9.999","amount":7}']
    records = spark.createDataFrame([(i, t.encode() if t else None) for i, t in enumerate(texts)],
                                    "offset BIGINT, value BINARY")
    rows = {r.offset: r for r in decode.decode(records, TRANSACTION_DDL, decode.TRANSACTION_ENUMS).collect()}
    assert (rows[0].payload.transactionId, rows[0].payload.amountRaw, rows[0].payload.counterpartyAccountId) == (
        "t1", "1.100", None)
    assert rows[0].payload.timestamp.microsecond == 123000
    assert [i for i, r in rows.items() if r.decodeError is not None] == [1, 2, 3, 7, 8]
    assert rows[4].payload.amountRaw == "12.50"
    assert rows[5].payload is None and rows[5].decodeError is None
    assert rows[6].payload is None and rows[6].decodeError is None
    assert rows[9].payload.amountRaw == "7"
    kept = decode.drop_undecodable(decode.decode(records, TRANSACTION_DDL, decode.TRANSACTION_ENUMS))
    assert kept.count() == 5


def test_dead_letters_keep_the_bytes(spark):
    records = spark.createDataFrame([("k", b"{not json\xff", "bank.transactions.requested", 2, 7)],
                                    "key STRING, value BINARY, topic STRING, partition INT, offset BIGINT")
    row = validation.dead_letters(records, F.lit("DeserializationException"), F.lit("x")).first()
    assert bytes(row.value) == b"{not json\xff"
    assert (row.key, row.partition, row.topic, row.origTopic, row.origPartition, row.origOffset) == (
        "k", 2, "bank.transactions.requested.DLT", "bank.transactions.requested", 2, 7)


def test_headers(spark):
    df = spark.range(1).select(headers.stamp(F.lit("c1"), F.lit("web"), F.lit("E")).alias("h"))
    row = df.select(F.transform(headers.propagate(F.col("h")), lambda x: x["key"]).alias("names"),
                    headers.last_text(F.col("h"), "x-correlation-id").alias("c"),
                    headers.last_text(F.col("h"), "nope").alias("n")).first()
    assert (row.names, row.c, row.n) == (["x-correlation-id", "x-source-system"], "c1", None)


def test_written_scale(spark):
    texts = ["1.100", "100", "1.10E+3", "1e-3", "0.0e0", "-1.5", "000.10"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = {r.t: (r.s, r.p) for r in df.select("t", money.written_scale(F.col("t")).alias("s"),
                                              money.written_positive(F.col("t")).alias("p")).collect()}
    assert got == {"1.100": (3, True), "100": (0, True), "1.10E+3": (-1, True), "1e-3": (3, True),
                   "0.0e0": (1, False), "-1.5": (1, False), "000.10": (2, True)}


def test_long_and_heavily_escaped_records_decode(spark):
    long = "m" * 1_000_000
    escaped = "\\\\\\\"" * 100_000
    texts = ['{"amount": 1.10, "merchant": "%s", "amount": 2.50}' % long,
             '{"merchant": "%s", "amount": 3.00, "x": {"amount": 9}}' % escaped,
             '{"amount": 4.0, "amount": 5, "merchant": "%s' % long,
             '{"amount": 6, "merchant": %s, "amount": 7.0}' % ('["' + '", "'.join(["a"] * 100_000) + '"]')]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select(decode.written_amount(F.col("t")).alias("a"))
    assert [r.a for r in rows.collect()][:2] == ["2.50", "3.00"] and rows.collect()[3].a == "7.0"
    records = spark.createDataFrame(
        [(None, f'{{"transactionId": "{k}", "accountId": "A1", "merchant": "{m}", "amount": 1, "amount": 2.0}}'.encode(), "t", 0, k, T0)
         for k, m in enumerate((long, escaped, "a"))],
        "key STRING, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP")
    got = decode.decode(records, TRANSACTION_DDL, decode.TRANSACTION_ENUMS).select("offset", "decodeError", "payload.amountRaw").collect()
    assert {r.offset: (r.decodeError, r.amountRaw) for r in got} == {k: (None, "2.0") for k in range(3)}


def test_email_with_very_many_host_parts(spark):
    rows = spark.createDataFrame([("a@" + "b." * 100_000 + "c",), ("a@" + "b." * 100_000,), ("a@b-.c",), ("a@b-c.d",)], "email STRING")
    assert [r.v is None for r in rows.select(ingest.email_form("email").alias("v")).collect()] == [True, False, False, True]
