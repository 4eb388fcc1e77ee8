from __future__ import annotations

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from helpers import CREDITS, T0, entry, posted

from vaultflow.operators import fraud
from vaultflow.schemas import FraudRules


def send(rows):
    """Rows (account, type, amount, seconds, country) numbered in order of arrival."""
    return [entry(i, f"t{i}", a, k, amount, at=at, country=c) for i, (a, k, amount, at, c) in enumerate(rows, 1)]


def found(df):
    return sorted((r.accountId, r.rule, r.transactionId) for r in df.collect())


MIN = 60
# Every scenario on its own account.
SCENARIO = send([
    ("calm", "DEPOSIT", "2000", 0, "US"), ("calm", "PAYMENT", "40", 600, "US"), ("calm", "WITHDRAWAL", "100", 1200, "US"),
    ("large", "DEPOSIT", "15000", 0, "US"), ("edge", "DEPOSIT", "10000.00", 0, "US"), ("below", "REFUND", "9999.99", 0, "US"),
    *[("burst", "PAYMENT", "10", 5 * i, "US") for i in range(8)],
    *[("two-windows", "PAYMENT", "10", w * MIN + i, "US") for i in range(5) for w in (0, 1)],
    *[("credits", "DEPOSIT", "10", i, "US") for i in range(9)],
    ("jump", "PAYMENT", "20", 0, "US"), ("jump", "PAYMENT", "30", 12 * MIN, "SG"),
    ("incoming", "PAYMENT", "20", 0, "US"), ("incoming", "TRANSFER_IN", "20", MIN, "SG"),
    ("incoming", "PAYMENT", "20", 2 * MIN, "US"),
    ("slow", "PAYMENT", "20", 0, "US"), ("slow", "PAYMENT", "20", 9 * 3600, "FR"),
    ("exact-gap", "PAYMENT", "20", 0, "US"), ("exact-gap", "PAYMENT", "20", 30 * MIN, "FR"),
    ("over-gap", "PAYMENT", "20", 0, "US"), ("over-gap", "PAYMENT", "20", 30 * MIN + 0.001, "FR"),
    # The second row is older: it alerts against the first, but the first stays the last place.
    ("late", "PAYMENT", "20", 20 * MIN, "US"), ("late", "PAYMENT", "20", 0, "FR"), ("late", "PAYMENT", "20", 21 * MIN, "US"),
    ("no-country", "PAYMENT", "20", 0, "US"), ("no-country", "PAYMENT", "20", 60, None),
    ("mule", "DEPOSIT", "8000", 0, "US"), ("mule", "TRANSFER", "7900", 10 * MIN, "US"),
    ("reverse", "WITHDRAWAL", "6000", 0, "US"), ("reverse", "DEPOSIT", "8000", 5 * MIN, "US"),
    ("mule-edge", "REFUND", "5000", 0, "US"), ("mule-edge", "PAYMENT", "5000", 30 * MIN, "US"),
    ("mule-over", "DEPOSIT", "5000", 0, "US"), ("mule-over", "PAYMENT", "5000", 30 * MIN + 0.001, "US"),
    ("same-time", "DEPOSIT", "5000", 0, "US"), ("same-time", "PAYMENT", "5000", 0, "US"),
])


def test_scenarios(spark):
    alerts = fraud.all_alerts(posted(spark, SCENARIO))
    rows = {(r.accountId, r.rule): r for r in alerts.collect()}
    assert sorted(rows) == [
        ("burst", "VELOCITY"), ("edge", "LARGE_AMOUNT"), ("exact-gap", "IMPOSSIBLE_TRAVEL"),
        ("jump", "IMPOSSIBLE_TRAVEL"), ("large", "LARGE_AMOUNT"), ("late", "IMPOSSIBLE_TRAVEL"),
        ("mule", "MONEY_MULE"), ("mule-edge", "MONEY_MULE"), ("same-time", "MONEY_MULE")]
    assert alerts.count() == len(rows)
    large = rows["large", "LARGE_AMOUNT"]
    assert (large.severity, large.description) == ("HIGH", "DEPOSIT of 15000.00 USD exceeds 10000")
    burst = rows["burst", "VELOCITY"]
    assert (burst.severity, burst.transactionId) == ("MEDIUM", None)
    assert burst.description == "6 debits between 2026-01-01T10:00:00Z and 2026-01-01T10:01:00Z"
    assert burst.detectedAt == T0 + timedelta(minutes=1)
    jump = rows["jump", "IMPOSSIBLE_TRAVEL"]
    assert (jump.severity, jump.description) == ("CRITICAL", "Used in US and SG within 12 min")
    assert rows["late", "IMPOSSIBLE_TRAVEL"].description == "Used in US and FR within 20 min"
    assert rows["mule", "MONEY_MULE"].description == "Deposit of 8000.00 followed by TRANSFER of 7900.00 within 30 min"
    opened = {r.accountId for r in fraud.cases(alerts).collect()}
    assert opened == {k[0] for k in rows} - {"burst"}


def test_alert_ids_are_stable_and_distinct(spark):
    rows = send([("m", "DEPOSIT", "6000", 0, "US"), ("m", "DEPOSIT", "6000", 0, "US"), ("m", "PAYMENT", "6000", 60, "US")])
    first, second = (sorted(r.alertId for r in fraud.money_mule(posted(spark, rows)).collect()) for _ in range(2))
    assert first == second and len(set(first)) == 2


def travel_by_hand(rows, minutes=30):
    last, out = {}, []
    for r in sorted(rows, key=lambda r: r[0]):
        account, country, ts = r[2], r[9], r[11]
        if country is None or r[3] == "TRANSFER_IN":
            continue
        previous = last.get(account)
        if previous and previous[1] != country and abs(ts - previous[0]) <= timedelta(minutes=minutes):
            out.append((account, "IMPOSSIBLE_TRAVEL", r[1]))
        if previous is None or ts >= previous[0]:
            last[account] = (ts, country)
    return sorted(out)


@pytest.mark.parametrize("slice_rows", [1_000_000, 60])
def test_travel_equals_the_sequential_rule(spark, slice_rows):
    """Out-of-order times; half of the rows on one account, which the second run cuts into slices."""
    r = random.Random(4)
    rows = [entry(i, f"t{i}", "hot" if r.random() < 0.5 else f"a{r.randrange(5)}",
                  r.choice(["PAYMENT", "DEPOSIT", "TRANSFER_IN"]), "1", at=60 * (i + r.randrange(-40, 40)),
                  country=r.choice(["US", "FR", "SG", None])) for i in range(600)]
    assert found(fraud.travel(posted(spark, rows), slice_rows=slice_rows)) == travel_by_hand(rows)


def test_mule_equals_all_pairs(spark):
    r = random.Random(5)
    rows = [entry(i, f"t{i}", f"a{r.randrange(3)}", r.choice(["DEPOSIT", "REFUND", "PAYMENT", "TRANSFER"]),
                  r.choice(["4999.99", "5000", "7000"]), at=r.randrange(0, 40_000)) for i in range(400)]
    want = sorted((d[2], "MONEY_MULE", b[1]) for d in rows for b in rows
                  if d[2] == b[2] and d[3] in CREDITS and b[3] not in CREDITS
                  and min(d[4], b[4]) >= Decimal(5000) and timedelta(0) <= b[11] - d[11] <= timedelta(minutes=30))
    assert found(fraud.money_mule(posted(spark, rows))) == want and want


def test_rules_are_parameters(spark):
    rules = FraudRules(large_amount=Decimal("50"), velocity_window="1 day", velocity_max=2)
    rows = send([("v", "PAYMENT", "60", i * 3600, "US") for i in range(3)])
    assert found(fraud.velocity(posted(spark, rows), rules)) == [("v", "VELOCITY", None)]
    assert len(found(fraud.large_amount(posted(spark, rows), rules))) == 3


def test_mule_pairs_of_a_busy_bin(spark):
    """One account holds most rows of one half hour; its bin is dealt to several tasks and no pair is lost."""
    r = random.Random(8)
    rows = [entry(i, f"t{i}", "A0" if i % 5 else f"A{i % 3}", r.choice(["DEPOSIT", "PAYMENT"]), "6000", at=r.randrange(5400)) for i in range(240)]
    want = sorted((d[1], p[1]) for d in rows for p in rows if d[2] == p[2] and d[3] == "DEPOSIT" and p[3] == "PAYMENT"
                  and 0 <= (p[11] - d[11]).total_seconds() <= FraudRules().mule_minutes * 60)
    whole = fraud.money_mule(posted(spark, rows))
    split = fraud.money_mule(posted(spark, rows), spread_rows=7)
    assert sorted(x.transactionId for x in split.collect()) == sorted(p for _, p in want)
    assert sorted(x.alertId for x in split.collect()) == sorted(x.alertId for x in whole.collect())
