"""Fraud rules over posted transactions; each returns rows of the alert schema.

Rule names, severities and description texts are fixed values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.functions import money, times
from vaultflow.functions.money import text
from vaultflow.operators.lookups import SPREAD_ROWS, hot_table, with_copies, with_salt
from vaultflow.operators.slices import running_max_before
from vaultflow.schemas import CASE_SEVERITIES, FraudRules

ALERT = ("alertId", "accountId", "transactionId", "rule", "severity", "description", "detectedAt")


def alerts_of(rows: DataFrame, rule: str, severity: str, description: Column, at: Column,
              transaction: Column | None = None, also: tuple[Column, ...] = ()) -> DataFrame:
    """Alert columns. The id is a hash of what raised the alert, so a replay raises the same one."""
    transaction = F.lit(None).cast("string") if transaction is None else transaction
    parts = [F.lit(rule), F.col("accountId"), F.coalesce(transaction, F.lit("")),
             F.unix_millis(at).cast("string"), *also]
    return rows.select(
        F.sha2(F.concat_ws("~", *parts), 256).alias("alertId"), "accountId", transaction.alias("transactionId"),
        F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), description.alias("description"),
        at.alias("detectedAt"))


def large_amount(posted: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """Any posted transaction, credits included, at or above the threshold."""
    big = posted.where(F.col("amount") >= F.lit(rules.large_amount))
    words = F.concat(F.col("type"), F.lit(" of "), text(F.col("amount")), F.lit(" "), text(F.col("currency")),
                     F.lit(f" exceeds {rules.large_amount}"))
    return alerts_of(big, "LARGE_AMOUNT", "HIGH", words, F.col("timestamp"), F.col("transactionId"))


def debits_per_window(posted: DataFrame, rules: FraudRules) -> DataFrame:
    """(accountId, start, end, n): debits of each account and window."""
    return (posted.where(~money.is_credit(F.col("type")))
            .groupBy("accountId", F.window("timestamp", rules.velocity_window).alias("w")).agg(F.count("*").alias("n"))
            .select("accountId", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n"))


def velocity_of(windows: DataFrame, rules: FraudRules) -> DataFrame:
    words = F.concat(F.lit(f"{rules.velocity_max + 1} debits between "), times.iso(F.col("start")), F.lit(" and "),
                     times.iso(F.col("end")))
    return alerts_of(windows, "VELOCITY", "MEDIUM", words, F.col("end"))


def velocity(posted: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """One alert per account and window with more than the allowed number of debits."""
    return velocity_of(debits_per_window(posted, rules).where(F.col("n") > rules.velocity_max), rules)


def located(posted: DataFrame) -> DataFrame:
    """Rows with a country of the account's own; that of a credit leg belongs to whoever paid."""
    return posted.where(F.col("country").isNotNull() & (F.col("type") != "TRANSFER_IN"))


def travel_alerts(rows: DataFrame, previous: str, rules: FraudRules) -> DataFrame:
    """Alerts for rows whose ``previous`` location (ts, seq, country) is another country too recently."""
    gap = times.gap_millis(F.col(f"{previous}.ts"), F.col("timestamp"))
    jumped = rows.where((F.col(f"{previous}.country") != F.col("country")) & (gap <= rules.travel_minutes * 60_000))
    words = F.concat(F.lit("Used in "), F.col(f"{previous}.country"), F.lit(" and "), F.col("country"),
                     F.lit(" within "), F.floor(gap / 60_000).cast("string"), F.lit(" min"))
    return alerts_of(jumped, "IMPOSSIBLE_TRAVEL", "CRITICAL", words, F.col("timestamp"), F.col("transactionId"))


def location() -> Column:
    """A location that compares by time, then arrival: the newest wins, older arrivals do not replace it."""
    return F.struct(F.col("timestamp").alias("ts"), F.col("seq").alias("seq"), F.col("country").alias("country"))


def travel(posted: DataFrame, rules: FraudRules = FraudRules(), slice_rows: int = 1_000_000) -> DataFrame:
    """Two countries within the time limit, compared with the newest location seen before."""
    rows = running_max_before(located(posted), "accountId", "seq", location(), "previous", slice_rows)
    return travel_alerts(rows, "previous", rules)


def mule_sides(posted: DataFrame, rules: FraudRules) -> tuple[DataFrame, DataFrame]:
    large = posted.where(F.col("amount") >= F.lit(rules.mule_amount))
    credit = money.is_credit(F.col("type"))
    deposits = large.where(credit).select(
        F.col("accountId").alias("d_account"), F.col("transactionId").alias("d_id"),
        F.col("amount").alias("d_amount"), F.col("timestamp").alias("d_ts"))
    debits = large.where(~credit).select("accountId", "transactionId", "type", "amount", "timestamp")
    return deposits, debits


def mule_alerts(pairs: DataFrame, rules: FraudRules) -> DataFrame:
    words = F.concat(F.lit("Deposit of "), text(F.col("d_amount")), F.lit(" followed by "), F.col("type"),
                     F.lit(" of "), text(F.col("amount")), F.lit(f" within {rules.mule_minutes} min"))
    return alerts_of(pairs, "MONEY_MULE", "HIGH", words, F.col("timestamp"), F.col("transactionId"),
                     (F.col("d_id"),))


def money_mule(posted: DataFrame, rules: FraudRules = FraudRules(), spread_rows: int = SPREAD_ROWS) -> DataFrame:
    """A large deposit, then a large debit of the same account within the limit; one alert per pair.

    The join key is (account, time bin) with bins as long as the limit: a debit meets deposits of
    its own bin and the one before. A busy account spreads over its bins, and in a table the debits of a bin with more
    than ``spread_rows`` of them over several tasks, each with its own copy of the bin's deposits.
    """
    deposits, debits = mule_sides(posted, rules)
    span = rules.mule_minutes * 60_000

    def bin_of(ts: str) -> Column:
        return F.floor(F.unix_millis(F.col(ts)) / span)

    deposits = deposits.withColumn("d_bin", F.explode(F.array(bin_of("d_ts"), bin_of("d_ts") + 1)))
    debits = debits.withColumn("bin", bin_of("timestamp"))
    same = (F.col("accountId") == F.col("d_account")) & (F.col("bin") == F.col("d_bin"))
    if not posted.isStreaming:
        keys, names = [F.col("accountId"), F.col("bin")], ["_hotAccount", "_hotBin"]
        hot = hot_table(debits, keys, names, spread_rows)
        debits = with_salt(debits, keys, hot, names, F.col("transactionId"))
        deposits = with_copies(deposits, [F.col("d_account"), F.col("d_bin")], hot, names)
        same = same & (F.col("_salt") == F.col("_copy"))
    # Plain comparisons of the two event times: a stream-stream join derives its state bound from them.
    latest = F.col("d_ts") + F.expr(f"INTERVAL {rules.mule_minutes} MINUTES")
    pairs = debits.join(deposits, same & (F.col("timestamp") >= F.col("d_ts")) & (F.col("timestamp") <= latest))
    return mule_alerts(pairs, rules)


def merge(*alerts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [a.select(*ALERT) for a in alerts])


def all_alerts(posted: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    return merge(large_amount(posted, rules), velocity(posted, rules), travel(posted, rules), money_mule(posted, rules))


def cases(alerts: DataFrame) -> DataFrame:
    """Alerts grave enough to open a case."""
    return alerts.where(F.col("severity").isin(*CASE_SEVERITIES))
