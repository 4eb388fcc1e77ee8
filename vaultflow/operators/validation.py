"""Business rules on transaction requests, resubmissions, and routing by outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.functions import headers, money
from vaultflow.functions.money import text
from vaultflow.operators.lookups import Lookup, lookup_join
from vaultflow.schemas import DEAD_LETTER_SUFFIX, ValidationRules
from vaultflow.session import stage

VALIDATED, REJECTED, DEAD, DUPLICATE = "VALIDATED", "REJECTED", "DEAD_LETTER", "DUPLICATE"


def channel_limit(channel: Column, rules: ValidationRules) -> Column:
    given, limit = F.upper(channel), F
    for name, most in rules.channel_limits.items():
        limit = limit.when(given == name, most)
    return F.lit(rules.default_limit) if limit is F else limit.otherwise(rules.default_limit)


def _first_match(cases: list[tuple[Column, object]]) -> Column:
    chosen = F
    for condition, result in cases:
        chosen = chosen.when(condition, result)
    return chosen


def verdicts(requests: DataFrame, accounts: Lookup, rules: ValidationRules = ValidationRules()) -> DataFrame:
    """Add ``outcome`` (VALIDATED, REJECTED or DEAD_LETTER), ``reason`` and ``amount``.

    The first failing rule decides. A request without a transaction id cannot be told from its own resubmission and is
    set aside as a dead letter before any other rule. Rules on the request alone come before any account is looked
    up; an unknown account is a technical error, not a rejection. The rules first give a number,
    the text follows from it: small expressions in separate steps stay within what the JVM compiles.
    """
    raw, currency, channel = F.col("amountRaw"), F.col("currency"), F.col("channel")
    transfer = F.col("type") == "TRANSFER"
    own = (requests.drop("outcome", "reason", "amount")
           .withColumn("amount", money.parse_amount(raw))
           .withColumn("_limit", channel_limit(channel, rules))
           .withColumn("_other", F.when(transfer, F.col("counterpartyAccountId"))))
    # A number too long for the amount type is above every limit.
    alone = own.withColumn("_alone", _first_match([
        (F.col("transactionId").isNull(), 14),
        (F.col("accountId").isNull() | F.col("type").isNull() | raw.isNull(), 1),
        (~money.written_positive(raw), 2),
        (money.written_scale(raw) > 2, 3),
        (~F.coalesce(currency.isin(*rules.currencies), F.lit(False)), 4),
        (F.col("amount").isNull() | (F.col("amount") > F.col("_limit")), 5),
    ]))
    # Null tests are done once per account here, not once per request below.
    needed = accounts.only(F.when(~F.col("status").eqNullSafe("ACTIVE"), text(F.col("status"))).alias("blocked"),
                           text(F.col("currency")).alias("currency"))
    facts = _with_accounts(alone, needed)
    judged = facts.withColumn("_rule", F.coalesce("_alone", _first_match([
        (F.col("_account").isNull(), 6),
        (F.col("_account.blocked").isNotNull(), 7),
        (F.col("_account.currency") != currency, 8),
        (transfer & (F.col("_other").isNull() | (F.col("_other") == F.col("accountId"))), 9),
        (transfer & F.col("_counter").isNull(), 10),
        (transfer & F.col("_counter.blocked").isNotNull(), 11),
        (transfer & (F.col("_counter.currency") != currency), 12),
        (F.col("type") == "TRANSFER_IN", 13),
    ])))

    first, second = F.col("accountId"), F.col("_other")
    # The reason texts. Per rule: text, value, text, value.
    messages = [
        ("MALFORMED: accountId, type and amount are mandatory",),
        ("INVALID_AMOUNT: amount must be positive",),
        ("INVALID_AMOUNT: more than 2 decimal places",),
        ("UNSUPPORTED_CURRENCY: ", currency),
        ("LIMIT_EXCEEDED: ", channel, " limit is ", F.col("_limit").cast("string")),
        ("Account ", first, " not (yet) known"),
        ("ACCOUNT_", F.col("_account.blocked"), ": ", first),
        ("CURRENCY_MISMATCH: account ", first, " is in ", F.col("_account.currency")),
        ("INVALID_TRANSFER: counterparty must be a different account",),
        ("Account ", second, " not (yet) known"),
        ("COUNTERPARTY_ACCOUNT_", F.col("_counter.blocked"), ": ", second),
        ("COUNTERPARTY_CURRENCY_MISMATCH: account ", second, " is in ", F.col("_counter.currency")),
        ("INVALID_TYPE: TRANSFER_IN is generated by the ledger only",),
        ("MISSING_ID: transactionId is mandatory",),
    ]
    rule = F.col("_rule")
    outcome = F.when(rule.isNull(), VALIDATED).when(rule.isin(6, 10, 14), DEAD).otherwise(REJECTED)
    return (judged.withColumn("outcome", outcome).withColumn("reason", _message(rule, messages))
            .drop("_alone", "_limit", "_other", "_account", "_counter", "_rule"))


def _with_accounts(alone: DataFrame, accounts: Lookup) -> DataFrame:
    """Add ``_account`` and ``_counter``. Where accounts are too many to be sent to the tasks, a request moves only for what its verdict still needs:
    not at all if a rule on the request alone has decided, and once unless it names another account.
    """
    if accounts.small:
        return lookup_join(lookup_join(alone, accounts, "accountId", "_account"), accounts, "_other", "_counter")
    nothing = F.lit(None).cast(accounts.df.schema)
    open_ = F.col("_alone").isNull()
    decided = alone.where(~open_).withColumns({"_account": nothing, "_counter": nothing})
    # keys are counted over all requests, which needs none of the rules
    plain = lookup_join(alone.where(open_ & F.col("_other").isNull()), accounts, "accountId", "_account", counted=alone).withColumn("_counter", nothing)
    named = lookup_join(alone.where(open_ & F.col("_other").isNotNull()), accounts, "accountId", "_account", counted=alone)
    return decided.unionByName(plain).unionByName(lookup_join(named, accounts, "_other", "_counter", counted=alone))


def _message(rule: Column, messages: list[tuple]) -> Column:
    """Message number ``rule``. Its texts come from constant arrays, which keeps the expression small."""
    parts = []
    for place in range(4):
        given = [(i + 1, m[place]) for i, m in enumerate(messages) if len(m) > place]
        if place % 2 == 0:
            words = dict(given)
            parts.append(F.element_at(F.array(*[F.lit(words.get(i + 1, "")) for i in range(len(messages))]), rule))
        else:
            value = _first_match([(rule == i, text(column)) for i, column in given])
            parts.append(value.otherwise(""))
    return F.when(rule.isNotNull(), F.concat(*parts))


def first_processed(judged: DataFrame) -> DataFrame:
    """Validated and rejected requests, each transaction id once, in its first occurrence.

    Dead letters do not count as processed: they rank last and leave at the end. The ranking filter
    lets Spark keep one row per id on every map task, so an id sent very often does not pile up in
    one reducer.
    """
    dead = F.col("outcome") == DEAD
    first = Window.partitionBy("transactionId").orderBy(dead, "seq")
    return (judged.withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1).drop("_n")
            .where(~dead))


def write_processed(judged: DataFrame, requests: DataFrame) -> DataFrame:
    """``first_processed`` of the verdicts on ``requests``, written.

    Ids are counted in the requests, over one narrow column. A row whose id comes once is written where it was judged; only rows
    whose id comes again, or is missing, are moved and ranked. Resent ids too many to be sent to the tasks are ranked with all others.
    """
    sent = requests.groupBy("transactionId").agg(F.count("*").alias("n")).where("n > 1 and transactionId is not null")
    again = Lookup(stage(sent.select("transactionId"), "resent-ids"), "transactionId")
    if not again.small:
        return stage(first_processed(judged), "processed")
    ranked = F.col("_sent").isNotNull() | F.col("transactionId").isNull()
    written = stage(lookup_join(judged, again, "transactionId", "_sent").withColumn("_ranked", ranked).drop("_sent"), "judged")
    first = stage(first_processed(written.where("_ranked").drop("_ranked")), "processed")
    # dead letters leave here, from the file: above the joins, a filter would work out every rule again
    return written.where(~F.col("_ranked") & (F.col("outcome") != DEAD)).drop("_ranked").unionByName(first)


def dispositions(judged: DataFrame) -> DataFrame:
    """Every request with its final ``outcome``, resubmissions marked DUPLICATE.

    A request is a duplicate when an earlier one with its id was validated or rejected, whatever
    its own verdict would have been. Only ids seen more than once are looked up.
    """
    seen = (judged.groupBy("transactionId")
            .agg(F.count("*").alias("n"), F.min(F.when(F.col("outcome") != DEAD, F.col("seq"))).alias("firstSeq"))
            .where(F.col("n") > 1))
    resent = Lookup(stage(seen.where("transactionId is not null"), "resent-ids"), "transactionId")
    rows = lookup_join(judged, resent, "transactionId", "resent")
    repeat = F.coalesce(F.col("seq") > F.col("resent.firstSeq"), F.lit(False))
    return (rows.withColumn("outcome", F.when(repeat, F.lit(DUPLICATE)).otherwise(F.col("outcome")))
            .withColumn("reason", F.when(~repeat, F.col("reason"))).drop("resent"))


def validated(processed: DataFrame) -> DataFrame:
    """Valid requests as ledger input: status VALIDATED, no reason, no balance."""
    return _as_transaction(processed.where(F.col("outcome") == VALIDATED), VALIDATED)


def rejected(processed: DataFrame) -> DataFrame:
    return _as_transaction(processed.where(F.col("outcome") == REJECTED), REJECTED)


def _as_transaction(rows: DataFrame, status: str) -> DataFrame:
    return rows.select(
        "seq", "transactionId", "accountId", "type", "amount", "amountRaw", "currency", "counterpartyAccountId",
        "channel", "country", "merchant", "timestamp", F.lit(status).alias("status"), "reason",
        F.lit(None).cast("decimal(38,2)").alias("balanceAfter"), *[c for c in ("partition", "headers") if c in rows.columns])


def unknown_accounts(requests: DataFrame, accounts: Lookup) -> DataFrame:
    """Requests whose account is in no change log."""
    return lookup_join(requests, accounts, "accountId", "account", "left_anti")


def dead_letters(records: DataFrame, error: Column, message: Column) -> DataFrame:
    """Records set aside: bytes untouched, same key and partition, and where they came from."""
    return records.select(
        "key", "value", F.concat("topic", F.lit(DEAD_LETTER_SUFFIX)).alias("topic"), "partition",
        F.col("topic").alias("origTopic"), F.col("partition").alias("origPartition"),
        F.col("offset").alias("origOffset"), error.alias("errorClass"), message.alias("errorMessage"))


def outcome_records(processed: DataFrame, request_headers: str = "headers") -> DataFrame:
    """Headers an outcome record carries on: correlation id and source, not the event type."""
    return processed.withColumn("headers", headers.propagate(F.col(request_headers)))
