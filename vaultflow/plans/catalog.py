"""Every query by name: how Spark answers it, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.functions import headers, money
from vaultflow.operators import activity, enrich, fraud, ingest, ledger, memory, notify, validation
from vaultflow.plans import oracles as o
from vaultflow.plans.pipeline import Pipeline
from vaultflow.schemas import (ALERT_RETRY, HEADER_CORRELATION, HEADER_SOURCE, RECEIPT_RETRY, REQUESTED, STREAM_RETENTION_DAYS,
                               TRANSACTION_DDL, TRANSACTION_FIELDS, FraudRules, LedgerRules, RetryPolicy)
from vaultflow.session import new_folder, stage
from vaultflow.sources import decode, driver_tables, streams, tables
from vaultflow.streaming import delivery, jobs, windows
from vaultflow.streaming.record_sink import RecordSink
from vaultflow.streaming.replay import replay
from vaultflow.streaming.retention import RetainedTable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The tables hold a few rows per account and day: at the default of one minute velocity never fires.
SPARSE = FraudRules(velocity_window="1 day", velocity_max=2)
REQUEST = ("seq", "transactionId", "accountId", "type", "amount", "amountRaw", "currency", "counterpartyAccountId",
           "channel", "country", "merchant", "timestamp")
BOOKING = ("seq", "leg", *TRANSACTION_FIELDS, "balanceBefore", "transactionCount", "accountCurrency")


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# -- sources ---------------------------------------------------------------------------------------

_RECORD = o.INPUTS + f""",
record AS (
  SELECT seq, accountId AS key, {o.PART.format('accountId')} AS part, "timestamp",
         CASE WHEN seq % 101 = 7 THEN '{{not json' ELSE
           '{{"transactionId":"' || transactionId || '","accountId":"' || accountId || '","type":"' || type ||
           '","amount":' || coalesce(amountRaw, 'null') || ',"currency":"' || currency ||
           '","counterpartyAccountId":' || coalesce('"' || counterpartyAccountId || '"', 'null') ||
           ',"channel":' || coalesce('"' || channel || '"', 'null') ||
           ',"country":' || coalesce('"' || country || '"', 'null') || ',"unknownField":1}}' END AS value
  FROM bank_request)"""


@query(o.q(_RECORD, """
SELECT seq, key, NOT json_valid(value) AS bad,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.transactionId') END AS transactionId,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.type') END AS type,
       CASE WHEN json_valid(value) THEN nullif(regexp_extract(value, '"amount":([0-9.]+)', 1), '') END AS amountRaw,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.currency') END AS currency,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.counterpartyAccountId') END
         AS counterpartyAccountId,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.channel') END AS channel,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.country') END AS country
FROM record"""))
def decode_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON bytes to typed fields, bad records flagged."""
    rows = decode.decode(Pipeline.of(spark, sf_dir).records(), TRANSACTION_DDL, decode.TRANSACTION_ENUMS)
    fields = ("transactionId", "type", "amountRaw", "currency", "counterpartyAccountId", "channel", "country")
    return rows.select(F.col("offset").alias("seq"), "key", F.col("decodeError").isNotNull().alias("bad"),
                       *[F.col(f"payload.{f}").alias(f) for f in fields])


@query(o.q(_RECORD, """
SELECT part AS "partition", count(*) FILTER (json_valid(value)) AS kept,
       count(*) FILTER (NOT json_valid(value)) AS dropped FROM record GROUP BY part"""))
def decode_drop_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The skipping policy: good records go on, dropped ones are counted per stream partition."""
    rows = Pipeline.of(spark, sf_dir).decoded
    return rows.groupBy("partition").agg(F.count_if(F.col("decodeError").isNull()).alias("kept"),
                                         F.count_if(F.col("decodeError").isNotNull()).alias("dropped"))


@query(o.q(_RECORD + o.VERDICTS.removeprefix(o.INPUTS), f"""
, judged AS (
  SELECT r.key, r.value, r.part, r.seq, v.transactionId, json_valid(r.value) AS good, v.outcome, v.reason
  FROM record r JOIN verdict v ON v.seq = r.seq),
ok AS (SELECT transactionId, min(seq) AS first FROM judged WHERE good AND outcome <> 'DEAD_LETTER' GROUP BY 1)
SELECT key, value, '{REQUESTED}.DLT' AS topic, part AS "partition", '{REQUESTED}' AS origTopic,
       part AS origPartition, j.seq AS origOffset,
       CASE WHEN good THEN 'AccountNotFoundException' ELSE 'DeserializationException' END AS errorClass,
       CASE WHEN good THEN reason ELSE 'Cannot deserialize record' END AS errorMessage
FROM judged j LEFT JOIN ok ON good AND ok.transactionId = j.transactionId AND ok.first < j.seq
WHERE (NOT good OR outcome = 'DEAD_LETTER') AND ok.first IS NULL""".strip()))
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poison records and requests on unknown accounts, bytes untouched (shown as text)."""
    p = Pipeline.of(spark, sf_dir)
    poison = decode.poison_letters(p.decoded)
    requests = decode.requests_of(p.decoded)
    judged = stage(validation.verdicts(requests, p.account_lookup, p.validation_rules), "judged-records")
    lost = validation.dispositions(judged).where(F.col("outcome") == validation.DEAD).select("record.*", "reason")
    unknown = validation.dead_letters(lost, F.lit("AccountNotFoundException"), F.col("reason"))
    return poison.unionByName(unknown).withColumn("value", F.col("value").cast("string"))


@query(o.q(o.INPUTS, f"""
, timed AS (
  SELECT seq, {o.PART.format('accountId')} AS part, CASE WHEN seq % 4 = 0 THEN "timestamp" END AS payload_ts,
         CASE WHEN seq % 3 <> 0 THEN "timestamp" + INTERVAL '5 seconds' END AS record_ts
  FROM bank_request)
SELECT seq, part AS "partition", coalesce(payload_ts, record_ts, max(coalesce(payload_ts, record_ts)) OVER (
         PARTITION BY part ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS eventTime
FROM timed"""))
def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload time, else record time, else the partition's clock."""
    seq, ts = F.col("seq"), F.col("timestamp")
    rows = Pipeline.of(spark, sf_dir).requests().select(
        "seq", driver_tables.partition_of(F.col("accountId")).alias("partition"),
        F.when(seq % 4 == 0, ts).alias("payload_ts"),
        F.when(seq % 3 != 0, ts + F.expr("INTERVAL 5 SECONDS")).alias("record_ts"))
    timed = decode.event_time(rows, F.col("payload_ts"), F.col("record_ts"), "partition", "seq")
    return timed.select("seq", "partition", "eventTime")


@query(o.q(o.INPUTS, """
SELECT accountId, customerId, accountType, currency, status FROM bank_account_changelog
QUALIFY row_number() OVER (PARTITION BY accountId ORDER BY seq DESC) = 1"""))
def latest_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state per account from its change log."""
    return Pipeline.of(spark, sf_dir).accounts()


@query(o.q(o.INPUTS, "SELECT customerId, fullName, email, phone, homeCountry, tier FROM bank_customer"))
def latest_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state per customer; a tombstone removes the customer."""
    return Pipeline.of(spark, sf_dir).customers()


@query(o.q(o.LEDGER, f"""
SELECT accountId AS key, {o.PART.format('accountId')} AS "partition", seq AS "offset",
       CASE WHEN seq % 7 = 0 THEN '-' ELSE 'C-' || seq END AS correlation, transactionId, reason
FROM (SELECT seq, accountId, transactionId, reason FROM processed WHERE outcome = 'REJECTED'
      UNION ALL SELECT seq, accountId, transactionId, reason FROM postings WHERE status = 'REJECTED')"""))
def rejection_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejections of the rules and of the ledger with the key, partition, offset and correlation id of their record."""
    p = Pipeline.of(spark, sf_dir)
    fields = ("accountId", "partition", "seq", "headers", "transactionId", "reason")
    both = p.rejected_by_rules().select(*fields).unionByName(p.rejected_by_ledger().select(*fields))
    return both.select(
        F.col("accountId").alias("key"), "partition", F.col("seq").alias("offset"),
        F.coalesce(headers.last_text(F.col("headers"), HEADER_CORRELATION), F.lit("-")).alias("correlation"),
        "transactionId", "reason")


def _outcome_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated and rejected records with the headers they inherit from their request record."""
    p = Pipeline.of(spark, sf_dir)
    return validation.outcome_records(p.validated().unionByName(p.rejected_by_rules()))


_NOW = "2024-01-20 00:00:00"
_KEPT = STREAM_RETENTION_DAYS[REQUESTED]


@query(o.q(o.INPUTS, f"""
SELECT seq, transactionId, accountId, "timestamp" FROM bank_request
WHERE "timestamp" >= TIMESTAMP '{_NOW}' - INTERVAL '{_KEPT} days'"""))
def retention_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests still inside their stream's retention at a given time."""
    now = F.lit(_NOW).cast("timestamp")
    return (tables.retain(Pipeline.of(spark, sf_dir).requests(), "timestamp", _KEPT, now)
            .select("seq", "transactionId", "accountId", "timestamp"))


@query(ORACLES["retention_prune"])
def retention_dropped_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream kept in folders by day, where two expiries have dropped what was too old."""
    kept = RetainedTable(new_folder(spark, "stream-job"), "seq BIGINT, transactionId STRING, accountId STRING, timestamp TIMESTAMP", "timestamp", _KEPT)
    replay(Pipeline.of(spark, sf_dir).requests().select("seq", "transactionId", "accountId", "timestamp"), "seq", kept.run)
    now = F.lit(_NOW).cast("timestamp")
    for at in (now - F.expr("INTERVAL 5 DAYS"), now):
        kept.expire(spark, at)
    return kept.rows(spark, now)


# -- sinks as projections --------------------------------------------------------------------------

@query(o.q(o.LEDGER, """
SELECT seq, leg, accountId, balanceAfter AS balance, accountCurrency AS currency, transactionCount,
       transactionId AS lastTransactionId, "timestamp" AS updatedAt FROM posted"""))
def balance_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One balance snapshot per posted row."""
    return ledger.balance_changes(Pipeline.of(spark, sf_dir).posted())


_BALANCES = """
SELECT accountId, balanceAfter AS balance, accountCurrency AS currency, transactionCount,
       transactionId AS lastTransactionId, "timestamp" AS updatedAt FROM posted
QUALIFY row_number() OVER (PARTITION BY accountId ORDER BY seq DESC, leg DESC) = 1"""


@query(o.q(o.LEDGER, _BALANCES))
def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest balance of every account."""
    return Pipeline.of(spark, sf_dir).balances()


def _json_text(column: str) -> str:
    return f"coalesce('\"' || {column} || '\"', 'null')"


@query(o.q(o.LEDGER, f"""
SELECT seq, leg, accountId AS key, '{{"transactionId":' || {_json_text('transactionId')} || ',"accountId":'
       || {_json_text('accountId')} || ',"type":' || {_json_text('type')} || ',"amount":' || amount || ',"currency":'
       || {_json_text('currency')} || ',"counterpartyAccountId":' || {_json_text('counterpartyAccountId')}
       || ',"channel":' || {_json_text('channel')} || ',"country":' || {_json_text('country')} || ',"merchant":'
       || {_json_text('merchant')} || ',"timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%gZ')
       || '","status":' || {_json_text('status')} || ',"reason":' || {_json_text('reason')} || ',"balanceAfter":'
       || balanceAfter || '}}' AS value
FROM posted"""))
def encode_posted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted rows as JSON: ISO times, nulls kept, no type information."""
    return Pipeline.of(spark, sf_dir).posted().select(
        "seq", "leg", F.col("accountId").alias("key"), streams.encode(*TRANSACTION_FIELDS).alias("value"))


@query(o.q(o.VERDICTS, f"""
SELECT {o.PART.format('accountId')} AS "partition", accountId, seq, transactionId,
       row_number() OVER (PARTITION BY accountId ORDER BY seq) AS place FROM processed"""))
def keyed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by stream partition, key and order; ``place`` counts the rows of a key as they lie in the files."""
    rows = Pipeline.of(spark, sf_dir).processed.select("accountId", "seq", "transactionId")
    path = new_folder(spark, "keyed-layout")
    streams.keyed_layout(rows, "accountId", "seq", driver_tables.partition_of(F.col("accountId"))).write.parquet(path)
    read = spark.read.parquet(path).select("*", streams.place_in_files().alias("_at"))
    return streams.place_in_key(read, "accountId", "_at").drop("_at").select("partition", "accountId", "seq", "transactionId", "place")


@query(o.q(o.VERDICTS, """
SELECT seq, transactionId, outcome AS status, CASE WHEN seq % 7 = 0 THEN '' ELSE 'x-correlation-id,x-source-system' END
         AS headerNames, CASE WHEN seq % 7 <> 0 THEN 'C-' || seq END AS correlation,
       CASE WHEN seq % 7 <> 0 THEN 'web' END AS source
FROM processed"""))
def header_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome records inherit correlation id and source, not the event type."""
    rows = _outcome_headers(spark, sf_dir)
    return rows.select(
        "seq", "transactionId", "status",
        F.array_join(F.transform("headers", lambda h: h["key"]), ",").alias("headerNames"),
        headers.last_text(F.col("headers"), HEADER_CORRELATION).alias("correlation"),
        headers.last_text(F.col("headers"), HEADER_SOURCE).alias("source"))


# -- ingest ----------------------------------------------------------------------------------------

_COMMANDS = o.INPUTS + f""",
command AS (
  SELECT * REPLACE (CASE WHEN seq % 5 <> 0 THEN transactionId END AS transactionId,
                    CASE WHEN seq % 97 = 11 THEN ' ' ELSE accountId END AS accountId,
                    CASE WHEN seq % 89 = 13 THEN '' ELSE currency END AS currency), seq // 20 AS batchId
  FROM bank_request),
checked AS (
  SELECT *, concat_ws('; ', CASE WHEN trim(accountId) = '' THEN 'accountId: must not be blank' END,
       CASE WHEN amountRaw IS NULL THEN 'amountRaw: must not be null' END,
       CASE WHEN cast(amountRaw AS decimal(18,3)) < 0.01
            THEN 'amountRaw: must be greater than or equal to 0.01' END,
       CASE WHEN trim(currency) = '' THEN 'currency: must not be blank' END) AS violations
  FROM command)"""


@query(o.q(_COMMANDS, "SELECT seq, violations, violations = '' AS accepted FROM checked"))
def ingest_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraint violations of every transaction command."""
    commands = driver_tables.transaction_commands(spark, sf_dir)
    checked = ingest.check(commands, ingest.transaction_constraints())
    return checked.select("seq", F.array_join("violations", "; ").alias("violations"), "accepted")


@query(o.q(_COMMANDS, """
SELECT seq, coalesce(transactionId, sha256('transaction~web~' || seq)[1:32]) AS transactionId, accountId, type, amountRaw,
       currency, cast(NULL AS varchar) AS counterpartyAccountId, coalesce(channel, 'ONLINE') AS channel, country,
       merchant, "timestamp", 'REQUESTED' AS status
FROM checked WHERE violations = ''"""))
def ingest_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted transaction commands as events, defaults filled in."""
    commands = driver_tables.transaction_commands(spark, sf_dir)
    checked = ingest.check(commands, ingest.transaction_constraints())
    return ingest.transaction_events(checked.where("accepted"))


@query(o.q(o.INPUTS, """
, command AS (
  SELECT c_custkey AS seq, CASE WHEN c_custkey % 4 <> 0 THEN customerId END AS customerId, fullName,
         CASE WHEN c_custkey % 13 = 5 THEN 'no-at-sign' ELSE email END AS email, phone,
         CASE WHEN c_custkey % 19 <> 4 THEN homeCountry END AS homeCountry,
         CASE WHEN c_custkey % 3 <> 0 THEN tier END AS tier
  FROM bank_customer_all)
SELECT seq, coalesce(customerId, 'CUST-' || upper(sha256('customer~web~' || seq)[1:8])) AS customerId, fullName, email,
       phone, homeCountry, coalesce(tier, 'STANDARD') AS tier,
       concat_ws('; ', CASE WHEN email NOT LIKE '%@%' THEN 'email: must be a well-formed email address' END,
                 CASE WHEN homeCountry IS NULL THEN 'homeCountry: must not be blank' END) AS violations
FROM command"""))
def ingest_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer commands: violations, and the event each one would publish."""
    checked = ingest.check(driver_tables.customer_commands(spark, sf_dir), ingest.customer_constraints())
    return ingest.customer_events(checked)


@query(o.q(o.INPUTS, """
, command AS (
  SELECT c_custkey AS seq, CASE WHEN c_custkey % 4 <> 0 THEN accountId END AS accountId, customerId,
         CASE WHEN c_custkey % 17 = 2 THEN '' ELSE accountType END AS accountType, currency
  FROM bank_account)
SELECT seq, coalesce(accountId, 'ACC-' || upper(sha256('account~web~' || seq)[1:8])) AS accountId, customerId, accountType,
       currency, 'ACTIVE' AS status, TIMESTAMP '2026-01-01 10:00:00' + seq * INTERVAL '1 second' AS updatedAt
FROM command WHERE accountType <> ''"""))
def ingest_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted account commands as events of an ACTIVE account."""
    checked = ingest.check(driver_tables.account_commands(spark, sf_dir), ingest.account_constraints())
    return ingest.account_events(checked.where("accepted"))


@query(o.q(o.INPUTS, """
SELECT seq, CASE WHEN seq % 5 <> 0 THEN transactionId ELSE sha256('transfer~web~' || seq)[1:32] END AS transactionId,
       accountId, 'TRANSFER' AS type, amountRaw, currency, counterpartyAccountId, coalesce(channel, 'ONLINE') AS channel,
       country, cast(NULL AS varchar) AS merchant, "timestamp", 'REQUESTED' AS status
FROM bank_request
WHERE type = 'TRANSFER' AND counterpartyAccountId IS NOT NULL AND cast(amountRaw AS decimal(18,3)) >= 0.01"""))
def transfer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted transfer commands as TRANSFER events keyed by the paying account."""
    checked = ingest.check(driver_tables.transfer_commands(spark, sf_dir), ingest.transfer_constraints())
    return ingest.transfer_events(checked.where("accepted"))


@query(o.q(o.INPUTS, """
, opened AS (SELECT * FROM bank_account WHERE c_custkey % 7 <> 0),
changed AS (
  SELECT 500 + length(accountId) AS seq, accountId, status FROM bank_account WHERE status <> 'ACTIVE'
  UNION ALL
  SELECT 600 + length(accountId), accountId, 'ACTIVE' FROM bank_account WHERE status <> 'ACTIVE' AND c_custkey % 2 = 0)
SELECT cast(0 AS bigint) AS seq, accountId, customerId, accountType, currency, 'ACTIVE' AS status,
       cast(NULL AS varchar) AS error FROM opened
UNION ALL
SELECT c.seq, c.accountId, a.customerId, a.accountType, a.currency,
       CASE WHEN a.accountId IS NOT NULL THEN c.status END,
       CASE WHEN a.accountId IS NULL THEN 'Unknown account ' || c.accountId END
FROM changed c LEFT JOIN opened a ON a.accountId = c.accountId"""))
def account_status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account change log that opens and status commands produce; unknown accounts are errors."""
    return ingest.status_changes(driver_tables.account_opens(spark, sf_dir),
                                 driver_tables.status_commands(spark, sf_dir))


@query(o.q(o.INPUTS, "SELECT customerId, fullName, email, phone, homeCountry, tier FROM bank_customer"))
def gdpr_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer history without the customers that a tombstone erased."""
    changes = driver_tables.customer_changelog(spark, sf_dir)
    gone = changes.where(F.col("value").isNull())
    kept = tables.erase(changes.withColumnRenamed("customerId", "key"), gone.select(F.col("customerId").alias("key")),
                        "key")
    return kept.select("value.*")


@query(o.q(_COMMANDS, """
, whole AS (SELECT batchId FROM checked GROUP BY batchId HAVING bool_and(violations = ''))
SELECT seq, batchId, transactionId, accountId, sha256('batch~' || batchId)[1:32] AS correlationId
FROM checked WHERE batchId IN (SELECT batchId FROM whole)"""))
def payroll_batch_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches are published whole or not at all."""
    commands = driver_tables.transaction_commands(spark, sf_dir)
    checked = ingest.check(commands, ingest.transaction_constraints())
    return ingest.gate_batches(checked, "batchId").select(
        "seq", "batchId", "transactionId", "accountId", "correlationId")


# -- validation ------------------------------------------------------------------------------------

@query(o.q(o.VERDICTS, "SELECT seq, transactionId, outcome, reason FROM verdict"))
def validation_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome and reason of every request, resubmissions judged like any other."""
    return Pipeline.of(spark, sf_dir).verdicts().select("seq", "transactionId", "outcome", "reason")


@query(o.q(o.VERDICTS, """
, ok AS (SELECT transactionId, min(seq) AS first FROM verdict WHERE outcome <> 'DEAD_LETTER' GROUP BY 1)
SELECT v.seq, v.transactionId, CASE WHEN v.seq > ok.first THEN 'DUPLICATE' ELSE outcome END AS outcome,
       CASE WHEN v.seq > ok.first THEN NULL ELSE reason END AS reason
FROM verdict v LEFT JOIN ok ON ok.transactionId = v.transactionId"""))
def request_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every request: validated, rejected, duplicate or dead letter."""
    rows = validation.dispositions(Pipeline.of(spark, sf_dir).verdicts())
    return rows.select("seq", "transactionId", "outcome", "reason")


@query(o.q(o.VERDICTS, f"SELECT {o.REQ}, outcome AS status FROM processed WHERE outcome = 'VALIDATED'"))
def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validated stream."""
    return Pipeline.of(spark, sf_dir).validated().select(*REQUEST, "status")


@query(o.q(o.VERDICTS, f"SELECT {o.REQ}, outcome AS status, reason FROM processed WHERE outcome = 'REJECTED'"))
def rejected_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests the business rules turned down."""
    return Pipeline.of(spark, sf_dir).rejected_by_rules().select(*REQUEST, "status", "reason")


@query(o.q(o.INPUTS, """
SELECT seq, transactionId, accountId FROM bank_request
WHERE accountId NOT IN (SELECT accountId FROM bank_account)"""))
def unknown_account_txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose account nobody opened."""
    p = Pipeline.of(spark, sf_dir)
    return validation.unknown_accounts(p.requests(), p.account_lookup).select("seq", "transactionId", "accountId")


@query(o.q(o.VERDICTS, "SELECT seq, transactionId, outcome, reason FROM processed"))
def dedup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First processed occurrence of every transaction id."""
    judged = Pipeline.of(spark, sf_dir).verdicts()
    return validation.first_processed(judged).select("seq", "transactionId", "outcome", "reason")


@query(o.q(o.VERDICTS, """
SELECT seq, type, amount, type IN ('DEPOSIT', 'TRANSFER_IN', 'REFUND') AS credit,
       cast(CASE WHEN type IN ('DEPOSIT', 'TRANSFER_IN', 'REFUND') THEN amount ELSE -amount END AS decimal(28,2)) AS signed
FROM processed WHERE outcome = 'VALIDATED'"""))
def signed_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits positive, debits negative."""
    rows = Pipeline.of(spark, sf_dir).validated()
    return rows.select("seq", "type", "amount", money.is_credit(F.col("type")).alias("credit"),
                       money.signed_amount(F.col("type"), F.col("amount")).cast("decimal(28,2)").alias("signed"))


# -- ledger ----------------------------------------------------------------------------------------

@query(o.q(o.LEDGER_ALONE, f"SELECT {o.BOOKING} FROM postings"))
def ledger_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold on its own: every valid request, resubmissions included, no transfer credit."""
    judged = Pipeline.of(spark, sf_dir).verdicts()
    return ledger.book(validation.validated(judged), LedgerRules(transfers=False)).select(*BOOKING)


@query(o.q(o.LEDGER, f"SELECT {o.BOOKING} FROM postings"))
def ledger_with_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ledger, run afresh: booked and refused rows, credit legs included."""
    return ledger.book(Pipeline.of(spark, sf_dir).validated(), LedgerRules()).select(*BOOKING)


@query(ORACLES["ledger_with_transfers"])
def ledger_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger booked in three periods, each on the balances that the one before left."""
    rows = Pipeline.of(spark, sf_dir).validated()
    low, high = rows.agg(F.min("seq"), F.max("seq")).first()
    return ledger.book_in_periods(rows, (high - low) // 3 + 1).select(*BOOKING)


@query(o.q(o.LEDGER, f"SELECT seq, leg, {o.TXN} FROM posted"))
def posted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posted stream."""
    return Pipeline.of(spark, sf_dir).posted().select("seq", "leg", *TRANSACTION_FIELDS)


@query(o.q(o.LEDGER, f"SELECT seq, leg, {o.TXN} FROM postings WHERE status = 'REJECTED'"))
def rejected_by_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debits without funds."""
    return Pipeline.of(spark, sf_dir).rejected_by_ledger().select("seq", "leg", *TRANSACTION_FIELDS)


@query(o.q(o.LEDGER, """
SELECT seq, transactionId || '-IN' AS transactionId, counterpartyAccountId AS accountId, 'TRANSFER_IN' AS type, amount,
       currency, accountId AS counterpartyAccountId, channel, country, merchant, "timestamp", 'VALIDATED' AS status
FROM posted WHERE type = 'TRANSFER'"""))
def credit_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The credit leg every posted transfer sends to its counterparty."""
    return ledger.credit_legs(Pipeline.of(spark, sf_dir).posted())


@query(o.q(o.LEDGER, """
SELECT seq, transactionId, accountId, type, amount, currency, "timestamp", 'REJECTED' AS status, reason
FROM processed WHERE outcome = 'REJECTED'
UNION ALL
SELECT seq, transactionId, accountId, type, amount, currency, "timestamp", status, reason
FROM postings WHERE status = 'REJECTED'"""))
def rejected_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejections of the rules and of the ledger in one stream."""
    return _rejected_all(spark, sf_dir).drop("amountRaw")


def _rejected_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Pipeline.of(spark, sf_dir)
    fields = ("seq", "transactionId", "accountId", "type", "amount", "amountRaw", "currency", "timestamp", "status",
              "reason")
    by_ledger = p.rejected_by_ledger().withColumn("amountRaw", F.col("amount").cast("string"))
    return p.rejected_by_rules().select(*fields).unionByName(by_ledger.select(*fields))


# -- enrichment and windows ------------------------------------------------------------------------

_ENRICHED = f"seq, leg, {o.TXN}, customerId, accountType, customerName, customerEmail, customerTier"


@query(o.q(o.LEDGER, f"""
SELECT seq, leg, {o.TXN_P}, a.customerId, a.accountType, c.fullName AS customerName, c.email AS customerEmail,
       c.tier AS customerTier
FROM posted p JOIN bank_account a ON a.accountId = p.accountId LEFT JOIN bank_customer c ON c.customerId = a.customerId"""))
def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted rows with the latest account and customer data."""
    return enrich.flat(Pipeline.of(spark, sf_dir).enriched())


@query(o.q(o.LEDGER, f"""
, version AS (
  SELECT p.*, v.customerId, v.accountType, v.seq AS at
  FROM posted p JOIN bank_account_changelog v ON v.accountId = p.accountId AND v.seq <= p.seq
  QUALIFY row_number() OVER (PARTITION BY p.seq, p.leg ORDER BY v.seq DESC) = 1)
SELECT p.seq, p.leg, {o.TXN_P}, p.customerId, p.accountType, c.fullName AS customerName, c.email AS customerEmail,
       c.tier AS customerTier
FROM version p LEFT JOIN bank_customer c ON c.customerId = p.customerId"""))
def enriched_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted rows with the account version that was current when they arrived."""
    p = Pipeline.of(spark, sf_dir)
    changes = driver_tables.account_changelog(spark, sf_dir)
    return enrich.flat(enrich.enrich_as_of(p.posted(), changes, p.customer_lookup))


_SUMMARY = "accountId, windowStart, windowEnd, transactionCount, totalCredits, totalDebits"


@query(o.q(o.LEDGER + o.SUMMARY, f"""
SELECT {_SUMMARY}, cast(totalCredits - totalDebits AS decimal(38,2)) AS netFlow FROM summary"""))
def activity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly activity per account with its net flow."""
    return activity.with_net_flow(activity.summarize(Pipeline.of(spark, sf_dir).posted()))


_ACCOUNT = "ACC-1"
_LOOK_BACK_DAYS = 10


@query(o.q(o.LEDGER + o.SUMMARY, f"""
SELECT accountId, windowStart, cast(NULL AS timestamp) AS windowEnd, transactionCount, totalCredits, totalDebits
FROM summary WHERE accountId = '{_ACCOUNT}'
  AND windowStart BETWEEN TIMESTAMP '{_NOW}' - INTERVAL '{_LOOK_BACK_DAYS} days' AND TIMESTAMP '{_NOW}'"""))
def activity_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of one account that started lately, open ones included."""
    return activity.look_back(Pipeline.of(spark, sf_dir).posted(), _ACCOUNT, F.lit(_NOW).cast("timestamp"),
                              F.expr(f"INTERVAL {_LOOK_BACK_DAYS} DAYS"))


@query(o.q(o.LEDGER, f"""
, shuffled AS (
  SELECT seq, leg, accountId, seq * 2 + leg AS place, {o.PART.format('accountId')} AS part,
         CASE WHEN seq % 13 = 4 THEN "timestamp" - INTERVAL '3 hours' ELSE "timestamp" END AS ts
  FROM posted)
SELECT seq, leg, accountId, ts AS "timestamp",
       coalesce(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' + INTERVAL '5 minutes' <= max(ts) OVER (
         PARTITION BY part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late
FROM shuffled"""))
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows arrive after their window has closed, when one in 13 is three hours out of order."""
    ts = F.col("timestamp")
    rows = Pipeline.of(spark, sf_dir).posted().select(
        "seq", "leg", "accountId", (F.col("seq") * 2 + F.col("leg")).alias("place"),
        driver_tables.partition_of(F.col("accountId")).alias("partition"),
        F.when(F.col("seq") % 13 == 4, ts - F.expr("INTERVAL 3 HOURS")).otherwise(ts).alias("timestamp"))
    return activity.late_rows(rows, "partition", "place").drop("place", "partition")


# -- fraud -----------------------------------------------------------------------------------------

def _alert_sql(rule: str) -> str:
    return o.q(o.LEDGER + o.ALERTS, f"SELECT {o.ALERT} FROM alert WHERE rule = '{rule}'")


@query(_alert_sql("LARGE_AMOUNT"))
def fraud_large_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.large_amount(Pipeline.of(spark, sf_dir).posted())


@query(_alert_sql("VELOCITY"))
def fraud_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More than two debits in a day."""
    return fraud.velocity(Pipeline.of(spark, sf_dir).posted(), SPARSE)


@query(_alert_sql("IMPOSSIBLE_TRAVEL"))
def fraud_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.travel(Pipeline.of(spark, sf_dir).posted())


@query(_alert_sql("MONEY_MULE"))
def fraud_money_mule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.money_mule(Pipeline.of(spark, sf_dir).posted())


@query(o.q(o.LEDGER + o.ALERTS, f"SELECT {o.ALERT} FROM alert"))
def fraud_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four rules in one stream."""
    return fraud.all_alerts(Pipeline.of(spark, sf_dir).posted(), SPARSE)


@query(o.q(o.LEDGER + o.ALERTS, f"SELECT {o.ALERT} FROM alert WHERE severity IN ('HIGH', 'CRITICAL')"))
def fraud_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that open a case."""
    return fraud.cases(fraud.all_alerts(Pipeline.of(spark, sf_dir).posted(), SPARSE))


# -- serving and notification ----------------------------------------------------------------------

@query(o.q(o.LEDGER, f"SELECT * FROM ({_BALANCES}) WHERE accountId = '{_ACCOUNT}'"))
def balance_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance of one account, from the kept balances: one folder is opened."""
    return Pipeline.of(spark, sf_dir).balance_of(_ACCOUNT)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Pipeline.of(spark, sf_dir).posted()
    clock = rows.agg(F.max("timestamp")).first()[0]
    return notify.all_messages(rows, _rejected_all(spark, sf_dir), fraud.all_alerts(rows, SPARSE),
                               activity.final(activity.summarize(rows), clock))


@query(o.q(o.LEDGER + o.MESSAGES, "SELECT channel, recipient, accountId, message, sentAt FROM message"))
def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message to an owner: receipts, refusals, alerts, digests."""
    return _messages(spark, sf_dir)


@query(o.q(o.LEDGER + o.MESSAGES, """
SELECT channel, recipient, accountId, message, sentAt FROM message
ORDER BY sentAt DESC, accountId, channel, message LIMIT 500"""))
def recent_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 500 messages."""
    return notify.recent(_messages(spark, sf_dir))


@query(o.q(o.LEDGER + o.ALERTS, f"""
, tried AS (
  SELECT alertId, detectedAt, {o.HASH6.format('alertId')} % 6 AS fails FROM alert),
attempt AS (
  SELECT alertId, unnest(range(1, least(CASE WHEN fails = 5 THEN 0 ELSE fails END, 3) + 2)) AS attempt, fails, detectedAt
  FROM tried),
delivery AS (
  SELECT alertId, cast(attempt AS int) AS attempt, detectedAt + (attempt - 1) * INTERVAL '1 minute' AS tried_at,
         CASE WHEN fails = 5 THEN 'IllegalArgumentException'
              WHEN attempt <= fails THEN 'GatewayUnavailableException' END AS error
  FROM attempt),
routed AS (
  SELECT *, CASE WHEN error IS NULL THEN 'DELIVERED'
                 WHEN attempt >= 4 OR error = 'IllegalArgumentException' THEN 'DEAD_LETTER' ELSE 'RETRY' END AS action
  FROM delivery)
SELECT alertId, attempt, error, action,
       CASE WHEN action = 'RETRY' THEN tried_at + INTERVAL '1 second' * cast(least(pow(2, attempt - 1), 10) AS bigint) END
         AS nextAt
FROM routed"""))
def delivery_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert deliveries: retry with growing waits, then dead letter. Outcomes come from the alert's hash."""
    alerts = fraud.all_alerts(Pipeline.of(spark, sf_dir).posted(), SPARSE)
    fails = F.conv(F.substring(F.md5("alertId"), 1, 8), 16, 10).cast("bigint") % 6
    tried = alerts.select("alertId", "detectedAt", fails.alias("fails"))
    last = F.least(F.when(F.col("fails") == 5, 0).otherwise(F.col("fails")), F.lit(3)) + 1
    attempts = (tried.withColumn("attempt", F.explode(F.sequence(F.lit(1), last.cast("int"))))
                .withColumn("at", F.timestamp_millis(F.unix_millis("detectedAt") + (F.col("attempt") - 1) * 60_000))
                .withColumn("error", F.when(F.col("fails") == 5, "IllegalArgumentException")
                            .when(F.col("attempt") <= F.col("fails"), "GatewayUnavailableException")))
    return notify.route_attempts(attempts, ALERT_RETRY).select("alertId", "attempt", "error", "action", "nextAt")


@query(o.q(o.LEDGER, f"""
, receipt AS (
  SELECT seq, leg, seq * 2 + leg AS place, {o.PART.format('accountId')} AS part, seq // 500 AS batch,
         {o.HASH6.format('transactionId')} % 50 = 0 AS failed
  FROM posted)
SELECT seq, leg, part AS "partition", batch,
       coalesce(place < min(CASE WHEN failed THEN place END) OVER (PARTITION BY part, batch), true) AS committed
FROM receipt"""))
def delivery_prefix_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of a batch are committed up to its first failure."""
    rows = Pipeline.of(spark, sf_dir).posted().select(
        "seq", "leg", (F.col("seq") * 2 + F.col("leg")).alias("place"),
        driver_tables.partition_of(F.col("accountId")).alias("partition"), F.expr("seq div 500").alias("batch"),
        (F.conv(F.substring(F.md5("transactionId"), 1, 8), 16, 10).cast("bigint") % 50 == 0).alias("failed"))
    done = notify.commit_prefix(rows, ("partition", "batch"), "place", F.col("failed"))
    return done.select("seq", "leg", "partition", "batch", "committed")


# -- the same jobs as streams: the table arrives in three pieces ------------------------------------

def _posted_stream(spark: SparkSession, sf_dir: str, job) -> DataFrame:
    home = new_folder(spark, "stream-job")
    return replay(Pipeline.of(spark, sf_dir).posted(), "seq", lambda stream: job(stream, home))


@query(o.q(o.LEDGER + o.SUMMARY, f"""
SELECT {_SUMMARY} FROM summary
WHERE windowEnd + INTERVAL '5 minutes' <= (SELECT max("timestamp") FROM posted)"""))
def activity_summary_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final summaries of the windows that have closed by the end of the stream."""
    return _posted_stream(spark, sf_dir, jobs.activity_summaries)


def _shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted rows, one in 13 three hours out of order."""
    ts = F.col("timestamp")
    late = F.when(F.col("seq") % 13 == 4, ts - F.expr("INTERVAL 3 HOURS")).otherwise(ts)
    return Pipeline.of(spark, sf_dir).posted().withColumn("timestamp", late)


def _kept_windows(spark: SparkSession, rows: DataFrame) -> windows.ActivityWindows:
    """Windows kept in tables, after ``rows`` came as a stream."""
    job = windows.ActivityWindows(new_folder(spark, "stream-job"), driver_tables.partition_of(F.col("accountId")), F.col("seq") * 2 + F.col("leg"))
    replay(rows, "seq", job.run)
    return job


@query(ORACLES["activity_lookback"])
def activity_lookback_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of one account that started lately, open ones included, served from the state of the stream."""
    job = _kept_windows(spark, Pipeline.of(spark, sf_dir).posted())
    return job.look_back(spark, _ACCOUNT, F.lit(_NOW).cast("timestamp"), F.expr(f"INTERVAL {_LOOK_BACK_DAYS} DAYS"))


@query(f"SELECT seq, leg, accountId, \"timestamp\" FROM ({ORACLES['late_rows']}) WHERE late")
def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the stream sets aside as late, by a clock per partition."""
    return _kept_windows(spark, _shuffled(spark, sf_dir)).output(spark, "late").select("seq", "leg", "accountId", "timestamp")


@query(f"""
WITH judged AS ({ORACLES['late_rows']}),
typed AS (
  SELECT j.*, p.type, p.amount, {o.PART.format('j.accountId')} AS part
  FROM judged j JOIN ({o.q(o.LEDGER, 'SELECT seq, leg, type, amount FROM posted')}) p ON p.seq = j.seq AND p.leg = j.leg),
kept AS (
  SELECT part, accountId, time_bucket(INTERVAL '1 hour', "timestamp") AS windowStart, count(*) AS transactionCount,
         cast(coalesce(sum(amount) FILTER (type IN ('DEPOSIT', 'REFUND', 'TRANSFER_IN')), 0) AS decimal(38,2)) AS totalCredits,
         cast(coalesce(sum(amount) FILTER (type NOT IN ('DEPOSIT', 'REFUND', 'TRANSFER_IN')), 0) AS decimal(38,2)) AS totalDebits
  FROM typed WHERE NOT late GROUP BY ALL),
clock AS (SELECT part, max("timestamp") AS clock FROM typed GROUP BY part)
SELECT accountId, windowStart, windowStart + INTERVAL '1 hour' AS windowEnd, transactionCount, totalCredits, totalDebits
FROM kept JOIN clock USING (part)
WHERE windowStart + INTERVAL '1 hour' + INTERVAL '5 minutes' <= clock""")
def activity_final_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final summaries without the late rows, each window closed by the clock of its partition."""
    return _kept_windows(spark, _shuffled(spark, sf_dir)).output(spark, "final").drop("batch_id")


@query(_alert_sql("VELOCITY"))
def fraud_velocity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocity alerts, each in the micro-batch that crosses the limit."""
    return _posted_stream(spark, sf_dir, lambda stream, home: jobs.velocity_alerts(stream, home, SPARSE)).select(*fraud.ALERT)


@query(_alert_sql("MONEY_MULE"))
def fraud_money_mule_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deposits and debits joined as two streams."""
    return _posted_stream(spark, sf_dir, jobs.mule_alerts)


@query(_alert_sql("IMPOSSIBLE_TRAVEL"))
def fraud_travel_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last locations carried from micro-batch to micro-batch."""
    return _posted_stream(spark, sf_dir, jobs.travel_alerts).select(*fraud.ALERT)


@query(_alert_sql("LARGE_AMOUNT"))
def fraud_large_amount_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posted_stream(spark, sf_dir, jobs.large_amount_alerts)


@query(ORACLES["enriched"])
def enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches joined with the account and customer tables of the moment."""
    p = Pipeline.of(spark, sf_dir)
    rows = _posted_stream(spark, sf_dir, lambda stream, home: jobs.enrich_posted(
        stream, p.accounts(), p.customers(), home))
    return rows.drop("batch_id")


@query(ORACLES["dedup_requests"])
def dedup_requests_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests judged and de-duplicated with the ids that earlier micro-batches saw."""
    p = Pipeline.of(spark, sf_dir)
    job = jobs.Validation(lambda _: p.accounts(), new_folder(spark, "stream-job"))
    replay(p.requests(), "seq", job.run)
    return job.finish(spark).output(spark, "processed").select("seq", "transactionId", "outcome", "reason")


@query(ORACLES["dead_letters"])
def dead_letters_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records through the same job: poison and requests on unknown accounts, bytes untouched (shown as text)."""
    job = _records_job(spark, sf_dir)
    letters = job.output(spark, "dead").unionByName(job.output(spark, "poison")).drop("batch_id")
    return letters.withColumn("value", F.col("value").cast("string"))


def _records_job(spark: SparkSession, sf_dir: str) -> jobs.Validation:
    p = Pipeline.of(spark, sf_dir)
    job = jobs.Validation(lambda _: p.accounts(), new_folder(spark, "stream-job"))
    replay(p.records(), "offset", job.run_records)
    return job.finish(spark)


_SOUND = o.VERDICTS.replace("FROM bank_request q", "FROM (SELECT * FROM bank_request WHERE seq % 101 <> 7) q")


@query(o.q(_SOUND, """
, ok AS (SELECT transactionId, min(seq) AS first FROM verdict WHERE outcome <> 'DEAD_LETTER' GROUP BY 1)
SELECT CASE WHEN v.seq > ok.first THEN 'DUPLICATE' ELSE outcome END AS outcome, count(*) AS n
FROM verdict v LEFT JOIN ok ON ok.transactionId = v.transactionId GROUP BY 1
UNION ALL SELECT 'POISON', count(*) FROM bank_request WHERE seq % 101 = 7
UNION ALL SELECT 'RECORDS', count(*) FROM bank_request"""))
def record_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the records: validated, rejected, duplicate, dead letter and poison add up to all of them."""
    p = Pipeline.of(spark, sf_dir)
    requests = decode.requests_of(p.decoded)
    judged = stage(validation.verdicts(requests, p.account_lookup, p.validation_rules), "judged-records")
    counted = validation.dispositions(judged).groupBy("outcome").agg(F.count("*").alias("n"))
    poison = decode.poison_letters(p.decoded).agg(F.lit("POISON").alias("outcome"), F.count("*").alias("n"))
    return counted.unionByName(poison).unionByName(p.records().agg(F.lit("RECORDS").alias("outcome"), F.count("*").alias("n")))


@query(o.q(o.ledger_of(_SOUND), f"SELECT {o.BOOKING} FROM postings"))
def records_to_ledger_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From key, JSON value and headers to postings: poison leaves before validation and is never booked."""
    done = _records_job(spark, sf_dir).output(spark, "processed").drop("batch_id")
    home = new_folder(spark, "stream-job")
    rows = replay(stage(validation.validated(done), "validated-records"), "seq", lambda stream: jobs.book(stream, home))
    return rows.select(*BOOKING)


@query(ORACLES["ledger_with_transfers"])
def ledger_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger booked micro-batch by micro-batch on the balances carried over."""
    home = new_folder(spark, "stream-job")
    rows = replay(Pipeline.of(spark, sf_dir).validated(), "seq", lambda stream: jobs.book(stream, home))
    return rows.select(*BOOKING)


@query(ORACLES["validation_verdicts"])
def pending_lookup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account in five becomes known a micro-batch late: its requests wait, then get their verdict."""
    p = Pipeline.of(spark, sf_dir)
    home = new_folder(spark, "stream-job")
    late = F.regexp_extract("accountId", "([0-9]+)", 1).cast("bigint") % 5 == 0

    def accounts_at(batch_id: int) -> DataFrame:
        return p.accounts() if batch_id > 0 else p.accounts().where(~late)

    job = jobs.Validation(accounts_at, home)
    replay(p.requests(), "seq", job.run)
    return job.finish(spark).output(spark, "settled").select("seq", "transactionId", "outcome", "reason")


# -- ids remembered by their number: one id per account and kind of transaction, the last 50 count ---

_LAST_IDS = 50
_WALK = f"""
, asked AS MATERIALIZED (
  SELECT seq, accountId || '-' || type AS id, outcome, reason, row_number() OVER (ORDER BY seq) AS k FROM verdict),
walk(k, recent, again) AS (
  SELECT cast(0 AS bigint), cast([] AS varchar[]), false
  UNION ALL
  SELECT k, CASE WHEN again OR dead THEN recent ELSE list_slice(list_append(recent, id), -{_LAST_IDS}, -1) END, again
  FROM (SELECT a.k, w.recent, a.id, a.outcome = 'DEAD_LETTER' AS dead, list_contains(w.recent, a.id) AS again
        FROM walk w JOIN asked a ON a.k = w.k + 1))"""


def _one_id_per_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Pipeline.of(spark, sf_dir).requests().withColumn("transactionId", F.concat_ws("-", "accountId", "type"))


@query(o.q(o.VERDICTS + _WALK, """
SELECT seq, id AS transactionId, CASE WHEN again THEN 'DUPLICATE' ELSE outcome END AS outcome,
       CASE WHEN NOT again THEN reason END AS reason
FROM asked JOIN walk USING (k)"""))
def last_ids_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request, a duplicate if its id is one of the last 50 that were processed."""
    p = Pipeline.of(spark, sf_dir)
    judged = stage(validation.verdicts(_one_id_per_kind(spark, sf_dir), p.account_lookup, p.validation_rules), "judged")
    rows = memory.dispositions(judged, _LAST_IDS, F.col("outcome") == validation.DEAD, validation.DUPLICATE)
    return rows.select("seq", "transactionId", "outcome", "reason")


@query(o.q(o.VERDICTS + _WALK, """
SELECT seq, id AS transactionId, outcome, reason
FROM asked JOIN walk USING (k) WHERE NOT again AND outcome <> 'DEAD_LETTER'"""))
def last_ids_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream, the last 50 ids carried from micro-batch to micro-batch; nothing waits for an account."""
    p = Pipeline.of(spark, sf_dir)
    job = jobs.Validation(lambda _: p.accounts(), new_folder(spark, "stream-job"), policy=RetryPolicy(attempts=1, first_ms=0), memory_ids=_LAST_IDS)
    replay(_one_id_per_kind(spark, sf_dir), "seq", job.run)
    return job.output(spark, "processed").select("seq", "transactionId", "outcome", "reason")


# -- deliveries as streams: outcomes come from the hash of what is delivered ------------------------

def _hash6(column: str):
    return F.conv(F.substring(F.md5(column), 1, 8), 16, 10).cast("bigint")


@query(o.q(o.LEDGER, f"""
, receipt AS (
  SELECT seq, leg, seq * 2 + leg AS place, {o.PART.format('accountId')} AS part,
         CASE WHEN {o.HASH6.format('transactionId')} % 20 = 0 THEN {o.HASH6.format('transactionId')} // 20 % 6 ELSE 0 END AS fails
  FROM posted)
SELECT seq, leg, part AS "partition", CASE WHEN fails >= 4 THEN 'SKIPPED' ELSE 'DELIVERED' END AS outcome,
       cast(least(fails, 3) + 1 AS int) AS attempts, row_number() OVER (PARTITION BY part ORDER BY place) AS number
FROM receipt"""))
def receipt_redelivery_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts in the order of their partition, again from the first failure on; given up after four tries."""
    h = _hash6("transactionId")
    fails = F.when(h % 20 == 0, F.floor(h / 20) % 6).otherwise(0)
    rows = Pipeline.of(spark, sf_dir).posted().select(
        "seq", "leg", (F.col("seq") * 2 + F.col("leg")).alias("place"), driver_tables.partition_of(F.col("accountId")).alias("partition"),
        fails.cast("int").alias("fails"))
    job = delivery.Receipts(new_folder(spark, "stream-job"), lambda n: F.when(n <= F.col("fails"), "GatewayUnavailableException"), polls=60)
    replay(stage(rows, "receipts"), "seq", job.run)
    return job.finish(spark).output(spark).select("seq", "leg", "partition", "outcome", "attempts", "number")


def _tries_sql(rows: str, wait: str, last: str, fatal: str) -> str:
    """Every try of ``rows`` (id, tried_at, fails); ``wait`` gives the seconds after the failure whose number stands for {}."""
    return f"""
, to_send AS ({rows}),
tries AS (
  SELECT id, unnest(range(1, least(CASE WHEN {fatal} THEN 0 ELSE fails END, 3) + 2)) AS attempt, fails, tried_at AS first_at FROM to_send),
timed AS (
  SELECT id, cast(attempt AS int) AS attempt,
         first_at + INTERVAL '1 second' * coalesce(list_sum([{wait.format('n')} FOR n IN range(1, attempt)]), 0) AS "at",
         CASE WHEN {fatal} THEN 'IllegalArgumentException' WHEN attempt <= fails THEN 'GatewayUnavailableException' END AS error,
         {wait.format('attempt')} AS wait
  FROM tries),
acted AS (
  SELECT *, CASE WHEN error IS NULL THEN 'DELIVERED' WHEN attempt >= 4 OR error = 'IllegalArgumentException' THEN '{last}' ELSE 'RETRY' END AS action
  FROM timed)
SELECT id, attempt, "at", error, action, CASE WHEN action = 'RETRY' THEN "at" + INTERVAL '1 second' * wait END AS nextAt FROM acted"""


@query(o.q(o.LEDGER + o.ALERTS, _tries_sql(
    f"SELECT alertId AS id, detectedAt AS tried_at, {o.HASH6.format('alertId')} % 6 AS fails FROM alert",
    "cast(least(pow(2, {} - 1), 10) AS bigint)", "DEAD_LETTER", "fails = 5")))
def alert_delivery_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts tried as they arrive and again when they are due, with growing waits, without holding up others."""
    alerts = fraud.all_alerts(Pipeline.of(spark, sf_dir).posted(), SPARSE)
    rows = alerts.select(F.col("alertId").alias("id"), F.col("detectedAt").alias("at"), (_hash6("alertId") % 6).cast("int").alias("fails"),
                         F.unix_millis("detectedAt").alias("place"))
    error = lambda n: F.when(F.col("fails") == 5, "IllegalArgumentException").when(n <= F.col("fails"), "GatewayUnavailableException")
    job = delivery.DueQueue(new_folder(spark, "stream-job"), error, ALERT_RETRY)
    replay(stage(rows, "alerts"), "place", job.run)
    return job.finish(spark).output(spark).select("id", "attempt", "at", "error", "action", "nextAt")


@query(o.q(o.LEDGER, _tries_sql(
    f"""SELECT seq || '-' || leg AS id, "timestamp" AS tried_at, {o.HASH6.format('transactionId')} % 6 AS fails FROM postings WHERE status = 'REJECTED'""",
    "1 + 0 * {}", "SKIPPED", "false")))
def decline_delivery_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declines of the ledger with a fixed wait between tries; the fourth failure skips the message."""
    rows = Pipeline.of(spark, sf_dir).rejected_by_ledger().select(
        F.concat_ws("-", "seq", "leg").alias("id"), F.col("timestamp").alias("at"), (_hash6("transactionId") % 6).cast("int").alias("fails"), "seq")
    job = delivery.DueQueue(new_folder(spark, "stream-job"), lambda n: F.when(n <= F.col("fails"), "GatewayUnavailableException"), RECEIPT_RETRY,
                            fatal=(), give_up=delivery.SKIPPED, bucket_seconds=3600)
    replay(stage(rows, "declines"), "seq", job.run)
    return job.finish(spark).output(spark).select("id", "attempt", "at", "error", "action", "nextAt")


# -- records of the streams between services, broken ones skipped -----------------------------------

def _as_records(rows: DataFrame, topic: str) -> DataFrame:
    """Transactions as stream records, one in 101 broken."""
    seq = F.col("seq")
    return rows.select(
        F.col("accountId").alias("key"), F.when(seq % 101 == 7, F.lit("{not json")).otherwise(streams.encode(*TRANSACTION_FIELDS)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"), driver_tables.partition_of(F.col("accountId")).alias("partition"), seq.alias("offset"), "timestamp",
        F.array().cast("array<struct<key:string,value:binary>>").alias("headers"))


@query(o.q(o.VERDICTS + o.booking_of("(SELECT * FROM processed WHERE outcome = 'VALIDATED' AND seq % 101 <> 7)"), f"SELECT {o.BOOKING} FROM postings"))
def ledger_from_records_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger on JSON records of the validated stream: a broken one is skipped, and the job goes on."""
    home = new_folder(spark, "stream-job")
    records = stage(_as_records(Pipeline.of(spark, sf_dir).validated(), "bank.transactions.validated"), "validated-records")
    return replay(records, "offset", lambda stream: jobs.book_records(stream, home)).select(*BOOKING)


@query(o.q(o.LEDGER + o.ALERTS.replace("FROM posted WHERE amount >= 10000", "FROM posted WHERE amount >= 10000 AND leg = 0 AND seq % 101 <> 7"),
           f"SELECT {o.ALERT} FROM alert WHERE rule = 'LARGE_AMOUNT'"))
def fraud_from_records_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large-amount alerts from JSON records of the posted stream (credit legs left out), broken ones skipped."""
    home = new_folder(spark, "stream-job")
    posted_rows = Pipeline.of(spark, sf_dir).posted().where("leg = 0")
    records = stage(_as_records(posted_rows, "bank.transactions.posted"), "posted-records")
    return replay(records, "offset", lambda stream: jobs.large_amount_records(stream, home)).select(*fraud.ALERT)


@query(ORACLES["enriched_asof"])
def enriched_moving_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted rows and account changes as one stream: each row meets the version that was current when it arrived."""
    p, home = Pipeline.of(spark, sf_dir), new_folder(spark, "stream-job")
    changes = driver_tables.account_changelog(spark, sf_dir).select("accountId", "seq", "customerId", "accountType", "currency", "status")
    facts = p.posted().select("seq", F.struct("*").alias("fact"))
    mixed = facts.unionByName(changes.select("seq", F.struct("*").alias("version")), allowMissingColumns=True)
    return replay(mixed, "seq", lambda stream: jobs.enrich_moving(stream, p.customer_lookup.df, home)).drop("batch_id")


@query(o.q(o.LEDGER, f"""
, numbered AS (
  SELECT *, {o.PART.format('accountId')} AS part FROM posted)
SELECT accountId AS key, part AS "partition", row_number() OVER (PARTITION BY part ORDER BY seq, leg) - 1 AS "offset",
       transactionId, balanceAfter, CASE WHEN seq % 7 = 0 THEN '-' ELSE 'C-' || seq END AS correlation
FROM numbered"""))
def record_sink_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted rows written as records with gap-free offsets per partition and their headers, then read and decoded."""
    sink = RecordSink(new_folder(spark, "stream-job"), "bank.transactions.posted", "accountId", TRANSACTION_FIELDS,
                      driver_tables.partition_of(F.col("accountId")), F.col("seq") * 2 + F.col("leg"))
    replay(Pipeline.of(spark, sf_dir).posted(), "seq", sink.run)
    read = decode.decode(sink.records(spark), TRANSACTION_DDL, decode.TRANSACTION_ENUMS)
    return read.select("key", "partition", "offset", "payload.transactionId", "payload.balanceAfter",
                       F.coalesce(headers.last_text(F.col("headers"), HEADER_CORRELATION), F.lit("-")).alias("correlation"))
