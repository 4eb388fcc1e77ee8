"""The same results in plain SQL (DuckDB dialect), built from common table expressions."""

from __future__ import annotations

PART = "cast(cast('0x' || substr(md5({0}), 1, 8) AS bigint) % 3 AS int)"
HASH6 = "cast('0x' || substr(md5({0}), 1, 8) AS bigint)"

INPUTS = """
bank_event AS (
  SELECT event_id, user_id, event_type, value, date_trunc('millisecond', ts) AS ts,
         cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k
  FROM events),
bank_customer_all AS (
  SELECT c.c_custkey, 'CUST-' || cast(c.c_custkey AS string) AS customerId, c.c_name AS fullName,
         lower(c.c_mktsegment) || '@example.com' AS email, cast(NULL AS varchar) AS phone, n.n_name AS homeCountry,
         CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'GOLD' WHEN 'BUILDING' THEN 'SILVER' ELSE 'STANDARD' END AS tier
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey),
bank_customer AS (SELECT * EXCLUDE (c_custkey) FROM bank_customer_all WHERE c_custkey % 10 <> 9),
bank_account AS (
  SELECT 'ACC-' || cast(c_custkey AS string) AS accountId,
         'CUST-' || cast(cast(floor(c_custkey / 2) AS bigint) AS string) AS customerId,
         CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'CHECKING' ELSE 'SAVINGS' END AS accountType,
         CASE WHEN c_custkey % 11 = 3 THEN 'EUR' ELSE 'USD' END AS currency,
         CASE WHEN c_custkey % 23 = 7 THEN 'FROZEN' WHEN c_custkey % 41 = 5 THEN 'CLOSED' ELSE 'ACTIVE' END AS status,
         c_custkey
  FROM customer),
bank_account_changelog AS (
  SELECT 0 AS seq, accountId, customerId, accountType, currency, 'ACTIVE' AS status FROM bank_account
  UNION ALL
  SELECT 500 + length(accountId) AS seq, accountId, customerId, accountType, currency, status
  FROM bank_account WHERE status <> 'ACTIVE'),
bank_request AS (
  SELECT event_id AS seq,
         'T-' || cast(CASE WHEN event_id % 50 = 49 THEN event_id - 1 ELSE event_id END AS string) AS transactionId,
         CASE WHEN user_id % 29 = 13 THEN 'ACC-X' ELSE 'ACC-' END || cast(user_id AS string) AS accountId,
         CASE event_type WHEN 'signup' THEN 'DEPOSIT' WHEN 'purchase' THEN 'PAYMENT' WHEN 'click' THEN 'WITHDRAWAL'
              WHEN 'view' THEN 'TRANSFER' ELSE CASE WHEN k % 10 = 0 THEN 'TRANSFER_IN' ELSE 'REFUND' END END AS type,
         CASE WHEN event_id % 199 = 5 THEN NULL
              WHEN event_id % 211 = 6 THEN '0.00'
              WHEN event_id % 223 = 8 THEN cast(cast(round(value, 2) AS decimal(18,2)) AS string) || '1'
              ELSE cast(cast(round(value * 100, 2) AS decimal(18,2)) AS string) END AS amountRaw,
         CASE WHEN k >= 97 THEN 'JPY' WHEN k >= 92 THEN 'EUR' ELSE 'USD' END AS currency,
         CASE WHEN event_type = 'view' AND k % 20 <> 19
              THEN 'ACC-' || cast(user_id + k % 7 AS string) END AS counterpartyAccountId,
         CASE k % 5 WHEN 0 THEN 'ATM' WHEN 1 THEN 'MOBILE' WHEN 2 THEN 'ONLINE' WHEN 3 THEN 'BRANCH' END AS channel,
         CASE k % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'SG'
              ELSE CASE WHEN k % 3 <> 0 THEN 'FR' END END AS country,
         cast(NULL AS varchar) AS merchant, ts AS "timestamp"
  FROM bank_event)"""

VERDICTS = INPUTS + """,
verdict AS (
  SELECT seq, transactionId, accountId, type, amountRaw, cast(amt AS decimal(28,2)) AS amount, currency,
         counterpartyAccountId, channel, country, merchant, "timestamp", said[1:1] AS tag,
         CASE said[1:1] WHEN 'V' THEN 'VALIDATED' WHEN 'R' THEN 'REJECTED' ELSE 'DEAD_LETTER' END AS outcome,
         CASE WHEN said <> 'V' THEN said[3:] END AS reason
  FROM (
    SELECT r.*, CASE
      WHEN accountId IS NULL OR type IS NULL OR amountRaw IS NULL
        THEN 'R:MALFORMED: accountId, type and amount are mandatory'
      WHEN amt <= 0 THEN 'R:INVALID_AMOUNT: amount must be positive'
      WHEN length(split_part(amountRaw, '.', 2)) > 2 THEN 'R:INVALID_AMOUNT: more than 2 decimal places'
      WHEN currency IS NULL OR currency NOT IN ('USD', 'EUR', 'GBP', 'INR')
        THEN 'R:UNSUPPORTED_CURRENCY: ' || coalesce(currency, 'null')
      WHEN amt > lim THEN 'R:LIMIT_EXCEEDED: ' || coalesce(channel, 'null') || ' limit is ' || lim
      WHEN a_id IS NULL THEN 'D:Account ' || accountId || ' not (yet) known'
      WHEN a_status <> 'ACTIVE' THEN 'R:ACCOUNT_' || a_status || ': ' || accountId
      WHEN a_ccy <> currency THEN 'R:CURRENCY_MISMATCH: account ' || accountId || ' is in ' || a_ccy
      WHEN type = 'TRANSFER' AND (counterpartyAccountId IS NULL OR counterpartyAccountId = accountId)
        THEN 'R:INVALID_TRANSFER: counterparty must be a different account'
      WHEN type = 'TRANSFER' AND t_id IS NULL THEN 'D:Account ' || counterpartyAccountId || ' not (yet) known'
      WHEN type = 'TRANSFER' AND t_status <> 'ACTIVE'
        THEN 'R:COUNTERPARTY_ACCOUNT_' || t_status || ': ' || counterpartyAccountId
      WHEN type = 'TRANSFER' AND t_ccy <> currency
        THEN 'R:COUNTERPARTY_CURRENCY_MISMATCH: account ' || counterpartyAccountId || ' is in ' || t_ccy
      WHEN type = 'TRANSFER_IN' THEN 'R:INVALID_TYPE: TRANSFER_IN is generated by the ledger only'
      ELSE 'V' END AS said
    FROM (
      SELECT q.*, cast(q.amountRaw AS decimal(18,3)) AS amt,
             CASE upper(q.channel) WHEN 'ATM' THEN 2000 WHEN 'MOBILE' THEN 10000 WHEN 'ONLINE' THEN 25000
                  WHEN 'BRANCH' THEN 100000 ELSE 50000 END AS lim,
             a.accountId AS a_id, a.status AS a_status, a.currency AS a_ccy,
             t.accountId AS t_id, t.status AS t_status, t.currency AS t_ccy
      FROM bank_request q
      LEFT JOIN bank_account a ON a.accountId = q.accountId
      LEFT JOIN bank_account t ON t.accountId = q.counterpartyAccountId) r)),
processed AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY transactionId ORDER BY seq) AS n
    FROM verdict WHERE outcome <> 'DEAD_LETTER') WHERE n = 1)"""


def _ledger(source: str, transfers: bool) -> str:
    """Book ``source`` account by account: each step takes the next row of every account that may go on.

    A credit leg may go on once its debit has been decided.
    """
    legs = """
  UNION ALL
  SELECT seq, 1 AS leg, counterpartyAccountId, transactionId || '-IN', amount, currency, accountId
  FROM ledger_input WHERE type = 'TRANSFER' AND counterpartyAccountId IS NOT NULL""" if transfers else ""
    return f""",
ledger_input AS MATERIALIZED (SELECT * FROM {source}),
ledger_row AS (
  SELECT seq, 0 AS leg, accountId AS a, transactionId AS id,
         cast(CASE WHEN type IN ('DEPOSIT', 'REFUND', 'TRANSFER_IN') THEN amount ELSE -amount END AS decimal(38,2)) AS amt,
         currency AS ccy, cast(NULL AS varchar) AS src
  FROM ledger_input{legs}),
ledger_queue AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY seq, leg) AS pos, count(*) OVER (PARTITION BY a) AS n
  FROM ledger_row),
ledger_event AS MATERIALIZED (
  SELECT e.*, d.pos AS src_pos
  FROM ledger_queue e LEFT JOIN ledger_queue d ON d.a = e.src AND d.seq = e.seq AND d.leg = 0),
ledger_run(a, pos, n, bal, done, last, cnt, ccy, seq, leg, status, before) AS (
  SELECT a, cast(1 AS bigint), any_value(n), cast(0 AS decimal(38,2)), cast([] AS bigint[]), cast(NULL AS varchar),
         cast(0 AS bigint), cast(NULL AS varchar), cast(NULL AS bigint), cast(NULL AS int), cast(NULL AS varchar),
         cast(0 AS decimal(38,2))
  FROM ledger_event GROUP BY a
  UNION ALL
  SELECT a, CASE WHEN ready THEN pos + 1 ELSE pos END, n, CASE WHEN booked THEN bal + amt ELSE bal END,
         CASE WHEN booked AND row_leg = 0 THEN list_append(done, row_seq) ELSE done END,
         CASE WHEN booked THEN id ELSE last END, CASE WHEN booked THEN cnt + 1 ELSE cnt END,
         CASE WHEN booked THEN coalesce(ccy, row_ccy) ELSE ccy END,
         CASE WHEN ready THEN row_seq END, row_leg,
         CASE WHEN booked THEN 'POSTED' WHEN ready AND live AND NOT again THEN 'REJECTED' END, bal
  FROM (
    SELECT *, ready AND live AND NOT again AND funds AS booked
    FROM (
      SELECT r.a, r.pos, r.n, r.bal, r.done, r.last, r.cnt, r.ccy, e.seq AS row_seq, e.leg AS row_leg, e.id, e.amt,
             e.ccy AS row_ccy, e.a IS NOT NULL AND (e.leg = 0 OR s.pos > e.src_pos) AS ready,
             e.leg = 0 OR list_contains(s.done, e.seq) AS live, coalesce(e.id = r.last, false) AS again,
             e.amt >= 0 OR r.bal + e.amt >= 0 AS funds
      FROM ledger_run r
      LEFT JOIN ledger_event e ON e.a = r.a AND e.pos = r.pos
      LEFT JOIN ledger_run s ON s.a = e.src
      WHERE EXISTS (SELECT 1 FROM ledger_run p WHERE p.pos <= p.n)))),
postings AS MATERIALIZED (
  SELECT i.seq, r.leg, i.transactionId || CASE r.leg WHEN 1 THEN '-IN' ELSE '' END AS transactionId,
         CASE r.leg WHEN 1 THEN i.counterpartyAccountId ELSE i.accountId END AS accountId,
         CASE r.leg WHEN 1 THEN 'TRANSFER_IN' ELSE i.type END AS type, i.amount, i.currency,
         CASE r.leg WHEN 1 THEN i.accountId ELSE i.counterpartyAccountId END AS counterpartyAccountId,
         i.channel, i.country, i.merchant, i."timestamp", r.status,
         CASE r.status WHEN 'REJECTED' THEN 'INSUFFICIENT_FUNDS: available ' || r.before || ' '
              || coalesce(r.ccy, i.currency) END AS reason,
         CASE r.status WHEN 'POSTED' THEN r.bal END AS balanceAfter, r.before AS balanceBefore,
         r.cnt AS transactionCount, coalesce(r.ccy, i.currency) AS accountCurrency
  FROM ledger_run r JOIN ledger_input i ON i.seq = r.seq
  WHERE r.status IS NOT NULL),
posted AS (SELECT * FROM postings WHERE status = 'POSTED')"""


def booking_of(source: str) -> str:
    """Booking of ``source``, transfers included."""
    return _ledger(source, transfers=True)


def ledger_of(verdicts: str) -> str:
    """Booking of what ``verdicts`` let through."""
    return verdicts + _ledger("(SELECT * FROM processed WHERE outcome = 'VALIDATED')", transfers=True)


LEDGER = ledger_of(VERDICTS)
LEDGER_ALONE = VERDICTS + _ledger("(SELECT * FROM verdict WHERE outcome = 'VALIDATED')", transfers=False)

SUMMARY = """,
summary AS (
  SELECT accountId, time_bucket(INTERVAL '1 hour', "timestamp") AS windowStart,
         time_bucket(INTERVAL '1 hour', "timestamp") + INTERVAL '1 hour' AS windowEnd,
         count(*) AS transactionCount,
         cast(coalesce(sum(amount) FILTER (type IN ('DEPOSIT', 'REFUND', 'TRANSFER_IN')), 0) AS decimal(38,2))
           AS totalCredits,
         cast(coalesce(sum(amount) FILTER (type NOT IN ('DEPOSIT', 'REFUND', 'TRANSFER_IN')), 0) AS decimal(38,2))
           AS totalDebits
  FROM posted GROUP BY accountId, time_bucket(INTERVAL '1 hour', "timestamp"))"""

# Velocity runs at (1 day, > 2): the tables are too sparse for the default of one minute.
ALERTS = """,
alert_large AS (
  SELECT accountId, transactionId, 'LARGE_AMOUNT' AS rule, 'HIGH' AS severity,
         type || ' of ' || amount || ' ' || currency || ' exceeds 10000' AS description, "timestamp" AS detectedAt,
         '' AS also
  FROM posted WHERE amount >= 10000),
alert_velocity AS (
  SELECT accountId, cast(NULL AS varchar) AS transactionId, 'VELOCITY' AS rule, 'MEDIUM' AS severity,
         '3 debits between ' || strftime(start, '%Y-%m-%dT%H:%M:%SZ') || ' and '
           || strftime(start + INTERVAL '1 day', '%Y-%m-%dT%H:%M:%SZ') AS description,
         start + INTERVAL '1 day' AS detectedAt, '' AS also
  FROM (SELECT accountId, time_bucket(INTERVAL '1 day', "timestamp") AS start, count(*) AS n
        FROM posted WHERE type NOT IN ('DEPOSIT', 'REFUND', 'TRANSFER_IN') GROUP BY ALL)
  WHERE n > 2),
located AS (
  SELECT *, max({'ts': "timestamp", 'seq': seq, 'country': country}) OVER (
           PARTITION BY accountId ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
  FROM posted WHERE country IS NOT NULL AND type <> 'TRANSFER_IN'),
alert_travel AS (
  SELECT accountId, transactionId, 'IMPOSSIBLE_TRAVEL' AS rule, 'CRITICAL' AS severity,
         'Used in ' || p.country || ' and ' || country || ' within '
           || cast(floor(abs(epoch_ms("timestamp") - epoch_ms(p.ts)) / 60000) AS bigint) || ' min' AS description,
         "timestamp" AS detectedAt, '' AS also
  FROM located
  WHERE p.country <> country AND abs(epoch_ms("timestamp") - epoch_ms(p.ts)) <= 1800000),
alert_mule AS (
  SELECT b.accountId, b.transactionId, 'MONEY_MULE' AS rule, 'HIGH' AS severity,
         'Deposit of ' || d.amount || ' followed by ' || b.type || ' of ' || b.amount || ' within 30 min' AS description,
         b."timestamp" AS detectedAt, '~' || d.transactionId AS also
  FROM posted d JOIN posted b ON d.accountId = b.accountId
  WHERE d.type IN ('DEPOSIT', 'REFUND', 'TRANSFER_IN') AND b.type NOT IN ('DEPOSIT', 'REFUND', 'TRANSFER_IN')
    AND d.amount >= 5000 AND b.amount >= 5000
    AND b."timestamp" BETWEEN d."timestamp" AND d."timestamp" + INTERVAL '30 minutes'),
alert AS (
  SELECT sha256(rule || '~' || accountId || '~' || coalesce(transactionId, '') || '~' || epoch_ms(detectedAt) || also)
           AS alertId, accountId, transactionId, rule, severity, description, detectedAt
  FROM (SELECT * FROM alert_large UNION ALL SELECT * FROM alert_velocity
        UNION ALL SELECT * FROM alert_travel UNION ALL SELECT * FROM alert_mule))"""

MESSAGES = SUMMARY + ALERTS + """,
rejected_all AS (
  SELECT seq, transactionId, accountId, type, amount, amountRaw, currency, "timestamp", reason
  FROM processed WHERE outcome = 'REJECTED'
  UNION ALL
  SELECT seq, transactionId, accountId, type, amount, cast(amount AS varchar), currency, "timestamp", reason
  FROM postings WHERE status = 'REJECTED'),
message AS (
  SELECT 'PUSH' AS channel, 'owner-of-' || accountId AS recipient, accountId,
         type || ' of ' || amount || ' ' || currency || ' posted. New balance: ' || balanceAfter || ' ' || currency
           AS message, "timestamp" AS sentAt FROM posted
  UNION ALL
  SELECT 'EMAIL', 'owner-of-' || accountId, accountId, 'Your ' || coalesce(type, 'null') || ' of '
           || coalesce(amountRaw, 'null') || ' ' || coalesce(currency, 'null') || ' was declined: ' || reason, "timestamp"
  FROM rejected_all
  UNION ALL
  SELECT 'SMS', 'owner-of-' || accountId, accountId, 'Security alert [' || severity || '] ' || description
           || '. Reply NO if this was not you.', detectedAt FROM alert
  UNION ALL
  SELECT 'EMAIL', 'owner-of-' || accountId, accountId, 'Activity ' || strftime(windowStart, '%Y-%m-%dT%H:%M:%SZ')
           || ' - ' || strftime(windowEnd, '%Y-%m-%dT%H:%M:%SZ') || ': ' || transactionCount || ' transactions, in '
           || totalCredits || ', out ' || totalDebits || ', net ' || cast(totalCredits - totalDebits AS decimal(38,2)),
         windowEnd FROM summary
  WHERE windowEnd + INTERVAL '5 minutes' <= (SELECT max("timestamp") FROM posted))"""

TXN = ('transactionId, accountId, type, amount, currency, counterpartyAccountId, channel, country, merchant, '
       '"timestamp", status, reason, balanceAfter')
TXN_P = ", ".join(f"p.{c.strip()}" for c in TXN.split(","))
BOOKING = f"seq, leg, {TXN}, balanceBefore, transactionCount, accountCurrency"
REQ = ('seq, transactionId, accountId, type, amount, amountRaw, currency, counterpartyAccountId, channel, country, '
       'merchant, "timestamp"')
ALERT = "alertId, accountId, transactionId, rule, severity, description, detectedAt"


def q(prefix: str, body: str) -> str:
    return f"WITH RECURSIVE {prefix.strip()}\n{body.strip()}"
