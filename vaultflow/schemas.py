"""Record schemas, fixed vocabularies and rule parameters."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# Record schemas as Spark DDL (field names are the wire format).
TRANSACTION_DDL = """
    transactionId STRING, accountId STRING, type STRING, amount DECIMAL(28,2), currency STRING,
    counterpartyAccountId STRING, channel STRING, country STRING, merchant STRING,
    timestamp TIMESTAMP, status STRING, reason STRING, balanceAfter DECIMAL(38,2)
"""
TRANSACTION_FIELDS = (
    "transactionId", "accountId", "type", "amount", "currency", "counterpartyAccountId", "channel",
    "country", "merchant", "timestamp", "status", "reason", "balanceAfter",
)
ACCOUNT_DDL = """
    accountId STRING, customerId STRING, accountType STRING, currency STRING, status STRING,
    updatedAt TIMESTAMP
"""
CUSTOMER_DDL = """
    customerId STRING, fullName STRING, email STRING, phone STRING, homeCountry STRING, tier STRING
"""
BALANCE_DDL = """
    accountId STRING, balance DECIMAL(38,2), currency STRING, transactionCount BIGINT,
    lastTransactionId STRING, updatedAt TIMESTAMP
"""
SUMMARY_DDL = """
    accountId STRING, windowStart TIMESTAMP, windowEnd TIMESTAMP, transactionCount BIGINT,
    totalCredits DECIMAL(38,2), totalDebits DECIMAL(38,2)
"""
ALERT_DDL = """
    alertId STRING, accountId STRING, transactionId STRING, rule STRING, severity STRING,
    description STRING, detectedAt TIMESTAMP
"""
NOTIFICATION_DDL = """
    channel STRING, recipient STRING, accountId STRING, message STRING, sentAt TIMESTAMP
"""
ENVELOPE_DDL = """
    key STRING, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP,
    headers ARRAY<STRUCT<key: STRING, value: BINARY>>
"""

# Vocabularies.
CREDIT_TYPES = ("DEPOSIT", "TRANSFER_IN", "REFUND")
DEBIT_TYPES = ("WITHDRAWAL", "PAYMENT", "TRANSFER")
TRANSACTION_TYPES = ("DEPOSIT", "WITHDRAWAL", "PAYMENT", "TRANSFER", "TRANSFER_IN", "REFUND")
TRANSACTION_STATUSES = ("REQUESTED", "VALIDATED", "POSTED", "REJECTED")
ACCOUNT_STATUSES = ("ACTIVE", "FROZEN", "CLOSED")
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
CASE_SEVERITIES = ("HIGH", "CRITICAL")

# Record headers.
HEADER_CORRELATION = "x-correlation-id"
HEADER_SOURCE = "x-source-system"
HEADER_EVENT_TYPE = "x-event-type"

# Stream names and how long each is kept in days (None = compacted, -1 = forever).
STREAM_RETENTION_DAYS = {
    "bank.customers": None,
    "bank.accounts": None,
    "bank.balances": None,
    "bank.transactions.requested": 7,
    "bank.transactions.requested.DLT": 30,
    "bank.transactions.validated": 7,
    "bank.transactions.posted": 30,
    "bank.transactions.rejected": 30,
    "bank.transactions.enriched": 7,
    "bank.account.activity-summary": 30,
    "bank.fraud.alerts": 30,
    "bank.fraud.cases": -1,
}
REQUESTED = "bank.transactions.requested"
DEAD_LETTER_SUFFIX = ".DLT"


@dataclass(frozen=True)
class ValidationRules:
    currencies: tuple[str, ...] = ("USD", "EUR", "GBP", "INR")
    channel_limits: dict[str, int] = field(
        default_factory=lambda: {"ATM": 2000, "MOBILE": 10000, "ONLINE": 25000, "BRANCH": 100000}
    )
    default_limit: int = 50000


@dataclass(frozen=True)
class LedgerRules:
    overdraft: Decimal = Decimal("0")
    transfers: bool = True
    # An account with more rows than this is folded in several slices of at most this many
    # sequence numbers.
    slice_rows: int = 1_000_000


@dataclass(frozen=True)
class ActivityRules:
    window: str = "1 hour"
    grace: str = "5 minutes"


@dataclass(frozen=True)
class FraudRules:
    large_amount: Decimal = Decimal("10000")
    velocity_window: str = "1 minute"
    velocity_max: int = 5
    travel_minutes: int = 30
    mule_minutes: int = 30
    mule_amount: Decimal = Decimal("5000")


@dataclass(frozen=True)
class RetryPolicy:
    """``attempts`` counts every try; the n-th wait is ``first * factor ** (n - 1)`` up to ``longest``."""

    attempts: int
    first_ms: int
    factor: float = 1.0
    longest_ms: int | None = None


# The three retry policies of the platform.
VALIDATION_RETRY = RetryPolicy(attempts=4, first_ms=500, factor=2.0, longest_ms=10_000)
ALERT_RETRY = RetryPolicy(attempts=4, first_ms=1000, factor=2.0, longest_ms=10_000)
RECEIPT_RETRY = RetryPolicy(attempts=4, first_ms=1000)
