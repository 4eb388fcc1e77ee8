"""Posted transactions with account and customer data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.operators.lookups import Lookup, lookup_join
from vaultflow.schemas import TRANSACTION_FIELDS
from vaultflow.sources.tables import as_of


def with_customer(rows: DataFrame, customers: Lookup) -> DataFrame:
    """Look the owner up by foreign key; without a match the customer columns stay null."""
    joined = lookup_join(rows.withColumn("_owner", F.col("account.customerId")), customers, "_owner", "customer")
    return joined.select(
        "seq", "leg", F.struct(*TRANSACTION_FIELDS).alias("transaction"), F.col("account.customerId").alias("customerId"),
        F.col("account.accountType").alias("accountType"), F.col("customer.fullName").alias("customerName"),
        F.col("customer.email").alias("customerEmail"), F.col("customer.tier").alias("customerTier"))


def enrich(posted: DataFrame, accounts: Lookup, customers: Lookup) -> DataFrame:
    """Inner join with the account, left join with its customer, both in their latest state."""
    known = lookup_join(posted, accounts, "accountId", "account").where(F.col("account").isNotNull())
    return with_customer(known, customers)


def enrich_as_of(posted: DataFrame, account_changes: DataFrame, customers: Lookup,
                 slice_rows: int = 1_000_000) -> DataFrame:
    """The same with the account as it was when the transaction arrived."""
    fields = ("accountId", "customerId", "accountType", "currency", "status")
    known = as_of(posted, account_changes, "accountId", "seq", fields, "account", slice_rows)
    rows = known.where(F.col("account").isNotNull())
    return with_customer(rows, customers)


def flat(enriched: DataFrame) -> DataFrame:
    """One column per field, the nested transaction spread out."""
    return enriched.select("seq", "leg", "transaction.*", "customerId", "accountType", "customerName",
                           "customerEmail", "customerTier")
