"""The platform end to end: requests -> verdicts -> ledger -> everything that reads posted rows.

Like the streams between services, the tables that several jobs read
(`request_table`, `decoded`, `processed` and `postings`) are written once per session and data folder
and then read as tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vaultflow.operators import enrich, ledger, validation
from vaultflow.operators.lookups import Lookup
from vaultflow.schemas import TRANSACTION_DDL, LedgerRules, ValidationRules
from vaultflow.session import new_folder, stage
from vaultflow.sources import decode, driver_tables, tables

_open: dict[tuple[str, str], "Pipeline"] = {}


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.validation_rules = ValidationRules()
        self.ledger_rules = LedgerRules()

    @staticmethod
    def of(spark: SparkSession, sf_dir: str) -> "Pipeline":
        """The pipeline of this session and data folder, so its tables are written once."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _open:
            _open[key] = Pipeline(spark, sf_dir)
        return _open[key]

    # -- inputs ----------------------------------------------------------------------------------
    @cached_property
    def request_table(self) -> DataFrame:
        """The requested stream as ingest leaves it (written)."""
        return stage(driver_tables.carried(driver_tables.requests(self.spark, self.sf_dir)), "requests")

    def requests(self) -> DataFrame:
        return self.request_table

    def records(self) -> DataFrame:
        return driver_tables.request_records(self.requests())

    @cached_property
    def decoded(self) -> DataFrame:
        """Request records with their payload or decode error, JSON parsed once (written)."""
        return stage(decode.decode(self.records(), TRANSACTION_DDL, decode.TRANSACTION_ENUMS), "decoded")

    def accounts(self) -> DataFrame:
        """Latest state per account, from the change log."""
        fields = ("accountId", "customerId", "accountType", "currency", "status")
        changes = driver_tables.account_changelog(self.spark, self.sf_dir)
        return tables.latest(changes, "accountId", F.struct(*fields), "seq")

    def customers(self) -> DataFrame:
        """Latest state per customer, erased ones gone."""
        changes = driver_tables.customer_changelog(self.spark, self.sf_dir)
        return tables.latest(changes, "customerId", F.col("value"), "offset")

    @cached_property
    def account_lookup(self) -> Lookup:
        """Accounts for joins (written: several joins of one query read them)."""
        return Lookup(stage(self.accounts(), "accounts"), "accountId")

    @cached_property
    def customer_lookup(self) -> Lookup:
        """Customers for joins (written)."""
        return Lookup(stage(self.customers(), "customers"), "customerId")

    # -- validation ------------------------------------------------------------------------------
    def verdicts(self) -> DataFrame:
        return validation.verdicts(self.requests(), self.account_lookup, self.validation_rules)

    @cached_property
    def processed(self) -> DataFrame:
        """Validated and rejected requests, resubmissions removed (written)."""
        return validation.write_processed(self.verdicts(), self.requests())

    def validated(self) -> DataFrame:
        return validation.validated(self.processed)

    def rejected_by_rules(self) -> DataFrame:
        return validation.rejected(self.processed)

    # -- ledger ----------------------------------------------------------------------------------
    @cached_property
    def postings(self) -> DataFrame:
        """Posted and rejected bookings with transfers settled (written)."""
        return ledger.book(self.validated(), self.ledger_rules)

    def posted(self) -> DataFrame:
        return self.postings.where(F.col("status") == "POSTED")

    def rejected_by_ledger(self) -> DataFrame:
        """The default branch: everything that was not posted."""
        return self.postings.where(~F.coalesce(F.col("status") == "POSTED", F.lit(False)))

    def balances(self) -> DataFrame:
        return ledger.balances_of(self.posted())

    @cached_property
    def balance_table(self) -> tuple[str, StructType, int]:
        """Folder and columns of the balances, and the number of folders by account hash that they fill (written)."""
        rows, path = stage(self.balances(), "balance-rows"), new_folder(self.spark, "balances")
        return path, rows.schema, tables.write_sized(rows, "accountId", path)

    def balance_of(self, account: str) -> DataFrame:
        """Served from the kept state: one folder is opened, nothing is aggregated."""
        path, schema, parts = self.balance_table
        return tables.one_key(self.spark, path, schema, "accountId", account, parts)

    def enriched(self) -> DataFrame:
        return enrich.enrich(self.posted(), self.account_lookup, self.customer_lookup)
