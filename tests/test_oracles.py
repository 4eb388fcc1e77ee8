"""Every query against its SQL on the smallest data set, and what must hold across queries."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from vaultflow.plans import catalog  # noqa: E402
from vaultflow.plans.pipeline import Pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_same_as_sql(spark, con, name):
    assert name in entry.oracle_sql()
    assert check.difference(spark, con, name, SF) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_request_ends_up_somewhere(spark):
    p = Pipeline.of(spark, SF)
    fates = {r.outcome: r["count"] for r in catalog.QUERIES["request_dispositions"](spark, SF).groupBy("outcome")
             .count().collect()}
    assert sum(fates.values()) == p.requests().count()
    assert fates["VALIDATED"] == p.validated().count() == p.postings.where("leg = 0").count()
    assert fates["REJECTED"] == p.rejected_by_rules().count()


def test_known_totals(spark):
    """Totals of a sequential replay (see FIXTURES.md)."""
    p = Pipeline.of(spark, SF)
    assert p.posted().count() == 415 and p.rejected_by_ledger().count() == 53
    assert str(p.balances().agg(F.sum("balance")).first()[0]) == "211671.00"


@pytest.mark.parametrize("name", ["enriched", "enriched_asof", "fraud_alerts", "notifications", "dedup_requests",
                                  "ledger_with_transfers", "late_rows"])
def test_plans_have_no_cross_join(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_plans_prune_and_push(spark):
    def plan(name):
        return catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()

    lookup = plan("balance_lookup")
    assert "EqualTo(accountId,ACC-1)" in lookup and "merchant" not in lookup
    large = plan("fraud_large_amount")
    assert "GreaterThanOrEqual(amount" in large and "Exchange" not in large
    assert plan("dedup_requests").count("WindowGroupLimit") == 2  # before and after the shuffle
    assert "partial_count" in plan("activity_summary")
