from __future__ import annotations

import sys
from pathlib import Path

import pytest

from vaultflow.llm import queries

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import check  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, sf, name):
    assert check.difference(spark, check.connect(sf), name, sf) is None
