"""Registered queries against their DuckDB statements on the smallest tables."""
from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
try:
    import check
except ImportError:  # no DuckDB here
    check = None

import __spark_entry__ as entry
from samples import DATA

KEYS = ["adapter_txns", "features_all", "features_hot_split", "finding_reason", "project_processed", "dq_failed_checks",
        "customer_profile", "merchant_risk", "join_detection", "ml_split", "ml_pr_auc", "health_latency_pcts",
        "archive_scan", "upsert_daily", "demo_stats"]


@pytest.fixture(scope="module")
def db():
    if check is None:
        pytest.skip("DuckDB is not installed")
    return check.connect(DATA)


@pytest.mark.parametrize("key", KEYS)
def test_equals_duckdb(spark, db, key):
    assert check.compare(spark, db, key, DATA) == ""


def test_every_statement_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(k.startswith("op") or k == "pipeline" for k in set(entry.queries()) - set(entry.oracle_sql()))


def test_entry(spark):
    assert entry.entry(spark).count() == 5
