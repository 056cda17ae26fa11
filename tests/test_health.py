"""Histogram quantiles."""
from __future__ import annotations

from datetime import datetime

import pytest

from fraudloom.operators import health


def at(spark, seconds):
    rows = [(datetime(2026, 1, 1, 9, 0, 1), float(s)) for s in seconds]
    return spark.createDataFrame(rows, "observed_at timestamp, seconds double")


@pytest.mark.parametrize("seconds,q,want", [
    ([0.003] * 10, 0.5, 2.5),            # half way into the first bucket, which starts at zero
    ([0.003] * 50 + [0.04] * 50, 0.75, 37.5),
    ([0.003] * 50 + [0.04] * 50, 0.5, 5.0),
    ([5.0] * 10, 0.99, 1000.0),          # above the last bound
    ([0.04] * 100, 0.99, 49.8),
])
def test_quantile_inside_buckets(spark, seconds, q, want):
    row = health.latency_percentiles(at(spark, seconds), (q,), slide=False).first()
    assert row[2] == pytest.approx(want, abs=0.05)


def test_sliding_windows_see_each_event_five_times(spark):
    rows = health.sliding(health.bucket_counts(at(spark, [0.2] * 3), health.PANE)).collect()
    assert len(rows) == 5 and {r["observed"] for r in rows} == {3} and {r["le_5"] for r in rows} == {3}


def test_series_are_filled_with_zero(spark):
    processed = spark.createDataFrame([(datetime(2026, 1, 1, 9, 0, 1),)], "processed_at timestamp")
    fraud = spark.createDataFrame([(datetime(2026, 1, 1, 9, 5, 1),)], "detected_at timestamp")
    got = [(r["txns"], r["alerts"]) for r in health.throughput_vs_alerts(processed, fraud).orderBy("minute").collect()]
    assert got == [(1, 0), (0, 1)]


def test_rows_are_not_copied_per_window(spark):
    plan = health.latency_percentiles(at(spark, [0.2] * 3))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
