"""Sinks, reruns, curated tables and the archive."""
from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from samples import DATA, frame, txn
from fraudloom.operators import curated, layers
from fraudloom.sources import adapter, archive


@pytest.fixture(scope="module")
def built(spark):
    return layers.build_layers(adapter.messages(spark, DATA))


def test_every_message_lands_once(spark, built):
    n = adapter.messages(spark, DATA).count()
    raw, letters = built["raw"].count(), built["dead_letters"].count()
    assert raw + letters == n and letters == 60
    assert built["processed"].count() + built["rejected"].count() == raw


def test_payload_is_kept_verbatim(spark, built):
    sent = adapter.messages(spark, DATA).select("offset", "value")
    kept = built["raw"].select("offset", F.col("payload").alias("value"))
    assert kept.exceptAll(sent).count() == 0


def test_unstaged_build_is_the_same(spark, built):
    plain = layers.build_layers(adapter.messages(spark, DATA), stage=False)
    for name in ("processed", "fraud_events", "rejected"):
        assert plain[name].exceptAll(built[name]).count() == 0
        assert plain[name].count() == built[name].count()


def test_outgoing_messages(built):
    cleaned = [json.loads(r["value"]) for r in built["cleaned"].collect()]
    assert all("_injected_fraud" not in m for m in cleaned)
    assert isinstance(cleaned[0]["latitude"], float) and isinstance(cleaned[0]["amount"], str)
    alerts = built["suspicious"].collect()
    assert len(alerts) == built["flagged"].filter("is_flagged").count()
    assert all(json.loads(r["value"])["fraud_findings"][0]["rule"] for r in alerts)


def test_first_copy_wins_and_target_wins(spark):
    rows = frame(spark, [txn(0, transaction_id="a"), txn(1, transaction_id="a", amount=9), txn(2, transaction_id="b")])
    assert [r["seq"] for r in layers.first_by_key(rows, "transaction_id").orderBy("seq").collect()] == [0, 2]
    there = rows.filter("seq = 2")
    assert [r["seq"] for r in layers.insert_if_absent(there, rows, "transaction_id").collect()] == [0]


def test_writing_a_batch_again_replaces_it(spark, tmp_path, built):
    path = str(tmp_path / "fraud")
    for batch_id in (0, 1, 1):
        layers.append_batch(built["fraud_events"], path, batch_id)
    assert spark.read.parquet(path).count() == 2 * built["fraud_events"].count()


def test_retain_latest(spark):
    df = frame(spark, [txn(i, i) for i in range(10)]).withColumn("event_time", F.timestamp_micros("event_us"))
    assert sorted(r["seq"] for r in layers.retain_latest(df, 3).collect()) == [7, 8, 9]


def test_update_scores_leaves_other_rows(spark, built):
    table = built["processed"].select("transaction_id", "fraud_score", "ml_flagged")
    one = table.orderBy("transaction_id").limit(1).select("transaction_id", F.lit(0.9).alias("fraud_score"),
                                                          F.lit(True).alias("ml_flagged"))
    got = layers.update_scores(table, one)
    assert got.filter("fraud_score = 0.9 AND ml_flagged").count() == 1
    assert got.filter("fraud_score IS NULL AND NOT ml_flagged").count() == table.count() - 1


def archive_rows(spark):
    start = datetime(2026, 1, 1, 22, 0)
    rows = [(f"t{i}", "{}", "raw", 0, i, start + timedelta(minutes=20 * i)) for i in range(12)]
    return spark.createDataFrame(
        rows, "transaction_id string, payload string, topic string, partition int, offset bigint, ingested_at timestamp")


def test_archive_hours(spark, tmp_path):
    root = str(tmp_path / "archive")
    raw = archive_rows(spark)
    for hour in (22, 23, 22):  # the first hour twice
        archive.archive_hour(raw, datetime(2026, 1, 1, hour, 31), root)
    archive.archive_hour(raw, datetime(2026, 1, 2, 1, 0), root)
    archive.archive_hour(raw, datetime(2026, 1, 5, 1, 0), root)  # nothing there
    folders = sorted(str(p.relative_to(root)) for p in (tmp_path / "archive").glob("year=*/month=*/day=*/hour=*"))
    assert folders == ["year=2026/month=01/day=01/hour=22", "year=2026/month=01/day=01/hour=23",
                       "year=2026/month=01/day=02/hour=01"]
    assert spark.read.parquet(root).count() == 9
    got = archive.scan_archive(spark, root, datetime(2026, 1, 1, 22, 40), datetime(2026, 1, 2, 1, 1))
    assert sorted(r["offset"] for r in got.collect()) == [2, 3, 4, 5, 9]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def day(spark, rows):
    return spark.createDataFrame(rows, "merchant string, window_date string, txn_count int")


def test_daily_upsert(spark, tmp_path):
    old = day(spark, [("a", "2026-01-01", 1), ("a", "2026-01-02", 1), ("b", "2026-01-02", 1)])
    new = day(spark, [("a", "2026-01-02", 7), ("c", "2026-01-02", 7)])
    got = curated.upsert_daily(old, new, ("merchant", "window_date"))
    assert sorted(map(tuple, got.collect())) == [("a", "2026-01-01", 1), ("a", "2026-01-02", 7),
                                                 ("b", "2026-01-02", 1), ("c", "2026-01-02", 7)]
    path = str(tmp_path / "daily")
    curated.write_daily(old, path)
    curated.write_daily(new, path)
    curated.write_daily(new, path)
    kept = spark.read.parquet(path).select("merchant", F.col("window_date").cast("string"), "txn_count")
    assert sorted(map(tuple, kept.collect())) == [("a", "2026-01-01", 1), ("a", "2026-01-02", 7),
                                                  ("c", "2026-01-02", 7)]


def test_refresh_takes_whole_days(spark, built):
    rows = built["processed"]
    late = curated.merchant_metrics(rows, F.lit("2024-01-02 23:59:00").cast("timestamp"))
    assert late.agg(F.sum("txn_count")).first()[0] == rows.count()
    after = curated.merchant_metrics(rows, F.lit("2024-01-03 00:00:00").cast("timestamp"))
    assert after.count() == 0


def test_tiers_and_bands(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (24.99,), (25.0,)], "r double")
    assert [r[0] for r in df.select(curated.risk_tier(F.col("r"))).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]
    df = spark.createDataFrame([(499.99,), (500.0,), (1000.0,), (2000.0,)], "r double")
    assert [r[0] for r in df.select(curated.spend_band(F.col("r"))).collect()] == [
        "<500", "500-1000", "1000-2000", "2000+"]


def test_empty_tables_do_not_divide_by_zero(spark, built):
    none = built["processed"].filter("false")
    row = curated.executive_summary(none).first()
    assert row["total_transactions"] == 0 and row["success_rate_pct"] is None and row["avg_amount"] is None
    stats = curated.demo_stats(none, built["rejected"], built["fraud_events"])["summary"].first()
    assert stats["success_rate"] == 0.0 and stats["rejected"] == built["rejected"].count()
