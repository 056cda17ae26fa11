"""Limits from a table of periods, and arrival counts without lists."""
from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from fraudloom.operators import features, rules
from fraudloom.sources import adapter
from samples import DATA, START_US, frame, txn

START = datetime.fromtimestamp(START_US / 1e6, timezone.utc)


def table(spark, rows, columns="valid_from timestamp, velocity int, times_average int, failed_burst int"):
    return rules.RulesTable(spark.createDataFrame(rows, columns))


def fired(spark, rows, limits):
    found = rules.evaluate(features.add_features(frame(spark, rows), tail=rules.statuses_needed(limits)), limits).collect()
    return {r["seq"]: {f["rule"]: f["reason"] for f in r["findings"]} for r in found}


def test_limits_change_at_the_stated_instant(spark):
    second = START + timedelta(seconds=10)
    limits = table(spark, [(second, 2, None, None), (START + timedelta(seconds=20), None, None, None)])
    rows = [txn(k, at) for k, at in enumerate((7, 8, 9.999999, 10, 11, 20, 21))]
    hits = {seq for seq, found in fired(spark, rows, limits).items() if "VELOCITY" in found}
    assert hits == {3, 4, 5, 6}  # two earlier events are enough from the tenth second on, four before and after
    assert fired(spark, rows, table(spark, [])) == fired(spark, rows, rules.DEFAULT)


def test_fields_left_null_and_columns_left_out_keep_their_defaults(spark):
    limits = rules.RulesTable(spark.createDataFrame([(START, 3)], "valid_from timestamp, failed_burst int").unionByName(
        spark.createDataFrame([(None, 9)], "valid_from timestamp, failed_burst int")))
    assert limits.n == 1 and rules.statuses_needed(limits) == 10
    rows = [txn(k, 3600 * k, status="FAILED") for k in range(3)] + [txn(3, 4 * 3600)]
    assert "REPEATED_FAILURES" in fired(spark, rows, limits)[3]


def test_a_longer_burst_is_remembered(spark):
    limits = table(spark, [(START, None, None, 12)])
    rows = [txn(k, 3600 * k, status="FAILED") for k in range(12)] + [txn(12, 13 * 3600)]
    assert fired(spark, rows, limits)[12] == {"REPEATED_FAILURES": "12 consecutive failures before a success"}
    assert fired(spark, rows[1:], limits)[12] == {}


def test_of_two_rows_for_one_instant_the_later_revision_counts(spark):
    limits = table(spark, [(START, 9, 1), (START, 1, 2)], "valid_from timestamp, velocity int, revision int")
    assert "VELOCITY" in fired(spark, [txn(0, 0), txn(1, 1)], limits)[1]


def test_many_periods(spark):
    rows = [(START + timedelta(seconds=k), 1 if k % 2 else 100, None, None) for k in range(500)]
    events = [txn(k, k) for k in range(0, 60)]
    hits = {seq for seq, found in fired(spark, events, table(spark, rows)).items() if "VELOCITY" in found}
    assert hits == {k for k in range(1, 60) if k % 2}


def test_the_index_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(rules, "MOST_PERIODS", 2)
    with pytest.raises(ValueError):
        table(spark, [(START + timedelta(days=k), 1, None, None) for k in range(3)])


def test_arrival_counts_need_no_lists_and_no_further_exchange(spark):
    plan = features.add_features(adapter.transactions(spark, DATA, late=True), order="arrival")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "collect_list(event_us" not in text
    assert text.count("Exchange hashpartitioning(user_id") == 1


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_arrival_counts_over_blocks_and_keys(spark, monkeypatch, hot_rows):
    """Blocks of three rows: keys that begin, go on and end within and across blocks."""
    rows = [txn(k, (k * 7919) % 900 * 10, user_id=f"U{k % 11 if k % 3 else 0}") for k in range(600)]
    want = {}
    for row in sorted(rows, key=lambda r: r[2]):
        before = want.setdefault(row[1], [])
        ages = [row[3] - t for _, t, *_ in before[-200:]]
        before.append((row[2], row[3], sum(a <= 3_600_000_000 for a in ages), sum(a <= 60_000_000 for a in ages)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = features.add_features(frame(spark, rows), order="arrival", hot_rows=hot_rows).select(
            "seq", "txns_last_hour", "payment_velocity").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got)) == sorted((seq, h, m) for rows in want.values() for seq, _, h, m in rows)
