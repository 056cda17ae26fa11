"""Rules: when they fire, their order, severity and text."""
from __future__ import annotations

from pyspark.sql import functions as F

from samples import DELHI, frame, txn
from fraudloom.operators import features, rules

THERE = {"city": "Delhi", "latitude": DELHI[0], "longitude": DELHI[1]}


def found(spark, rows, **kw):
    flagged = rules.evaluate(features.add_features(frame(spark, rows)), **kw)
    return {r["seq"]: [f.asDict() for f in r["findings"]] for r in flagged.collect()}


def names(findings):
    return [f["rule"] for f in findings]


def test_velocity_from_the_fifth(spark):
    got = found(spark, [txn(i, i * 3) for i in range(6)])
    assert [names(got[i]) for i in range(6)] == [[], [], [], [], ["VELOCITY"], ["VELOCITY"]]
    assert got[4][0] == {"rule": "VELOCITY", "severity": "HIGH", "reason": "4 transactions within 60 seconds"}


def test_impossible_travel(spark):
    got = found(spark, [txn(0), txn(1), txn(2, 300, **THERE)])
    assert names(got[2]) == ["IMPOSSIBLE_TRAVEL"] and got[2][0]["severity"] == "CRITICAL"
    assert got[2][0]["reason"].startswith("1179 km in 300s (~14154") and got[2][0]["reason"].endswith(
        " km/h) between consecutive txns")
    assert names(found(spark, [txn(0), txn(1, 7200, **THERE)])[1]) == []  # a plane could do it
    assert names(found(spark, [txn(0), txn(1, 0.9, **THERE)])[1]) == []  # less than a second apart


def test_high_value_by_multiple_of_average(spark):
    rows = [txn(i, i * 60) for i in range(20)] + [txn(20, 3600, amount=98000)]
    got = found(spark, rows)[20]
    assert got == [{"rule": "HIGH_VALUE", "severity": "HIGH", "reason": "₹98,000 vs 30d avg ₹500 (z=0.0)"}]
    rows[-1] = txn(20, 3600, amount=10000)
    assert names(found(spark, rows)[20]) == ["HIGH_VALUE"]  # exactly twenty times
    rows[-1] = txn(20, 3600, amount=9999.99)
    assert names(found(spark, rows)[20]) == []


def test_high_value_by_zscore(spark):
    rows = [txn(i, i * 60, amount=490 + 20 * (i % 2)) for i in range(20)] + [txn(20, 3600, amount=550)]
    got = found(spark, rows)[20]
    assert got[0]["reason"] == "₹550 vs 30d avg ₹500 (z=5.0)"


def test_new_device_there_and_back(spark):
    got = found(spark, [txn(0), txn(1, 90000, device="other", **THERE), txn(2, 180000), txn(3, 270000, device="x")])
    assert names(got[1]) == ["NEW_DEVICE"] and names(got[2]) == ["NEW_DEVICE"] and names(got[3]) == []
    assert got[1][0]["reason"] == "new device 'other' in new city 'Delhi'"


def test_repeated_failures(spark):
    def run(*statuses):
        last = len(statuses) - 1
        return names(found(spark, [txn(i, i * 100, status=s) for i, s in enumerate(statuses)])[last])

    assert run("FAILED", "FAILED", "FAILED", "SUCCESS") == ["REPEATED_FAILURES"]
    assert run("FAILED", "FAILED", "SUCCESS") == []
    assert run("FAILED", "PENDING", "FAILED", "FAILED", "SUCCESS") == []
    assert run("FAILED", "FAILED", "FAILED", "PENDING") == []


def test_order_of_findings(spark):
    rows = [txn(i, i, status="FAILED") for i in range(5)]
    rows.append(txn(5, 6, amount=90000, device="other", **THERE))
    assert names(found(spark, rows)[5]) == list(rules.SEVERITIES)


def test_out_of_order_never_travels(spark):
    flagged = rules.evaluate(features.add_features(
        frame(spark, [txn(0, 300), txn(1, 0, **THERE)]), order="arrival"))
    assert flagged.filter("seq = 1").first()["findings"] == []


def test_score_is_last_and_missing_score_is_silent(spark):
    df = features.add_features(frame(spark, [txn(i, i) for i in range(8)]))
    scores = {0: 0.79, 1: 0.8, 2: 0.88, 3: 0.95, 5: 0.9, 6: None}
    score = F.create_map(*[F.lit(x) for kv in scores.items() for x in (kv[0], kv[1])])[F.col("seq").cast("int")]
    rows = rules.evaluate(df.withColumn("s", score.cast("double")), score_col="s").collect()
    got = {r["seq"]: [(f["rule"], f["severity"]) for f in r["findings"]] for r in rows}
    assert got[0] == [] and got[1] == [("ML_SCORE", "LOW")] and got[2] == [("ML_SCORE", "MEDIUM")]
    assert got[3] == [("ML_SCORE", "HIGH")] and got[5] == [("VELOCITY", "HIGH"), ("ML_SCORE", "MEDIUM")]
    assert got[6] == [("VELOCITY", "HIGH")]
    by_seq = {r["seq"]: r for r in rows}
    assert by_seq[1]["ml_flagged"] and by_seq[1]["is_flagged"] and not by_seq[1]["rule_flagged"]
    assert not by_seq[7]["ml_flagged"] and by_seq[7]["rule_flagged"]


def test_thresholds_and_light_text(spark):
    rows = [txn(i, i) for i in range(3)]
    got = found(spark, rows, limits=rules.Thresholds(velocity=2))
    assert names(got[2]) == ["VELOCITY"]
    got = found(spark, [txn(0), txn(1, 90000, device="other", **THERE)], light=True)
    assert got[1][0]["reason"] == "new device in new city 'Delhi'"
