"""Inputs at and beyond the limits: nothing is lost or changed without a trace."""
from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from samples import DATA, frame, txn
from fraudloom import session
from fraudloom.functions.exact import std_money
from fraudloom.operators import features, ingest, layers, quality, rules
from fraudloom.sources import adapter

SENT = "value string, topic string, partition int, offset long"


def messages(spark, values, **over):
    rows = [(v, "t", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SENT).withColumn("ingested_at", F.expr("TIMESTAMP '2026-01-01 12:00:00'"))


def event(**over):
    return {
        "transaction_id": "a", "user_id": "u", "merchant": "m", "city": "Pune", "device": "d", "amount": "500.00",
        "status": "SUCCESS", "upi_handle": "u@bank", "event_time": "2026-01-01T10:00:00+00:00", **over,
    }


@pytest.mark.parametrize("amounts, want", [
    (["900000000000.00", "900000000200.00"] * 2000, 100.0), (["99999.99", "100000.00"] * 3, 0.01), (["999999999999.99"] * 50, 0.0),
    (["1.00", "2.00", "3.50"], 1.03), (["7.00"], 0.0), ([], None), ([None, "4.00", "8.00"], 2.0),
])
def test_deviation_is_exact_for_any_amount(spark, amounts, want):
    rows = spark.createDataFrame([(a,) for a in amounts], "a string").select(F.col("a").cast("decimal(14,2)").alias("a"))
    assert rows.agg(std_money(F.col("a")).alias("x")).first().x == want


def test_amounts_beyond_the_table_are_judged_and_quarantined(spark):
    times = [f"2026-01-01T10:{k:02d}:00+00:00" for k in range(8)]
    amounts = ["500", "500", "500", "500", "1000000000000", "990000000000", "1e300", "NaN"]
    sent = [json.dumps(event(transaction_id=f"t{k}", amount=a, event_time=t)) for k, (a, t) in enumerate(zip(amounts, times))]
    out = layers.build_layers(messages(spark, sent))
    found = {r.transaction_id for r in out["fraud_events"].where("rule_triggered = 'HIGH_VALUE'").collect()}
    assert found == {"t4", "t5", "t6"}
    refused = {r.transaction_id: r.failed_checks for r in out["rejected"].collect()}
    assert refused == {k: [quality.OUT_OF_RANGE] for k in ("t4", "t6", "t7")}
    assert {r.transaction_id for r in out["processed"].collect()} == {"t0", "t1", "t2", "t3", "t5"}
    assert {json.loads(r.value)["transaction_id"] for r in out["suspicious"].collect()} == found


def test_bursts_longer_than_the_usual_memory(spark):
    rows = frame(spark, [txn(k, k * 4000, status="FAILED") for k in range(10)] + [txn(10, 90_000, status="SUCCESS")])
    limits = rules.Thresholds(failed_burst=10)
    made = features.add_features(rows, tail=rules.statuses_needed(limits))
    found = rules.evaluate(made, limits).filter(rules.conditions(limits)["REPEATED_FAILURES"])
    assert [r.seq for r in found.collect()] == [10]
    with pytest.raises(ValueError, match="failed_burst"):
        rules.evaluate(features.add_features(rows), limits)


VALUES = {
    '{"transaction_id":"a"}': "a", '\n\t {"transaction_id":"b"} \r\n': "b", "{'transaction_id':'c'}": None,
    '{"transaction_id":"d"} xyz': None, '{"transaction_id":"e"}{"transaction_id":"f"}': None, '{"transaction_id":"g"}}tail': None,
    '{"transaction_id":"h","transaction_id":"i"}': "i", '{"transaction_id":"j"},{"transaction_id":"k"}': None, "[1]": None,
    '{"transaction_id":"l","end":"1"}': "l", '{"transaction_id":"m {} } \\" x"}': 'm {} } " x', '{"a":': None, "": None,
    '{"transaction_id":"n"},"end":1}': None, '{"event":{"transaction_id":"o"}}': "",
}


def test_messages_are_one_object_or_dead_letters(spark):
    flat = ingest.parse(messages(spark, VALUES)).collect()
    got = {r.payload: (r.transaction_id or "") if r.error is None else None for r in flat}
    assert got == VALUES
    errors = {r.payload: r.error for r in flat}
    assert errors["[1]"] == "not a JSON object" and errors["{'transaction_id':'c'}"] == "malformed JSON"
    none = ingest.parse(messages(spark, [None])).first()
    assert none.error == "not a JSON object"


def test_outgoing_messages_survive_any_payload(spark):
    payloads = [
        '{"user_id":"u","n":1.5,"n":2,"fraud_findings":7,"_injected_fraud":"X"}', '{"user_id":"u","o":{"k":1,"k":2},"n":1.5}',
    ]
    rows = [(p, "u", True, [("R", "HIGH", "x")]) for p in payloads]
    flagged = spark.createDataFrame(rows, "payload string, user_id string, is_flagged boolean, findings array<struct<rule string,severity string,reason string>>")
    alerts = [json.loads(r.value) for r in layers.suspicious_messages(flagged).collect()]
    assert alerts[0] == {"user_id": "u", "n": 2, "fraud_findings": [{"rule": "R", "severity": "HIGH", "reason": "x"}]}
    assert alerts[1]["o"] == '{"k":1,"k":2}' and alerts[1]["fraud_findings"][0]["rule"] == "R"
    clean = [json.loads(r.value) for r in layers.cleaned_messages(flagged).collect()]
    assert clean[0] == {"user_id": "u", "n": 2, "fraud_findings": 7}


def test_order_does_not_depend_on_offsets_of_other_partitions(spark):
    sent = [(json.dumps(event(transaction_id="same", amount=str(10 + p))), "t", p, 7, p) for p in range(6)]
    rows = spark.createDataFrame(sent, SENT + ", p int").withColumn(
        "ingested_at", F.expr("TIMESTAMP '2026-01-01 12:00:00' - make_dt_interval(0, 0, p)")).drop("p")
    for shuffled in (rows, rows.orderBy(F.desc("partition")), rows.repartition(5)):
        got = layers.build_layers(shuffled)["processed"].collect()
        assert [str(r.amount) for r in got] == ["15.00"]  # the earliest on the ingest clock
    keys = [r.seq for r in ingest.parse(rows).collect()]
    assert len(set(keys)) == len(keys)


def test_a_score_given_twice_multiplies_no_row(spark):
    processed = layers.build_layers(adapter.messages(spark, DATA))["processed"].limit(5).cache()
    twice = processed.select("transaction_id", F.explode(F.array(F.lit(0.2), F.lit(0.9))).alias("fraud_score")).withColumn("ml_flagged", F.col("fraud_score") > 0.8)
    got = layers.update_scores(processed, twice).collect()
    assert len(got) == 5 and all(r.fraud_score == 0.9 and r.ml_flagged for r in got)


def test_a_session_without_a_shared_folder_gets_a_clear_error(spark, monkeypatch):
    class Bare:
        class sparkContext:
            @staticmethod
            def getConf():
                return {}

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Bare)


def test_rows_of_hot_users_carry_short_lists(spark):
    """The search for a segment meets parts of the cuts, never the whole list."""
    from fraudloom.plans.hot_keys import in_segments

    cuts = spark.range(1).select(F.lit("U1").alias("k"), F.sequence(F.lit(10), F.lit(1000), F.lit(10)).alias("cuts"))
    rows = spark.range(1, 1100).select(F.when(F.col("id") % 7 == 0, "U2").otherwise("U1").alias("k"), "id")
    got = in_segments(rows, "k", F.col("id"), cuts).collect()
    assert all(r.segment == (min(r.id // 10, 100) if r.k == "U1" else 0) and r.is_hot == (r.k == "U1") for r in got)
    assert len(got) == 1099


def test_cards_without_features_only_read_the_schema(spark):
    from fraudloom import queries

    names = ("dash_total", "dash_city", "top_merchants_volume", "health_throughput")
    spark.sparkContext.setJobGroup("cards", "building only")
    try:
        for name in names:
            queries.registered()[name](spark, DATA)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("cards")) <= len(names)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_training_publishes_a_model_that_scores(spark, tmp_path):
    from fraudloom.operators import model

    out = layers.build_layers(adapter.messages(spark, "/root/testdata/sf0.01"))
    path = str(tmp_path / "model")
    assert model.load_model(spark, path) == (None, None)
    made = model.publish(out["processed"], out["raw"], path, "2024-01-02", model.TreeParams(trees=3, depth=3))
    loaded, metadata = model.load_model(spark, path)
    assert metadata == made and loaded.getNumTrees == 3
    assert set(made["ml_metrics"]) == set(made["rule_metrics"]) and 0 <= made["pr_auc"] <= 1
    assert abs(sum(made["feature_importances"].values()) - 1) < 0.01
    scored = model.score(out["processed"].drop("fraud_score").limit(50), loaded)
    assert scored.where(F.col("fraud_score").between(0, 1)).count() == 50


def test_profiles_compute_the_features_once(spark):
    from fraudloom import queries

    text = queries.profile(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and not re.search("from_json|haversine|ATAN2", text)


def test_a_payload_is_read_once_per_message_and_not_once_per_member(spark):
    flagged = spark.createDataFrame(
        [('{"user_id":"u","n":1}', "u", True, [("R", "HIGH", "x")])],
        "payload string, user_id string, is_flagged boolean, findings array<struct<rule string,severity string,reason string>>")
    for made in (layers.cleaned_messages(flagged), layers.suspicious_messages(flagged)):
        plan = made._jdf.queryExecution().analyzed().toString()
        assert plan.count("from_json(") == 2  # with typed values and as text
