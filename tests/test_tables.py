"""Tables changed by folders: what is not touched is neither read nor written."""
from __future__ import annotations

from pathlib import Path

import pytest

from fraudloom.operators import curated, layers, quality, tables
from samples import DATA
from fraudloom.sources import adapter


def state(root):
    """Every data file with its time of change and size."""
    return {str(p.relative_to(root)): (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(root).rglob("*.parquet")}


QUARANTINE = "transaction_id string, failed_checks array<string>"


def test_every_check_has_a_bit(spark):
    from pyspark.sql import functions as F
    codes = {*quality.checks(F.lit(0)), *quality.checks(F.lit(0), "light"), quality.OUT_OF_RANGE}
    assert codes == set(tables.CHECK_BITS)


def test_search_reads_files_of_its_masks_only(spark, tmp_path):
    root = str(tmp_path / "q")
    rows = [("a", ["NULL_AMOUNT"]), ("b", ["INVALID_CITY", "NULL_AMOUNT"]), ("c", ["INVALID_STATUS"]), ("d", ["INVALID_CITY"])]
    tables.write_rejected(spark.createDataFrame(rows, QUARANTINE), root, 0)
    tables.write_rejected(spark.createDataFrame(rows[:2], QUARANTINE), root, 1)
    tables.write_rejected(spark.createDataFrame(rows[:2], QUARANTINE), root, 1)  # the batch runs again

    def found(*codes, **kw):
        return sorted(r["transaction_id"] for r in tables.search_rejected(spark, root, *codes, **kw).collect())

    assert found("INVALID_CITY") == ["b", "b", "d"]
    assert found("INVALID_CITY", "NULL_AMOUNT", every=True) == ["b", "b"]
    assert found("INVALID_CITY", "NULL_AMOUNT") == ["a", "a", "b", "b", "d"]
    assert {r["failed_check"]: r["events"] for r in tables.rejected_summary(spark, root).collect()} == {
        "NULL_AMOUNT": 4, "INVALID_CITY": 3, "INVALID_STATUS": 1}
    plan = tables.search_rejected(spark, root, "INVALID_CITY")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "check_mask" in plan.split("PartitionFilters: [")[1].split("]")[0]
    for file in Path(root).glob(f"*/{tables.MASK}={tables.mask_of(('INVALID_STATUS',))}/*.parquet"):
        file.write_bytes(b"not to be read")
    assert found("INVALID_CITY") == ["b", "b", "d"]
    with pytest.raises(ValueError):
        tables.search_rejected(spark, root, "NO_SUCH_CHECK")


SCORED = "transaction_id string, amount int, fraud_score double, ml_flagged boolean"


@pytest.mark.parametrize("most", [10**6, 0])
def test_scores_rewrite_only_their_buckets(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(tables, "MOST_BROADCAST", most)
    root, rows = str(tmp_path / "t"), [(f"t{k}", k, None, False) for k in range(400)]
    tables.write_by_bucket(spark.createDataFrame(rows, SCORED), root, 8)
    before = state(root)
    scores = spark.createDataFrame([("t7", 0.9, True), ("t7", 0.2, False), ("none", 0.5, False)], "transaction_id string, fraud_score double, ml_flagged boolean")
    touched = tables.write_scores(spark, root, scores, 8)
    after = state(root)
    same = {p for p in before if after.get(p) == before[p]}
    assert touched <= 2 and {p.split("/")[0] for p in set(after) - same} <= {p.split("/")[0] for p in set(before) - same}
    assert len({p.split("/")[0] for p in set(before) - same}) <= touched
    got = {r["transaction_id"]: (r["amount"], r["fraud_score"], r["ml_flagged"]) for r in spark.read.parquet(root).collect()}
    assert got.pop("t7") == (7, 0.9, True)
    assert got == {f"t{k}": (k, None, False) for k in range(400) if k != 7}
    assert tables.write_scores(spark, root, scores.limit(0), 8) == 0 and state(root) == after


def test_broadcast_scores_do_not_move_the_table(spark):
    table = spark.createDataFrame([("t1", 1, None, False)], SCORED)
    scores = spark.createDataFrame([("t1", 0.9, True)], "transaction_id string, fraud_score double, ml_flagged boolean")
    plan = layers.update_scores(table, scores, broadcast=True)._jdf.queryExecution().optimizedPlan().toString()
    text = layers.update_scores(table, scores, broadcast=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Join LeftOuter" in plan


def test_refreshed_days_leave_the_others(spark, tmp_path):
    from pyspark.sql import functions as F
    root = str(tmp_path / "daily")
    flagged = layers.build_layers(adapter.messages(spark, DATA))["processed"]
    day = F.expr("event_time + make_dt_interval(cast(pmod(crc32(transaction_id), 3) as int))")
    rows = flagged.withColumn("event_time", day).cache()
    as_of = F.lit("2024-01-03 09:00:00").cast("timestamp")
    curated.write_daily(curated.merchant_metrics(rows, as_of, 30), root)
    before = state(root)
    curated.write_daily(curated.merchant_metrics(rows, as_of, 1), root)
    changed = {p.split("/")[0] for p in set(before.items()) ^ set(state(root).items()) for p in p[:1]}
    rows.unpersist()
    assert changed == {"window_date=2024-01-02", "window_date=2024-01-03"} and len({p.split("/")[0] for p in before}) == 3
