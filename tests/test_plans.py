"""The shape of the plans that matter at scale."""
from __future__ import annotations

import re

from pyspark.sql import functions as F

from samples import DATA
from fraudloom import queries
from fraudloom.operators import curated, features, ingest, layers, quality
from fraudloom.plans import hot_keys
from fraudloom.sources import adapter


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, tmp_path, df, name="t"):
    path = str(tmp_path / name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_all_feature_windows_share_one_exchange(spark, tmp_path):
    txns = table(spark, tmp_path, adapter.transactions(spark, DATA))
    text = plan(features.add_features(txns))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "Python" not in text


def test_copies_of_one_key_are_cut_before_the_shuffle(spark, tmp_path):
    txns = table(spark, tmp_path, adapter.transactions(spark, DATA))
    text = plan(layers.first_by_key(txns, "transaction_id"))
    exchange, partial = text.index("Exchange hashpartitioning"), text.index("Partial")
    assert "WindowGroupLimit" in text and partial > exchange  # deeper in the tree: runs before


def test_refresh_pushes_the_time_and_reads_few_columns(spark, tmp_path):
    rows = layers.build_layers(adapter.messages(spark, DATA))["processed"]
    processed = table(spark, tmp_path, rows)
    text = plan(curated.customer_metrics(processed, F.lit("2024-01-02 00:00:00").cast("timestamp")))
    assert "GreaterThanOrEqual(event_time" in text
    schema = re.search(r"ReadSchema: struct<([^\n]*)", text).group(1)
    assert "ip_address" not in schema and "amount" in schema


def test_messages_are_parsed_once_per_pass(spark, tmp_path):
    messages = table(spark, tmp_path, adapter.messages(spark, DATA))
    valid, _ = quality.dq_split(quality.gate(ingest.events(ingest.parse(messages))))
    assert plan(quality.typed(valid)).count("from_json") == 1


def test_city_check_broadcasts_the_ten_cities(spark):
    from fraudloom.schemas import cities
    assert "BroadcastHashJoin" in plan(curated.city_membership(adapter.dirty(spark, DATA), cities(spark)))


def test_rows_of_one_row_group_are_dealt_to_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapter, "ROWS_PER_TASK", 100)
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t")
    dealt = adapter.spread(spark.read.parquet(f"{tmp_path}/t"))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 110


def test_steps_of_a_stream_compute_their_rows_once(spark, monkeypatch):
    monkeypatch.setattr(adapter, "ROWS_PER_TASK", 10)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        calls.add(1)
        return x

    path, n_files = queries.in_steps(spark.range(300).select(counted("id").alias("seq")), "seq", "counted")
    assert calls.value == 300 and n_files == 10
    files = [r["f"] for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()]
    assert len(files) == 30 and spark.read.parquet(path).distinct().count() == 300


def test_features_work_on_tasks_of_bounded_size(spark, monkeypatch):
    rows = adapter.transactions(spark, DATA)
    wanted = {order: features.add_features(rows, order=order).collect() for order in ("arrival", "event_time")}
    monkeypatch.setattr(hot_keys, "ROWS_PER_TASK", 50)
    for order, before in wanted.items():
        made = features.add_features(rows, order=order)
        assert len(re.findall(r"Exchange hashpartitioning\(user_id", plan(made))) == 1
        assert made.rdd.getNumPartitions() == -(-len(before) // 50)
        assert sorted(made.collect(), key=lambda r: r.seq) == sorted(before, key=lambda r: r.seq)
