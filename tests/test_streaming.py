"""Streams against the batch job, over several triggers, restarts and redelivery."""
from __future__ import annotations

import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from samples import DATA
from fraudloom.operators import health, layers
from fraudloom.sources import adapter, streams
from fraudloom.streaming import jobs


def part(rows, low, high):
    """The rows whose place by ingest time lies in the range."""
    place = F.row_number().over(Window.orderBy("ingested_at", "offset")) - 1
    return rows.withColumn("place", place).filter((F.col("place") >= low) & (F.col("place") < high)).drop("place")


def drop_file(rows, path, low, high):
    """One file of a part; files arrive in the order of ingest times."""
    part(rows, low, high).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)  # files are taken by modification time


def run(messages, root, job, **kw):
    if job == "landing":
        jobs.start_landing(messages, f"{root}/out", f"{root}/progress-landing", once=True, **kw).awaitTermination()
        return
    txns = jobs.valid_transactions(messages)
    if not kw.get("copies_count"):
        jobs.start_admission(messages, f"{root}/out", f"{root}/progress-admission", once=True).awaitTermination()
        txns = streams.admitted(messages.sparkSession, f"{root}/out", txns.schema, 2)
    jobs.start_scoring(txns, f"{root}/out", f"{root}/progress-scoring", once=True, **kw).awaitTermination()


def test_stream_equals_batch_across_a_restart(spark, tmp_path):
    root, source = str(tmp_path), str(tmp_path / "in")
    rows = adapter.messages(spark, DATA).cache()
    drop_file(rows, source, 0, 300)
    drop_file(rows, source, 300, 600)
    run(streams.file_messages(spark, source, 1), root, "landing")
    run(streams.file_messages(spark, source, 1), root, "scoring")
    drop_file(rows, source, 600, 10_000)
    run(streams.file_messages(spark, source, 1), root, "landing")  # new queries over the old progress
    run(streams.file_messages(spark, source, 1), root, "scoring")

    want = layers.build_layers(rows, order="arrival")
    for name in ("raw", "dead_letters", "rejected", "processed", "fraud_events"):
        got = spark.read.parquet(f"{root}/out/{name}").select(want[name].columns)
        assert got.exceptAll(want[name]).count() == 0, name
        assert got.count() == want[name].count(), name
    for name in ("cleaned", "suspicious"):
        assert spark.read.parquet(f"{root}/out/{name}").count() == want[name].count()
    rows.unpersist()


def test_redelivered_events(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = adapter.messages(spark, DATA)
    again = rows.withColumns({"offset": F.col("offset") + 500,
                              "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")})
    drop_file(rows, source, 0, 300)
    drop_file(again, source, 0, 300)
    run(streams.file_messages(spark, source, 1), str(tmp_path / "a"), "scoring")
    run(streams.file_messages(spark, source, 1), str(tmp_path / "b"), "scoring", copies_count=True)
    valid = layers.build_layers(part(rows, 0, 300))["processed"].count()
    for run_of in "ab":  # with and without copies as history, an id comes out once
        assert spark.read.parquet(f"{tmp_path}/{run_of}/out/processed").count() == valid
        assert spark.read.parquet(f"{tmp_path}/{run_of}/out/cleaned").count() == valid


def test_an_id_stays_unique_across_days_and_late_first_events_come_through(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = adapter.messages(spark, DATA)
    one_id = F.regexp_replace("value", '"transaction_id":"[^"]*"', '"transaction_id":"same"')
    days = F.regexp_replace(one_id, "2024-01-01T", "2024-01-02T")
    good = rows.filter("offset % 50 > 20")
    drop_file(good.withColumn("value", one_id).limit(3), source, 0, 10_000)
    drop_file(good.withColumn("value", days).limit(3), source, 0, 10_000)
    early = good.withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 5 DAYS"))
    drop_file(early, source, 0, 10_000)  # ids never seen, with an ingest clock that steps back
    run(streams.file_messages(spark, source, 1), str(tmp_path), "scoring")
    got = spark.read.parquet(f"{tmp_path}/out/processed")
    assert got.filter("transaction_id = 'same'").count() == 1
    assert got.filter("transaction_id <> 'same'").count() == layers.build_layers(early)["processed"].count()


def test_outgoing_messages_can_be_sent(spark, tmp_path):
    source, sent = str(tmp_path / "in"), []
    rows = adapter.messages(spark, DATA)
    drop_file(rows, source, 0, 200)

    def send(messages, name):
        sent.append((name, messages.columns, messages.count()))

    run(streams.file_messages(spark, source, 1), str(tmp_path), "scoring", send=send)
    want = layers.build_layers(part(rows, 0, 200))
    for name in ("cleaned", "suspicious"):
        assert sum(n for kind, _, n in sent if kind == name) == want[name].count()
    assert all(columns == ["key", "value"] for _, columns, _ in sent)


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    flagged = layers.build_layers(adapter.messages(spark, DATA))["flagged"]
    for batch_id in (0, 0):
        jobs.append_processed(flagged, str(tmp_path), batch_id)
    assert spark.read.parquet(f"{tmp_path}/processed").count() == flagged.count()


def test_throughput_panel_on_a_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    times = adapter.messages(spark, DATA).select(F.col("ingested_at").alias("processed_at"))
    times.orderBy("processed_at").coalesce(1).write.parquet(source)
    closing = times.agg((F.max("processed_at") + F.expr("INTERVAL 1 HOUR")).alias("processed_at"))
    for i in range(2):  # events that only move the clock on
        time.sleep(1.1)
        closing.select(F.col("processed_at") + F.make_dt_interval(hours=F.lit(i))).toDF(
            "processed_at").write.mode("append").parquet(source)
    stream = spark.readStream.schema("processed_at timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    query = (health.throughput(stream.withWatermark("processed_at", "1 minute")).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", out + "-progress").trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.parquet(out).join(health.throughput(times), ["minute", "txns"], "left_semi").count()
    assert got == health.throughput(times).count()
