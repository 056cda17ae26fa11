"""Every operator as a query over the tables of a data folder."""
from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudloom import schemas
from fraudloom.operators import (
    curated, dashboards, features, health, ingest, layers, model, profile_states, quality, rules, tables,
)
from fraudloom.session import checkpoint_root, configure, scratch_folder
from fraudloom.sources import adapter, archive, files, streams
from fraudloom.streaming import health as panels
from fraudloom.streaming import jobs, state

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types every engine compares alike."""
    def simple(field: T.StructField) -> Column:
        col, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.TimestampType):
            col = F.unix_micros(col)
        elif isinstance(kind, T.DateType):
            col = col.cast("string")
        elif isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, T.IntegerType):
            col = col.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(col, ",")
        return col.alias(field.name)

    return df.select(*[simple(f) for f in df.schema.fields])


# ---- frames the queries start from ------------------------------------------------------------------

def txns(spark: SparkSession, d: str, **kw) -> DataFrame:
    return adapter.transactions(spark, d, **kw)


def flagged(spark: SparkSession, d: str, **kw) -> DataFrame:
    events = txns(spark, d, **kw).withColumn("ingested_at", F.timestamp_micros("ingested_us"))
    return rules.evaluate(features.add_features(events))


def processed(spark: SparkSession, d: str, **kw) -> DataFrame:
    return layers.processed_rows(flagged(spark, d, **kw))


def stored(spark: SparkSession, d: str) -> DataFrame:
    """The processed layer's columns that need no features; nothing is computed to get them."""
    return txns(spark, d, dealt=False).select(
        *schemas.EVENT_FIELDS, F.timestamp_micros("event_us").alias("event_time"),
        F.timestamp_micros("ingested_us").alias("processed_at"))


def fraud(spark: SparkSession, d: str) -> DataFrame:
    return layers.fraud_rows(flagged(spark, d))


def both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Processed and fraud layer of features that are computed once."""
    rows = layers.staged(flagged(spark, d).drop("recent_statuses"), "flagged")
    return layers.processed_rows(rows), layers.fraud_rows(rows)


def clock() -> Column:
    return F.lit(adapter.AS_OF).cast("timestamp")


def profile(spark: SparkSession, d: str) -> DataFrame:
    return curated.customer_profile(*both(spark, d), clock())


def risk(spark: SparkSession, d: str) -> DataFrame:
    return curated.merchant_risk(*both(spark, d), clock())


def written_once(name: str, made: Query) -> Query:
    """A table that the first of its readers in this application writes for a data folder and all read."""
    def read(spark: SparkSession, d: str) -> DataFrame:
        folder = hashlib.sha256(f"{spark.sparkContext.applicationId} {d}".encode()).hexdigest()
        path = f"{checkpoint_root(spark).rstrip('/')}/curated-{folder}/{name}"
        files.publish(spark, path, lambda place: made(spark, d).write.mode("overwrite").parquet(place))
        return spark.read.parquet(path)

    return read


def customer_profile_refresh(spark: SparkSession, d: str) -> DataFrame:
    """The profile from states of days: all days as they were at noon of the last one, then that day anew."""
    rows = layers.staged(flagged(spark, d, squeeze=10).drop("recent_statuses"), "flagged")
    table, found, root = layers.processed_rows(rows), layers.fraud_rows(rows), scratch_folder(spark, "profile-states")
    span = table.agg(F.to_date(F.min("event_time")).alias("first"), F.to_date(F.max("event_time")).alias("last")).first()
    noon = F.lit(str(span["last"])).cast("timestamp") + F.expr("INTERVAL 12 HOURS")
    profile_states.refresh_days(spark, table.where(F.col("event_time") < noon), root, span["first"], span["last"])
    profile_states.refresh_days(spark, table, root, span["last"], span["last"])
    return profile_states.read_profile(spark, root, found, clock())


def gated(spark: SparkSession, d: str, profile_name: str = "full") -> DataFrame:
    return quality.gate(adapter.dirty(spark, d), F.lit(adapter.GATE_CLOCK_US), profile_name)


def parsed(spark: SparkSession, d: str) -> DataFrame:
    return ingest.parse(adapter.messages(spark, d))


def all_layers(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return layers.build_layers(adapter.messages(spark, d))


def rejected(spark: SparkSession, d: str) -> DataFrame:
    return quality.rejected_rows(quality.dq_split(quality.gate(ingest.events(parsed(spark, d))))[1])


def written(df: DataFrame, name: str, times: int = 1) -> DataFrame:
    """``df`` after a trip through a table, written ``times`` times as the same batch."""
    path = scratch_folder(df.sparkSession, name)
    for _ in range(times):
        layers.append_batch(df, path, 0)
    return df.sparkSession.read.parquet(path).drop("batch_id")


# ---- sources and sinks --------------------------------------------------------------------------------

STEP_FILES = 4  # of a small step


def in_steps(rows: DataFrame, order: str, name: str, steps: int = 3) -> tuple[str, int]:
    """``rows`` as files in arrival order: the folder, and the files that each step adds, one trigger's worth.

    The rows are computed once, and files grow in number and not in size.
    """
    spark = rows.sparkSession
    rows, path = layers.staged(rows, f"{name}-rows"), scratch_folder(spark, name)
    found = rows.agg(F.max(order).alias("last"), F.count("*").alias("rows")).first()
    last, n_files = found["last"] + 1, max(STEP_FILES, -(-found["rows"] // (steps * adapter.ROWS_PER_TASK)))
    for i in range(steps):
        low, high = last * i // steps, last * (i + 1) // steps
        part = rows.filter((F.col(order) >= low) & (F.col(order) < high))
        part.repartition(n_files).write.mode("append").parquet(path)
    return path, n_files


def src_stream(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_folder(spark, "stream-out")
    stream = streams.file_messages(spark, *in_steps(adapter.messages(spark, d), "offset", "messages"))
    query = (stream.select("topic", "partition", "offset", F.length("value").alias("chars")).writeStream
             .format("parquet").option("path", out).option("checkpointLocation", out + "-progress")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out)


def parse_json_dlq(spark: SparkSession, d: str) -> DataFrame:
    letters = ingest.dead_letters(parsed(spark, d))
    body = F.from_json("value", "error string, raw string")
    return letters.select("key", "offset", body["error"].alias("error"), body["raw"].alias("raw"))


def land_raw(spark: SparkSession, d: str) -> DataFrame:
    return written(ingest.raw_rows(parsed(spark, d)), "raw", 2)


def sink_processed_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every third event is delivered again; then half of the table is already there."""
    rows = txns(spark, d)
    again = rows.filter("seq % 3 = 0").withColumn("seq", F.col("seq") + 1_000_000_000)
    there = rows.filter("seq % 2 = 0")
    fresh = layers.insert_if_absent(there, rows.unionByName(again), "transaction_id")
    return fresh.select("transaction_id", "seq", "amount")


def insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    rows = txns(spark, d)
    there = rows.filter("seq % 4 = 0")
    return layers.insert_if_absent(there, rows, "transaction_id").select("transaction_id")


def emit_cleaned(spark: SparkSession, d: str) -> DataFrame:
    out = all_layers(spark, d)["cleaned"]
    return out.select(
        "key", F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
        F.get_json_object("value", "$.amount").alias("amount"),
        F.get_json_object("value", "$.event_time").alias("event_time"),
        F.contains("value", F.lit(schemas.LABEL_FIELD)).alias("leaks_label"))


def emit_suspicious(spark: SparkSession, d: str) -> DataFrame:
    out = all_layers(spark, d)["suspicious"]
    found = F.from_json(F.get_json_object("value", "$.fraud_findings"),
                        "array<struct<rule string, severity string, reason string>>")
    return out.select(
        "key", F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
        F.array_join(F.transform(found, lambda f: f["rule"]), ",").alias("rules"),
        F.contains("value", F.lit(schemas.LABEL_FIELD)).alias("leaks_label"))


def archive_window(spark: SparkSession, d: str) -> tuple[DataFrame, datetime, datetime]:
    """Raw rows on the uncompressed clock, and the hours they span."""
    raw = ingest.raw_rows(parsed(spark, d)).withColumn("ingested_at", F.timestamp_micros(
        F.lit(adapter.EPOCH_US) + (F.unix_micros("ingested_at") - adapter.EPOCH_US) * 10))
    span = raw.agg(F.min("ingested_at").alias("low"), F.max("ingested_at").alias("high")).first()
    start = span["low"].replace(minute=0, second=0, microsecond=0)
    return raw, start, span["high"] + timedelta(hours=1)


def archived(spark: SparkSession, d: str) -> tuple[str, datetime, datetime]:
    raw, start, end = archive_window(spark, d)
    root = scratch_folder(spark, "archive")
    archive.archive_range(raw, start, end, root)
    archive.archive_hour(raw, start + timedelta(hours=1, minutes=20), root)  # run again: replaces the hour
    return root, start, end


def archive_hourly(spark: SparkSession, d: str) -> DataFrame:
    root, _, _ = archived(spark, d)
    return spark.read.parquet(root).select(
        *[F.lpad(F.col(p).cast("string"), 4 if p == "year" else 2, "0").alias(p) for p in archive.PARTS],
        "transaction_id", "offset")


def archive_scan(spark: SparkSession, d: str) -> DataFrame:
    root, start, _ = archived(spark, d)
    rows = archive.scan_archive(spark, root, start + timedelta(hours=1), start + timedelta(hours=4))
    return rows.select("transaction_id", "offset", "ingested_at")


# ---- quality --------------------------------------------------------------------------------------------

def failing(code: str) -> Query:
    return lambda s, d: quality.rejected_with(gated(s, d), code).select("seq")


def dq_split(spark: SparkSession, d: str) -> DataFrame:
    good, bad = quality.dq_split(gated(spark, d))
    return good.select("seq", F.lit("valid").alias("side")).unionByName(
        bad.select("seq", F.lit("rejected").alias("side")))


def project_processed(spark: SparkSession, d: str) -> DataFrame:
    return all_layers(spark, d)["processed"].drop("fraud_score", "ml_flagged", "processed_at")


# ---- features and rules -----------------------------------------------------------------------------------

def feature(*names: str, **kw) -> Query:
    return lambda s, d: features.add_features(txns(s, d), **kw).select("seq", *names)


def feat_arrival(spark: SparkSession, d: str) -> DataFrame:
    return features.add_features(txns(spark, d, late=True), order="arrival").select("seq", *schemas.FEATURES)


def feat_stream_state(spark: SparkSession, d: str) -> DataFrame:
    """The keyed-state features of a stream that arrives in three steps, back-dated events included."""
    rows = txns(spark, d, late=True)
    path, n_files = in_steps(rows, "seq", "txns")
    out = scratch_folder(spark, "stream-features")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", n_files).parquet(path)
    wanted = stream.select("user_id", "local_us", *features.INPUTS)
    query = (state.add_features(wanted).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", out + "-progress").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out).select("seq", *schemas.FEATURES)


def rule(name: str) -> Query:
    return lambda s, d: flagged(s, d).filter(rules.conditions()[name]).select("seq")


def rule_ml_score(spark: SparkSession, d: str) -> DataFrame:
    """The score rule on a stand-in score made from the z-score; rows without history have none."""
    rows = features.add_features(txns(spark, d))
    scored = rows.withColumn("fraud_score", F.when(
        F.col("merchant_frequency") > 1, F.least(F.col("amount_zscore") / 5, F.lit(1.0))))
    found = rules.evaluate(scored, score_col="fraud_score")
    return (found.select("seq", F.explode("findings").alias("f")).filter("f.rule = 'ML_SCORE'")
            .select("seq", "f.severity", "f.reason"))


def findings_array(spark: SparkSession, d: str) -> DataFrame:
    return flagged(spark, d).select(
        "seq", F.array_join(F.transform("findings", lambda f: f["rule"]), ",").alias("rules"),
        F.size("findings").alias("n_findings"), "is_flagged")


def finding_reason(spark: SparkSession, d: str) -> DataFrame:
    return fraud(spark, d).select("transaction_id", "rule_triggered", "severity", "reason")


def rules_thresholds(spark: SparkSession, d: str) -> DataFrame:
    limits = rules.Thresholds(velocity=2, zscore=3.0, times_average=10)
    found = rules.evaluate(features.add_features(txns(spark, d)), limits)
    return (found.select(F.explode("findings").alias("f")).groupBy(F.col("f.rule").alias("rule_triggered"))
            .agg(F.count("*").alias("events")))


def rules_periods(spark: SparkSession) -> rules.RulesTable:
    """Limits that change twice while the test events run; other fields keep their defaults."""
    rows = [(adapter.EPOCH_US + adapter.RULES_CHANGE_US, 2, None, 10), (adapter.EPOCH_US + 2 * adapter.RULES_CHANGE_US, None, 3.0, None)]
    table = spark.createDataFrame(rows, "us long, velocity int, zscore double, times_average int")
    return rules.RulesTable(table.withColumn("valid_from", F.timestamp_micros("us")))


def rules_table(spark: SparkSession, d: str) -> DataFrame:
    """Findings under limits that change at stated instants."""
    found = rules.evaluate(features.add_features(txns(spark, d)), rules_periods(spark))
    return found.select("seq", F.array_join(F.transform("findings", lambda f: f["rule"]), ",").alias("rules"))


def rules_table_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same in a stream, where events also arrive after a change that is valid from a later time."""
    rows = txns(spark, d, late=True)
    (path, n_files), out = in_steps(rows, "seq", "txns"), scratch_folder(spark, "stream-rules")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", n_files).parquet(path)
    found = jobs.flag(stream.select("user_id", "local_us", *features.INPUTS), limits=rules_periods(spark))
    named = found.select("seq", F.array_join(F.transform("findings", lambda f: f["rule"]), ",").alias("rules"))
    panels.start_panel(named, out, f"{out}-progress", once=True).awaitTermination()
    return spark.read.parquet(out)


def rules_light(spark: SparkSession, d: str) -> DataFrame:
    found = rules.evaluate(features.add_light_features(txns(spark, d)), light=True)
    return found.select("transaction_id", F.explode("findings").alias("f")).select(
        "transaction_id", F.col("f.rule").alias("rule_triggered"), F.col("f.reason").alias("reason"))


# ---- joins, upserts -----------------------------------------------------------------------------------------

def join_customer_fraud(spark: SparkSession, d: str) -> DataFrame:
    rows, found = both(spark, d)
    return curated.join_customer_fraud(rows.groupBy("user_id").agg(F.count("*").alias("txn_count")), found)


def join_fraud_merchant(spark: SparkSession, d: str) -> DataFrame:
    rows, found = both(spark, d)
    return curated.join_fraud_merchant(found.select("transaction_id", "rule_triggered"), rows)


def join_merchant_fraud(spark: SparkSession, d: str) -> DataFrame:
    rows, found = both(spark, d)
    volumes = rows.groupBy("merchant").agg(F.count("*").alias("txn_count"))
    return curated.join_merchant_fraud(volumes, curated.fraud_by_merchant(found, rows))


def labelled(spark: SparkSession, d: str) -> DataFrame:
    out = all_layers(spark, d)
    return model.join_features_label(out["processed"], out["raw"])


learned_from = written_once("labelled", labelled)


def join_detection(spark: SparkSession, d: str) -> DataFrame:
    out = all_layers(spark, d)
    return curated.join_detection(out["raw"], out["fraud_events"])


def update_scores(spark: SparkSession, d: str) -> DataFrame:
    table = processed(spark, d)
    share = F.col("merchant_frequency") / (F.col("merchant_frequency") + 1)
    scores = table.filter("payment_velocity > 0").select(
        "transaction_id", share.alias("fraud_score"), (share >= 0.8).alias("ml_flagged"))
    return layers.update_scores(table, scores).select("transaction_id", "fraud_score", "ml_flagged")


SCORE_BUCKETS = 16


def update_scores_write(spark: SparkSession, d: str) -> DataFrame:
    """The same as a change of a written table: scores come for some ids, and once more for fewer."""
    table, root = layers.staged(processed(spark, d), "scored"), scratch_folder(spark, "scores-table")
    tables.write_by_bucket(table, root, SCORE_BUCKETS)
    share = F.col("merchant_frequency") / (F.col("merchant_frequency") + 1)
    scores = table.filter("payment_velocity > 0").select(
        "transaction_id", share.alias("fraud_score"), (share >= 0.8).alias("ml_flagged"))
    tables.write_scores(spark, root, scores, SCORE_BUCKETS)
    tables.write_scores(spark, root, scores.where("fraud_score > 0.9"), SCORE_BUCKETS)
    return spark.read.parquet(root).select("transaction_id", "fraud_score", "ml_flagged")


def upsert_daily_write(spark: SparkSession, d: str) -> DataFrame:
    """A written table of all days whose newest days are stale, and those days refreshed."""
    whole, path = daily(spark, d, 30), scratch_folder(spark, "daily")
    curated.write_daily(whole.withColumn("txn_count", F.lit(0).cast("bigint")), path)
    curated.write_daily(daily(spark, d, 1), path)
    return spark.read.schema(whole.schema).parquet(path)


def dq_search(spark: SparkSession, d: str) -> DataFrame:
    """Quarantine rows with either of two failed checks, searched in the written table."""
    root = scratch_folder(spark, "quarantine")
    tables.write_rejected(rejected(spark, d), root, 0)
    return tables.search_rejected(spark, root, "INVALID_CITY", "NULL_AMOUNT").select("transaction_id", "reason")


def dq_summary_masks(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_folder(spark, "quarantine")
    tables.write_rejected(rejected(spark, d), root, 0)
    return tables.rejected_summary(spark, root)


def daily(spark: SparkSession, d: str, days: int) -> DataFrame:
    return curated.merchant_metrics(processed(spark, d, squeeze=10), F.lit("2024-01-03 09:00:00").cast("timestamp"), days)


def upsert_daily(spark: SparkSession, d: str) -> DataFrame:
    """A table of all days with stale counts for the newest, refreshed."""
    whole = daily(spark, d, 30)
    stale = whole.withColumn("txn_count", F.lit(0).cast("bigint"))
    return curated.upsert_daily(stale, daily(spark, d, 1), ("merchant", "window_date"))


def layer_counts(spark: SparkSession, d: str) -> DataFrame:
    out = all_layers(spark, d)
    return curated.layer_counts(out["raw"], out["processed"], out["rejected"], out["fraud_events"])


def city_membership(spark: SparkSession, d: str) -> DataFrame:
    return curated.city_membership(adapter.dirty(spark, d), schemas.cities(spark)).select("seq", "city")


# ---- curated ---------------------------------------------------------------------------------------------------

def customer_daily(spark: SparkSession, d: str) -> DataFrame:
    return curated.customer_metrics(processed(spark, d, squeeze=10), F.lit("2024-01-03 09:00:00").cast("timestamp"))


def demo_stats(spark: SparkSession, d: str) -> DataFrame:
    """The three parts of the report as one table."""
    rows, found = both(spark, d)
    bad = quality.dq_split(gated(spark, d, "light"))[1]
    parts = curated.demo_stats(rows, bad, found)
    summary = parts["summary"].select(
        F.lit("summary").alias("part"),
        F.concat_ws("|", "total", "success", "failed", "flagged", "avg_amount", "success_rate", "rejected")
        .alias("text"))
    by_rule = parts["by_rule"].select(F.lit("by_rule").alias("part"),
                                      F.concat_ws("|", "rule_triggered", "severity", "events").alias("text"))
    recent = parts["recent"].select(
        F.lit("recent").alias("part"),
        F.concat_ws("|", F.unix_micros("detected_at"), "rule_triggered", "severity", "user_id", "amount", "reason")
        .alias("text"))
    return summary.unionByName(by_rule).unionByName(recent)


def card(cards: dict, name: str, source: Query) -> Query:
    return lambda s, d: cards[name](source(s, d))


# ---- health ----------------------------------------------------------------------------------------------------

def latencies(spark: SparkSession, d: str) -> DataFrame:
    return adapter.latencies(spark, d)


def health_running_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts observed while the gated events are written, without a job of their own."""
    gate, judged = Observation("gate"), Observation("judged")
    rows = quality.gate(ingest.events(parsed(spark, d)))
    valid, _ = quality.dq_split(layers.staged(rows.observe(gate, *health.running_counts(rows)), "gated"))
    found = rules.evaluate(features.add_features(layers.first_by_key(quality.typed(valid), "transaction_id")))
    found.observe(judged, health.flagged_count()).write.format("noop").mode("overwrite").save()
    got = [(gate.get["accepted"], gate.get["rejected"], judged.get["flagged"])]
    return spark.createDataFrame(got, "accepted bigint, rejected bigint, flagged bigint")


# ---- health of streams -------------------------------------------------------------------------------------------


def split_stream(rows: DataFrame, time: str) -> tuple[str, DataFrame, DataFrame]:
    """Rows that arrive in steps by ``seq``, parted by lateness: where, the stream in time, the late table.

    One row two hours later than all others comes last, so that the windows of the others close.
    """
    spark, root = rows.sparkSession, scratch_folder(rows.sparkSession, "panel")
    source, n_files = in_steps(rows, "seq", "panel-rows")
    last = spark.read.schema(rows.schema).parquet(source).agg(F.max(time).alias("t")).select((F.col("t") + F.expr("INTERVAL 2 HOURS")).alias("t"))
    closing = [F.col("t").alias(c) if c == time else F.lit(None).cast(kind).alias(c) for c, kind in rows.dtypes]
    last.select(*closing).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", n_files).parquet(source)
    panels.start_split(stream, root, f"{root}-split", time, once=True).awaitTermination()
    return root, panels.in_time(spark, root, rows.schema, time), panels.late(spark, root, rows.schema)


def closed_windows(panel: DataFrame, root: str) -> DataFrame:
    panels.start_panel(panel, f"{root}/closed", f"{root}-closed", once=True).awaitTermination()
    return panel.sparkSession.read.schema(panel.schema).parquet(f"{root}/closed")


def panel(rows: DataFrame, time: str, name: str, *by: str) -> DataFrame:
    """A counting panel of a stream, late rows included."""
    root, live, late = split_stream(rows, time)
    closed = closed_windows(health.per_minute(live, time, name, *by), root)
    return panels.with_late(closed, health.per_minute(late, time, name, *by), "minute", *by).drop("late")


def arriving(spark: SparkSession, d: str) -> DataFrame:
    """Processed events on the ingest clock, some back-dated."""
    return txns(spark, d, late=True).select("seq", F.timestamp_micros("ingested_us").alias("processed_at"))


def arriving_alerts(spark: SparkSession, d: str) -> DataFrame:
    found = flagged(spark, d, late=True).select("seq", F.col("ingested_at").alias("detected_at"), F.explode("findings").alias("f"))
    return found.select("seq", "detected_at", F.col("f.rule").alias("rule_triggered"))


def arriving_rejections(spark: SparkSession, d: str) -> DataFrame:
    rows = rejected(spark, d)
    return rows.select(F.unix_micros("rejected_at").alias("seq"), "rejected_at")


def health_throughput_vs_alerts_stream(spark: SparkSession, d: str) -> DataFrame:
    rows, found = arriving(spark, d), layers.staged(arriving_alerts(spark, d), "alerts")
    root, live_rows, late_rows = split_stream(rows, "processed_at")
    _, live_found, late_found = split_stream(found, "detected_at")
    closed = closed_windows(panels.throughput_vs_alerts(live_rows, live_found), root)
    whole = closed.unionByName(health.throughput_vs_alerts(late_rows, late_found))
    return whole.groupBy("minute").agg(F.sum("txns").alias("txns"), F.sum("alerts").alias("alerts"))


def health_latency_pcts_stream(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of sliding windows from panes that a stream closes, and from panes of late rows."""
    seconds = ((F.col("ingested_us") - F.col("event_us")) / 1e6).alias("seconds")
    rows = txns(spark, d, late=True).select("seq", F.timestamp_micros("ingested_us").alias("observed_at"), seconds)
    root, live, late = split_stream(rows, "observed_at")
    panes = closed_windows(panels.latency_panes(live), root).unionByName(panels.latency_panes(late))
    return health.percentiles(health.sliding(panes))


def stream_layers(spark: SparkSession, d: str, *wanted: str) -> str:
    """Streaming queries over the messages in steps, and again in a later run over copies of some, days later."""
    root, (source, n_files) = scratch_folder(spark, "streams"), in_steps(adapter.messages(spark, d), "offset", "messages")

    def run() -> None:
        messages = streams.file_messages(spark, source, n_files)
        if "landing" in wanted:
            jobs.start_landing(messages, root, f"{root}-landing", once=True).awaitTermination()
        jobs.start_admission(messages, root, f"{root}-admission", once=True).awaitTermination()
        if "scoring" in wanted:
            txns = streams.admitted(spark, root, jobs.valid_transactions(messages).schema)
            jobs.start_scoring(txns, root, f"{root}-scoring", once=True).awaitTermination()

    run()
    again = adapter.messages(spark, d).where("offset % 3 = 0").withColumns({
        "offset": F.col("offset") + 1_000_000_000, "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 9 DAYS")})
    again.repartition(n_files).write.mode("append").parquet(source)
    run()
    return root


def sink_processed_stream(spark: SparkSession, d: str) -> DataFrame:
    """Ids that come again days later, in another run, are admitted to the processed table once."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{stream_layers(spark, d)}/admitted")
    return rows.select("transaction_id", "amount")


def health_running_counts_stream(spark: SparkSession, d: str) -> DataFrame:
    return panels.running_totals(spark, stream_layers(spark, d, "landing", "scoring"))


# ---- model -------------------------------------------------------------------------------------------------------

def halves(spark: SparkSession, d: str) -> DataFrame:
    checkpoint_root(spark)
    return model.stratified_split(labelled(spark, d).checkpoint())


def published(spark: SparkSession, d: str) -> tuple:
    """The model and metadata that the training job of this application published for a data folder."""
    name = hashlib.sha256(f"{spark.sparkContext.applicationId} {d}".encode()).hexdigest()
    path = f"{checkpoint_root(spark).rstrip('/')}/model-{name}"
    if model.load_model(spark, path)[0] is None:
        model.publish_labelled(learned_from(spark, d), path, adapter.AS_OF)
    return model.load_model(spark, path)


def trained(spark: SparkSession, d: str):
    return published(spark, d)[0]


def ml_train(spark: SparkSession, d: str) -> DataFrame:
    got = trained(spark, d)
    rows = [(got.getNumTrees, int(got.numFeatures), got.totalNumNodes > got.getNumTrees)]
    return spark.createDataFrame(rows, "trees int, inputs int, has_splits boolean")


def ml_importances(spark: SparkSession, d: str) -> DataFrame:
    found = model.importances(spark, trained(spark, d))
    return found.agg(
        F.array_join(F.array_sort(F.collect_list("feature")), ",").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"), F.bool_and(F.col("importance") >= 0).alias("none_negative"))


def ml_vector(spark: SparkSession, d: str) -> DataFrame:
    made = model.vectorize(processed(spark, d))
    parts = model.vector_to_array(model.VECTOR)
    return made.select("transaction_id", *[parts[i].alias(f"x_{name}") for i, name in enumerate(model.input_columns())])


def ml_score(spark: SparkSession, d: str) -> DataFrame:
    """Every row with its score, which is shown by what holds for any model."""
    scored = model.score(learned_from(spark, d), trained(spark, d))
    return scored.select("transaction_id", "label", F.col("fraud_score").between(0, 1).alias("is_probability"))


def ml_metadata(spark: SparkSession, d: str) -> DataFrame:
    _, metadata = published(spark, d)
    return spark.createDataFrame(
        [(metadata["rows"], metadata["positives"], ",".join(metadata["features"]))],
        "rows bigint, positives bigint, features string")


def stand_in_scores(spark: SparkSession, d: str) -> DataFrame:
    """Whole table with a label and the z-score as score: metrics that any engine can recompute."""
    return labelled(spark, d).withColumn("fraud_score", F.col("amount_zscore"))


def ml_pr_auc(spark: SparkSession, d: str) -> DataFrame:
    checkpoint_root(spark)
    found = model.average_precision(stand_in_scores(spark, d), rows_per_range=500)
    return found.select(F.round("average_precision", 9).alias("average_precision"))


def ml_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Rows scored, and that the flags follow the threshold."""
    done = model.backfill(processed(spark, d), trained(spark, d))
    agree = F.bool_and(F.col("ml_flagged") == (F.col("fraud_score") >= rules.DEFAULT.score))
    return done.agg(F.count("*").alias("updated"), agree.alias("flags_follow"))


REGISTRY: dict[str, Query] = {
    "adapter_txns": lambda s, d: txns(s, d).drop("is_offset"),
    "src_stream": src_stream,
    "parse_json_dlq": parse_json_dlq,
    "land_raw": land_raw,
    "sink_rejected": lambda s, d: written(rejected(s, d), "rejected", 2).drop("payload"),
    "sink_processed_dedup": sink_processed_dedup,
    "sink_fraud_events": lambda s, d: written(all_layers(s, d)["fraud_events"], "fraud", 2),
    "emit_cleaned": emit_cleaned,
    "emit_suspicious": emit_suspicious,
    "dlq_report": lambda s, d: ingest.dlq_report(ingest.dead_letters(parsed(s, d))),
    "dlq_counts": lambda s, d: ingest.dlq_counts(ingest.dead_letters(parsed(s, d))),
    "archive_hourly": archive_hourly,
    "archive_scan": archive_scan,
    "retain_latest": lambda s, d: layers.retain_latest(stored(s, d), keep=2_000).select("transaction_id", "event_time"),
    "ml_feature_scan": lambda s, d: model.feature_scan(processed(s, d)),
    "dq_failed_checks": lambda s, d: gated(s, d).select("seq", "failed_checks"),
    "dq_missing_txn": failing("MISSING_TRANSACTION_ID"),
    "dq_missing_user": failing("MISSING_USER_ID"),
    "dq_null_amount": failing("NULL_AMOUNT"),
    "dq_non_positive": failing("NON_POSITIVE_AMOUNT"),
    "dq_non_numeric": failing("NON_NUMERIC_AMOUNT"),
    "dq_missing_merchant": failing("MISSING_MERCHANT"),
    "dq_bad_handle": failing("INVALID_UPI_HANDLE"),
    "dq_bad_status": failing("INVALID_STATUS"),
    "dq_bad_city": failing("INVALID_CITY"),
    "dq_bad_ts": failing("INVALID_TIMESTAMP"),
    "dq_future_ts": failing("FUTURE_TIMESTAMP"),
    "dq_split": dq_split,
    "dq_light": lambda s, d: gated(s, d, "light").select("seq", "failed_checks"),
    "dq_summary": lambda s, d: quality.dq_summary(gated(s, d)),
    "project_processed": project_processed,
    "features_all": feature(*schemas.FEATURES),
    "features_hot_split": feature(*schemas.FEATURES, hot_rows=40),
    "feat_txns_last_hour": feature("txns_last_hour"),
    "feat_velocity": feature("payment_velocity"),
    "feat_avg_amount": feature("avg_amount_30d"),
    "feat_zscore": feature("amount_zscore"),
    "feat_merchant_freq": feature("merchant_frequency"),
    "feat_device_changed": feature("device_changed"),
    "feat_location_changed": feature("location_changed"),
    "feat_seconds_since_prev": feature("seconds_since_prev"),
    "feat_km_from_prev": feature("km_from_prev"),
    "feat_is_weekend": feature("is_weekend"),
    "feat_is_night": feature("is_night"),
    "feat_recent_statuses": feature("recent_statuses"),
    "feat_arrival_mode": feat_arrival,
    "feat_stream_state": feat_stream_state,
    "feat_window_size": lambda s, d: features.add_light_features(txns(s, d)).select("seq", *schemas.LIGHT_FEATURES),
    "rule_impossible_travel": rule("IMPOSSIBLE_TRAVEL"),
    "rule_velocity": rule("VELOCITY"),
    "rule_high_value": rule("HIGH_VALUE"),
    "rule_new_device": rule("NEW_DEVICE"),
    "rule_repeated_failures": rule("REPEATED_FAILURES"),
    "rule_ml_score": rule_ml_score,
    "findings_array": findings_array,
    "finding_reason": finding_reason,
    "rules_thresholds": rules_thresholds,
    "rules_table": rules_table,
    "rules_table_stream": rules_table_stream,
    "rules_light": rules_light,
    "join_customer_fraud": join_customer_fraud,
    "join_fraud_merchant": join_fraud_merchant,
    "join_merchant_fraud": join_merchant_fraud,
    "join_features_label": labelled,
    "join_detection": join_detection,
    "update_scores": update_scores,
    "upsert_daily": upsert_daily,
    "update_scores_write": update_scores_write,
    "upsert_daily_write": upsert_daily_write,
    "dq_search": dq_search,
    "dq_summary_masks": dq_summary_masks,
    "layer_counts": layer_counts,
    "insert_if_absent": insert_if_absent,
    "city_membership": city_membership,
    "merchant_metrics": lambda s, d: daily(s, d, 1),
    "customer_metrics": customer_daily,
    "customer_profile": profile,
    "customer_profile_refresh": customer_profile_refresh,
    "merchant_risk": risk,
    "risk_tier": lambda s, d: risk(s, d).select("merchant", "fraud_rate_pct", "risk_tier"),
    "fraud_rate_pct": lambda s, d: profile(s, d).select("user_id", "fraud_txns", "txn_count", "fraud_rate_pct"),
    "fraud_by_user": lambda s, d: curated.fraud_by_user(fraud(s, d)),
    "fraud_by_merchant": lambda s, d: curated.fraud_by_merchant(*reversed(both(s, d))),
    "top_risky_merchants": lambda s, d: curated.top_risky_merchants(risk(s, d)),
    "executive_summary": lambda s, d: curated.executive_summary(processed(s, d)),
    "fraud_by_rule": lambda s, d: curated.fraud_by_rule(fraud(s, d)),
    "latest_alerts": lambda s, d: curated.latest_alerts(fraud(s, d)),
    "top_merchants_volume": lambda s, d: curated.top_merchants_volume(stored(s, d)),
    "txns_by_city": lambda s, d: curated.txns_by_city(stored(s, d)),
    "demo_stats": demo_stats,
    **{f"dash_{n}": card(dashboards.EXECUTIVE, n, processed if n == "flagged" else stored) for n in dashboards.EXECUTIVE},
    **{f"dash_{n}": card(dashboards.OPERATIONS, n, fraud) for n in dashboards.OPERATIONS},
    **{f"dash_{n}": card(dashboards.RISK_BY_CUSTOMER, n, written_once("customer_profile", profile)) for n in dashboards.RISK_BY_CUSTOMER},
    **{f"dash_{n}": card(dashboards.RISK_BY_MERCHANT, n, written_once("merchant_risk", risk)) for n in dashboards.RISK_BY_MERCHANT},
    "health_throughput": lambda s, d: health.throughput(stored(s, d)),
    "health_rejections": lambda s, d: health.rejections(rejected(s, d)),
    "health_alerts": lambda s, d: health.alerts(fraud(s, d)),
    "health_p99": lambda s, d: health.p99(latencies(s, d)),
    "health_throughput_vs_alerts": lambda s, d: health.throughput_vs_alerts(*both(s, d)),
    "health_alerts_by_rule": lambda s, d: health.alerts_by_rule(fraud(s, d)),
    "health_latency_pcts": lambda s, d: health.latency_percentiles(latencies(s, d)),
    "health_running_counts": health_running_counts,
    "health_throughput_stream": lambda s, d: panel(arriving(s, d), "processed_at", "txns"),
    "health_rejections_stream": lambda s, d: panel(arriving_rejections(s, d), "rejected_at", "rejected"),
    "health_alerts_stream": lambda s, d: panel(arriving_alerts(s, d), "detected_at", "alerts"),
    "health_alerts_by_rule_stream": lambda s, d: panel(arriving_alerts(s, d), "detected_at", "alerts", "rule_triggered"),
    "health_throughput_vs_alerts_stream": health_throughput_vs_alerts_stream,
    "health_latency_pcts_stream": health_latency_pcts_stream,
    "health_running_counts_stream": health_running_counts_stream,
    "sink_processed_stream": sink_processed_stream,
    "ml_vector": ml_vector,
    "ml_label": lambda s, d: model.labels(ingest.raw_rows(parsed(s, d))),
    "ml_gate": lambda s, d: model.gate_counts(labelled(s, d)),
    "ml_split": lambda s, d: halves(s, d).select("transaction_id", "label", "is_train"),
    "ml_class_weight": lambda s, d: s.createDataFrame(
        [(model.positive_weight(halves(s, d).filter("is_train")),)], "weight double"),
    "ml_train": ml_train,
    "ml_eval": lambda s, d: model.evaluate(stand_in_scores(s, d), F.col("fraud_score") >= 3.0, "score"),
    "ml_pr_auc": ml_pr_auc,
    "ml_vs_rules": lambda s, d: model.evaluate(labelled(s, d), F.col("rule_pred") == 1, "rules"),
    "ml_importances": ml_importances,
    "ml_metadata": ml_metadata,
    "ml_score": ml_score,
    "ml_backfill": ml_backfill,
}


def registered() -> dict[str, Query]:
    def run(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(configure(spark), sf_dir))

    return {name: run(query) for name, query in REGISTRY.items()}
