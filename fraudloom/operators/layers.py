"""Rows of the processed and fraud layers, outgoing messages, and how tables are written."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom import schemas
from fraudloom.functions.clock import bind
from fraudloom.operators import features, ingest, quality, rules
from fraudloom.session import scratch_folder

DETECTED = "ingested_at"  # stands for the wall clock of the run


def first_by_key(df: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The first row of each key. Each task keeps one row per key before the shuffle, so a key with
    very many copies is no burden."""
    position = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """Rows of ``batch`` to append to ``target``: one per key, keys not there yet."""
    return first_by_key(batch, key, order).join(target.select(key), key, "left_anti")


def processed_rows(flagged: DataFrame) -> DataFrame:
    """Processed layer: event fields, time, features, flags and score.

    Events whose amount the table cannot hold are not in it; they are in quarantine.
    """
    flagged = flagged.filter(F.col("amount").isNotNull())
    score = F.col("fraud_score") if "fraud_score" in flagged.columns else F.lit(None).cast("double")
    return flagged.select(
        *schemas.EVENT_FIELDS, F.timestamp_micros("event_us").alias("event_time"), *schemas.FEATURES,
        "is_flagged", "rule_flagged", score.alias("fraud_score"), "ml_flagged",
        F.col(DETECTED).alias("processed_at"))


def fraud_rows(flagged: DataFrame) -> DataFrame:
    """Fraud layer: one row per finding."""
    return flagged.select("*", F.explode("findings").alias("finding")).select(
        "transaction_id", "user_id", F.col("finding.rule").alias("rule_triggered"),
        F.col("finding.severity").alias("severity"), F.col("finding.reason").alias("reason"),
        "amount", "city", F.timestamp_micros("event_us").alias("event_time"),
        F.col(DETECTED).alias("detected_at"))


def _last_of_each(members: Column) -> Column:
    """Map of the members; of a name given twice the last counts, as in the usual JSON readers."""
    def made(held: Column) -> Column:
        def stays(member: Column, at: Column) -> Column:
            later = F.slice(held, at + 2, F.size(held))
            return ~F.exists(later, lambda other: other["key"] == member["key"])

        names = F.transform(held, lambda member: member["key"])
        return F.when(F.size(F.array_distinct(names)) == F.size(held), F.map_from_entries(held)).otherwise(
            F.map_from_entries(F.filter(held, stays)))

    # bound, since the payload would be read again for every member otherwise
    return bind(members, made)


def _members() -> Column:
    """The payload's members with their JSON types, without the ground-truth label.

    Where an inner object repeats a name, which typed values cannot hold, all members are text.
    """
    exact = F.from_json("payload", "map<string,variant>")
    text = F.from_json("payload", "map<string,string>")
    as_text = F.transform(F.map_entries(text), lambda m: F.struct(
        m["key"].alias("key"), F.to_variant_object(F.array(m["value"])).alias("value")))
    as_text = F.transform(as_text, lambda m: F.struct(m["key"].alias("key"), F.variant_get(m["value"], "$[0]", "variant").alias("value")))
    members = F.coalesce(F.map_entries(exact), as_text)
    return F.filter(members, lambda member: member["key"] != schemas.LABEL_FIELD)


def cleaned_messages(flagged: DataFrame) -> DataFrame:
    """Every valid event as a message keyed by user."""
    return flagged.select(F.col("user_id").alias("key"), F.to_json(_last_of_each(_members())).alias("value"))


def suspicious_messages(flagged: DataFrame) -> DataFrame:
    """Events with findings as messages keyed by user. A ``fraud_findings`` of the payload is replaced."""
    found = F.array(F.struct(F.lit("fraud_findings").alias("key"), F.to_variant_object("findings").alias("value")))
    return flagged.filter("is_flagged").select(
        F.col("user_id").alias("key"), F.to_json(_last_of_each(F.concat(_members(), found))).alias("value"))


def retain_latest(table: DataFrame, keep: int = 20_000, time: str = "event_time",
                  tie: str = "transaction_id") -> DataFrame:
    """The newest ``keep`` rows of a table."""
    return table.orderBy(F.col(time).desc(), F.col(tie).desc()).limit(keep)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that later passes read columns of a table."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_layers(
    messages: DataFrame, as_of_us=None, dedupe: bool = True, order: str = "event_time",
    limits: rules.Thresholds = rules.DEFAULT, stage: bool = True,
) -> dict[str, DataFrame]:
    """All layers of a batch of messages.

    Every layer starts from the parsed and gated events. With ``stage`` these are written once and
    each layer reads only its columns; without it the messages are parsed again per layer.
    """
    gated = quality.gate(ingest.parse(messages), as_of_us)
    if stage:
        gated = staged(gated, "gated")
    valid, rejected = quality.dq_split(ingest.events(gated))
    txns = quality.typed(valid)
    if dedupe:
        txns = first_by_key(txns, "transaction_id")
    txns = features.add_features(txns, order=order, tail=rules.statuses_needed(limits))
    flagged = rules.evaluate(txns, limits)
    return {
        "raw": ingest.raw_rows(gated),
        "dead_letters": ingest.dead_letters(gated),
        "rejected": quality.rejected_rows(rejected).unionByName(quality.out_of_range_rows(valid)),
        "flagged": flagged,
        "processed": processed_rows(flagged),
        "fraud_events": fraud_rows(flagged),
        "cleaned": cleaned_messages(flagged),
        "suspicious": suspicious_messages(flagged),
    }


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch below ``batch_id=``; writing it again replaces it."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def update_scores(processed: DataFrame, scores: DataFrame, broadcast: bool = False) -> DataFrame:
    """Processed rows with ``fraud_score`` and ``ml_flagged`` replaced where ``scores`` has the key.

    Of several scores for one key the highest counts. ``broadcast`` says that the scores are few.
    """
    best = scores.groupBy("transaction_id").agg(F.max(F.struct("fraud_score", "ml_flagged")).alias("s"))
    new = best.select("transaction_id", "s.*").select("transaction_id", F.col("fraud_score").alias("_score"), F.col("ml_flagged").alias("_flag"))
    joined = processed.join(F.broadcast(new) if broadcast else new, "transaction_id", "left")
    return joined.withColumns({
        "fraud_score": F.coalesce("_score", "fraud_score"),
        "ml_flagged": F.coalesce("_flag", "ml_flagged"),
    }).select(*processed.columns)
