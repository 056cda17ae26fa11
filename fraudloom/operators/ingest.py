"""From broker messages to the raw layer, parsed events and dead letters."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudloom import schemas

CORRUPT = "_corrupt"
# Key of dead letters, text kept by the report, name for a missing error.
DEAD_LETTER_KEY = "unparseable"
REPORT_CHARS = 200
UNKNOWN_ERROR = "unknown"
JSON_SPACE = " \t\n\r"


def arrival_key() -> Column:
    """One number per message that sorts by ingest time, topic, partition and offset."""
    parts = (
        (F.unix_micros("ingested_at"), 16), (F.pmod(F.crc32("topic"), F.lit(1000)), 3), (F.col("partition"), 5),
        (F.col("offset"), 14),
    )
    digits = [F.lpad(F.coalesce(part, F.lit(0)).cast("string"), width, "0") for part, width in parts]
    return F.concat(*digits).cast("decimal(38,0)")


def _flatten(parsed: DataFrame) -> DataFrame:
    """Event fields as text columns next to payload, coordinates and error."""
    fields = [F.col(f"evt.event.{f.name}").alias(f.name) for f in schemas.EVENT_SCHEMA.fields]
    return parsed.select(*fields, F.col("value").alias("payload"), "topic", "partition", "offset", "ingested_at",
                         arrival_key().alias("seq"), "error")


def parse(messages: DataFrame) -> DataFrame:
    """Messages with their event fields as text columns and a parse ``error`` or null.

    A message is read as one member of an object whose other member repeats the message's hash. Text
    after the event breaks that object or ends it before the hash, so it is not lost unseen.
    """
    whole = schemas.T.StructType([schemas.T.StructField("event", schemas.EVENT_SCHEMA), *[
        schemas.T.StructField(name, schemas.T.StringType()) for name in ("end", CORRUPT)]])
    mark = F.xxhash64("value").cast("string")
    wrapped = F.concat(F.lit('{"event":'), "value", F.lit(',"end":"'), mark, F.lit('"}'))
    parsed = F.from_json(wrapped, whole, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"})
    is_object = F.coalesce(F.ltrim("value", F.lit(JSON_SPACE)).startswith("{"), F.lit(False))
    broken = F.col("evt.event").isNull() | F.col(f"evt.{CORRUPT}").isNotNull() | ~F.col("evt.end").eqNullSafe(mark)
    error = F.when(~is_object, "not a JSON object").when(broken, "malformed JSON")
    # A generator, so that the parse is not copied into every filter on its fields.
    return messages.select("*", F.explode(F.array(parsed)).alias("evt")).withColumn("error", error).transform(_flatten)


def dead_letters(flat: DataFrame) -> DataFrame:
    """Dead-letter messages ``{error, raw}`` for what is not a JSON object."""
    body = F.to_json(F.struct("error", F.col("payload").alias("raw")))
    return flat.filter(F.col("error").isNotNull()).select(
        F.lit(DEAD_LETTER_KEY).alias("key"), body.alias("value"), "topic", "partition", "offset")


def raw_rows(flat: DataFrame) -> DataFrame:
    """Raw layer: every parsed event verbatim, with broker coordinates and ingest time."""
    return flat.filter(F.col("error").isNull()).select(
        "transaction_id", "payload", "topic", "partition", "offset", "ingested_at")


def events(flat: DataFrame) -> DataFrame:
    """What goes on to the gate."""
    return flat.filter(F.col("error").isNull()).drop("error")


def injected(payload: Column) -> Column:
    """The ground-truth scenario inside a raw payload; null for a normal event."""
    return F.get_json_object(payload, f"$.{schemas.LABEL_FIELD}")


def dlq_report(letters: DataFrame) -> DataFrame:
    """Dead letters as error and shortened raw text."""
    body = F.from_json("value", "error string, raw string")
    return letters.select(
        F.col("offset"), F.coalesce(body["error"], F.lit(UNKNOWN_ERROR)).alias("error"),
        F.substring(F.coalesce(body["raw"], F.lit("")), 1, REPORT_CHARS).alias("raw"))


def dlq_counts(letters: DataFrame) -> DataFrame:
    return dlq_report(letters).groupBy("error").agg(F.count("*").alias("letters"))
