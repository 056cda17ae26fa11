"""The data-quality gate: every failed check of an event, in a fixed order."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudloom import schemas
from fraudloom.functions.clock import bind, parse_common_iso, parse_iso

# Fixed value: text that reads as a number (digits may be grouped by single underscores).
NUMBER_FORM = (
    r"(?i)^\s*[+-]?(nan|inf|infinity|(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?)\s*$"
)
USUAL_NUMBER = r"^[+-]?\d{1,15}(\.\d{1,9})?$"
MIN_HANDLE = 4  # fixed value
OUT_OF_RANGE = "AMOUNT_OUT_OF_RANGE"  # of events that pass the gate and that no table holds


def _blank(column: str) -> Column:
    return F.coalesce(column, F.lit("")) == ""


def number(text: Column) -> Column:
    """Text as double, null if it is not a number. A bare JSON NaN arrives with quotes around it."""
    def read(bare: Column) -> Column:
        plain = F.lower(F.trim(F.replace(bare, F.lit("_"), F.lit(""))))
        return F.when(bare.rlike(NUMBER_FORM), F.regexp_replace(plain, "inf$", "infinity").try_cast("double"))

    return bind(F.regexp_replace(text, '^"(.*)"$', "$1"), read)


def with_reading(events: DataFrame) -> DataFrame:
    """Add ``reading``: time and amount read from their text.

    The usual forms are read by compiled code; what is left null goes through the general readers.
    These sit in a generator and not a projection, because the optimizer copies projected expressions
    into every filter and column that uses them.
    """
    amount = F.col("amount")
    usual = events.withColumns({
        "_time": parse_common_iso(F.col("event_time")),
        "_number": F.when(amount.rlike(USUAL_NUMBER), amount.try_cast("double")),
    })
    reading = F.struct(
        F.coalesce("_time", parse_iso(F.col("event_time"))).alias("time"),
        F.coalesce("_number", number(amount)).alias("amount"),
    )
    return usual.select(*events.columns, F.explode(F.array(reading)).alias("reading"))


def checks(as_of_us: Column, profile: str = "full") -> dict[str, Column]:
    """When each check fails, in listing order, for rows with their ``reading``.

    ``as_of_us`` is the clock for the future check. ``light`` is the reduced gate with one merged
    amount check.
    """
    value = F.col("reading.amount")
    gone = {
        "MISSING_TRANSACTION_ID": _blank("transaction_id"),
        "MISSING_USER_ID": _blank("user_id"),
    }
    city = ~F.coalesce(F.col("city").isin(*schemas.CITIES), F.lit(False))
    status = ~F.coalesce(F.col("status").isin(*schemas.STATUSES), F.lit(False))
    # Spark orders NaN above every number, so NaN <= 0 is false, as in IEEE comparison.
    not_positive = value <= 0
    if profile == "light":
        bad_amount = F.coalesce(value.isNull() | not_positive, F.lit(True))
        return {**gone, "INVALID_AMOUNT": bad_amount, "INVALID_CITY": city, "INVALID_STATUS": status}
    handle = F.coalesce("upi_handle", F.lit(""))
    event_us = F.col("reading.time.event_us")
    return {
        **gone,
        "NULL_AMOUNT": F.col("amount").isNull(),
        "NON_POSITIVE_AMOUNT": not_positive,
        "NON_NUMERIC_AMOUNT": F.col("amount").isNotNull() & value.isNull(),
        "MISSING_MERCHANT": _blank("merchant"),
        "INVALID_UPI_HANDLE": ~F.contains(handle, F.lit("@")) | (F.length(handle) < MIN_HANDLE),
        "INVALID_STATUS": status,
        "INVALID_CITY": city,
        "INVALID_TIMESTAMP": event_us.isNull(),
        "FUTURE_TIMESTAMP": event_us > as_of_us,
    }


def gate(events: DataFrame, as_of_us: Column | None = None, profile: str = "full") -> DataFrame:
    """Events with ``failed_checks``. Without ``as_of_us`` the ingest time is the clock."""
    clock = F.unix_micros("ingested_at") if as_of_us is None else as_of_us
    codes = [F.when(bad, F.lit(code)) for code, bad in checks(clock, profile).items()]
    failed = F.array_except(F.array(*codes), F.array(F.lit(None).cast("string")))
    return with_reading(events).withColumn("failed_checks", failed)


def dq_split(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected events. Rejected ones never reach the features."""
    clean = F.size("failed_checks") == 0
    return gated.filter(clean), gated.filter(~clean)


def rejected_rows(rejected: DataFrame) -> DataFrame:
    """Quarantine layer."""
    return rejected.select(
        "transaction_id", "payload", "failed_checks",
        F.array_join("failed_checks", ", ").alias("reason"), F.col("ingested_at").alias("rejected_at"))


def dq_summary(gated: DataFrame) -> DataFrame:
    """Events per failed check."""
    return (gated.select(F.explode("failed_checks").alias("failed_check"))
            .groupBy("failed_check").agg(F.count("*").alias("events")))


def rejected_with(rejected: DataFrame, code: str) -> DataFrame:
    return rejected.filter(F.array_contains("failed_checks", code))


def _money() -> Column:
    """The amount as money; null if it is NaN, infinite or too large."""
    value = F.col("reading.amount")
    plain = F.trim(F.replace("amount", F.lit("_"), F.lit("")))
    return F.when(~F.isnan(value) & (F.abs(value) < 1e12), F.coalesce(
        plain.try_cast(schemas.MONEY), F.round(value, 2).try_cast(schemas.MONEY)))


def out_of_range_rows(valid: DataFrame) -> DataFrame:
    """Quarantine rows of events that pass the gate with an amount the processed table cannot hold."""
    odd = valid.filter(_money().isNull())
    return rejected_rows(odd.withColumn("failed_checks", F.array(F.lit(OUT_OF_RANGE))))


def typed(valid: DataFrame) -> DataFrame:
    """Valid events as typed transactions, ready for the features.

    An amount that no money column can hold passes the gate. ``amount`` is null then; the rules look at
    ``amount_value``, which is the number as read wherever it is finite.
    """
    value = F.col("reading.amount")
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    return valid.withColumns({
        "amount": _money(),
        "amount_value": F.when(finite, value),
        "latitude": F.col("latitude").try_cast("double"),
        "longitude": F.col("longitude").try_cast("double"),
        "event_us": F.col("reading.time.event_us"),
        "local_us": F.col("reading.time.local_us"),
    }).drop("reading", "event_time", "failed_checks")
