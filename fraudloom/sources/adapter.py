"""Payment events derived from the generic ``events`` table.

``events`` holds no payments, so fields are computed from its ids, kind and value. ``squeeze`` divides
the distance between event times, so that short feature windows fill.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudloom import schemas
from fraudloom.functions.clock import DAY_US
from fraudloom.functions.exact import int_div

EPOCH_US = 1_704_067_200_000_000  # 2024-01-01, where the test events begin
SQUEEZE = 1000
OFFSET_US = 19_800_000_000  # +05:30, written by every fourth user
LATE_US = 120_000_000
RULES_CHANGE_US = 600_000_000  # after this time, and again after it, the test rules change
TOPIC = "transactions.raw"


def _prefixed(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


ROWS_PER_TASK = 100_000


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a table out to tasks of bounded size, one per core at least.

    How a file is cut says little about rows: a cut within a row group holds none, and a row group stays whole.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // ROWS_PER_TASK)))


def transactions(
    spark: SparkSession, sf_dir: str, squeeze: int = SQUEEZE, late: bool = False, dealt: bool = True
) -> DataFrame:
    """Clean typed transactions. ``late`` back-dates every 17th event, so order and time differ.

    ``dealt`` is for work that costs more a row than its scan; without it no row is counted or moved.
    """
    seq, user, k, event_us = F.col("event_id"), F.col("user_id"), F.col("k"), F.col("event_us")
    time_us = F.unix_micros(F.col("ts").cast("timestamp"))
    squeezed = F.lit(EPOCH_US) + int_div(time_us - EPOCH_US, F.lit(squeeze))
    if late:
        squeezed = squeezed - F.when(seq % 17 == 0, F.lit(LATE_US)).otherwise(0)
    # k and the time are used many times below: a generator computes them once per row.
    base = F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), squeezed.alias("event_us"))
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    events = (spread(table) if dealt else table).select(
        "event_id", "user_id", "event_type", "value", F.inline(F.array(base)))
    rows = events.select(
        seq.alias("seq"),
        _prefixed("T", seq).alias("transaction_id"),
        _prefixed("U", user).alias("user_id"),
        _prefixed("Name", user % 97).alias("user_name"),
        _prefixed("M", seq % 25).alias("merchant"),
        _prefixed("C", seq % 25 % 5).alias("merchant_category"),
        F.when(k == 7, (user + 3) % 10).otherwise(user % 10).cast("int").alias("ci"),
        _prefixed("D", F.when(k.isin(7, 8), (user + 1) % 6).otherwise(user % 6)).alias("device"),
        F.when(user % 5 == 0, "iOS").otherwise("Android").alias("device_os"),
        F.when(k == 11, F.col("value") * 40).otherwise(F.col("value")).cast(schemas.MONEY).alias("amount"),
        F.lit("INR").alias("currency"),
        F.lit("UPI").alias("payment_method"),
        F.when(seq % 25 % 5 == 0, "P2P").otherwise("P2M").alias("transaction_type"),
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "signup", "PENDING").otherwise("SUCCESS").alias("status"),
        F.concat(_prefixed("u", user), F.lit("@bank")).alias("upi_handle"),
        F.concat(_prefixed("m", seq % 25), F.lit("@shop")).alias("payee_vpa"),
        _prefixed("B", user % 7).alias("bank"),
        _prefixed("10.0.0.", user % 250).alias("ip_address"),
        event_us.alias("event_us"),
        (event_us + F.when(user % 4 == 1, F.lit(OFFSET_US)).otherwise(0)).alias("local_us"),
        (user % 4 == 1).alias("is_offset"),
        (event_us + (seq * 7919) % 400_000).alias("ingested_us"),
        (user % 3).cast("int").alias("partition"),
        F.when(k == 7, "TRAVEL").when(k == 11, "HIGH_VALUE").alias("injected"),
    )
    return rows.join(F.broadcast(schemas.cities(spark)), "ci").drop("ci")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text events in which fixed residues of ``seq`` carry one defect each."""
    t = transactions(spark, sf_dir)
    slot = F.col("seq") % 50
    written = F.date_format(F.timestamp_micros("local_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    event_time = F.concat(written, F.when(F.col("is_offset"), "+05:30").otherwise("+00:00"))

    def broken(good: Column, **bad: str | None) -> Column:
        value = good
        for at, text in bad.items():
            value = F.when(slot == int(at[1:]), F.lit(text).cast("string")).otherwise(value)
        return value

    return t.withColumns({
        "transaction_id": broken(F.col("transaction_id"), _1=None),
        "user_id": broken(F.col("user_id"), _2=""),
        "amount": broken(F.col("amount").cast("string"), _3=None, _4="-5.00", _5="abc"),
        "merchant": broken(F.col("merchant"), _6=None),
        "upi_handle": broken(F.col("upi_handle"), _7="nohandle", _8="a@b"),
        "status": broken(F.col("status"), _9="success"),
        "city": broken(F.col("city"), _10="Atlantis", _11=None),
        "event_time": broken(event_time, _12="not-a-time", _13="2999-01-01T00:00:00+00:00"),
    })


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty events as JSON messages with broker coordinates; three residues are not JSON objects."""
    members = [F.col(name) for name in schemas.EVENT_FIELDS]
    event = F.struct(*members, "event_time", F.col("injected").alias(schemas.LABEL_FIELD))
    text = F.to_json(event, {"ignoreNullFields": "false"})
    d = dirty(spark, sf_dir).select("*", F.explode(F.array(text)).alias("whole"))
    whole = F.col("whole")
    slot = F.col("seq") % 50
    value = F.when(slot == 14, F.substring(whole, 1, 40)).when(slot == 15, "[1]").when(slot == 16, "5")
    return d.select(
        value.otherwise(whole).alias("value"),
        F.lit(TOPIC).alias("topic"),
        "partition",
        F.col("seq").alias("offset"),
        F.timestamp_micros("ingested_us").alias("ingested_at"),
    )


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds from event to ingest per transaction, on the ingest clock."""
    t = transactions(spark, sf_dir)
    return t.select(
        F.timestamp_micros("ingested_us").alias("observed_at"),
        ((F.col("ingested_us") - F.col("event_us")) / 1e6).alias("seconds"),
    )


AS_OF = "2024-01-02 00:00:00"  # end of the squeezed period, used where the reference reads the clock
GATE_CLOCK_US = EPOCH_US + 731 * DAY_US  # 2026-01-01
