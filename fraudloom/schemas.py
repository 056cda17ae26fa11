"""Column contracts of the layers and the reference data."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The recognised cities with latitude and longitude.
CITIES = {
    "Mumbai": (19.0760, 72.8777),
    "Pune": (18.5204, 73.8567),
    "Delhi": (28.7041, 77.1025),
    "Bengaluru": (12.9716, 77.5946),
    "Hyderabad": (17.3850, 78.4867),
    "Chennai": (13.0827, 80.2707),
    "Kolkata": (22.5726, 88.3639),
    "Ahmedabad": (23.0225, 72.5714),
    "Jaipur": (26.9124, 75.7873),
    "Lucknow": (26.8467, 80.9462),
}

# Accepted payment states.
STATUSES = ("SUCCESS", "FAILED", "PENDING")

# Event fields copied into the processed layer, in table order.
EVENT_FIELDS = (
    "transaction_id", "user_id", "user_name", "merchant", "merchant_category", "city", "device",
    "device_os", "amount", "currency", "payment_method", "transaction_type", "status", "upi_handle",
    "payee_vpa", "bank", "ip_address", "latitude", "longitude",
)

# The engineered features, in table order.
FEATURES = (
    "txns_last_hour", "avg_amount_30d", "amount_zscore", "merchant_frequency", "device_changed",
    "location_changed", "payment_velocity", "is_weekend", "is_night", "seconds_since_prev",
    "km_from_prev",
)

# The subset of features of the light profile.
LIGHT_FEATURES = (
    "amount_zscore", "payment_velocity", "avg_amount_30d", "device_changed", "location_changed",
    "seconds_since_prev", "km_from_prev",
)

# The model's inputs; training and scoring both use this order.
MODEL_FEATURES = (
    "amount", "amount_zscore", "payment_velocity", "txns_last_hour", "merchant_frequency",
    "avg_amount_30d", "seconds_since_prev", "km_from_prev", "device_changed", "location_changed",
    "is_night", "is_weekend",
)
FLAG_FEATURES = ("device_changed", "location_changed", "is_night", "is_weekend")

# Fixed value: statuses remembered per user unless a rule needs more.
STATUS_TAIL = 10

# Fixed value: key of the ground-truth label inside a raw payload.
LABEL_FIELD = "_injected_fraud"

# Every field is read as text first, so that a bad type becomes a failed check and not a failed job.
EVENT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*EVENT_FIELDS, "event_time", LABEL_FIELD)]
)

MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()),
])

FINDING = T.StructType([
    T.StructField("rule", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("reason", T.StringType()),
])

MONEY = T.DecimalType(14, 2)
TOTAL = T.DecimalType(18, 2)


def cities(spark: SparkSession) -> DataFrame:
    """The city reference table (ten fixed rows)."""
    rows = ", ".join(f"({i}, '{name}', {lat}D, {lon}D)" for i, (name, (lat, lon)) in enumerate(CITIES.items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS cities(ci, city, latitude, longitude)")
