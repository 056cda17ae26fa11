"""What the statements take as given, written out apart from the engine."""
from __future__ import annotations

# Cities with latitude and longitude, in the adapter's order.
CITIES = {
    "Mumbai": (19.0760, 72.8777), "Pune": (18.5204, 73.8567), "Delhi": (28.7041, 77.1025), "Bengaluru": (12.9716, 77.5946),
    "Hyderabad": (17.3850, 78.4867), "Chennai": (13.0827, 80.2707), "Kolkata": (22.5726, 88.3639),
    "Ahmedabad": (23.0225, 72.5714), "Jaipur": (26.9124, 75.7873), "Lucknow": (26.8467, 80.9462),
}

# Event fields, features, model inputs, latency bounds in seconds.
EVENT_FIELDS = (
    "transaction_id", "user_id", "user_name", "merchant", "merchant_category", "city", "device", "device_os", "amount",
    "currency", "payment_method", "transaction_type", "status", "upi_handle", "payee_vpa", "bank", "ip_address", "latitude",
    "longitude",
)
FEATURES = (
    "txns_last_hour", "avg_amount_30d", "amount_zscore", "merchant_frequency", "device_changed", "location_changed",
    "payment_velocity", "is_weekend", "is_night", "seconds_since_prev", "km_from_prev",
)
LIGHT_FEATURES = (
    "amount_zscore", "payment_velocity", "avg_amount_30d", "device_changed", "location_changed", "seconds_since_prev",
    "km_from_prev",
)
MODEL_FEATURES = (
    "amount", "amount_zscore", "payment_velocity", "txns_last_hour", "merchant_frequency", "avg_amount_30d",
    "seconds_since_prev", "km_from_prev", "device_changed", "location_changed", "is_night", "is_weekend",
)
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)
