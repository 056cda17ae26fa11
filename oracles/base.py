"""Common table expressions: the adapter, the features, the rules and the layers in DuckDB SQL."""
from __future__ import annotations

from oracles.constants import CITIES, EVENT_FIELDS

EPOCH = 1704067200000000
HOUR, MINUTE = 3600000000, 60000000
GATE_CLOCK = EPOCH + 731 * 86400000000


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def adapter(squeeze: int = 1000, late: bool = False) -> str:
    cities = ",".join(f"({i},'{name}',{lat}e0,{lon}e0)" for i, (name, (lat, lon)) in enumerate(CITIES.items()))
    shift = "- CASE WHEN seq % 17 = 0 THEN 120000000 ELSE 0 END" if late else ""
    return f"""
cities(ci, city, latitude, longitude) AS (VALUES {cities}),
b AS (SELECT event_id AS seq, user_id AS u, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type,
    value, {EPOCH} + (epoch_us(ts) - {EPOCH}) // {squeeze} AS base_us FROM events),
t AS (SELECT seq, k, concat('T', seq) AS transaction_id, concat('U', u) AS user_id,
    concat('Name', u % 97) AS user_name, concat('M', seq % 25) AS merchant,
    concat('C', seq % 25 % 5) AS merchant_category,
    CASE WHEN k = 7 THEN (u + 3) % 10 ELSE u % 10 END AS ci,
    concat('D', CASE WHEN k IN (7, 8) THEN (u + 1) % 6 ELSE u % 6 END) AS device,
    CASE WHEN u % 5 = 0 THEN 'iOS' ELSE 'Android' END AS device_os,
    CAST(CASE WHEN k = 11 THEN value * 40 ELSE value END AS DECIMAL(14,2)) AS amount,
    'INR' AS currency, 'UPI' AS payment_method,
    CASE WHEN seq % 25 % 5 = 0 THEN 'P2P' ELSE 'P2M' END AS transaction_type,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'SUCCESS' END AS status,
    concat('u', u, '@bank') AS upi_handle, concat('m', seq % 25, '@shop') AS payee_vpa,
    concat('B', u % 7) AS bank, concat('10.0.0.', u % 250) AS ip_address,
    base_us {shift} AS event_us,
    base_us {shift} + CASE WHEN u % 4 = 1 THEN 19800000000 ELSE 0 END AS local_us, u % 4 = 1 AS is_offset,
    base_us {shift} + (seq * 7919) % 400000 AS ingested_us, u % 3 AS partition,
    CASE WHEN k = 7 THEN 'TRAVEL' WHEN k = 11 THEN 'HIGH_VALUE' END AS injected
  FROM b),
txns AS (SELECT t.*, city, latitude, longitude FROM t JOIN cities USING (ci))"""


DIRTY = """
dirty AS (SELECT * REPLACE (
    CASE seq % 50 WHEN 1 THEN NULL ELSE transaction_id END AS transaction_id,
    CASE seq % 50 WHEN 2 THEN '' ELSE user_id END AS user_id,
    CASE seq % 50 WHEN 3 THEN NULL WHEN 4 THEN '-5.00' WHEN 5 THEN 'abc' ELSE CAST(amount AS VARCHAR) END AS amount,
    CASE seq % 50 WHEN 6 THEN NULL ELSE merchant END AS merchant,
    CASE seq % 50 WHEN 7 THEN 'nohandle' WHEN 8 THEN 'a@b' ELSE upi_handle END AS upi_handle,
    CASE seq % 50 WHEN 9 THEN 'success' ELSE status END AS status,
    CASE seq % 50 WHEN 10 THEN 'Atlantis' WHEN 11 THEN NULL ELSE city END AS city),
  CASE seq % 50 WHEN 12 THEN 'not-a-time' WHEN 13 THEN '2999-01-01T00:00:00+00:00'
    ELSE concat(strftime(make_timestamp(local_us), '%Y-%m-%dT%H:%M:%S.%f'),
                CASE WHEN is_offset THEN '+05:30' ELSE '+00:00' END) END AS event_time
  FROM txns)"""

NUMERIC = "regexp_full_match(amount, '[+-]?[0-9]+([.][0-9]*)?')"
CODES = {
    "MISSING_TRANSACTION_ID": "coalesce(transaction_id, '') = ''",
    "MISSING_USER_ID": "coalesce(user_id, '') = ''",
    "NULL_AMOUNT": "amount IS NULL",
    "NON_POSITIVE_AMOUNT": "try_cast(amount AS DOUBLE) <= 0",
    "NON_NUMERIC_AMOUNT": f"amount IS NOT NULL AND NOT {NUMERIC}",
    "MISSING_MERCHANT": "coalesce(merchant, '') = ''",
    "INVALID_UPI_HANDLE": "NOT contains(coalesce(upi_handle, ''), '@') OR length(coalesce(upi_handle, '')) < 4",
    "INVALID_STATUS": "NOT coalesce(status IN ('SUCCESS', 'FAILED', 'PENDING'), false)",
    "INVALID_CITY": "NOT coalesce(city IN (SELECT city FROM cities), false)",
    "INVALID_TIMESTAMP": "try_cast(event_time AS TIMESTAMPTZ) IS NULL",
    "FUTURE_TIMESTAMP": f"epoch_us(try_cast(event_time AS TIMESTAMPTZ)) > {GATE_CLOCK}",
}
LIGHT_CODES = {
    "MISSING_TRANSACTION_ID": CODES["MISSING_TRANSACTION_ID"],
    "MISSING_USER_ID": CODES["MISSING_USER_ID"],
    "INVALID_AMOUNT": "coalesce(try_cast(amount AS DOUBLE) <= 0, true)",
    "INVALID_CITY": CODES["INVALID_CITY"],
    "INVALID_STATUS": CODES["INVALID_STATUS"],
}


def gated(codes: dict[str, str] = CODES, clock: str | None = None) -> str:
    cases = ",".join(f"CASE WHEN {when} THEN '{code}' END" for code, when in codes.items())
    if clock:
        cases = cases.replace(f"> {GATE_CLOCK}", f"> {clock}")
    return f"gated AS (SELECT *, list_filter([{cases}], lambda x: x IS NOT NULL) AS failed FROM dirty)"


def json_text() -> str:
    parts = []
    for name in EVENT_FIELDS:
        text = f"CAST({name} AS VARCHAR)"
        quoted = text if name in ("latitude", "longitude") else f"concat('\"', {text}, '\"')"
        parts.append(f"concat('\"{name}\":', CASE WHEN {name} IS NULL THEN 'null' ELSE {quoted} END)")
    for name, col in (("event_time", "event_time"), ("_injected_fraud", "injected")):
        parts.append(f"concat('\"{name}\":', CASE WHEN {col} IS NULL THEN 'null' ELSE concat('\"', {col}, '\"') END)")
    return "concat('{', concat_ws(',', " + ", ".join(parts) + "), '}')"


MESSAGES = f"""
wholes AS (SELECT *, {json_text()} AS whole FROM gated),
messages AS (SELECT *, CASE seq % 50 WHEN 14 THEN substr(whole, 1, 40) WHEN 15 THEN '[1]' WHEN 16 THEN '5'
    ELSE whole END AS value FROM wholes),
landed AS (SELECT * FROM messages WHERE seq % 50 NOT IN (14, 15, 16)),
accepted AS (SELECT * REPLACE (CAST(amount AS DECIMAL(14,2)) AS amount) FROM landed WHERE len(failed) = 0)"""


def feats(src: str = "txns", history: int = 200, order: str = "event_us, seq") -> str:
    """Features of ``src``, with the same names the Spark side uses."""
    arrival = order == "seq"
    if arrival:
        def within(span: int) -> str:
            return f"len(list_filter(coalesce(times, []), lambda x: event_us - x <= {span}))"
    else:
        def within(span: int) -> str:
            return (f"least({history}, count(*) OVER (PARTITION BY user_id ORDER BY event_us RANGE BETWEEN {span} "
                    "PRECEDING AND CURRENT ROW) - count(*) OVER (PARTITION BY user_id, event_us ORDER BY seq "
                    "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")
    times = "list(event_us) OVER hist" if arrival else "NULL"
    return f"""
h0 AS (SELECT *, CAST(amount * 100 AS BIGINT) AS cents FROM {src}),
h1 AS (SELECT *, {times} AS times,
    count(*) OVER hist AS n, CAST(sum(cents) OVER hist AS HUGEINT) AS s,
    CAST(sum(CAST(cents AS HUGEINT) * cents) OVER hist AS HUGEINT) AS s2,
    row_number() OVER (PARTITION BY user_id, merchant ORDER BY {order}) AS merchant_frequency,
    lag(event_us) OVER w AS prev_us, lag(device) OVER w AS prev_device, lag(city) OVER w AS prev_city,
    lag(latitude) OVER w AS lat0, lag(longitude) OVER w AS lon0,
    coalesce(lag(status, 1) OVER w = 'FAILED' AND lag(status, 2) OVER w = 'FAILED'
             AND lag(status, 3) OVER w = 'FAILED', false) AS three_failed,
    array_to_string(list(status) OVER (PARTITION BY user_id ORDER BY {order} ROWS 9 PRECEDING), ',') AS recent_statuses
  FROM h0 WINDOW w AS (PARTITION BY user_id ORDER BY {order}),
    hist AS (PARTITION BY user_id ORDER BY {order} ROWS BETWEEN {history} PRECEDING AND 1 PRECEDING)),
h2 AS (SELECT *, {within(HOUR)} AS txns_last_hour, {within(MINUTE)} AS payment_velocity,
    CASE WHEN n > 0 THEN CAST((2 * s + n) // (2 * n) AS BIGINT) ELSE cents END AS avg_cents,
    CASE WHEN n >= 2 AND n * s2 - s * s > 0
      THEN round(CAST(n * cents - s AS DOUBLE) / sqrt(CAST(n * s2 - s * s AS DOUBLE)), 4) ELSE 0.0 END AS amount_zscore
  FROM h1),
feats AS (SELECT *, avg_cents / 100.0 AS avg_amount_30d,
    coalesce(prev_device <> device, prev_device IS NOT NULL) AS device_changed,
    coalesce(prev_city <> city, prev_city IS NOT NULL) AS location_changed,
    isodow(make_timestamp(local_us)) >= 6 AS is_weekend,
    (hour(make_timestamp(local_us)) >= 23 OR hour(make_timestamp(local_us)) < 5) AS is_night,
    CAST(trunc((event_us - prev_us) / 1000000.0) AS BIGINT) AS seconds_since_prev,
    CASE WHEN lat0 IS NOT NULL AND latitude IS NOT NULL THEN round(2 * 6371.0e0 * asin(sqrt(least(1.0e0, pow(sin(radians(latitude - lat0) / 2), 2)
      + cos(radians(lat0)) * cos(radians(latitude)) * pow(sin(radians(longitude - lon0) / 2), 2)))), 2) END AS km_from_prev
  FROM h2)"""


RULES = ("IMPOSSIBLE_TRAVEL", "VELOCITY", "HIGH_VALUE", "NEW_DEVICE", "REPEATED_FAILURES")
SEVERITY = dict(zip(RULES, ("CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM")))
SPEED = "(km_from_prev / (seconds_since_prev / 3600.0e0))"


def verdicts(velocity: int = 4, zscore: float = 5.0, multiple: int = 20) -> str:
    return f"""
ruled AS (SELECT *,
    coalesce(km_from_prev > 200 AND seconds_since_prev > 0 AND {SPEED} > 800, false) AS "IMPOSSIBLE_TRAVEL",
    payment_velocity >= {velocity} AS "VELOCITY",
    amount_zscore >= {zscore} OR (avg_cents > 0 AND cents >= {multiple} * avg_cents) AS "HIGH_VALUE",
    device_changed AND location_changed AS "NEW_DEVICE",
    status = 'SUCCESS' AND three_failed AS "REPEATED_FAILURES" FROM feats),
flagged AS (SELECT *, {' OR '.join(f'"{r}"' for r in RULES)} AS is_flagged,
    {' + '.join(f'CAST("{r}" AS INT)' for r in RULES)} AS n_findings FROM ruled)"""


def reason_texts(light: bool = False) -> dict[str, str]:
    rupee = "Rs." if light else "₹"
    device = ("concat('new device in new city ''', city, '''')" if light else
              "concat('new device ''', device, ''' in new city ''', city, '''')")
    return {
        "IMPOSSIBLE_TRAVEL": f"format('{{:.0f}} km in {{}}s (~{{:.0f}} km/h){'' if light else ' between consecutive txns'}', "
                             f"km_from_prev, seconds_since_prev, {SPEED})",
        "VELOCITY": "concat(payment_velocity, ' transactions within 60 seconds')",
        "HIGH_VALUE": f"format('{rupee}{{:,.0f}} vs 30d avg {rupee}{{:,.0f}} (z={{:.1f}})', CAST(amount AS DOUBLE), "
                      "CAST(avg_amount_30d AS DOUBLE), amount_zscore)",
        "NEW_DEVICE": device,
        "REPEATED_FAILURES": f"'3 consecutive failures before {'' if light else 'a '}success'",
    }


def findings(light: bool = False) -> str:
    texts = reason_texts(light)
    rows = " UNION ALL ".join(
        f"SELECT seq, transaction_id, user_id, merchant, '{r}' AS rule_triggered, '{SEVERITY[r]}' AS severity, "
        f"{texts[r]} AS reason, amount, city, event_us, ingested_us, {i} AS rule_no FROM flagged WHERE \"{r}\""
        for i, r in enumerate(RULES))
    return f"fraud AS ({rows})"


PROFILE = """
fraud_users AS (SELECT user_id, count(DISTINCT transaction_id) AS fraud_txns FROM fraud GROUP BY 1),
profile AS (SELECT p.user_id, user_name, txn_count, avg_amount, std_amount, p95_amount, max_amount, distinct_cities,
    distinct_devices, first_seen, last_seen, coalesce(fraud_txns, 0) AS fraud_txns,
    ((200 * 100 * coalesce(fraud_txns, 0) + txn_count) // (2 * txn_count)) / 100.0 AS fraud_rate_pct
  FROM (SELECT user_id, arg_min(user_name, (event_us, transaction_id)) AS user_name, count(*) AS txn_count,
      CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0 AS avg_amount,
      round(sqrt(CAST(count(*) * sum(CAST(cents AS HUGEINT) * cents) - sum(cents) * sum(cents) AS DOUBLE))
            / count(*) / 100, 2) AS std_amount,
      CAST(quantile_disc(amount, 0.95) AS DOUBLE) AS p95_amount, CAST(max(amount) AS DOUBLE) AS max_amount,
      count(DISTINCT city) AS distinct_cities, count(DISTINCT device) AS distinct_devices,
      min(event_us) AS first_seen, max(event_us) AS last_seen FROM flagged GROUP BY 1) p
  LEFT JOIN fraud_users USING (user_id))"""

RISK = """
fraud_merchants AS (SELECT merchant, count(DISTINCT transaction_id) AS fraud_txns FROM fraud GROUP BY 1),
modes AS (SELECT merchant, merchant_category, row_number() OVER (PARTITION BY merchant
    ORDER BY count(*) DESC, merchant_category) AS rn FROM flagged GROUP BY 1, 2),
risk0 AS (SELECT merchant, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
    CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0 AS avg_amount FROM flagged GROUP BY 1),
risk1 AS (SELECT r.*, merchant_category, coalesce(fraud_txns, 0) AS fraud_txns,
    ((200 * 100 * coalesce(fraud_txns, 0) + txn_count) // (2 * txn_count)) / 100.0 AS fraud_rate_pct
  FROM risk0 r JOIN modes m ON m.merchant = r.merchant AND m.rn = 1
  LEFT JOIN fraud_merchants f ON f.merchant = r.merchant),
risk AS (SELECT *, CASE WHEN fraud_rate_pct >= 25 THEN 'HIGH' WHEN fraud_rate_pct >= 10 THEN 'MEDIUM' ELSE 'LOW' END
    AS risk_tier FROM risk1)"""

TXNS = ctes(adapter())
FEATS = ctes(adapter(), feats())
FLAGGED = ctes(adapter(), feats(), verdicts())
FRAUD = ctes(adapter(), feats(), verdicts(), findings())
PROFILES = ctes(adapter(), feats(), verdicts(), findings(), PROFILE)
RISKS = ctes(adapter(), feats(), verdicts(), findings(), RISK)
GATED = ctes(adapter(), DIRTY, gated())
LANDED = ctes(adapter(), DIRTY, gated(clock="ingested_us"), MESSAGES)
PIPELINE = ctes(adapter(), DIRTY, gated(clock="ingested_us"), MESSAGES, feats("accepted"), verdicts(), findings())
