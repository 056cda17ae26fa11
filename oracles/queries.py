"""One DuckDB statement per registered query."""
from __future__ import annotations

from oracles.base import (
    CODES, DIRTY, FEATS, FLAGGED, FRAUD, GATED, LANDED, LIGHT_CODES, MESSAGES, PIPELINE, PROFILE, PROFILES, RISKS, RULES, TXNS,
    EPOCH, adapter, ctes, feats, findings, gated, verdicts,
)
from oracles.constants import BUCKETS, FEATURES, LIGHT_FEATURES, MODEL_FEATURES

Q: dict[str, str] = {}
DOUBLES = ("amount", "avg_amount_30d")


def cols(names, prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{n} AS DOUBLE) AS {n}" if n in DOUBLES else f"{prefix}{n}" for n in names)


def pct(num: str, den: str, places: int = 2) -> str:
    scale = 10**places
    return f"(CAST(({200 * scale} * {num} + {den}) // (2 * {den}) AS BIGINT) / {float(scale)}e0)"


def mean_cents(col: str = "cents") -> str:
    return f"CAST((2 * sum({col}) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0e0"


# ---- sources and sinks -------------------------------------------------------------------------------
Q["adapter_txns"] = TXNS + """
SELECT seq, transaction_id, user_id, user_name, merchant, merchant_category, device, device_os,
  CAST(amount AS DOUBLE) AS amount, currency, payment_method, transaction_type, status, upi_handle, payee_vpa, bank,
  ip_address, event_us, local_us, ingested_us, partition, injected, city, latitude, longitude FROM txns"""
TOPIC = "'transactions.raw' AS topic"
Q["src_stream"] = LANDED + f"SELECT {TOPIC}, partition, seq AS \"offset\", length(value) AS chars FROM messages"
LETTER = """CASE seq % 50 WHEN 14 THEN 'malformed JSON' ELSE 'not a JSON object' END"""
Q["parse_json_dlq"] = LANDED + f"""
SELECT 'unparseable' AS key, seq AS "offset", {LETTER} AS error, value AS raw FROM messages WHERE seq % 50 IN (14, 15, 16)"""
Q["land_raw"] = LANDED + f"""
SELECT transaction_id, value AS payload, {TOPIC}, partition, seq AS "offset", ingested_us AS ingested_at FROM landed"""
Q["sink_rejected"] = LANDED + """
SELECT transaction_id, array_to_string(failed, ',') AS failed_checks, array_to_string(failed, ', ') AS reason,
  ingested_us AS rejected_at FROM landed WHERE len(failed) > 0"""
Q["sink_processed_dedup"] = TXNS + "SELECT transaction_id, seq, CAST(amount AS DOUBLE) AS amount FROM txns WHERE seq % 2 <> 0"
Q["insert_if_absent"] = TXNS + "SELECT transaction_id FROM txns WHERE seq % 4 <> 0"
FRAUD_COLS = ("transaction_id, user_id, rule_triggered, severity, reason, CAST(amount AS DOUBLE) AS amount, city, "
              "event_us AS event_time, ingested_us AS detected_at")
Q["sink_fraud_events"] = PIPELINE + f"SELECT {FRAUD_COLS} FROM fraud"
Q["emit_cleaned"] = PIPELINE + """
SELECT user_id AS key, transaction_id, CAST(amount AS VARCHAR) AS amount, event_time, false AS leaks_label FROM accepted"""
NAMES = "concat_ws(',', " + ", ".join(f"CASE WHEN \"{r}\" THEN '{r}' END" for r in RULES) + ")"
Q["emit_suspicious"] = PIPELINE + f"""
SELECT user_id AS key, transaction_id, {NAMES} AS rules, false AS leaks_label FROM flagged WHERE is_flagged"""
Q["dlq_report"] = LANDED + f"""
SELECT seq AS "offset", {LETTER} AS error, substr(value, 1, 200) AS raw FROM messages WHERE seq % 50 IN (14, 15, 16)"""
Q["dlq_counts"] = LANDED + f"SELECT {LETTER} AS error, count(*) AS letters FROM messages WHERE seq % 50 IN (14, 15, 16) GROUP BY 1"
STRETCHED = "(1704067200000000 + (ingested_us - 1704067200000000) * 10)"
Q["archive_hourly"] = LANDED + f"""
SELECT strftime(make_timestamp({STRETCHED}), '%Y') AS year, strftime(make_timestamp({STRETCHED}), '%m') AS month,
  strftime(make_timestamp({STRETCHED}), '%d') AS day, strftime(make_timestamp({STRETCHED}), '%H') AS hour,
  transaction_id, seq AS "offset" FROM landed"""
Q["archive_scan"] = LANDED + f"""
SELECT transaction_id, seq AS "offset", {STRETCHED} AS ingested_at FROM landed
WHERE {STRETCHED} >= (SELECT min({STRETCHED}) // 3600000000 * 3600000000 FROM landed) + 3600000000
  AND {STRETCHED} < (SELECT min({STRETCHED}) // 3600000000 * 3600000000 FROM landed) + 4 * 3600000000"""
Q["retain_latest"] = TXNS + """
SELECT transaction_id, event_us AS event_time FROM txns ORDER BY event_us DESC, transaction_id DESC LIMIT 2000"""
FLAGS = ("device_changed", "location_changed", "is_night", "is_weekend")
INPUTS = ", ".join(f"CAST({c} AS INT) AS {c}" if c in FLAGS else cols([c]) for c in MODEL_FEATURES)
Q["ml_feature_scan"] = FEATS + f"SELECT transaction_id, {INPUTS} FROM feats"

# ---- quality -----------------------------------------------------------------------------------------
Q["dq_failed_checks"] = GATED + "SELECT seq, array_to_string(failed, ',') AS failed_checks FROM gated"
for key, code in {
    "dq_missing_txn": "MISSING_TRANSACTION_ID", "dq_missing_user": "MISSING_USER_ID", "dq_null_amount": "NULL_AMOUNT",
    "dq_non_positive": "NON_POSITIVE_AMOUNT", "dq_non_numeric": "NON_NUMERIC_AMOUNT",
    "dq_missing_merchant": "MISSING_MERCHANT", "dq_bad_handle": "INVALID_UPI_HANDLE",
    "dq_bad_status": "INVALID_STATUS", "dq_bad_city": "INVALID_CITY", "dq_bad_ts": "INVALID_TIMESTAMP",
    "dq_future_ts": "FUTURE_TIMESTAMP",
}.items():
    Q[key] = ctes(adapter(), DIRTY) + f"SELECT seq FROM dirty WHERE {CODES[code]}"
Q["dq_split"] = GATED + "SELECT seq, CASE WHEN len(failed) = 0 THEN 'valid' ELSE 'rejected' END AS side FROM gated"
Q["dq_light"] = ctes(adapter(), DIRTY, gated(LIGHT_CODES)) + "SELECT seq, array_to_string(failed, ',') AS failed_checks FROM gated"
Q["dq_summary"] = GATED + "SELECT f AS failed_check, count(*) AS events FROM (SELECT unnest(failed) AS f FROM gated) GROUP BY 1"
Q["dq_summary_masks"] = LANDED + "SELECT f AS failed_check, count(*) AS events FROM (SELECT unnest(failed) AS f FROM landed) GROUP BY 1"
Q["dq_search"] = LANDED + """
SELECT transaction_id, array_to_string(failed, ', ') AS reason FROM landed WHERE list_has_any(failed, ['INVALID_CITY', 'NULL_AMOUNT'])"""
PLAIN_FIELDS = ("transaction_id, user_id, user_name, merchant, merchant_category, city, device, device_os, "
                "CAST(amount AS DOUBLE) AS amount, currency, payment_method, transaction_type, status, upi_handle, "
                "payee_vpa, bank, ip_address, latitude, longitude")
RULE_FLAG = " OR ".join(f'"{r}"' for r in RULES)
Q["project_processed"] = PIPELINE + f"""
SELECT {PLAIN_FIELDS}, event_us AS event_time, {cols(FEATURES)}, is_flagged, is_flagged AS rule_flagged FROM flagged"""

# ---- features ----------------------------------------------------------------------------------------
Q["features_all"] = FEATS + f"SELECT seq, {cols(FEATURES)} FROM feats"
Q["features_hot_split"] = Q["features_all"]
for key, name in {
    "feat_txns_last_hour": "txns_last_hour", "feat_velocity": "payment_velocity", "feat_avg_amount": "avg_amount_30d",
    "feat_zscore": "amount_zscore", "feat_merchant_freq": "merchant_frequency", "feat_device_changed": "device_changed",
    "feat_location_changed": "location_changed", "feat_seconds_since_prev": "seconds_since_prev",
    "feat_km_from_prev": "km_from_prev", "feat_is_weekend": "is_weekend", "feat_is_night": "is_night",
    "feat_recent_statuses": "recent_statuses",
}.items():
    Q[key] = FEATS + f"SELECT seq, {cols([name])} FROM feats"
ARRIVAL = ctes(adapter(late=True), feats(order="seq")) + f"SELECT seq, {cols(FEATURES)} FROM feats"
Q["feat_arrival_mode"] = ARRIVAL
Q["feat_stream_state"] = ARRIVAL
Q["feat_window_size"] = ctes(adapter(), feats(history=100)) + f"SELECT seq, {cols(LIGHT_FEATURES)} FROM feats"

# ---- rules -------------------------------------------------------------------------------------------
for key, name in zip(("rule_impossible_travel", "rule_velocity", "rule_high_value", "rule_new_device",
                      "rule_repeated_failures"), RULES):
    Q[key] = FLAGGED + f'SELECT seq FROM flagged WHERE "{name}"'
Q["rule_ml_score"] = FEATS + """
SELECT seq, CASE WHEN s >= 0.95 THEN 'HIGH' WHEN s >= 0.88 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  format('model fraud probability {:.2f}', s) AS reason
FROM (SELECT seq, least(amount_zscore / 5, 1.0e0) AS s FROM feats WHERE merchant_frequency > 1) WHERE s >= 0.8"""
Q["findings_array"] = FLAGGED + f"SELECT seq, {NAMES} AS rules, n_findings, is_flagged FROM flagged"
Q["finding_reason"] = FRAUD + "SELECT transaction_id, rule_triggered, severity, reason FROM fraud"
Q["rules_thresholds"] = ctes(adapter(), feats(), verdicts(2, 3.0, 10), findings()) + """
SELECT rule_triggered, count(*) AS events FROM fraud GROUP BY 1"""
Q["rules_light"] = ctes(adapter(), feats(history=100), verdicts(), findings(light=True)) + """
SELECT transaction_id, rule_triggered, reason FROM fraud"""

_FIRST, _SECOND = EPOCH + 600000000, EPOCH + 1200000000
_PERIODS = verdicts(
    velocity=f"CASE WHEN event_us >= {_SECOND} THEN 4 WHEN event_us >= {_FIRST} THEN 2 ELSE 4 END",
    zscore=f"CASE WHEN event_us >= {_SECOND} THEN 3.0 ELSE 5.0 END",
    multiple=f"CASE WHEN event_us >= {_SECOND} THEN 20 WHEN event_us >= {_FIRST} THEN 10 ELSE 20 END")
Q["rules_table"] = ctes(adapter(), feats(), _PERIODS) + f"SELECT seq, {NAMES} AS rules FROM flagged"
Q["rules_table_stream"] = ctes(adapter(late=True), feats(order="seq"), _PERIODS) + f"SELECT seq, {NAMES} AS rules FROM flagged"

# ---- joins -------------------------------------------------------------------------------------------
Q["join_customer_fraud"] = FRAUD + """
SELECT f.user_id, count(DISTINCT f.seq) AS txn_count, count(DISTINCT x.transaction_id) AS fraud_txns
FROM flagged f LEFT JOIN fraud x ON x.transaction_id = f.transaction_id GROUP BY 1"""
Q["join_fraud_merchant"] = FRAUD + "SELECT transaction_id, rule_triggered, merchant FROM fraud"
Q["join_merchant_fraud"] = FRAUD + """
SELECT f.merchant, count(DISTINCT f.seq) AS txn_count, count(DISTINCT x.transaction_id) AS fraud_txns
FROM flagged f LEFT JOIN fraud x ON x.transaction_id = f.transaction_id GROUP BY 1"""
LABEL = "CAST(injected IS NOT NULL AS INT)"
Q["join_features_label"] = PIPELINE + f"""
SELECT transaction_id, {INPUTS}, CAST(is_flagged AS INT) AS rule_pred, {LABEL} AS label FROM flagged"""
Q["join_detection"] = PIPELINE + """
, planted AS (SELECT DISTINCT injected AS injected_scenario, transaction_id FROM landed WHERE injected IS NOT NULL),
seen AS (SELECT *, transaction_id IN (SELECT transaction_id FROM fraud) AS caught FROM planted)
SELECT injected_scenario, count(transaction_id) AS injected, count(transaction_id) FILTER (caught) AS detected
FROM seen GROUP BY injected_scenario"""
Q["update_scores"] = FEATS + """
SELECT transaction_id, CASE WHEN payment_velocity > 0 THEN merchant_frequency / (merchant_frequency + 1e0) END AS fraud_score,
  payment_velocity > 0 AND merchant_frequency / (merchant_frequency + 1e0) >= 0.8 AS ml_flagged FROM feats"""
Q["update_scores_write"] = Q["update_scores"]
SLOW = ctes(adapter(squeeze=10), feats(), verdicts())
DAY = "strftime(make_timestamp(event_us), '%Y-%m-%d')"
METRICS = f"""CAST(sum(amount) AS DOUBLE) AS total_amount, {mean_cents()} AS avg_amount"""
DAY_US = 86400000000
REFRESHED, COMPUTED = EPOCH + 2 * DAY_US + 9 * 3600000000, EPOCH + DAY_US
MERCHANT_DAY = f"""SELECT merchant, {DAY} AS window_date, max(merchant_category) AS merchant_category, count(*) AS txn_count,
  {METRICS}, count(*) FILTER (status = 'SUCCESS') AS success_count, count(*) FILTER (status = 'FAILED') AS failed_count,
  count(*) FILTER (is_flagged) AS fraud_count, {REFRESHED} AS updated_at FROM flagged"""
Q["merchant_metrics"] = SLOW + f"{MERCHANT_DAY} WHERE {DAY} >= '2024-01-02' GROUP BY 1, 2"
Q["upsert_daily"] = SLOW + f"""
SELECT * REPLACE (CASE WHEN window_date >= '2024-01-02' THEN txn_count ELSE 0 END AS txn_count)
FROM ({MERCHANT_DAY} GROUP BY 1, 2)"""
Q["upsert_daily_write"] = Q["upsert_daily"]
Q["customer_metrics"] = SLOW + f"""
SELECT user_id, {DAY} AS window_date, count(*) AS txn_count, {METRICS}, count(DISTINCT city) AS distinct_cities,
  count(DISTINCT device) AS distinct_devices, count(*) FILTER (is_flagged) AS fraud_count, {REFRESHED} AS updated_at
FROM flagged WHERE {DAY} >= '2024-01-02' GROUP BY 1, 2"""
Q["layer_counts"] = PIPELINE + """
SELECT 'raw' AS layer, count(*) AS rows FROM landed UNION ALL SELECT 'processed', count(*) FROM flagged
UNION ALL SELECT 'rejected', count(*) FROM landed WHERE len(failed) > 0 UNION ALL SELECT 'fraud_events', count(*) FROM fraud"""
Q["city_membership"] = ctes(adapter(), DIRTY) + "SELECT seq, city FROM dirty WHERE city IN (SELECT city FROM cities)"

# ---- curated -----------------------------------------------------------------------------------------
Q["customer_profile"] = PROFILES + f"SELECT *, {COMPUTED} AS computed_at FROM profile"
Q["customer_profile_refresh"] = (
    ctes(adapter(squeeze=10), feats(), verdicts(), findings(), PROFILE) + f"SELECT *, {COMPUTED} AS computed_at FROM profile")
Q["merchant_risk"] = RISKS + f"""
SELECT merchant, merchant_category, txn_count, total_amount, avg_amount, fraud_txns, fraud_rate_pct, risk_tier,
  {COMPUTED} AS computed_at FROM risk"""
Q["risk_tier"] = RISKS + "SELECT merchant, fraud_rate_pct, risk_tier FROM risk"
Q["fraud_rate_pct"] = PROFILES + "SELECT user_id, fraud_txns, txn_count, fraud_rate_pct FROM profile"
Q["fraud_by_user"] = PROFILES + "SELECT user_id, fraud_txns FROM fraud_users"
Q["fraud_by_merchant"] = RISKS + "SELECT merchant, fraud_txns FROM fraud_merchants"
Q["top_risky_merchants"] = RISKS + """
SELECT merchant, txn_count, fraud_txns, fraud_rate_pct, risk_tier FROM risk ORDER BY fraud_rate_pct DESC, merchant LIMIT 5"""
SUCCESS = "count(*) FILTER (status = 'SUCCESS')"
Q["executive_summary"] = FLAGGED + f"""
SELECT count(*) AS total_transactions, {SUCCESS} AS successful, count(*) FILTER (status = 'FAILED') AS failed,
  {pct(SUCCESS, 'count(*)')} AS success_rate_pct, {mean_cents()} AS avg_amount,
  count(*) FILTER (is_flagged) AS flagged_transactions FROM flagged"""
Q["fraud_by_rule"] = FRAUD + """
SELECT rule_triggered, severity, count(*) AS events, CAST(sum(amount) AS DOUBLE) AS amount_at_risk FROM fraud
GROUP BY 1, 2 ORDER BY events DESC, 1, 2"""
ALERTS = """SELECT ingested_us AS detected_at, severity, rule_triggered, user_id, CAST(amount AS DOUBLE) AS amount, reason
FROM fraud ORDER BY ingested_us DESC, transaction_id, rule_triggered"""
Q["latest_alerts"] = FRAUD + f"{ALERTS} LIMIT 20"
Q["top_merchants_volume"] = TXNS + """
SELECT merchant, count(*) AS txns, CAST(sum(amount) AS DOUBLE) AS total FROM txns GROUP BY 1 ORDER BY txns DESC, 1 LIMIT 10"""
Q["txns_by_city"] = TXNS + "SELECT city, count(*) AS txns FROM txns GROUP BY 1 ORDER BY txns DESC, 1"
Q["demo_stats"] = ctes(adapter(), feats(), verdicts(), findings(), DIRTY, gated(LIGHT_CODES)) + f"""
SELECT 'summary' AS part, concat_ws('|', count(*), {SUCCESS}, count(*) FILTER (status = 'FAILED'),
  count(*) FILTER (is_flagged), CAST({mean_cents()} AS DECIMAL(14,2)), {pct(SUCCESS, 'count(*)', 1)},
  (SELECT count(*) FROM gated WHERE len(failed) > 0)) AS text FROM flagged
UNION ALL (SELECT 'by_rule', concat_ws('|', rule_triggered, severity, count(*)) FROM fraud GROUP BY rule_triggered, severity)
UNION ALL (SELECT 'recent', concat_ws('|', ingested_us, rule_triggered, severity, user_id, amount, reason) FROM fraud
  ORDER BY ingested_us DESC, transaction_id, rule_triggered LIMIT 12)"""

# ---- dashboards --------------------------------------------------------------------------------------
HOUR_OF = "{0} // 3600000000 * 3600000000"
WHOLE = "CAST(round(sum(amount), 0) AS BIGINT)"
Q["dash_total"] = TXNS + "SELECT count(*) AS total FROM txns"
Q["dash_success_rate"] = TXNS + f"SELECT {pct(SUCCESS, 'count(*)', 1)} AS success_rate_pct FROM txns"
Q["dash_failed"] = TXNS + "SELECT count(*) AS failed FROM txns WHERE status = 'FAILED'"
Q["dash_flagged"] = FLAGGED + "SELECT count(*) AS flagged FROM flagged WHERE is_flagged"
Q["dash_avg_payment"] = TXNS + """
SELECT CAST((2 * sum(CAST(amount * 100 AS BIGINT)) + 100 * count(*)) // (200 * count(*)) AS BIGINT) AS avg_payment FROM txns"""
Q["dash_status"] = TXNS + "SELECT status, count(*) AS count FROM txns GROUP BY 1"
Q["dash_hourly_volume"] = TXNS + f"SELECT {HOUR_OF.format('event_us')} AS hour, count(*) AS transactions FROM txns GROUP BY 1"
Q["dash_top_merchants"] = TXNS + """
SELECT merchant, count(*) AS transactions FROM txns GROUP BY 1 ORDER BY transactions DESC, 1 LIMIT 10"""
Q["dash_city"] = TXNS + "SELECT city, count(*) AS transactions FROM txns GROUP BY 1"
Q["dash_fraud_total"] = FRAUD + "SELECT count(*) AS fraud_events FROM fraud"
Q["dash_critical"] = FRAUD + "SELECT count(*) AS critical FROM fraud WHERE severity = 'CRITICAL'"
Q["dash_amount_at_risk"] = FRAUD + f"SELECT {WHOLE} AS amount_at_risk FROM fraud"
Q["dash_fraud_rule"] = FRAUD + "SELECT rule_triggered, count(*) AS events FROM fraud GROUP BY 1"
Q["dash_fraud_severity"] = FRAUD + "SELECT severity, count(*) AS events FROM fraud GROUP BY 1"
Q["dash_fraud_trend"] = FRAUD + f"SELECT {HOUR_OF.format('ingested_us')} AS hour, count(*) AS events FROM fraud GROUP BY 1"
Q["dash_risk_by_rule"] = FRAUD + f"SELECT rule_triggered, {WHOLE} AS amount_at_risk FROM fraud GROUP BY 1"
Q["dash_recent_alerts"] = Q["latest_alerts"]
Q["dash_users_profiled"] = TXNS + "SELECT count(DISTINCT user_id) AS users FROM txns"
Q["dash_avg_fraud_rate"] = PROFILES + """
SELECT CAST((2 * sum(CAST(round(fraud_rate_pct * 100) AS BIGINT)) + 10 * count(*)) // (20 * count(*)) AS BIGINT) / 10.0e0
  AS avg_fraud_rate_pct FROM profile"""
Q["dash_top_fraud_users"] = PROFILES + """
SELECT user_id, txn_count, avg_amount, fraud_txns, fraud_rate_pct FROM profile ORDER BY fraud_rate_pct DESC, user_id LIMIT 10"""
Q["dash_spend_bands"] = PROFILES + """
SELECT CASE WHEN avg_amount < 500 THEN '<500' WHEN avg_amount < 1000 THEN '500-1000' WHEN avg_amount < 2000
  THEN '1000-2000' ELSE '2000+' END AS spend_band, count(*) AS users FROM profile GROUP BY 1"""
Q["dash_city_spread"] = PROFILES + """
SELECT user_id, distinct_cities, distinct_devices, fraud_rate_pct FROM profile WHERE distinct_cities >= 5"""
Q["dash_high_risk_merchants"] = RISKS + "SELECT count(*) AS merchants FROM risk WHERE risk_tier = 'HIGH'"
Q["dash_risk_tiers"] = RISKS + "SELECT risk_tier, count(*) AS merchants FROM risk GROUP BY 1"
Q["dash_top_fraud_merchants"] = RISKS + """
SELECT merchant, merchant_category, txn_count, fraud_rate_pct, risk_tier FROM risk ORDER BY fraud_rate_pct DESC, merchant LIMIT 15"""

# ---- health ------------------------------------------------------------------------------------------
MIN_OF = "{0} // 60000000 * 60000000"
Q["health_throughput"] = TXNS + f"SELECT {MIN_OF.format('ingested_us')} AS minute, count(*) AS txns FROM txns GROUP BY 1"
Q["health_rejections"] = LANDED + f"""
SELECT {MIN_OF.format('ingested_us')} AS minute, count(*) AS rejected FROM landed WHERE len(failed) > 0 GROUP BY 1"""
Q["health_alerts"] = FRAUD + f"SELECT {MIN_OF.format('ingested_us')} AS minute, count(*) AS alerts FROM fraud GROUP BY 1"
Q["health_alerts_by_rule"] = FRAUD + f"""
SELECT {MIN_OF.format('ingested_us')} AS minute, rule_triggered, count(*) AS alerts FROM fraud GROUP BY 1, 2"""
Q["health_throughput_vs_alerts"] = FRAUD + f"""
SELECT {MIN_OF.format('ingested_us')} AS minute, count(*) AS txns, CAST(sum(n_findings) AS BIGINT) AS alerts
FROM flagged GROUP BY 1"""


def quantile(q: float) -> str:
    steps, low = [], 0.0
    for i, bound in enumerate(BUCKETS):
        below = f"b{i - 1}" if i else "0"
        steps.append(f"WHEN b{i} >= {q}e0 * n THEN {low}e0 + ({bound}e0 - {low}e0) * (({q}e0 * n - {below}) / "
                     f"CAST(b{i} - {below} AS DOUBLE))")
        low = bound
    return f"round((CASE {' '.join(steps)} ELSE {BUCKETS[-1]}e0 END) * 1000, 1) AS p{round(q * 100)}_ms"


def histogram(windows: str, width: int) -> str:
    counts = ", ".join(f"count(*) FILTER (s <= {b}e0) AS b{i}" for i, b in enumerate(BUCKETS))
    return f""", obs AS (SELECT {windows} AS ws, (ingested_us - event_us) / 1e6 AS s FROM txns),
hist AS (SELECT ws AS window_start, ws + {width} AS window_end, count(*) AS n, {counts} FROM obs GROUP BY ws)
"""


FIVE = 300000000
Q["health_p99"] = TXNS + histogram(f"ingested_us // {FIVE} * {FIVE}", FIVE) + f"""
SELECT window_start, window_end, {quantile(0.99)} FROM hist"""
Q["health_latency_pcts"] = TXNS + histogram(
    f"unnest([{', '.join(f'ingested_us // 60000000 * 60000000 - {i * 60000000}' for i in range(5))}])", FIVE) + f"""
SELECT window_start, window_end, {quantile(0.5)}, {quantile(0.95)}, {quantile(0.99)} FROM hist"""
Q["health_running_counts"] = PIPELINE + """
SELECT count(*) FILTER (len(failed) = 0) AS accepted, count(*) FILTER (len(failed) > 0) AS rejected,
  (SELECT count(*) FROM flagged WHERE is_flagged) AS flagged FROM landed"""

# The same from streams, some of whose rows come late.
LATE_TXNS = ctes(adapter(late=True))
LATE_FRAUD = ctes(adapter(late=True), feats(), verdicts(), findings())
for name, late in (("throughput", LATE_TXNS), ("alerts", LATE_FRAUD), ("alerts_by_rule", LATE_FRAUD), ("throughput_vs_alerts", LATE_FRAUD)):
    Q[f"health_{name}_stream"] = late + Q[f"health_{name}"][len(TXNS if name == "throughput" else FRAUD):]
Q["health_rejections_stream"] = Q["health_rejections"]
Q["health_latency_pcts_stream"] = LATE_TXNS + Q["health_latency_pcts"][len(TXNS):]
Q["sink_processed_stream"] = PIPELINE + "SELECT transaction_id, CAST(amount AS DOUBLE) AS amount FROM accepted"
# A third of the messages comes twice and counts twice, but is judged once; streams judge in order of arrival.
AGAIN = ctes(adapter(), DIRTY, gated(clock="ingested_us"), MESSAGES,
             "arrived AS (SELECT * REPLACE (row_number() OVER (ORDER BY ingested_us, partition, seq) AS seq) FROM accepted)",
             feats("arrived", order="seq"), verdicts())
Q["health_running_counts_stream"] = AGAIN + """
SELECT count(*) FILTER (len(failed) = 0) + count(*) FILTER (len(failed) = 0 AND seq % 3 = 0) AS accepted,
  count(*) FILTER (len(failed) > 0) + count(*) FILTER (len(failed) > 0 AND seq % 3 = 0) AS rejected,
  (SELECT count(*) FROM flagged WHERE is_flagged) AS flagged FROM landed"""

# ---- model -------------------------------------------------------------------------------------------
VECTOR = ", ".join(f"CAST(coalesce(CAST({c} AS DOUBLE), 0) AS DOUBLE) AS x_{c}" for c in MODEL_FEATURES)
VECTOR += ", " + ", ".join(f"CAST({c} IS NULL AS DOUBLE) AS x_{c}_missing" for c in ("seconds_since_prev", "km_from_prev"))
Q["ml_vector"] = FEATS + f"SELECT transaction_id, {VECTOR} FROM feats"
Q["ml_label"] = LANDED + "SELECT transaction_id, bool_or(injected IS NOT NULL) AS label FROM landed GROUP BY 1"
LABELLED = PIPELINE + f", lab AS (SELECT *, {LABEL} AS label FROM flagged)\n"
Q["ml_gate"] = LABELLED + """
SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, count(*) >= 500 AND sum(label) >= 50 AS enough FROM lab"""
SPLIT = LABELLED + """, cut AS (SELECT *, 4 * row_number() OVER (PARTITION BY label ORDER BY md5(concat('42:', transaction_id)))
  <= 3 * count(*) OVER (PARTITION BY label) AS is_train FROM lab)
"""
Q["ml_split"] = SPLIT + "SELECT transaction_id, label, is_train FROM cut"
Q["ml_class_weight"] = SPLIT + """
SELECT count(*) FILTER (label = 0) / CAST(greatest(count(*) FILTER (label = 1), 1) AS DOUBLE) AS weight FROM cut WHERE is_train"""


def metrics(name: str, hit: str) -> str:
    return f""", c AS (SELECT count(*) FILTER (label = 1 AND {hit}) AS tp, count(*) FILTER (label = 0 AND {hit}) AS fp,
  count(*) FILTER (label = 1 AND NOT {hit}) AS fn, count(*) FILTER (label = 0 AND NOT {hit}) AS tn FROM lab)
SELECT '{name}' AS name, tp, fp, fn, tn, round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 4) AS precision,
  round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 4) AS recall,
  round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 4) AS f1 FROM c"""


Q["ml_eval"] = LABELLED + metrics("score", "(amount_zscore >= 3.0)")
Q["ml_vs_rules"] = LABELLED + metrics("rules", "is_flagged")
Q["ml_pr_auc"] = LABELLED + """
, g AS (SELECT amount_zscore AS z, count(*) AS n, sum(label) AS pos FROM lab GROUP BY 1),
u AS (SELECT pos, sum(pos) OVER (ORDER BY z DESC) AS cp, sum(n) OVER (ORDER BY z DESC) AS cn FROM g)
SELECT round(sum(pos * (CAST(cp AS DOUBLE) / CAST(cn AS DOUBLE))) / sum(pos), 9) AS average_precision FROM u"""
Q["ml_metadata"] = LABELLED + f"""
SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, '{",".join(MODEL_FEATURES)}' AS features FROM lab"""

# What holds for any trained model.
Q["ml_train"] = f"SELECT CAST(300 AS BIGINT) AS trees, CAST({len(MODEL_FEATURES) + 2} AS BIGINT) AS inputs, true AS has_splits"
Q["ml_importances"] = f"SELECT '{','.join(sorted(MODEL_FEATURES))}' AS features, 1e0 AS total, true AS none_negative"
Q["ml_score"] = LABELLED + "SELECT transaction_id, label, true AS is_probability FROM lab"
Q["ml_backfill"] = FEATS + "SELECT count(*) AS updated, true AS flags_follow FROM feats"

ORACLES = Q
