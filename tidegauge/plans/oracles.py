"""The same results as ``catalog.py`` in plain SQL over the given tables, for DuckDB."""

from __future__ import annotations

from types import SimpleNamespace

# Fixed values, written out here so that the library's own are tested and not repeated.
DRIFT_SPLIT = "2024-01-16"
RAW_REQUIRED = [
    "user_id", "feature_name", "session_duration", "latency_ms", "crash_flag", "error_count", "feedback_score", "timestamp",
]
NUMERIC_COLUMNS = ["latency_ms", "crash_flag", "feedback_score", "error_count", "session_duration"]
VALUE_RANGES = {"latency_ms": (0, 10000), "crash_flag": (0, 1), "feedback_score": (1, 5), "error_count": (0, 1000)}
RISK_FEATURES = ["avg_latency", "crash_rate", "avg_feedback", "usage_count", "avg_error_count"]
LATENCY_BINS = [(100, "excellent"), (300, "good"), (600, "moderate"), (1000, "poor")]
LATENCY_TOP_BIN = "critical"
LATENCY_NO_BIN = "nan"
RISK_TIERS = [(0.7, "CRITICAL"), (0.5, "HIGH"), (0.3, "MEDIUM")]
RISK_FLOOR_TIER = "LOW"
ADVICE = {
    "CRITICAL": [
        "⚠ CRITICAL — Immediate investigation required. Escalate to on-call engineer.",
        "→ Check error logs for the past 24 hours",
        "→ Review recent deployments that may have impacted this feature",
        "→ Consider feature flag rollback if degradation persists",
    ],
    "HIGH": [
        "⚠ HIGH RISK — Monitor closely. Schedule investigation within 24 hours.",
        "→ Add to monitoring watchlist with 15-minute alert intervals",
    ],
}
ADVICE_OTHERWISE = ["✓ Feature operating within normal parameters. No immediate action required."]
quality = SimpleNamespace(NULL_RATE_COLUMNS=["latency_ms", "crash_flag", "feedback_score"])
star = SimpleNamespace(SLO_LATENCY_MS=1500.0, SLO_LATENCY_SHARE=0.95, SLO_CRASH_RATE=0.05)
drift = SimpleNamespace(
    METRICS=["latency_ms", "crash_flag", "feedback_score", "error_count"],
    MEANS={"latency_ms_mean": "latency_ms", "crash_flag_rate": "crash_flag", "feedback_score_mean": "feedback_score",
           "error_count_mean": "error_count"},
)
raw = SimpleNamespace(
    CATEGORY_PREFIXES=[
        ("electronics.smartphone", "Payments"), ("electronics.audio", "VideoPlayback"), ("electronics.tablet", "Search"),
        ("electronics.laptop", "Recommendations"), ("computers.notebook", "Recommendations"), ("computers.desktop", "Search"),
        ("appliances.kitchen", "Login"), ("appliances.environment", "Login"), ("sport.trainer", "Search"),
        ("kids.toys", "Recommendations"),
    ],
    CATEGORY_WORDS={
        "electronics": "VideoPlayback", "computers": "Recommendations", "appliances": "Login", "sport": "Search",
        "kids": "Recommendations", "auto": "Payments", "furniture": "Search", "medicine": "Login",
        "construction": "Payments", "clothing": "Search",
    },
    FALLBACK_UNKNOWN=["Login", "Payments", "VideoPlayback"],
    FALLBACK_NULL=["Login", "Payments", "VideoPlayback", "Recommendations", "Search"],
)

TELEMETRY = """
keyed AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type AS feature_name,
         CAST(10 + (event_id * 7919) % 590 AS DOUBLE) AS session_duration,
         value * CAST(10 AS DOUBLE) AS latency_ms,
         CASE WHEN k < 5 THEN 1 ELSE 0 END AS crash_flag,
         k % 7 AS error_count,
         CAST(1.0 + (k % 9) * 0.5 AS DOUBLE) AS feedback_score,
         ts AS "timestamp", k
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),
telemetry AS (
  SELECT user_id, feature_name, session_duration, latency_ms, crash_flag, error_count, feedback_score, "timestamp"
  FROM keyed
)"""

RAW = TELEMETRY + """,
raw AS (
  SELECT event_id, k,
         CASE WHEN k = 41 THEN NULL ELSE user_id END AS user_id,
         CASE WHEN k = 23 THEN '  ' WHEN k = 43 THEN NULL ELSE feature_name END AS feature_name,
         CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(session_duration AS VARCHAR) END AS session_duration,
         CASE WHEN k = 13 THEN NULL WHEN k = 37 THEN 'n/a' ELSE CAST(latency_ms AS VARCHAR) END AS latency_ms,
         CASE WHEN k = 17 THEN '2' ELSE CAST(crash_flag AS VARCHAR) END AS crash_flag,
         CASE WHEN k = 47 THEN '-1' ELSE CAST(error_count AS VARCHAR) END AS error_count,
         CASE WHEN k = 18 THEN '0' WHEN k = 19 THEN '6' ELSE CAST(feedback_score AS VARCHAR) END AS feedback_score,
         CASE WHEN k = 29 THEN 'not-a-time' WHEN k = 31 THEN NULL
              ELSE strftime("timestamp", '%Y-%m-%d %H:%M:%S') END AS "timestamp"
  FROM keyed
)"""

DIRTY = RAW + """,
dirty AS (
  SELECT event_id, k, user_id, feature_name,
         TRY_CAST(session_duration AS DOUBLE) AS session_duration, TRY_CAST(latency_ms AS DOUBLE) AS latency_ms,
         TRY_CAST(crash_flag AS DOUBLE) AS crash_flag, TRY_CAST(error_count AS DOUBLE) AS error_count,
         TRY_CAST(feedback_score AS DOUBLE) AS feedback_score, "timestamp"
  FROM raw
),
parsed AS (
  SELECT event_id, k, user_id, feature_name, session_duration, latency_ms, crash_flag, error_count, feedback_score,
         TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp", strftime(TRY_CAST("timestamp" AS TIMESTAMP), '%Y-%m-%d') AS date
  FROM dirty WHERE TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL
)"""

BRONZE = TELEMETRY + """,
bronze AS (SELECT *, CAST("timestamp" AS DATE) AS event_date FROM telemetry)"""

DAYS = TELEMETRY + """,
days AS (
  SELECT feature_name, strftime("timestamp", '%Y-%m-%d') AS date,
         ROUND(AVG(latency_ms), 6) AS avg_latency, ROUND(AVG(crash_flag), 6) AS crash_rate,
         ROUND(AVG(feedback_score), 6) AS avg_feedback, COUNT(user_id) AS usage_count,
         ROUND(AVG(error_count), 6) AS avg_error_count
  FROM telemetry GROUP BY ALL
)"""

LABELLED = DAYS + """,
limits AS (
  SELECT quantile_cont(crash_rate, 0.75) AS c, quantile_cont(avg_latency, 0.75) AS l,
         quantile_cont(avg_feedback, 0.25) AS f, quantile_cont(avg_error_count, 0.75) AS e FROM days
),
labelled AS (
  SELECT days.*, CASE WHEN (CASE WHEN crash_rate >= c THEN 1 ELSE 0 END) + (CASE WHEN avg_latency >= l THEN 1 ELSE 0 END)
      + (CASE WHEN avg_feedback <= f THEN 1 ELSE 0 END) + (CASE WHEN avg_error_count >= e THEN 1 ELSE 0 END) >= 2
      THEN 1 ELSE 0 END AS is_high_risk
  FROM days, limits
)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{body.strip()}"


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def draw(key: str, seed: int = 0) -> str:
    return f"((({key}) + {seed}) % 2147483647 * 48271) % 2147483647"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def event_quality() -> str:
    return "(1 / (1 + latency_ms) + (1 - crash_flag) + feedback_score / 5) / 3"


def daily_quality(latency: str, crash: str, feedback: str) -> str:
    return (f"ROUND((CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + {latency} / CAST(1000 AS DOUBLE)) + (CAST(1 AS DOUBLE) - {crash})"
            f" + {feedback} / CAST(5 AS DOUBLE)) / CAST(3 AS DOUBLE), 4)")


def bucket(latency: str) -> str:
    cases = " ".join(f"WHEN {latency} <= {upper} THEN '{name}'" for upper, name in LATENCY_BINS)
    return f"CASE WHEN {latency} IS NULL OR {latency} <= 0 THEN '{LATENCY_NO_BIN}' {cases} ELSE '{LATENCY_TOP_BIN}' END"


def tier(probability: str) -> str:
    cases = " ".join(f"WHEN {probability} >= {lower} THEN '{name}'" for lower, name in RISK_TIERS)
    return f"CASE {cases} ELSE '{RISK_FLOOR_TIER}' END"


def spike_flags() -> str:
    return "CASE WHEN latency_ms > p95 AND crash_flag = 1 AND feedback_score < 2.0 THEN 1 ELSE 0 END"


SECOND = """strftime("timestamp", '%Y-%m-%d %H:%M:%S')"""
RAW_ROWS = f'user_id, feature_name, session_duration, latency_ms, crash_flag, error_count, feedback_score, {SECOND} AS "timestamp"'

SQL: dict[str, str] = {}

# ---- sources and sinks -------------------------------------------------------------------

SQL["read_raw_csv"] = with_(TELEMETRY, f"SELECT {RAW_ROWS} FROM telemetry")
SQL["bronze_append"] = with_(TELEMETRY, """
SELECT source AS _source, 'bronze' AS _layer, COUNT(*) AS rows, CAST(1 AS BIGINT) AS partitions,
       ROUND(SUM(latency_ms), 3) AS latency_sum, COUNT(*) AS stamped
FROM telemetry, (VALUES ('events'), ('second load')) v(source) GROUP BY source""")
SQL["layer_inventory"] = """
SELECT layer, CAST(files AS BIGINT) AS files, true AS size_matches FROM (VALUES ('bronze', 3), ('silver', 2), ('gold', 0)) AS l(layer, files)"""
SQL["read_raw_csv_headers"] = with_(TELEMETRY, f"""
SELECT user_id, feature_name, CASE WHEN old THEN session_duration END AS session_duration, latency_ms, crash_flag,
       CASE WHEN NOT old THEN error_count END AS error_count, feedback_score, {SECOND} AS "timestamp"
FROM (SELECT *, "timestamp" < TIMESTAMP '{DRIFT_SPLIT}' AS old FROM telemetry)""")
SQL["read_bronze"] = with_(TELEMETRY, f"SELECT {RAW_ROWS}, 'events' AS _source, 'bronze' AS _layer FROM telemetry")
SQL["union_files"] = with_(TELEMETRY, f"""
SELECT user_id, feature_name, session_duration, latency_ms, crash_flag, feedback_score, "timestamp", CAST(NULL AS INTEGER) AS error_count
FROM telemetry WHERE "timestamp" < TIMESTAMP '{DRIFT_SPLIT}'
UNION ALL
SELECT user_id, feature_name, NULL, latency_ms, crash_flag, feedback_score, "timestamp", error_count
FROM telemetry WHERE "timestamp" >= TIMESTAMP '{DRIFT_SPLIT}'""")
SQL["bronze_typed_view"] = with_(TELEMETRY, """
SELECT user_id, feature_name, latency_ms, crash_flag, feedback_score, error_count, session_duration,
       "timestamp" AS event_timestamp, CAST("timestamp" AS DATE) AS event_date,
       'raw_events' AS _source_file, 'bronze' AS _layer
FROM keyed WHERE k NOT IN (41, 43)""")
SQL["silver_overwrite"] = with_(TELEMETRY, f"""
SELECT CASE WHEN "timestamp" < TIMESTAMP '{DRIFT_SPLIT}' THEN '2024-02-01' ELSE '2024-02-02' END AS processing_date,
       {bucket('latency_ms')} AS latency_bucket, COUNT(*) AS rows FROM telemetry GROUP BY ALL""")

SILVER_DAILY_COLUMNS = """feature_name, event_date,
       ROUND(AVG(latency_ms), 6) AS avg_latency, ROUND(AVG(crash_flag), 6) AS crash_rate,
       ROUND(AVG(feedback_score), 6) AS avg_feedback, ROUND(AVG(error_count), 6) AS avg_error_count,
       COUNT(*) AS usage_count, CAST(SUM(crash_flag) AS BIGINT) AS total_crashes,
       ROUND(AVG(session_duration), 6) AS avg_session_duration,
       COUNT(CASE WHEN latency_ms IS NULL THEN 1 END) AS null_latency_count"""
SQL["materialize_table"] = with_(BRONZE, f"SELECT {SILVER_DAILY_COLUMNS} FROM bronze GROUP BY feature_name, event_date")
SQL["export_csv"] = with_(LABELLED, "SELECT * FROM labelled")


def profile(source: str) -> str:
    names = ",".join(RAW_REQUIRED)
    return (f"SELECT COUNT(*) AS row_count, MIN(latency_ms) AS latency_min, MAX(latency_ms) AS latency_max, "
            f"ROUND(AVG(latency_ms), 6) AS latency_mean, {len(RAW_REQUIRED)} AS column_count, '{names}' AS columns FROM {source}")


def baseline(source: str) -> str:
    return f"""SELECT COUNT(*) AS row_count, ROUND(AVG(latency_ms), 6) AS latency_ms_mean,
       ROUND(STDDEV_SAMP(latency_ms), 6) AS latency_ms_std, ROUND(AVG(crash_flag), 6) AS crash_flag_rate,
       ROUND(AVG(feedback_score), 6) AS feedback_score_mean, ROUND(AVG(error_count), 6) AS error_count_mean FROM {source}"""


SQL["json_report_sink"] = with_(TELEMETRY, profile("telemetry"))
SQL["baseline_read"] = with_(TELEMETRY, baseline("telemetry"))

# ---- raw-source preparation --------------------------------------------------------------

CODES = [
    "electronics.smartphone", "electronics.audio.headphone", "electronics.clocks", "computers.notebook",
    "computers.desktop", "computers.ebooks", "appliances.kitchen.washer", "sport.trainer", "sport.bicycle",
    "kids.toys", "auto.accessories", "furniture.kitchen.chair", "medicine.tools", "construction.tools",
    "clothing.shoes", "stationery.paper", None,
]
_code_cases = " ".join(f"WHEN {i} THEN {quoted(c)}" for i, c in enumerate(CODES) if c)
COMMERCE = f"""
log AS (
  SELECT event_id,
         CASE WHEN k = 13 THEN NULL WHEN k = 29 THEN 'yesterday UTC' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS event_time,
         CASE WHEN k = 17 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN k = 19 THEN NULL ELSE user_id END AS user_id,
         CASE event_id % {len(CODES)} {_code_cases} END AS category_code,
         (value - CAST(20 AS DOUBLE)) / CAST(10 AS DOUBLE) AS price
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),
cleaned AS (
  SELECT event_id, event_time, TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS "timestamp" FROM log
  WHERE TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) IS NOT NULL
)"""
SQL["drop_incomplete"] = with_(COMMERCE, """
SELECT * FROM log WHERE event_time IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL""")
SQL["sample_n_ties"] = with_(TELEMETRY, """
SELECT event_id % 10 AS key, COUNT(*) AS rows, COUNT(DISTINCT event_id) AS event_ids
FROM (SELECT event_id FROM keyed ORDER BY event_id % 10 LIMIT 4500) GROUP BY key""")
SQL["sample_n"] = with_(TELEMETRY, f"""
SELECT event_id, user_id, latency_ms FROM keyed ORDER BY {draw('event_id', 42)} LIMIT 500""")


def _choice(names: list[str], pick: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE ({pick}) % {len(names)} {cases} END"


_prefixes = " ".join(f"WHEN starts_with(category_code, '{p}') THEN '{f}'" for p, f in raw.CATEGORY_PREFIXES)
_words = " ".join(f"WHEN split_part(category_code, '.', 1) = '{w}' THEN '{f}'" for w, f in raw.CATEGORY_WORDS.items())
SQL["map_category"] = with_(COMMERCE, f"""
SELECT event_id, category_code,
       CASE WHEN category_code IS NULL THEN {_choice(raw.FALLBACK_NULL, draw('event_id', 7))}
            {_prefixes} {_words} ELSE {_choice(raw.FALLBACK_UNKNOWN, draw('event_id', 7))} END AS feature_name FROM log""")
SQL["clean_timestamp"] = with_(COMMERCE, "SELECT * FROM cleaned")
SQL["spread_days"] = with_(COMMERCE, f"""
SELECT event_id, strftime("timestamp" + to_days(CAST(({draw('event_id', 11)}) % 30 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS "timestamp"
FROM cleaned""")
SQL["clip_range"] = with_(COMMERCE, """
SELECT event_id, CASE WHEN price < 1 THEN 1 WHEN price > 5 THEN 5 ELSE price END AS price,
       CASE WHEN latency_ms < 80 THEN 80 WHEN latency_ms > 600 THEN 600 ELSE latency_ms END AS latency_ms
FROM (SELECT *, CASE WHEN event_id % 10 != 3 THEN price * 10 END AS latency_ms FROM log)""")
SQL["project_raw_schema"] = with_(TELEMETRY, "SELECT * FROM telemetry")
_profile_raw = """COUNT(*) AS rows, ROUND(AVG(crash_flag), 6) AS crash_rate, ROUND(AVG(latency_ms), 6) AS avg_latency,
       ROUND(AVG(feedback_score), 6) AS avg_feedback, MIN("timestamp") AS first_timestamp, MAX("timestamp") AS last_timestamp"""
SQL["profile_raw"] = with_(TELEMETRY, f"""
SELECT false AS is_total, feature_name, {_profile_raw} FROM telemetry GROUP BY feature_name
UNION ALL SELECT true, NULL, {_profile_raw} FROM telemetry""")

# ---- schema validation -------------------------------------------------------------------


def number(name: str) -> str:
    return f'TRY_CAST("{name}" AS DOUBLE)' if name in NUMERIC_COLUMNS else f'"{name}"'


SQL["validate_required_columns"] = with_(RAW, union_all([
    f"SELECT '{n}' AS column_name, {str(n != 'session_duration').lower()} AS present, "
    + f"COUNT({'NULL' if n == 'session_duration' else number(n)}) AS non_null FROM raw"
    for n in RAW_REQUIRED
]))
SQL["validate_nonempty"] = "SELECT COUNT(*) AS rows, COUNT(*) > 0 AS nonempty, COUNT(*) < 10 AS few_rows FROM events"
SQL["coerce_numeric"] = with_(RAW, union_all([
    f"SELECT '{n}' AS column_name, COUNT({number(n)}) AS kept, "
    f"COUNT(CASE WHEN {n} IS NOT NULL AND {number(n)} IS NULL THEN 1 END) AS coerced_nulls FROM raw"
    for n in NUMERIC_COLUMNS
]))
SQL["coerced_rows"] = with_(DIRTY, "SELECT * EXCLUDE (k) FROM dirty")
SQL["range_violations"] = with_(DIRTY, union_all([
    f"SELECT '{n}' AS column_name, {low} AS low, {high} AS high, COUNT({n}) AS checked, "
    f"COUNT(CASE WHEN {n} < {low} OR {n} > {high} THEN 1 END) AS outside, "
    f"ROUND(COUNT(CASE WHEN {n} < {low} OR {n} > {high} THEN 1 END) / COUNT({n}), 6) AS share FROM dirty"
    for n, (low, high) in VALUE_RANGES.items()
]))
SQL["range_critical"] = with_(TELEMETRY, """
SELECT 'feedback_score' AS column_name, COUNT(CASE WHEN feedback_score + 1.5 > 5 THEN 1 END) AS outside, true AS critical
FROM telemetry HAVING COUNT(CASE WHEN feedback_score + 1.5 > 5 THEN 1 END) / COUNT(*) > 0.2""")
SQL["fully_null_columns"] = with_(TELEMETRY, union_all([
    f"SELECT '{n}' AS column_name, "
    + ("COUNT(CAST(NULL AS INTEGER))" if n == "error_count" else f'COUNT("{n}")') + " = 0 AS fully_null FROM telemetry"
    for n in RAW_REQUIRED
]))
SQL["validate_schema"] = with_(DIRTY, """
SELECT feature_name, COALESCE(strftime(TRY_CAST("timestamp" AS TIMESTAMP), '%Y-%m-%d'), 'NaT') AS date,
       ROUND(AVG(crash_flag), 12) AS crash_rate, COUNT(user_id) AS usage_count
FROM dirty WHERE feature_name IS NOT NULL GROUP BY ALL""")

# ---- data quality ------------------------------------------------------------------------

EXPECTATIONS = {
    "expect_columns_to_exist": "SELECT 1 AS position, 'expect_columns_to_exist' AS expectation, true AS passed, "
                               "'All required columns present' AS detail",
    "expect_no_duplicate_events": """SELECT 2 AS position, 'expect_no_duplicate_events' AS expectation, n = 0 AS passed,
       printf('Found %d duplicate (user_id, timestamp) pairs', n) AS detail
FROM (SELECT CAST(SUM(c - 1) AS BIGINT) AS n FROM (SELECT COUNT(*) AS c FROM dirty GROUP BY user_id, "timestamp"))""",
    **{
        f"expect_column_null_rate_below_threshold_{c}":
            f"SELECT {i} AS position, 'expect_column_null_rate_below_threshold_{c}' AS expectation, r <= 0.05 AS passed, "
            f"printf('{c} null rate: %.2f%% (threshold: 5%%)', r * 100) AS detail "
            f"FROM (SELECT AVG(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS r FROM dirty)"
        for i, c in enumerate(quality.NULL_RATE_COLUMNS, 3)
    },
    "expect_latency_in_valid_range": """SELECT 6 AS position, 'expect_latency_in_valid_range' AS expectation,
       COALESCE(MIN(latency_ms) >= 0 AND MAX(latency_ms) <= 10000, false) AS passed,
       printf('Latency range: [%.1f, %.1f] ms. Expected: [0, 10000]', MIN(latency_ms), MAX(latency_ms)) AS detail FROM dirty""",
    "expect_crash_flag_is_binary": """SELECT 7 AS position, 'expect_crash_flag_is_binary' AS expectation, n = 0 AS passed,
       printf('crash_flag values outside {0, 1}: %d', n) AS detail
FROM (SELECT COUNT(CASE WHEN crash_flag NOT IN (0, 1) THEN 1 END) AS n FROM dirty)""",
    "expect_feedback_score_between_1_and_5": """SELECT 8 AS position, 'expect_feedback_score_between_1_and_5' AS expectation,
       n = 0 AS passed, printf('Records with feedback_score outside [1,5]: %d', n) AS detail
FROM (SELECT COUNT(CASE WHEN feedback_score < 1 OR feedback_score > 5 THEN 1 END) AS n FROM dirty)""",
    "expect_minimum_row_count": """SELECT 9 AS position, 'expect_minimum_row_count' AS expectation, COUNT(*) >= 50 AS passed,
       printf('Row count: %d. Minimum required: 50', COUNT(*)) AS detail FROM dirty""",
    "expect_feature_name_not_null_or_empty": """SELECT 10 AS position, 'expect_feature_name_not_null_or_empty' AS expectation,
       n = 0 AND e = 0 AS passed, printf('Null feature names: %d, Empty: %d', n, e) AS detail
FROM (SELECT COUNT(CASE WHEN feature_name IS NULL THEN 1 END) AS n, COUNT(CASE WHEN trim(feature_name) = '' THEN 1 END) AS e FROM dirty)""",
    "expect_timestamp_parseable": """SELECT 11 AS position, 'expect_timestamp_parseable' AS expectation, n = 0 AS passed,
       CASE WHEN n = 0 THEN 'All timestamps parsed successfully' ELSE printf('Timestamps that do not parse: %d', n) END AS detail
FROM (SELECT COUNT(CASE WHEN "timestamp" IS NOT NULL AND TRY_CAST("timestamp" AS TIMESTAMP) IS NULL THEN 1 END) AS n FROM dirty)""",
    "expect_no_extreme_latency_spikes": """SELECT 12 AS position, 'expect_no_extreme_latency_spikes' AS expectation, n = 0 AS passed,
       printf('Events with latency > 5000ms: %d. P99 latency: %.1fms', n, p) AS detail
FROM (SELECT COUNT(CASE WHEN latency_ms > 5000 THEN 1 END) AS n, quantile_cont(latency_ms, 0.99) AS p FROM dirty)""",
}


def expectations(*names: str) -> str:
    return with_(DIRTY, union_all([EXPECTATIONS[n] for n in names]))


SQL["dq_columns_exist"] = expectations("expect_columns_to_exist", "expect_minimum_row_count")
SQL["dq_no_duplicates"] = expectations("expect_no_duplicate_events")
SQL["dq_null_rate"] = expectations(*[f"expect_column_null_rate_below_threshold_{c}" for c in quality.NULL_RATE_COLUMNS])
SQL["dq_latency_range"] = expectations("expect_latency_in_valid_range")
SQL["dq_crash_binary"] = expectations("expect_crash_flag_is_binary")
SQL["dq_feedback_range"] = expectations("expect_feedback_score_between_1_and_5")
SQL["dq_min_rows"] = expectations("expect_minimum_row_count")
SQL["dq_feature_name"] = expectations("expect_feature_name_not_null_or_empty")
SQL["dq_timestamp_parseable"] = expectations("expect_timestamp_parseable")
SQL["dq_no_spikes"] = expectations("expect_no_extreme_latency_spikes")
SQL["dq_report"] = with_(DIRTY, f"""
SELECT COUNT(*) AS total_checks, COUNT(CASE WHEN passed THEN 1 END) AS passed, COUNT(CASE WHEN NOT passed THEN 1 END) AS failed,
       ROUND(COUNT(CASE WHEN passed THEN 1 END) / COUNT(*) * 100, 1) AS score_pct, bool_and(passed) AS overall_passed,
       COALESCE(string_agg(CASE WHEN NOT passed THEN expectation END, ',' ORDER BY position), '') AS failures
FROM ({union_all(list(EXPECTATIONS.values()))})""")
SQL["null_rate_gate"] = with_(RAW, union_all([
    f"SELECT '{c}' AS column_name, ROUND(AVG(CASE WHEN \"{c}\" IS NULL THEN 1 ELSE 0 END), 6) AS null_rate, "
    f"AVG(CASE WHEN \"{c}\" IS NULL THEN 1 ELSE 0 END) > 0.2 AS breached FROM raw"
    for c in ["event_id", "k", *RAW_REQUIRED]
]))
SQL["latency_outlier_gate"] = with_(TELEMETRY, """
SELECT MAX(latency_ms) AS max_latency, MAX(latency_ms) > 5000 AS breached, 'as is' AS side FROM telemetry
UNION ALL SELECT MAX(latency_ms * 3), MAX(latency_ms * 3) > 5000, 'lifted' FROM telemetry""")
SQL["data_profile"] = with_(DIRTY, profile("dirty"))

CLEAN = LABELLED + f""",
dirty AS (SELECT * FROM telemetry),
suite AS (SELECT COUNT(CASE WHEN passed THEN 1 END) AS good, COUNT(*) AS total FROM ({union_all(list(EXPECTATIONS.values()))}))"""

# ---- event features ----------------------------------------------------------------------

SCALE = DIRTY + """,
scale AS (SELECT quantile_cont(latency_ms, 0.95) AS p95, MAX(session_duration) AS longest FROM parsed)"""
TIME_FEATURES = """CAST(hour("timestamp") AS INTEGER) AS hour_of_day, CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
       CASE WHEN isodow("timestamp") IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN hour("timestamp") BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours"""
ERROR_FLAGS = """CASE WHEN error_count > 0 THEN 1 ELSE 0 END AS has_errors,
       CASE WHEN error_count > 3 THEN 1 ELSE 0 END AS high_error"""
SESSION_QUALITY = ("round_even(session_duration / longest * CAST(0.5 AS DOUBLE)"
                   " + feedback_score / CAST(5 AS DOUBLE) * CAST(0.5 AS DOUBLE), 4)")
SQL["parse_ts_drop_bad"] = with_(DIRTY, 'SELECT event_id, "timestamp", date FROM parsed')
SQL["time_features"] = with_(DIRTY, f"SELECT event_id, {TIME_FEATURES} FROM parsed")
SQL["event_quality_score"] = with_(DIRTY, f"SELECT event_id, ROUND({event_quality()}, 6) AS quality_score FROM dirty")
SQL["latency_bucket"] = with_(DIRTY, f"SELECT event_id, latency_ms, {bucket('latency_ms')} AS latency_bucket FROM dirty")
SQL["anomaly_flag"] = with_(SCALE, f"SELECT event_id, {spike_flags()} AS is_anomaly FROM parsed, scale")
SQL["error_flags"] = with_(DIRTY, f"SELECT event_id, error_count, {ERROR_FLAGS} FROM dirty")
SQL["session_quality_index"] = with_(SCALE, f"SELECT event_id, {SESSION_QUALITY} AS session_quality_index FROM parsed, scale")
SQL["log_latency"] = with_(DIRTY, "SELECT event_id, ROUND(ln(1 + latency_ms), 6) AS log_latency FROM dirty")
SQL["engineer_features"] = with_(SCALE, f"""
SELECT event_id, user_id, feature_name, session_duration, latency_ms, crash_flag, error_count, feedback_score, "timestamp", date,
       {TIME_FEATURES}, ROUND({event_quality()}, 6) AS quality_score, {bucket('latency_ms')} AS latency_bucket,
       {spike_flags()} AS is_anomaly, {ERROR_FLAGS}, {SESSION_QUALITY} AS session_quality_index,
       ROUND(ln(1 + latency_ms), 6) AS log_latency
FROM parsed, scale""")
SQL["transform_summary"] = with_(SCALE, f"""
SELECT COUNT(*) AS rows, CAST(SUM({spike_flags()}) AS BIGINT) AS anomalies FROM parsed, scale""")

# ---- roll-ups and windows ----------------------------------------------------------------

SQL["agg_daily"] = with_(DIRTY, """
SELECT feature_name, COALESCE(strftime(TRY_CAST("timestamp" AS TIMESTAMP), '%Y-%m-%d'), 'NaT') AS date,
       ROUND(AVG(latency_ms), 6) AS avg_latency, ROUND(AVG(crash_flag), 12) AS crash_rate, ROUND(AVG(feedback_score), 12) AS avg_feedback,
       COUNT(user_id) AS usage_count, ROUND(AVG(error_count), 12) AS avg_error_count
FROM dirty WHERE feature_name IS NOT NULL GROUP BY ALL""")
SQL["silver_daily"] = with_(DIRTY, f"""
SELECT {SILVER_DAILY_COLUMNS}
FROM (SELECT *, CAST("timestamp" AS DATE) AS event_date FROM parsed WHERE user_id IS NOT NULL AND feature_name IS NOT NULL)
GROUP BY feature_name, event_date""")
SQL["silver_quality_score"] = with_(BRONZE, f"""
SELECT feature_name, event_date, {daily_quality('avg_latency', 'crash_rate', 'avg_feedback')} AS quality_score
FROM (SELECT {SILVER_DAILY_COLUMNS} FROM bronze GROUP BY feature_name, event_date)""")
SQL["baseline_stats"] = with_(DIRTY, baseline("dirty"))
SUMMARY = """
summary AS (
  SELECT feature_name, AVG(latency_ms) AS l, AVG(crash_flag) AS c, AVG(error_count) AS e, AVG(feedback_score) AS f, COUNT(user_id) AS usage_count
  FROM {source} GROUP BY feature_name
)"""
SUMMARY_COLUMNS = f"""feature_name, ROUND(l, 6) AS avg_latency_ms, ROUND(c, 6) AS crash_rate, ROUND(e, 6) AS avg_error_count,
       ROUND(f, 6) AS avg_feedback_score, usage_count, {daily_quality('l', 'c', 'f')} AS quality_score"""
SQL["feature_summary"] = with_(LABELLED + "," + SUMMARY.format(source="telemetry"), f"""
SELECT {SUMMARY_COLUMNS}, ROUND(p, 6) AS risk_probability, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS high_risk
FROM summary JOIN (SELECT feature_name, AVG(is_high_risk) AS p FROM labelled GROUP BY feature_name) USING (feature_name)""")

STAR = DAYS + """,
fact AS (
  SELECT feature_name AS feature_id, CAST(date AS DATE) AS event_date, CAST(avg_latency AS FLOAT) AS latency_ms,
         CAST(crash_rate AS FLOAT) AS crash_rate, CAST(avg_feedback AS FLOAT) AS feedback_score,
         CAST(usage_count AS INTEGER) AS active_users,
         CAST(LEAST(CAST(1 AS DOUBLE), ROUND(crash_rate * CAST(16 AS DOUBLE), 6)) AS FLOAT) AS risk_score,
         avg_latency > 600.0 AS anomaly_flag
  FROM days
),
dim AS (
  SELECT event_type AS feature_id, upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS feature_name,
         'team-' || substr(event_type, 1, 1) AS owner_team, CAST(MIN(ts) AS DATE) AS release_date,
         CASE WHEN length(event_type) > 5 THEN 'growth' ELSE 'mature' END AS lifecycle_stage
  FROM events GROUP BY event_type
)"""


def key_check(name: str, source: str, key: str) -> str:
    gap = " OR ".join(f"{column} IS NULL" for column in key.split(", "))
    return (f"SELECT (SELECT COUNT(*) FROM {source} WHERE {gap}) AS null_keys, COUNT(CASE WHEN n > 1 THEN 1 END) AS duplicate_keys, "
            f"'{name}' AS table_name FROM (SELECT COUNT(*) AS n FROM {source} WHERE NOT ({gap}) GROUP BY {key})")


SQL["fact_dim_model"] = with_(STAR, union_all([
    key_check("fact", "fact", "feature_id, event_date"),
    key_check("dimension", "dim", "feature_id"),
    key_check("fact with gaps", "(SELECT feature_id, CASE WHEN day(event_date) <> 5 THEN event_date END AS event_date FROM fact)",
              "feature_id, event_date"),
    key_check("fact twice", "(SELECT * FROM fact UNION ALL SELECT * FROM fact)", "feature_id, event_date"),
]))
SQL["fact_table"] = with_(STAR, "SELECT * FROM fact")
SQL["dim_table"] = with_(STAR, "SELECT * FROM dim")
SQL["high_risk_owners"] = with_(STAR, """
SELECT f.feature_id, d.owner_team, ROUND(AVG(CAST(risk_score AS DOUBLE)), 6) AS avg_risk
FROM fact f JOIN dim d ON f.feature_id = d.feature_id GROUP BY 1, 2 HAVING AVG(CAST(risk_score AS DOUBLE)) > 0.75""")
SQL["risk_by_lifecycle"] = with_(STAR, """
SELECT lifecycle_stage, COUNT(DISTINCT f.feature_id) AS features, COUNT(*) AS feature_days, ROUND(AVG(CAST(risk_score AS DOUBLE)), 6) AS avg_risk
FROM fact f JOIN dim d ON f.feature_id = d.feature_id GROUP BY lifecycle_stage""")
SQL["slo_tracking"] = with_(BRONZE, f"""
SELECT feature_name, COUNT(*) AS days, COUNT(CASE WHEN fast >= {star.SLO_LATENCY_SHARE} THEN 1 END) AS latency_ok_days,
       COUNT(CASE WHEN crash <= {star.SLO_CRASH_RATE} THEN 1 END) AS crash_ok_days,
       ROUND(AVG(CASE WHEN fast >= {star.SLO_LATENCY_SHARE} AND crash <= {star.SLO_CRASH_RATE} THEN 1 ELSE 0 END), 6) AS slo_share
FROM (SELECT feature_name, event_date, AVG(CASE WHEN latency_ms <= {star.SLO_LATENCY_MS} THEN 1 ELSE 0 END) AS fast, AVG(crash_flag) AS crash
      FROM bronze GROUP BY feature_name, event_date)
GROUP BY feature_name""")

SILVER = BRONZE + f""",
daily AS (
  SELECT feature_name, event_date, AVG(latency_ms) AS avg_latency, AVG(crash_flag) AS crash_rate, AVG(feedback_score) AS avg_feedback,
         AVG(error_count) AS avg_error_count, COUNT(*) AS usage_count, CAST(SUM(crash_flag) AS BIGINT) AS total_crashes,
         AVG(session_duration) AS avg_session_duration
  FROM bronze GROUP BY feature_name, event_date
),
scored AS (SELECT *, {daily_quality('avg_latency', 'crash_rate', 'avg_feedback')} AS quality_score FROM daily),
silver AS (
  SELECT *,
    AVG(avg_latency) OVER (PARTITION BY feature_name ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_avg_latency,
    AVG(crash_rate) OVER (PARTITION BY feature_name ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_crash_rate,
    avg_latency - LAG(avg_latency, 1) OVER (PARTITION BY feature_name ORDER BY event_date) AS latency_dod_change,
    ROW_NUMBER() OVER (PARTITION BY feature_name ORDER BY event_date DESC) AS recency_rank
  FROM scored
)"""
for _name, _column in [
    ("rolling_7d_latency", "rolling_7d_avg_latency"), ("rolling_7d_crash", "rolling_7d_crash_rate"),
    ("latency_dod_change", "latency_dod_change"),
]:
    SQL[_name] = with_(SILVER, f"SELECT feature_name, event_date, ROUND({_column}, 6) AS {_column} FROM silver")
SQL["recency_rank"] = with_(SILVER, "SELECT feature_name, event_date, recency_rank FROM silver")
_silver_rounded = ["avg_latency", "crash_rate", "avg_feedback", "avg_error_count", "avg_session_duration",
                   "rolling_7d_avg_latency", "rolling_7d_crash_rate", "latency_dod_change"]
SQL["silver_feature_metrics"] = with_(SILVER, f"""
SELECT feature_name, event_date, usage_count, total_crashes, quality_score, recency_rank, 'silver' AS _layer,
       {', '.join(f'ROUND({c}, 6) AS {c}' for c in _silver_rounded)} FROM silver""")
_null_day = SILVER.replace(
    """bronze AS (SELECT *, CAST("timestamp" AS DATE) AS event_date FROM telemetry)""",
    """bronze AS (SELECT *, CASE WHEN k <> 47 THEN CAST("timestamp" AS DATE) END AS event_date FROM keyed)""",
).replace("ORDER BY event_date DESC", "ORDER BY event_date DESC NULLS FIRST").replace("ORDER BY event_date ROWS", "ORDER BY event_date NULLS LAST ROWS")
SQL["silver_null_day"] = with_(_null_day, """
SELECT feature_name, event_date, usage_count, ROUND(rolling_7d_avg_latency, 6) AS rolling_7d_avg_latency,
       ROUND(rolling_7d_crash_rate, 6) AS rolling_7d_crash_rate, ROUND(latency_dod_change, 6) AS latency_dod_change, recency_rank FROM silver""")
SQL["fact_rolling_latency"] = with_(STAR, """
SELECT feature_id, event_date, ROUND(AVG(CAST(latency_ms AS DOUBLE)) OVER (
    PARTITION BY feature_id ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_7d_latency FROM fact""")
TRENDS = TELEMETRY + """,
trend_days AS (
  SELECT CAST("timestamp" AS DATE) AS date, feature_name, AVG(latency_ms) AS l, AVG(feedback_score) AS f FROM telemetry GROUP BY ALL
),
trends AS (
  SELECT date, feature_name, ROUND(l, 6) AS avg_latency_ms, ROUND(f, 6) AS avg_feedback,
         ROUND(AVG(l) OVER w, 6) AS latency_trend, ROUND(AVG(f) OVER w, 6) AS feedback_trend
  FROM trend_days WINDOW w AS (PARTITION BY feature_name ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)"""
SQL["daily_trends"] = with_(TRENDS, "SELECT * FROM trends")

# ---- drift -------------------------------------------------------------------------------


def changes_cte(shift: float) -> str:
    def line(position: int, name: str, column: str) -> str:
        return (f"SELECT {position} AS position, '{name}' AS metric, "
                f"AVG(CASE WHEN side = 0 THEN {column} END) AS baseline, AVG(CASE WHEN side = 1 THEN {column} END) AS current FROM sides")

    lines = union_all([line(i, n, c) for i, (n, c) in enumerate(drift.MEANS.items(), 1)])
    return sides_cte(shift) + f""",
changes AS (
  SELECT *, CASE WHEN baseline = 0 THEN 0 ELSE (current - baseline) / baseline END AS pct_change FROM ({lines})
)"""


def sides_cte(shift: float) -> str:
    return TELEMETRY + f""",
sides AS (
  SELECT CASE WHEN "timestamp" < TIMESTAMP '{DRIFT_SPLIT}' THEN 0 ELSE 1 END AS side,
         CASE WHEN "timestamp" < TIMESTAMP '{DRIFT_SPLIT}' THEN latency_ms ELSE latency_ms * CAST({shift} AS DOUBLE) END AS latency_ms,
         CAST(crash_flag AS DOUBLE) AS crash_flag, feedback_score, CAST(error_count AS DOUBLE) AS error_count FROM telemetry
),
long AS ({union_all([f"SELECT {i} AS position, '{m}' AS metric, side, {m} AS v FROM sides" for i, m in enumerate(drift.METRICS, 1)])})"""


def psi_ctes() -> str:
    return """,
bounds AS (SELECT position, metric, MIN(v) AS lo, MAX(v) AS hi, COUNT(CASE WHEN side = 0 THEN 1 END) AS nb,
                  COUNT(CASE WHEN side = 1 THEN 1 END) AS nc FROM long GROUP BY position, metric),
placed AS (
  SELECT l.metric, l.side, (SELECT COUNT(*) FROM range(1, 10) e(i) WHERE l.v >= b.lo + i * ((b.hi - b.lo) / 10)) AS bin
  FROM long l JOIN bounds b USING (metric)
),
shares AS (
  SELECT b.position, b.metric, (COUNT(CASE WHEN side = 0 THEN 1 END) + 1e-6) / (nb + 1e-5) AS pb,
         (COUNT(CASE WHEN side = 1 THEN 1 END) + 1e-6) / (nc + 1e-5) AS pc, b.lo = b.hi AS constant
  FROM bounds b CROSS JOIN range(0, 10) g(i) LEFT JOIN placed p ON p.metric = b.metric AND p.bin = g.i
  GROUP BY b.position, b.metric, g.i, nb, nc, b.lo, b.hi
),
psi AS (SELECT position, metric, ROUND(SUM(CASE WHEN constant THEN 0 ELSE (pc - pb) * ln(pc / pb) END), 6) AS psi FROM shares GROUP BY position, metric)"""


def ks_ctes() -> str:
    """The exact p-value for up to 10,000 rows a side: the two samples are drawn from one urn row by row,
    and the weight of the draws that never reach the gap is carried along."""
    return """,
counted AS (SELECT position, metric, v, COUNT(CASE WHEN side = 0 THEN 1 END) AS nb, COUNT(CASE WHEN side = 1 THEN 1 END) AS nc FROM long GROUP BY ALL),
running AS (
  SELECT position, metric, SUM(nb) OVER w AS rb, SUM(nc) OVER w AS rc,
         SUM(nb) OVER (PARTITION BY metric) AS tb, SUM(nc) OVER (PARTITION BY metric) AS tc
  FROM counted WINDOW w AS (PARTITION BY metric ORDER BY v ROWS UNBOUNDED PRECEDING)
),
gaps AS (SELECT position, metric, MAX(ABS(CAST(rb AS DOUBLE) / tb - CAST(rc AS DOUBLE) / tc)) AS d,
                CAST(MAX(tb) AS DOUBLE) * MAX(tc) / (MAX(tb) + MAX(tc)) AS n,
                CAST(LEAST(MAX(tb), MAX(tc)) AS BIGINT) AS small, CAST(GREATEST(MAX(tb), MAX(tc)) AS BIGINT) AS large
         FROM running GROUP BY position, metric),
sizes AS (SELECT *, CAST(round(d * small * large) AS BIGINT) AS reach FROM gaps),
walk AS (
  SELECT metric, 0 AS s, CAST(0 AS BIGINT) AS lo, [CAST(1 AS DOUBLE)] AS w FROM sizes WHERE 2 * n * d * d <= 20 AND large <= 10000 AND reach > 0
  UNION ALL
  SELECT metric, s + 1, first, list_transform(range(first, last + 1), lambda i:
      (CASE WHEN i > lo AND i - lo <= len(w) THEN w[i - lo] ELSE 0 END) * (small - i + 1) / (small + large - s)
    + (CASE WHEN i >= lo AND i - lo < len(w) THEN w[i - lo + 1] ELSE 0 END) * (large - s + i) / (small + large - s))
  FROM (
    SELECT k.*, small, large,
           GREATEST(0, s + 1 - large, CAST(floor(CAST((s + 1) * small - reach AS DOUBLE) / (small + large)) AS BIGINT) + 1) AS first,
           LEAST(small, s + 1, CAST(ceil(CAST((s + 1) * small + reach AS DOUBLE) / (small + large)) AS BIGINT) - 1) AS last
    FROM walk k JOIN sizes z USING (metric) WHERE s < small + large
  ) steps
),
ks AS (
  SELECT position, z.metric, d, CASE WHEN 2 * n * d * d > 20 THEN 0 WHEN reach = 0 THEN 1
    ELSE GREATEST(0, LEAST(1, 1 - COALESCE(list_sum(w), 0))) END AS p
  FROM sizes z LEFT JOIN walk k ON k.metric = z.metric AND k.s = small + large
)"""


SQL["drift_pct_change"] = with_(changes_cte(1.5), """
SELECT position, metric, ROUND(baseline, 6) AS baseline, ROUND(current, 6) AS current, ROUND(pct_change, 6) AS pct_change,
       ABS(pct_change) >= 0.2 AS alert FROM changes""")
SQL["drift_psi"] = with_(sides_cte(1.0) + psi_ctes(), "SELECT position, metric, psi FROM psi")
SQL["psi_severity"] = with_(sides_cte(2.5) + psi_ctes(), """
SELECT metric, psi, CASE WHEN psi > 0.2 THEN 'HIGH' WHEN psi > 0.1 THEN 'MODERATE' ELSE 'LOW' END AS severity FROM psi""")
SQL["drift_ks"] = with_(sides_cte(1.5) + ks_ctes(), """
SELECT position, metric, ROUND(d, 6) AS ks_statistic, ROUND(p, 6) AS p_value, p < 0.05 AS drift_detected FROM ks""")
DRIFT_REPORT = """
SELECT COALESCE(string_agg(alert, ' | ' ORDER BY method, position), '') AS alerts, COUNT(*) AS alert_count, COUNT(*) > 0 AS overall_drift_detected
FROM (
  SELECT 1 AS method, position, printf('%s drifted by %.2f%% (threshold 20%%)', metric, pct_change * 100) AS alert
  FROM changes WHERE ABS(pct_change) >= 0.2
  UNION ALL
  SELECT 2, position, CASE WHEN psi > 0.2 THEN printf('PSI ALERT: %s PSI=%.4f > 0.2 (HIGH drift)', metric, psi)
                           ELSE printf('PSI WARNING: %s PSI=%.4f — moderate drift, monitor closely', metric, psi) END
  FROM psi WHERE psi > 0.1
  UNION ALL
  SELECT 3, position, printf('KS ALERT: %s — KS=%.4f, p=%.4f →  Drift detected (p < 0.05)', metric, ROUND(d, 6), ROUND(p, 6))
  FROM ks WHERE p < 0.05
)"""
SQL["drift_report"] = with_(changes_cte(1.5) + psi_ctes() + ks_ctes(), DRIFT_REPORT)
SQL["drift_second_run"] = with_(changes_cte(2.5) + psi_ctes() + ks_ctes(), DRIFT_REPORT)
SQL["drift_first_run"] = with_(TELEMETRY, f"""
SELECT *, 0 AS alerts, CAST(0 AS BIGINT) AS alert_count, false AS overall_drift_detected FROM ({baseline("telemetry")})""")

# ---- streaming ---------------------------------------------------------------------------

STREAM = TELEMETRY + """,
stream AS (
  SELECT 'evt_' || event_id AS event_id, 'user_' || user_id AS user_id, feature_name, session_duration,
         ROUND(latency_ms, 2) AS latency_ms, crash_flag, error_count, feedback_score,
         strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         CASE k % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'us-west-2' ELSE 'eu-west-1' END AS region,
         CASE k % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END AS platform, '3.1.0' AS app_version, k = 13 AS cut
  FROM keyed
)"""
_cut_text = '{"event_id": "cut'
SQL["kafka_read_bronze"] = with_(STREAM, f"""
SELECT * EXCLUDE (cut), CAST(NULL AS VARCHAR) AS _corrupt_record FROM stream WHERE NOT cut
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{_cut_text}' FROM stream WHERE cut""")
STREAMED = """
SELECT CASE WHEN cut THEN NULL ELSE feature_name END AS feature_name, 'kafka_consumer' AS _source, COUNT(*) AS rows,
       COUNT(CASE WHEN cut THEN 1 END) AS corrupt, COUNT(CASE WHEN NOT cut THEN 1 END) AS event_ids,
       ROUND(SUM(CASE WHEN NOT cut THEN latency_ms END), 2) AS latency_sum, CAST(0 AS BIGINT) AS other_day{further}
FROM stream GROUP BY 1"""
SQL["stream_bronze_sink"] = with_(STREAM, STREAMED.format(further=""))
SQL["archive_replay"] = with_(STREAM, STREAMED.format(further=""",
       (SELECT (COUNT(*) + 1) // 2 FROM stream) AS first_run, (SELECT (COUNT(*) + 1) // 2 FROM stream) AS after_failure"""))
SQL["csv_fallback"] = with_(TELEMETRY, f"SELECT {RAW_ROWS}, 'bronze' AS _layer FROM telemetry")
SQL["kafka_write_keyed"] = with_(STREAM, """
SELECT feature_name AS key, CAST(to_json({event_id: event_id, user_id: user_id, feature_name: feature_name, session_duration: session_duration,
  latency_ms: latency_ms, crash_flag: crash_flag, error_count: error_count, feedback_score: feedback_score, "timestamp": "timestamp",
  region: region, platform: platform, app_version: app_version}) AS VARCHAR) AS value
FROM stream WHERE NOT cut""")

# ---- risk: labels, splits, metrics -------------------------------------------------------

SQL["risk_target"] = with_(LABELLED, "SELECT * FROM labelled")
SQL["save_model"] = with_(DAYS, "SELECT feature_name, date, true AS same FROM days")
SQL["row_attribution"] = with_(DAYS, "SELECT feature_name, date, true AS adds_up FROM days")
SQL["end_to_end_run"] = with_(LABELLED.replace("AVG(latency_ms)", "AVG(LEAST(GREATEST(latency_ms, 0), 5000))"),
                              "SELECT *, true AS scored FROM labelled")
SQL["gate_stops_run"] = """
SELECT 'failed' AS status, CAST(0 AS BIGINT) AS rows_processed, 'latency above 5000 ms' AS error, COUNT(*) AS landed,
       CAST(0 AS BIGINT) AS silver_files FROM events"""
SQL["clean_features"] = with_(DAYS, """
SELECT feature_name, date, CASE WHEN day(CAST(date AS DATE)) IN (3, 4) THEN 0 ELSE avg_latency END AS avg_latency,
       CASE WHEN day(CAST(date AS DATE)) = 5 THEN 0 ELSE crash_rate END AS crash_rate,
       CASE WHEN day(CAST(date AS DATE)) = 6 THEN 0 ELSE avg_feedback END AS avg_feedback,
       CAST(usage_count AS DOUBLE) AS usage_count, avg_error_count FROM days""")


def _scaled(name: str) -> str:
    spread = f"(quantile_cont({name}, 0.75) OVER () - quantile_cont({name}, 0.25) OVER ())"
    return (f"ROUND(({name} - quantile_cont({name}, 0.5) OVER ()) / "
            f"(CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END), 6) AS scaled_{name}")


SQL["robust_scale"] = with_(DAYS, f"""
SELECT feature_name, date, {', '.join(_scaled(c) for c in RISK_FEATURES)}
FROM (SELECT * REPLACE (CAST(usage_count AS DOUBLE) AS usage_count) FROM days)""")
SQL["stratified_split"] = with_(TELEMETRY, f"""
SELECT event_id, crash_flag, ROW_NUMBER() OVER (PARTITION BY crash_flag ORDER BY {draw('event_id', 42)})
       <= floor(0.2 * COUNT(*) OVER (PARTITION BY crash_flag) + 0.5) AS is_test FROM keyed""")
SQL["stratified_folds"] = with_(TELEMETRY + f""",
ranked AS (SELECT event_id, crash_flag, ROW_NUMBER() OVER (PARTITION BY crash_flag ORDER BY {draw('event_id', 43)}) AS r,
                  COUNT(*) OVER (PARTITION BY crash_flag) AS n FROM keyed)""", """
SELECT CAST((SELECT COUNT(*) FROM range(1, 5) c(i) WHERE r > floor(i / 5 * n + 0.5)) AS INTEGER) AS fold, crash_flag,
       COUNT(*) AS rows, CAST(SUM(event_id) AS BIGINT) AS id_sum FROM ranked GROUP BY 1, 2""")
SQL["class_weights"] = with_(LABELLED, """
SELECT is_high_risk, COUNT(*) AS rows, ROUND((SELECT COUNT(*) FROM labelled) / (2 * COUNT(*)), 6) AS weight FROM labelled GROUP BY is_high_risk""")
SCORED = TELEMETRY + """,
scored AS (
  SELECT crash_flag AS label, floor(latency_ms / 50) + CASE WHEN error_count < 5 THEN 3 ELSE 0 END AS score,
         CASE WHEN floor(latency_ms / 50) + CASE WHEN error_count < 5 THEN 3 ELSE 0 END > 14 THEN 1 ELSE 0 END AS predicted FROM telemetry
),
by_score AS (SELECT score, COUNT(CASE WHEN label = 1 THEN 1 END) AS pos, COUNT(CASE WHEN label = 0 THEN 1 END) AS neg FROM scored GROUP BY score),
ranked AS (
  SELECT *, SUM(neg) OVER (ORDER BY score) AS neg_upto, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(pos + neg) OVER (ORDER BY score DESC) AS raised,
         SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM by_score
),
cells AS (
  SELECT COUNT(CASE WHEN label = 0 AND predicted = 0 THEN 1 END) AS tn, COUNT(CASE WHEN label = 0 AND predicted = 1 THEN 1 END) AS fp,
         COUNT(CASE WHEN label = 1 AND predicted = 0 THEN 1 END) AS fn, COUNT(CASE WHEN label = 1 AND predicted = 1 THEN 1 END) AS tp FROM scored
)"""
SQL["eval_roc_auc"] = with_(SCORED, """
SELECT CAST(MAX(p) AS BIGINT) AS positives, CAST(MAX(n) AS BIGINT) AS negatives,
       ROUND(SUM(pos * (neg_upto - neg / 2)) / (CAST(MAX(p) AS DOUBLE) * MAX(n)), 6) AS roc_auc FROM ranked""")
SQL["eval_average_precision"] = with_(SCORED, """
SELECT CAST(MAX(p) AS BIGINT) AS positives, ROUND(SUM(CAST(pos AS DOUBLE) / p * tp / raised), 6) AS average_precision FROM ranked""")
SQL["eval_confusion"] = with_(SCORED, """
SELECT 0 AS actual, 0 AS predicted, tn AS rows FROM cells UNION ALL SELECT 0, 1, fp FROM cells
UNION ALL SELECT 1, 0, fn FROM cells UNION ALL SELECT 1, 1, tp FROM cells""")
SQL["eval_accuracy"] = with_(SCORED, """
SELECT tn + fp + fn + tp AS rows, ROUND((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy,
       ROUND((fn + tp) / (tn + fp + fn + tp), 6) AS positive_rate FROM cells""")
SQL["eval_class_report"] = with_(SCORED + """,
classes AS (
  SELECT '0' AS name, COALESCE(tn / nullif(tn + fn, 0), 0) AS p, COALESCE(tn / nullif(tn + fp, 0), 0) AS r, tn + fp AS n FROM cells
  UNION ALL SELECT '1', COALESCE(tp / nullif(tp + fp, 0), 0), COALESCE(tp / nullif(tp + fn, 0), 0), tp + fn FROM cells
),
report AS (SELECT name, p, r, COALESCE(2 * p * r / nullif(p + r, 0), 0) AS f, n FROM classes)""", """
SELECT name, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1, n AS support FROM report
UNION ALL SELECT 'macro avg', ROUND(AVG(p), 6), ROUND(AVG(r), 6), ROUND(AVG(f), 6), CAST(SUM(n) AS BIGINT) FROM report
UNION ALL SELECT 'weighted avg', ROUND(SUM(p * n) / SUM(n), 6), ROUND(SUM(r * n) / SUM(n), 6), ROUND(SUM(f * n) / SUM(n), 6), CAST(SUM(n) AS BIGINT) FROM report""")
SQL["logged_run"] = with_(SCORED, """
SELECT 'events' AS run_name, CAST(tn + fp + fn + cells.tp AS DOUBLE) AS test_rows, CAST(tn AS DOUBLE) AS true_negatives,
       CAST(fp AS DOUBLE) AS false_positives, CAST(fn AS DOUBLE) AS false_negatives, CAST(cells.tp AS DOUBLE) AS true_positives,
       (SELECT ROUND(SUM(pos * (neg_upto - neg / 2)) / (CAST(MAX(p) AS DOUBLE) * MAX(n)), 6) FROM ranked) AS roc_auc,
       ROUND((tn + cells.tp) / (tn + fp + fn + cells.tp), 6) AS accuracy, '300' AS trees, 'RandomForestClassifier' AS model_type FROM cells""")
SQL["training_counts"] = with_(LABELLED + """,
classes AS (SELECT is_high_risk AS c, COUNT(*) AS n, CAST(floor(0.2 * COUNT(*) + 0.5) AS BIGINT) AS test FROM labelled GROUP BY 1)""", """
SELECT CAST(SUM(n - test) AS BIGINT) AS train_rows, CAST(SUM(test) AS BIGINT) AS test_rows, CAST(SUM(c * test) AS BIGINT) AS test_positives,
       CAST(SUM((1 - c) * test) AS BIGINT) AS test_negatives, ROUND(SUM(c * n) / SUM(n), 6) AS positive_rate FROM classes""")
SQL["importance_order"] = """
SELECT CAST(i AS INTEGER) AS place, true AS rising, true AS sums_to_one, true AS not_negative FROM range(1, 6) r(i)"""
SQL["scored_days"] = with_(LABELLED, """
SELECT feature_name, COUNT(*) AS scored, CAST(SUM(is_high_risk) AS BIGINT) AS high_risk, true AS agree FROM labelled GROUP BY feature_name""")
SQL["best_run"] = with_(TELEMETRY, """
SELECT 'run-' || feature_name AS run_id, feature_name AS run_name, ROUND(AVG(crash_flag), 6) AS roc_auc
FROM telemetry GROUP BY feature_name ORDER BY roc_auc DESC LIMIT 1""")

# ---- serving -----------------------------------------------------------------------------

CARDS = TELEMETRY + "," + SUMMARY.format(source="(SELECT * REPLACE ('user-' || user_id AS feature_name) FROM telemetry)") + f""",
cards AS (SELECT {SUMMARY_COLUMNS}, ROUND(usage_count % 23 / CAST(23 AS DOUBLE), 4) AS risk_probability FROM summary)"""
SQL["kpi_overview"] = with_(CARDS, """
SELECT COUNT(*) AS total_features, COUNT(CASE WHEN risk_probability > 0.5 THEN 1 END) AS high_risk, ROUND(AVG(avg_latency_ms), 6) AS avg_latency,
       ROUND(AVG(quality_score), 6) AS avg_quality, CAST(0.9 AS DOUBLE) AS model_auc, CAST(91.7 AS DOUBLE) AS data_quality_pct FROM cards""")
SQL["risk_ranking"] = with_(CARDS, f"SELECT feature_name, risk_probability, {tier('risk_probability')} AS risk_tier FROM cards")
SQL["risk_tier"] = with_(CARDS, f"""
SELECT {tier('risk_probability')} AS risk_tier, COUNT(*) AS features, MIN(risk_probability) AS lowest, MAX(risk_probability) AS highest
FROM cards GROUP BY 1""")
_advice = [(name, i, m) for name, lines in ADVICE.items() for i, m in enumerate(lines, 1)]
_advice += [(name, i, m) for name in ("MEDIUM", RISK_FLOOR_TIER) for i, m in enumerate(ADVICE_OTHERWISE, 1)]
SQL["risk_recommendations"] = with_(CARDS, f"""
SELECT feature_name, risk_tier, step, message FROM (SELECT feature_name, {tier('risk_probability')} AS risk_tier FROM cards)
JOIN (VALUES {', '.join(f"('{n}', {i}, {quoted(m)})" for n, i, m in _advice)}) a(risk_tier, step, message) USING (risk_tier)""")
SQL["feature_deep_dive"] = with_(TELEMETRY + "," + SUMMARY.format(source="telemetry"), f"""
SELECT feature_name, risk_probability, {tier('risk_probability')} AS risk_tier, avg_latency_ms AS avg_latency, crash_rate,
       avg_feedback_score AS avg_feedback, usage_count
FROM (SELECT *, ROUND(crash_rate * 10, 4) AS risk_probability FROM (SELECT {SUMMARY_COLUMNS} FROM summary)) WHERE feature_name = 'purchase'""")
SQL["feature_deep_dive_days"] = with_(DAYS, f"""
SELECT feature_name, risk_probability, {tier('risk_probability')} AS risk_tier, avg_latency, crash_rate, avg_feedback, usage_count
FROM (SELECT *, ROUND(crash_rate * 10, 4) AS risk_probability FROM days) WHERE feature_name = 'purchase' ORDER BY date DESC LIMIT 1""")
SQL["feature_trend"] = with_(TRENDS, "SELECT * FROM trends WHERE feature_name = 'purchase'")
SQL["drift_status"] = with_(changes_cte(1.15), """
SELECT metric, ROUND(pct_change * 100, 6) AS change_pct,
       CASE WHEN ABS(pct_change) > 0.2 THEN 'red' WHEN ABS(pct_change) > 0.1 THEN 'amber' ELSE 'green' END AS colour FROM changes""")

RUN_FIGURES = CLEAN + f""",
moved AS ({union_all([
    f"SELECT (AVG(CASE WHEN side = 1 THEN {c} END) - AVG(CASE WHEN side = 0 THEN {c} END))"
    f" / AVG(CASE WHEN side = 0 THEN {c} END) AS change FROM sides" for c in drift.MEANS.values()
])}),
figures AS (
  SELECT 'success' AS status, (SELECT COUNT(*) FROM telemetry) AS rows_ingested, (SELECT COUNT(*) FROM labelled) AS rows_processed,
         (SELECT CAST(SUM(is_high_risk) AS BIGINT) FROM labelled) AS high_risk_features,
         (SELECT ROUND(good / total * 100, 1) FROM suite) AS quality_score_pct, (SELECT good FROM suite) AS quality_checks_passed,
         (SELECT COUNT(*) FROM moved WHERE ABS(change) >= 0.2) AS drift_alerts
)"""
RUN_FIGURES = sides_cte(1.5) + RUN_FIGURES.replace(TELEMETRY, "", 1)
SQL["run_summary"] = with_(RUN_FIGURES, "SELECT * FROM figures")
SQL["pipeline_status"] = with_(RUN_FIGURES, """
SELECT 1 AS step, 'Ingestion' AS name, rows_ingested || ' rows loaded' AS detail FROM figures
UNION ALL SELECT 2, 'Schema Validation', '8/8 columns validated' FROM figures
UNION ALL SELECT 3, 'Data Quality Suite', printf('%.1f%% · %d/12 checks', quality_score_pct, quality_checks_passed) FROM figures
UNION ALL SELECT 4, 'Drift Detection', drift_alerts || ' alerts · KS + PSI + Δ% methods' FROM figures
UNION ALL SELECT 5, 'Feature Engineering', '12 features engineered → Silver layer' FROM figures
UNION ALL SELECT 6, 'Aggregation', 'Feature-day grain aggregation' FROM figures
UNION ALL SELECT 7, 'ML Risk Scoring', printf('AUC=0.0000 · %d high-risk features', high_risk_features) FROM figures
UNION ALL SELECT 8, 'Artifact Persistence', 'Model + metrics + feature importance saved' FROM figures
UNION ALL SELECT 9, 'Output Export', 'CSV + Parquet (Silver) written' FROM figures""")
