"""Explicit schemas of the data model. Nothing in the library infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, types and accepted ranges of the telemetry data model.
RAW_EVENT = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("feature_name", T.StringType()),
    T.StructField("session_duration", T.DoubleType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("crash_flag", T.IntegerType()),
    T.StructField("error_count", T.IntegerType()),
    T.StructField("feedback_score", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])
STREAM_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    *RAW_EVENT.fields,
    T.StructField("region", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("app_version", T.StringType()),
])
RAW_REQUIRED = RAW_EVENT.fieldNames()
PROCESSED_REQUIRED = ["feature_name", "date", "crash_rate", "usage_count"]
NUMERIC_COLUMNS = ["latency_ms", "crash_flag", "feedback_score", "error_count", "session_duration"]
VALUE_RANGES = {
    "latency_ms": (0, 10_000),
    "crash_flag": (0, 1),
    "feedback_score": (1, 5),
    "error_count": (0, 1_000),
}

# The words that stand for a missing value in a raw CSV.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

RAW_EVENT_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_EVENT])

INGEST_COLUMNS = [
    T.StructField("_ingested_at", T.StringType()),
    T.StructField("_source", T.StringType()),
]
_BATCH_COLUMNS = [*INGEST_COLUMNS, T.StructField("_layer", T.StringType()), T.StructField("date", T.StringType())]
# Bronze holds raw columns as they came, as text; further columns of a load are kept beside them.
BRONZE_TEXT = T.StructType([*RAW_EVENT_TEXT.fields, *_BATCH_COLUMNS])
STREAM_BRONZE_EVENT = T.StructType([
    *STREAM_EVENT.fields,
    T.StructField("_corrupt_record", T.StringType()),
    *INGEST_COLUMNS,
    T.StructField("_partition_date", T.StringType()),
    T.StructField("date", T.StringType()),
])

BASELINE = T.StructType([
    T.StructField("row_count", T.LongType()),
    T.StructField("latency_ms_mean", T.DoubleType()),
    T.StructField("latency_ms_std", T.DoubleType()),
    T.StructField("crash_flag_rate", T.DoubleType()),
    T.StructField("feedback_score_mean", T.DoubleType()),
    T.StructField("error_count_mean", T.DoubleType()),
])

# How often each value of a monitored metric occurred in the load that the baseline came from.
BASELINE_VALUES = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("n", T.LongType()),
])

# Feature-day columns the risk model learns from.
RISK_FEATURES = ["avg_latency", "crash_rate", "avg_feedback", "usage_count", "avg_error_count"]
