"""The given ``events`` table seen as telemetry, clean or with deterministic defects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.schema import RAW_EVENT

DRIFT_SPLIT = "2024-01-16"


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telemetry columns plus ``event_id`` and ``k``; ``timestamp`` is a zone-less time."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    return events.withColumn("k", k).select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("feature_name"),
        (10 + (F.col("event_id") * 7919) % 590).cast("double").alias("session_duration"),
        (F.col("value") * 10.0).alias("latency_ms"),
        F.when(F.col("k") < 5, 1).otherwise(0).alias("crash_flag"),
        (F.col("k") % 7).alias("error_count"),
        (1.0 + (F.col("k") % 9) * 0.5).cast("double").alias("feedback_score"),
        F.col("ts").alias("timestamp"),
        "k",
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight raw columns."""
    return keyed_events(spark, sf_dir).select(*RAW_EVENT.fieldNames())


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry as untyped text with gaps and bad values placed by ``k``."""
    k = F.col("k")

    def text(name: str, **bad: str | None) -> Column:
        value = F.col(name).cast("string")
        for key, replacement in bad.items():
            value = F.when(k == int(key[1:]), F.lit(replacement)).otherwise(value)
        return value.alias(name)

    second = F.date_trunc("second", F.col("timestamp")).cast("string")
    return keyed_events(spark, sf_dir).select(
        "event_id",
        "k",
        text("user_id", k41=None),
        text("feature_name", k23="  ", k43=None),
        F.when(k % 4 == 0, None).otherwise(F.col("session_duration").cast("string")).alias("session_duration"),
        text("latency_ms", k13=None, k37="n/a"),
        text("crash_flag", k17="2"),
        text("error_count", k47="-1"),
        text("feedback_score", k18="0", k19="6"),
        F.when(k == 29, "not-a-time").when(k == 31, None).otherwise(second).alias("timestamp"),
    )
