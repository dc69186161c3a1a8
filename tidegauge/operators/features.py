"""Event-grain feature engineering: two global figures first, then one map-only projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.expressions import event_quality, flag, latency_bucket, wall_time
from tidegauge.functions.selection import exact_quantiles

# The anomaly rule, the error limit and the weekend and office hours.
ANOMALY_QUANTILE = 0.95
ANOMALY_FEEDBACK = 2.0
HIGH_ERROR = 3
WEEKEND = (5, 6)
OFFICE_HOURS = (9, 17)

DERIVED = [
    "date", "hour_of_day", "day_of_week", "is_weekend", "is_business_hours", "quality_score",
    "latency_bucket", "is_anomaly", "has_errors", "high_error", "session_quality_index", "log_latency",
]


@dataclass(frozen=True)
class EventScale:
    """Table-wide figures that row features are measured against."""

    latency_p95: float | None
    max_duration: float

    @classmethod
    def of(cls, df: DataFrame) -> EventScale:
        """``df`` must already be free of unparseable timestamps."""
        # Both from one read of the source; the greatest value is the quantile 1.
        found = exact_quantiles(df, {"latency_ms": [ANOMALY_QUANTILE], "session_duration": [1.0]})
        (p95,), (longest,) = found["latency_ms"], found["session_duration"]
        return cls.from_figures(p95, longest)

    @classmethod
    def of_sessions(cls, df: DataFrame) -> EventScale:
        """The longest session alone; the latency limit stays unknown."""
        return cls.from_figures(None, df.agg(F.max("session_duration")).first()[0])

    @classmethod
    def from_figures(cls, latency_p95: float | None, longest_session: float | None) -> EventScale:
        """A missing or non-positive longest session counts as 1."""
        return cls(latency_p95, float(longest_session) if longest_session and longest_session > 0 else 1.0)


def parse_ts_drop_bad(df: DataFrame) -> DataFrame:
    """Parse ``timestamp``, drop rows where that fails, add the ISO day as text."""
    parsed = df.withColumn("timestamp", wall_time(df, "timestamp")).dropna(subset=["timestamp"])
    return parsed.withColumn("date", F.col("timestamp").cast("date").cast("string"))


def bad_timestamp_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(wall_time(df, "timestamp").isNull()).alias("bad_timestamps"))


def time_features(df: DataFrame) -> DataFrame:
    """Hour, weekday (0 is Monday), weekend and office-hour flags; needs a parsed timestamp."""
    hour, weekday = F.hour("timestamp"), F.weekday("timestamp")
    return df.withColumns({
        "hour_of_day": hour,
        "day_of_week": weekday,
        "is_weekend": flag(weekday.isin(*WEEKEND)),
        "is_business_hours": flag(hour.between(*OFFICE_HOURS)),
    })


def add_quality_score(df: DataFrame) -> DataFrame:
    score = event_quality(F.col("latency_ms"), F.col("crash_flag"), F.col("feedback_score"))
    return df.withColumn("quality_score", score)


def add_latency_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("latency_bucket", latency_bucket(F.col("latency_ms")))


def add_anomaly_flag(df: DataFrame, scale: EventScale) -> DataFrame:
    slow = F.col("latency_ms") > F.lit(scale.latency_p95).cast("double")
    unhappy = F.col("feedback_score") < ANOMALY_FEEDBACK
    return df.withColumn("is_anomaly", flag(slow & (F.col("crash_flag") == 1) & unhappy))


def add_error_flags(df: DataFrame) -> DataFrame:
    errors = F.col("error_count")
    return df.withColumns({"has_errors": flag(errors > 0), "high_error": flag(errors > HIGH_ERROR)})


def add_session_quality(df: DataFrame, scale: EventScale) -> DataFrame:
    blend = F.col("session_duration") / scale.max_duration * 0.5 + F.col("feedback_score") / 5.0 * 0.5
    return df.withColumn("session_quality_index", F.bround(blend, 4))


def add_log_latency(df: DataFrame) -> DataFrame:
    return df.withColumn("log_latency", F.log1p("latency_ms"))


def engineer_features(df: DataFrame, scale: EventScale | None = None) -> DataFrame:
    """All twelve derived columns. Pass ``scale`` to reuse figures measured elsewhere."""
    parsed = parse_ts_drop_bad(df)
    scale = scale or EventScale.of(parsed)
    result = add_quality_score(time_features(parsed))
    result = add_anomaly_flag(add_latency_bucket(result), scale)
    return add_log_latency(add_session_quality(add_error_flags(result), scale))


def transform_summary(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomalies")
    )
