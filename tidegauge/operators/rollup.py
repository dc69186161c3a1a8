"""Feature-day roll-ups, their windows, and whole-table aggregates.

Events reach the feature-day grain through one partial-then-final hash aggregation, so a
feature that owns most events is still only one row per day and task in the shuffle. All
windows run on that grain, where a feature has one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.expressions import daily_quality, wall_time

NO_DAY = "NaT"  # fixed value: day label of rows whose timestamp does not parse


def agg_daily(df: DataFrame) -> DataFrame:
    """Per (feature_name, day text): means and the count of non-null user ids.

    Grouped by the date itself; only the grouped rows are formatted.
    """
    day = wall_time(df, "timestamp").cast("date")
    grouped = df.filter(F.col("feature_name").isNotNull()).groupBy("feature_name", day.alias("date")).agg(
        F.avg("latency_ms").alias("avg_latency"),
        F.avg("crash_flag").alias("crash_rate"),
        F.avg("feedback_score").alias("avg_feedback"),
        F.count("user_id").alias("usage_count"),
        F.avg("error_count").alias("avg_error_count"),
    )
    return grouped.withColumn("date", F.coalesce(F.col("date").cast("string"), F.lit(NO_DAY)))


def silver_daily(bronze: DataFrame) -> DataFrame:
    """Per (feature_name, event_date) of the typed Bronze view; usage counts every row."""
    return bronze.groupBy("feature_name", "event_date").agg(
        F.avg("latency_ms").alias("avg_latency"),
        F.avg("crash_flag").alias("crash_rate"),
        F.avg("feedback_score").alias("avg_feedback"),
        F.avg("error_count").alias("avg_error_count"),
        F.count(F.lit(1)).alias("usage_count"),
        F.sum("crash_flag").alias("total_crashes"),
        F.avg("session_duration").alias("avg_session_duration"),
        F.count_if(F.col("latency_ms").isNull()).alias("null_latency_count"),
    )


def silver_quality_score(daily: DataFrame) -> DataFrame:
    score = daily_quality(F.col("avg_latency"), F.col("crash_rate"), F.col("avg_feedback"))
    return daily.withColumn("quality_score", score)


def trailing_mean(value: str, rows: int, key: str, order: str) -> Column:
    """Mean of the current and the ``rows - 1`` preceding rows; gaps in days are not filled, a null day is last."""
    return F.avg(value).over(Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last()).rowsBetween(1 - rows, 0))


def add_rolling_stats(daily: DataFrame, key: str = "feature_name", order: str = "event_date") -> DataFrame:
    """Seven-row means, day-over-day latency change and recency rank.

    The rank counts back from the last row, so every window shares one sort order.
    """
    ordered = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last())
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    recency = F.count(F.lit(1)).over(whole) - F.row_number().over(ordered) + 1
    return daily.withColumns({
        "rolling_7d_avg_latency": trailing_mean("avg_latency", 7, key, order),
        "rolling_7d_crash_rate": trailing_mean("crash_rate", 7, key, order),
        "latency_dod_change": F.col("avg_latency") - F.lag("avg_latency").over(ordered),
        "recency_rank": recency,
    })


def silver_feature_metrics(bronze: DataFrame) -> DataFrame:
    """The Silver feature-day model: aggregate, score, windows; sixteen columns."""
    return add_rolling_stats(silver_quality_score(silver_daily(bronze))).select(
        "feature_name", "event_date", "avg_latency", "crash_rate", "avg_feedback", "avg_error_count",
        "usage_count", "total_crashes", "avg_session_duration", "quality_score",
        "rolling_7d_avg_latency", "rolling_7d_crash_rate", "latency_dod_change", "recency_rank",
        F.current_timestamp().alias("_silver_loaded_at"),
        F.lit("silver").alias("_layer"),
    )


def daily_trends(df: DataFrame) -> DataFrame:
    """Day by feature means of latency and feedback with their three-row trailing means."""
    daily = df.withColumn("date", wall_time(df, "timestamp").cast("date")).filter(
        F.col("date").isNotNull() & F.col("feature_name").isNotNull()
    ).groupBy("date", "feature_name").agg(
        F.avg("latency_ms").alias("avg_latency_ms"), F.avg("feedback_score").alias("avg_feedback")
    )
    return daily.withColumns({
        "latency_trend": trailing_mean("avg_latency_ms", 3, "feature_name", "date"),
        "feedback_trend": trailing_mean("avg_feedback", 3, "feature_name", "date"),
    })


def baseline_measures() -> dict[str, Column]:
    return {
        "row_count": F.count(F.lit(1)),
        "latency_ms_mean": F.avg("latency_ms"),
        "latency_ms_std": F.stddev_samp("latency_ms"),
        "crash_flag_rate": F.avg("crash_flag"),
        "feedback_score_mean": F.avg("feedback_score"),
        "error_count_mean": F.avg("error_count"),
    }


def baseline_stats(df: DataFrame) -> DataFrame:
    """The one-row baseline that later runs are compared with."""
    return df.agg(*[c.alias(n) for n, c in baseline_measures().items()])


def feature_summary(df: DataFrame, scored_days: DataFrame | None = None) -> DataFrame:
    """One row per feature, scored with the feature-day quality formula.

    ``scored_days`` (feature_name, risk_probability) adds the mean risk of the feature's days
    and ``high_risk`` where that exceeds one half.
    """
    summary = df.filter(F.col("feature_name").isNotNull()).groupBy("feature_name").agg(
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.avg("crash_flag").alias("crash_rate"),
        F.avg("error_count").alias("avg_error_count"),
        F.avg("feedback_score").alias("avg_feedback_score"),
        F.count("user_id").alias("usage_count"),
    )
    score = daily_quality(F.col("avg_latency_ms"), F.col("crash_rate"), F.col("avg_feedback_score"))
    summary = summary.withColumn("quality_score", score)
    if scored_days is None:
        return summary
    risk = scored_days.groupBy("feature_name").agg(F.avg("risk_probability").alias("risk_probability"))
    return summary.join(risk, "feature_name", "left").withColumn(
        "high_risk", F.coalesce(F.col("risk_probability") > 0.5, F.lit(False)).cast("int")
    )
