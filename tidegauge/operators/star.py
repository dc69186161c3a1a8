"""Star schema: feature-day fact, feature dimension, key checks and the queries on both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.rollup import trailing_mean

FACT_KEY = ("feature_id", "event_date")
DIMENSION_KEY = ("feature_id",)


def fact_feature_metrics(days: DataFrame, risk_score: Column, anomaly_flag: Column) -> DataFrame:
    """Fact rows from feature-day rows; ``days`` has feature_id, event_date and the metrics."""
    return days.select(
        "feature_id",
        F.col("event_date").cast("date").alias("event_date"),
        F.col("avg_latency").cast("float").alias("latency_ms"),
        F.col("crash_rate").cast("float").alias("crash_rate"),
        F.col("avg_feedback").cast("float").alias("feedback_score"),
        F.col("usage_count").cast("int").alias("active_users"),
        risk_score.cast("float").alias("risk_score"),
        anomaly_flag.cast("boolean").alias("anomaly_flag"),
    )


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that break a primary key: ``null_keys`` and ``duplicate_keys``, one row.

    Spark does not enforce keys, so a model that declares one checks it.
    """
    incomplete = F.lit(False)
    for name in key:
        incomplete = incomplete | F.col(name).isNull()
    groups = df.groupBy(*key).count()
    return groups.agg(
        F.coalesce(F.sum(F.when(incomplete, F.col("count"))), F.lit(0)).alias("null_keys"),
        F.count_if(~incomplete & (F.col("count") > 1)).alias("duplicate_keys"),
    )


def fact_rolling_latency(fact: DataFrame) -> DataFrame:
    return fact.select(
        "feature_id", "event_date",
        trailing_mean("latency_ms", 7, "feature_id", "event_date").alias("rolling_7d_latency"),
    )


def high_risk_owners(fact: DataFrame, dimension: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Features whose mean risk exceeds the threshold, with the owning team.

    The fact is averaged and filtered per feature before the join: the dimension holds one row
    per feature, so the mean is the same and only risky features are joined.
    """
    risky = fact.groupBy("feature_id").agg(F.avg("risk_score").alias("avg_risk")).filter(F.col("avg_risk") > threshold)
    owners = dimension.select("feature_id", "owner_team").distinct()
    return risky.join(owners, "feature_id").select("feature_id", "owner_team", "avg_risk")


def risk_by_attribute(fact: DataFrame, dimension: DataFrame, attribute: str) -> DataFrame:
    """Feature-days, features and mean risk per dimension attribute (team, lifecycle stage)."""
    per_feature = fact.groupBy("feature_id").agg(
        F.sum("risk_score").alias("_risk"),
        F.count("risk_score").alias("_scored"),
        F.count(F.lit(1)).alias("_days"),
    )
    joined = per_feature.join(dimension.select("feature_id", attribute), "feature_id")
    return joined.groupBy(attribute).agg(
        F.count(F.lit(1)).alias("features"),
        F.sum("_days").alias("feature_days"),
        F.try_divide(F.sum("_risk"), F.sum("_scored")).alias("avg_risk"),
    )


def risk_by_lifecycle(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    return risk_by_attribute(fact, dimension, "lifecycle_stage")


# Our own limits: the reliability targets a feature-day is held against.
SLO_LATENCY_MS = 1_500.0
SLO_LATENCY_SHARE = 0.95
SLO_CRASH_RATE = 0.05


def slo_tracking(
    bronze: DataFrame,
    latency_ms: float = SLO_LATENCY_MS,
    latency_share: float = SLO_LATENCY_SHARE,
    crash_rate: float = SLO_CRASH_RATE,
) -> DataFrame:
    """Per feature: days, days that meet each target, and the share of days that meet both.

    The latency target reads "95 % of events within the limit", i.e. p95 at or below it. That
    is a count, where a percentile per group would hold a busy feature-day in one task.
    """
    days = bronze.groupBy("feature_name", "event_date").agg(
        F.try_divide(F.count_if(F.col("latency_ms") <= latency_ms), F.count("latency_ms")).alias("fast_share"),
        F.avg("crash_flag").alias("crash_rate"),
    )
    fast = F.coalesce(F.col("fast_share") >= latency_share, F.lit(False))
    stable = F.coalesce(F.col("crash_rate") <= crash_rate, F.lit(False))
    return days.groupBy("feature_name").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(fast).alias("latency_ok_days"),
        F.count_if(stable).alias("crash_ok_days"),
        F.avg((fast & stable).cast("int")).alias("slo_share"),
    )
