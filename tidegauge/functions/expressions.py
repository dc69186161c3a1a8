"""Column expressions shared by the operators. All stay inside JVM code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def null_if_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing-value marker: NaN in floating columns becomes null."""
    floating = (T.DoubleType, T.FloatType)
    return df.select([
        null_if_nan(F.col(f.name)).alias(f.name) if isinstance(f.dataType, floating) else F.col(f.name)
        for f in df.schema
    ])


def finite_or_zero(value: Column) -> Column:
    value = value.cast("double")
    return F.when(F.abs(value) < float("inf"), value).otherwise(0.0)


def clip(value: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; null stays null although greatest/least skip nulls."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def wall_time(df: DataFrame, name: str) -> Column:
    """``name`` as a zone-less timestamp; text that does not parse becomes null."""
    value = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return value
    if isinstance(kind, T.StringType):
        value = F.try_to_timestamp(value)
    return value.cast("timestamp_ntz")


def rows_from(one_row: DataFrame, structs: Iterable[Column]) -> DataFrame:
    """Turn a one-row frame of measures into a short report, one row per struct."""
    return one_row.select(F.inline(F.array(*structs)))


def percent_text(share: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", share * 100)


def event_quality(latency: Column, crash: Column, feedback: Column) -> Column:
    """Event-grain score; latency enters in milliseconds."""
    return (1 / (1 + latency) + (1 - crash) + feedback / 5) / 3


def daily_quality(latency: Column, crash: Column, feedback: Column) -> Column:
    """Feature-day score; latency enters in seconds. Not the event formula."""
    raw = (1.0 / (1.0 + latency / 1000.0) + (1.0 - crash) + feedback / 5.0) / 3.0
    return F.round(raw, 4)


# Right-closed latency bins, risk tiers, drift and PSI limits.
LATENCY_BINS = [(100, "excellent"), (300, "good"), (600, "moderate"), (1000, "poor")]
LATENCY_TOP_BIN = "critical"
LATENCY_NO_BIN = "nan"
RISK_TIERS = [(0.7, "CRITICAL"), (0.5, "HIGH"), (0.3, "MEDIUM")]
RISK_FLOOR_TIER = "LOW"
PSI_HIGH = 0.20
PSI_MODERATE = 0.10
DRIFT_RED = 0.2
DRIFT_AMBER = 0.1


def latency_bucket(latency: Column) -> Column:
    bucket = F.when(latency.isNull() | (latency <= 0), LATENCY_NO_BIN)
    for upper, name in LATENCY_BINS:
        bucket = bucket.when(latency <= upper, name)
    return bucket.otherwise(LATENCY_TOP_BIN)


def risk_tier(probability: Column) -> Column:
    (first, name), *rest = RISK_TIERS
    tier = F.when(probability >= first, name)
    for lower, name in rest:
        tier = tier.when(probability >= lower, name)
    return tier.otherwise(RISK_FLOOR_TIER)


def psi_severity(psi: Column) -> Column:
    return F.when(psi > PSI_HIGH, "HIGH").when(psi > PSI_MODERATE, "MODERATE").otherwise("LOW")


def drift_colour(change: Column) -> Column:
    size = F.abs(change)
    return F.when(size > DRIFT_RED, "red").when(size > DRIFT_AMBER, "amber").otherwise("green")
