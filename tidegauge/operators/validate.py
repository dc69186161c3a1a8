"""Schema validation. Every figure comes from one aggregation over the table."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.expressions import rows_from
from tidegauge.schema import NUMERIC_COLUMNS, PROCESSED_REQUIRED, RAW_REQUIRED, VALUE_RANGES

logger = logging.getLogger(__name__)

# The share of out-of-range values that stops a run, and the few-rows warning.
CRITICAL_SHARE = 0.20
FEW_ROWS = 10
REQUIRED = {"raw": RAW_REQUIRED, "processed": PROCESSED_REQUIRED}


class ValidationError(ValueError):
    """The table breaks a rule that stops the run."""


def required_columns(stage: str) -> list[str]:
    if stage not in REQUIRED:
        raise ValidationError(f"Invalid stage '{stage}'. Use one of {sorted(REQUIRED)}.")
    return REQUIRED[stage]


def check_required_columns(df: DataFrame, stage: str) -> None:
    """Metadata only; no job."""
    missing = [c for c in required_columns(stage) if c not in df.columns]
    if missing:
        raise ValidationError(f"[{stage}] missing required columns: {missing}")


def _as_number(df: DataFrame, name: str, prefix: str = "") -> Column:
    """The column as a number; NaN, as a value or as text, is null."""
    kind, value = df.schema[name].dataType, F.col(prefix + name)
    if isinstance(kind, T.NumericType) and not isinstance(kind, (T.DoubleType, T.FloatType)):
        return value
    number = value if isinstance(kind, T.NumericType) else value.try_cast("double")
    return F.nanvl(number, F.lit(None))


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Text in the numeric columns becomes a number, or null where it is none."""
    text = [c for c in NUMERIC_COLUMNS if c in df.columns and not isinstance(df.schema[c].dataType, T.NumericType)]
    return df.withColumns({c: _as_number(df, c) for c in text}) if text else df


def measures(df: DataFrame, stage: str = "raw", prefix: str = "") -> dict[str, Column]:
    """Named aggregates that all the checks of a stage read; merge them into any other agg.

    ``prefix`` addresses the columns of ``df`` where they are nested, e.g. ``"text."``.
    """
    found: dict[str, Column] = {"rows": F.count(F.lit(1))}
    for name in required_columns(stage):
        if name in df.columns:
            numeric = stage == "raw" and name in NUMERIC_COLUMNS
            found[f"present_{name}"] = F.count(_as_number(df, name, prefix) if numeric else F.col(prefix + name))
    if stage == "raw":
        for name in NUMERIC_COLUMNS:
            if name in df.columns:
                given = F.col(prefix + name)
                lost = given.isNotNull() & (F.lower(given.cast("string")) != "nan") & _as_number(df, name, prefix).isNull()
                found[f"coerced_{name}"] = F.count_if(lost)
        for name, (low, high) in VALUE_RANGES.items():
            if name in df.columns:
                value = _as_number(df, name, prefix)
                found[f"outside_{name}"] = F.count_if((value < low) | (value > high))
    return found


def measured(df: DataFrame, stage: str = "raw") -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in measures(df, stage).items()])


def verdict(seen: dict[str, int], stage: str) -> None:
    """Raise on the first broken rule of an evaluated set of ``measures``; warn on weak ones."""
    if seen["rows"] == 0:
        raise ValidationError(f"[{stage}] no rows to process")
    if seen["rows"] < FEW_ROWS:
        logger.warning("[%s] very few rows (%d)", stage, seen["rows"])
    if stage == "raw":
        critical = []
        for name in VALUE_RANGES:
            outside, checked = seen[f"outside_{name}"], seen[f"present_{name}"]
            if outside:
                logger.warning("'%s': %d values (%.1f%%) out of range", name, outside, 100 * outside / checked)
            if checked and outside / checked > CRITICAL_SHARE:
                critical.append(name)
        if critical:
            raise ValidationError(f"[{stage}] more than {CRITICAL_SHARE:.0%} of values out of range in: {critical}")
    empty = [c for c in required_columns(stage) if seen[f"present_{c}"] == 0]
    if empty:
        raise ValidationError(f"[{stage}] entirely null columns: {empty}")


def validate_schema(df: DataFrame, stage: str = "raw") -> DataFrame:
    """Return ``df`` (numeric text coerced at the raw stage) or raise ``ValidationError``."""
    check_required_columns(df, stage)
    verdict(measured(df, stage).first().asDict(), stage)
    return coerce_numeric(df) if stage == "raw" else df


def required_report(df: DataFrame, stage: str = "raw") -> DataFrame:
    """column_name, present, non_null for each required column."""
    absent = F.lit(0).cast("long")
    return rows_from(measured(df, stage), [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(name in df.columns).alias("present"),
            (F.col(f"present_{name}") if name in df.columns else absent).alias("non_null"),
        )
        for name in required_columns(stage)
    ])


def row_count_report(df: DataFrame) -> DataFrame:
    rows = F.col("rows")
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", (rows > 0).alias("nonempty"), (rows < FEW_ROWS).alias("few_rows")
    )


def coercion_report(df: DataFrame) -> DataFrame:
    """column_name, kept, coerced_nulls for each numeric column."""
    return rows_from(measured(df), [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"present_{name}").alias("kept"),
            F.col(f"coerced_{name}").alias("coerced_nulls"),
        )
        for name in NUMERIC_COLUMNS
    ])


def range_report(df: DataFrame) -> DataFrame:
    """column_name, low, high, checked, outside, share, critical for each ranged column."""
    def line(name: str, low: float, high: float) -> Column:
        checked, outside = F.col(f"present_{name}"), F.col(f"outside_{name}")
        share = F.coalesce(F.try_divide(outside, checked), F.lit(0.0))
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(low).alias("low"),
            F.lit(high).alias("high"),
            checked.alias("checked"),
            outside.alias("outside"),
            share.alias("share"),
            (share > CRITICAL_SHARE).alias("critical"),
        )

    return rows_from(measured(df), [line(n, low, high) for n, (low, high) in VALUE_RANGES.items()])


def fully_null_report(df: DataFrame, stage: str = "raw") -> DataFrame:
    """column_name and whether no value is left, per required column."""
    return rows_from(measured(df, stage), [
        F.struct(F.lit(n).alias("column_name"), (F.col(f"present_{n}") == 0).alias("fully_null"))
        for n in required_columns(stage)
    ])
