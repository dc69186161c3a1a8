"""Data-quality suite: twelve expectations read from one aggregation.

Each expectation names the aggregates it needs and turns them into a verdict, so any subset
runs as a single ``agg``. The duplicate check alone needs a shuffle, on a hash of its two keys, and
adds its row by union.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.expressions import percent_text, rows_from
from tidegauge.functions.selection import exact_quantiles

# Names, limits and columns of the suite.
SUITE_COLUMNS = ["user_id", "feature_name", "latency_ms", "crash_flag", "feedback_score", "timestamp"]
NULL_RATE_COLUMNS = ["latency_ms", "crash_flag", "feedback_score"]
MAX_NULL_RATE = 0.05
MIN_ROWS = 50
MAX_LATENCY = 10_000
SPIKE_LATENCY = 5_000
GATE_NULL_RATE = 0.2
DUPLICATES = "expect_no_duplicate_events"
SPIKES = "expect_no_extreme_latency_spikes"


class QualityGateError(ValueError):
    """A gate that stops the run was breached."""


@dataclass(frozen=True)
class Expectation:
    name: str
    measures: dict[str, Column]
    passed: Column
    detail: Column


def _columns_exist(df: DataFrame) -> Expectation:
    missing = [c for c in SUITE_COLUMNS if c not in df.columns]
    detail = f"Missing columns: {missing}" if missing else "All required columns present"
    return Expectation("expect_columns_to_exist", {}, F.lit(not missing), F.lit(detail))


def _no_duplicates() -> Expectation:
    count = F.col("dq_duplicates")
    return Expectation(
        "expect_no_duplicate_events", {}, count == 0,
        F.format_string("Found %d duplicate (user_id, timestamp) pairs", count),
    )


def _null_rate(name: str) -> Expectation:
    rate = F.col(f"dq_null_{name}")
    return Expectation(
        f"expect_column_null_rate_below_threshold_{name}",
        {f"dq_null_{name}": F.avg(F.col(name).isNull().cast("int"))},
        rate <= MAX_NULL_RATE,
        F.concat(F.lit(f"{name} null rate: "), percent_text(rate), F.lit(f" (threshold: {MAX_NULL_RATE:.0%})")),
    )


def _latency_range() -> Expectation:
    low, high = F.col("dq_latency_min"), F.col("dq_latency_max")
    return Expectation(
        "expect_latency_in_valid_range",
        {"dq_latency_min": F.min("latency_ms"), "dq_latency_max": F.max("latency_ms")},
        (low >= 0) & (high <= MAX_LATENCY),
        F.format_string("Latency range: [%.1f, %.1f] ms. Expected: [0, 10000]", low.cast("double"), high.cast("double")),
    )


def _crash_binary() -> Expectation:
    other = F.col("dq_crash_other")
    return Expectation(
        "expect_crash_flag_is_binary",
        {"dq_crash_other": F.count_if(~F.col("crash_flag").isin(0, 1))},
        other == 0,
        F.format_string("crash_flag values outside {0, 1}: %d", other),
    )


def _feedback_range() -> Expectation:
    outside = F.col("dq_feedback_outside")
    score = F.col("feedback_score")
    return Expectation(
        "expect_feedback_score_between_1_and_5",
        {"dq_feedback_outside": F.count_if((score < 1) | (score > 5))},
        outside == 0,
        F.format_string("Records with feedback_score outside [1,5]: %d", outside),
    )


def _min_rows() -> Expectation:
    return Expectation(
        "expect_minimum_row_count",
        {"dq_rows": F.count(F.lit(1))},
        F.col("dq_rows") >= MIN_ROWS,
        F.format_string(f"Row count: %d. Minimum required: {MIN_ROWS}", F.col("dq_rows")),
    )


def _feature_name() -> Expectation:
    nulls, blanks = F.col("dq_name_nulls"), F.col("dq_name_blanks")
    name = F.col("feature_name")
    return Expectation(
        "expect_feature_name_not_null_or_empty",
        {"dq_name_nulls": F.count_if(name.isNull()), "dq_name_blanks": F.count_if(name.rlike(r"(?U)^\s*$"))},
        (nulls == 0) & (blanks == 0),
        F.format_string("Null feature names: %d, Empty: %d", nulls, blanks),
    )


def _timestamp_parseable(df: DataFrame) -> Expectation:
    value = F.col("timestamp")
    bad = F.col("dq_bad_timestamps")
    text = isinstance(df.schema["timestamp"].dataType, T.StringType)
    broken = value.isNotNull() & F.try_to_timestamp(value).isNull() if text else F.lit(False)
    return Expectation(
        "expect_timestamp_parseable",
        {"dq_bad_timestamps": F.count_if(broken)},
        bad == 0,
        F.when(bad == 0, "All timestamps parsed successfully")
        .otherwise(F.format_string("Timestamps that do not parse: %d", bad)),
    )


def _no_spikes(p99: float | None) -> Expectation:
    spikes = F.col("dq_spikes")
    shown = F.lit(float("nan") if p99 is None else p99)
    return Expectation(
        "expect_no_extreme_latency_spikes",
        {"dq_spikes": F.count_if(F.col("latency_ms") > SPIKE_LATENCY)},
        spikes == 0,
        F.format_string("Events with latency > 5000ms: %d. P99 latency: %.1fms", spikes, shown),
    )


def suite_names(columns: Sequence[str]) -> list[str]:
    """Expectations that apply to a table with these columns, in report order."""
    names = ["expect_columns_to_exist"]
    if {"user_id", "timestamp"} <= set(columns):
        names.append("expect_no_duplicate_events")
    names += [f"expect_column_null_rate_below_threshold_{c}" for c in NULL_RATE_COLUMNS if c in columns]
    per_column = [
        ("latency_ms", "expect_latency_in_valid_range"),
        ("crash_flag", "expect_crash_flag_is_binary"),
        ("feedback_score", "expect_feedback_score_between_1_and_5"),
        (None, "expect_minimum_row_count"),
        ("feature_name", "expect_feature_name_not_null_or_empty"),
        ("timestamp", "expect_timestamp_parseable"),
        ("latency_ms", "expect_no_extreme_latency_spikes"),
    ]
    return names + [name for column, name in per_column if column is None or column in columns]


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each (user_id, timestamp); nulls count as equal keys.

    Keys are nearly unique, so both texts of every event would be shuffled. Instead a 64-bit hash of
    the pair is counted first, and the keys themselves only of rows whose hash occurs twice or more.
    """
    keys = ["user_id", "timestamp"]
    hashed = F.xxhash64(*keys)
    repeated = df.select(hashed.alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
    suspects = df.select(*keys, hashed.alias("pair")).join(repeated.select("pair"), "pair", "left_semi")
    pairs = suspects.groupBy(*keys).count()
    return pairs.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dq_duplicates"))


def expectations(
    df: DataFrame,
    names: Sequence[str] | None = None,
    p99: float | None = None,
) -> list[tuple[int, Expectation]]:
    """The applicable expectations with their place in the report; ``names`` picks a subset."""
    builders = {
        "expect_columns_to_exist": lambda: _columns_exist(df),
        "expect_no_duplicate_events": _no_duplicates,
        **{
            f"expect_column_null_rate_below_threshold_{c}": (lambda c=c: _null_rate(c))
            for c in NULL_RATE_COLUMNS
        },
        "expect_latency_in_valid_range": _latency_range,
        "expect_crash_flag_is_binary": _crash_binary,
        "expect_feedback_score_between_1_and_5": _feedback_range,
        "expect_minimum_row_count": _min_rows,
        "expect_feature_name_not_null_or_empty": _feature_name,
        "expect_timestamp_parseable": lambda: _timestamp_parseable(df),
        "expect_no_extreme_latency_spikes": lambda: _no_spikes(p99),
    }
    order = suite_names(df.columns)
    return [(i, builders[n]()) for i, n in enumerate(order, 1) if names is None or n in names]


def suite_measures(chosen: Sequence[tuple[int, Expectation]]) -> dict[str, Column]:
    """The aggregates behind the expectations; merge them into any other agg on the table."""
    aggregates: dict[str, Column] = {"dq_rows": F.count(F.lit(1))}
    for _, expectation in chosen:
        aggregates.update(expectation.measures)
    return aggregates


def suite_rows(chosen: Sequence[tuple[int, Expectation]], seen: DataFrame, duplicates: DataFrame) -> DataFrame:
    """position, expectation, passed, detail from measured one-row frames."""
    def line(position: int, e: Expectation) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(e.name).alias("expectation"),
            F.coalesce(e.passed, F.lit(False)).alias("passed"),
            e.detail.alias("detail"),
        )

    pairs = [line(i, e) for i, e in chosen if e.name == DUPLICATES]
    others = [line(i, e) for i, e in chosen if e.name != DUPLICATES]
    parts = ([rows_from(seen, others)] if others else []) + ([rows_from(duplicates, pairs)] if pairs else [])
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def run_suite(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """position, expectation, passed, detail; ``names`` picks a subset."""
    applicable = [n for n in suite_names(df.columns) if names is None or n in names]
    p99 = exact_quantiles(df, {"latency_ms": [0.99]})["latency_ms"][0] if SPIKES in applicable else None
    chosen = expectations(df, names, p99)
    seen = df.agg(*[c.alias(n) for n, c in suite_measures(chosen).items()])
    return suite_rows(chosen, seen, duplicate_count(df) if DUPLICATES in applicable else seen)


def dq_report(results: DataFrame) -> DataFrame:
    """One row: totals, score, the failures and all results as arrays of structs."""
    line = F.struct("position", "expectation", "passed", "detail")
    total, good = F.count(F.lit(1)), F.count_if("passed")
    return results.agg(
        total.alias("total_checks"),
        good.alias("passed"),
        (total - good).alias("failed"),
        F.round(good / total * 100, 1).alias("score_pct"),
        (total == good).alias("overall_passed"),
        F.sort_array(F.collect_list(F.when(~F.col("passed"), line))).alias("failures"),
        F.sort_array(F.collect_list(line)).alias("results"),
    )


def null_rates(df: DataFrame, threshold: float = GATE_NULL_RATE) -> DataFrame:
    """column_name, null_rate, breached for every column of the table."""
    names = df.columns
    seen = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(f"n{i}") for i, c in enumerate(names)])
    return rows_from(seen, [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("null_rate"),
            F.coalesce(F.col(f"n{i}") > threshold, F.lit(False)).alias("breached"),
        )
        for i, c in enumerate(names)
    ])


def null_rate_gate(df: DataFrame, threshold: float = GATE_NULL_RATE) -> None:
    """Raise when any column has a null share strictly above the threshold."""
    bad = [r.column_name for r in null_rates(df, threshold).filter("breached").collect()]
    if bad:
        raise QualityGateError(f"null rate above {threshold} in columns: {bad}")


def latency_outliers(df: DataFrame, limit: float = SPIKE_LATENCY) -> DataFrame:
    """max_latency and whether it lies strictly above the limit."""
    top = F.max("latency_ms")
    return df.agg(top.alias("max_latency"), F.coalesce(top > limit, F.lit(False)).alias("breached"))


def latency_outlier_gate(df: DataFrame, limit: float = SPIKE_LATENCY) -> None:
    if latency_outliers(df, limit).first().breached:
        raise QualityGateError(f"latency above {limit} ms")


def data_profile(df: DataFrame) -> DataFrame:
    """Row count, columns, and latency range and mean where the column exists."""
    figures = [F.count(F.lit(1)).alias("row_count")]
    if "latency_ms" in df.columns:
        figures += [
            F.min("latency_ms").alias("latency_min"),
            F.max("latency_ms").alias("latency_max"),
            F.avg("latency_ms").alias("latency_mean"),
        ]
    return df.agg(*figures).withColumns({
        "column_count": F.lit(len(df.columns)),
        "columns": F.array(*[F.lit(c) for c in df.columns]),
    })
