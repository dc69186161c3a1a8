"""Risk labels and the data side of model training: cleaning, scaling, splits, weights."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.expressions import finite_or_zero, flag
from tidegauge.functions.selection import exact_quantiles, first_shares, group_counts
from tidegauge.schema import RISK_FEATURES

logger = logging.getLogger(__name__)


# Forest settings, split, and the label rule.
@dataclass(frozen=True)
class RiskConfig:
    label: str = "is_high_risk"
    features: tuple[str, ...] = field(default_factory=lambda: tuple(RISK_FEATURES))
    test_share: float = 0.2
    seed: int = 42
    trees: int = 300
    depth: int = 8
    min_leaf: int = 2
    folds: int = 5
    fold_min_rows: int = 50
    min_rows: int = 20


# column, quantile, +1 when high values are bad and -1 when low ones are
BREACHES = [
    ("crash_rate", 0.75, 1),
    ("avg_latency", 0.75, 1),
    ("avg_feedback", 0.25, -1),
    ("avg_error_count", 0.75, 1),
]
BREACHES_FOR_HIGH_RISK = 2
WEAK_POSITIVE_SHARE = (0.02, 0.40)


def risk_thresholds(days: DataFrame) -> dict[str, float | None]:
    quantiles = exact_quantiles(days, {name: [share] for name, share, _ in BREACHES})
    return {name: values[0] for name, values in quantiles.items()}


def breach_count(thresholds: dict[str, float | None]) -> Column:
    total = F.lit(0)
    for name, _, direction in BREACHES:
        limit = F.lit(thresholds[name]).cast("double")
        breach = F.col(name) >= limit if direction > 0 else F.col(name) <= limit
        total = total + flag(breach)
    return total


def risk_target(
    days: DataFrame,
    config: RiskConfig = RiskConfig(),
    thresholds: dict[str, float | None] | None = None,
) -> DataFrame:
    """Add the label: 1 where a feature-day breaches at least two of four quantile limits."""
    missing = [c for c in config.features if c not in days.columns]
    if missing:
        raise ValueError(f"risk_target: missing columns {missing}")
    thresholds = thresholds or risk_thresholds(days)
    return days.withColumn(config.label, flag(breach_count(thresholds) >= BREACHES_FOR_HIGH_RISK))


def warn_on_weak_label(positive_share: float) -> None:
    low, high = WEAK_POSITIVE_SHARE
    if not low <= positive_share <= high:
        logger.warning("risk label is weak: %.1f%% positive", 100 * positive_share)


def clean_features(df: DataFrame, columns: tuple[str, ...] = tuple(RISK_FEATURES)) -> DataFrame:
    """Infinite, NaN and null feature values become 0."""
    return df.withColumns({c: finite_or_zero(F.col(c)) for c in columns if c in df.columns})


def robust_scaling(df: DataFrame, columns: tuple[str, ...] = tuple(RISK_FEATURES)) -> dict[str, tuple[float, float]]:
    """Median and interquartile range per column; a range of 0 counts as 1."""
    return robust_scalings(df, {"all": F.lit(True)}, columns)["all"]


def robust_scalings(
    df: DataFrame, parts: Mapping[str, Column], columns: tuple[str, ...] = tuple(RISK_FEATURES)
) -> dict[str, dict[str, tuple[float, float]]]:
    """``robust_scaling`` of several parts of the rows, each given by a condition, in one rank search."""
    values = {(part, c): F.when(rows, F.col(c)) for part, rows in parts.items() for c in columns}
    found = exact_quantiles(df, {name: [0.25, 0.5, 0.75] for name in values}, values)
    scalings: dict[str, dict[str, tuple[float, float]]] = {part: {} for part in parts}
    for (part, name), (lower, median, upper) in found.items():
        spread = (upper or 0.0) - (lower or 0.0)
        scalings[part][name] = (median or 0.0, spread if spread else 1.0)
    return scalings


def robust_scale(df: DataFrame, scaling: dict[str, tuple[float, float]]) -> DataFrame:
    """Add ``scaled_<column>`` = (value - median) / range."""
    return df.withColumns({
        f"scaled_{name}": (F.col(name) - F.lit(median)) / F.lit(spread)
        for name, (median, spread) in scaling.items()
    })


def row_order(seed: int, *keys: str) -> Column:
    """A reproducible pseudo-random order for rows identified by ``keys``."""
    return F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))


def stratified_split(df: DataFrame, label: str, order: Column, test_share: float = 0.2) -> DataFrame:
    """Add ``is_test``: in each class the first round(share * rows) rows of ``order``.

    A class of a single row is not stratified; then the whole table is split as one.
    ``order`` must tell rows apart.
    """
    counts = group_counts(df, label)
    if min(counts.values(), default=0) >= 2:
        cuts = first_shares(df, label, order, [test_share], counts)
    else:
        whole = first_shares(df.withColumn("_all", F.lit(1)), "_all", order, [test_share])
        cuts = {None: whole.get(1, [None])}
    is_test = F.lit(False)
    for value, (cut,) in cuts.items():
        if cut is not None:
            member = F.lit(True) if value is None else F.col(label) == F.lit(value)
            is_test = is_test | (member & (order <= F.lit(cut)))
    return df.withColumn("is_test", F.coalesce(is_test, F.lit(False)))


def stratified_folds(df: DataFrame, label: str, order: Column, folds: int) -> DataFrame:
    """Add ``fold`` 0..folds-1: per class, consecutive equal ranges of ``order``."""
    cuts = first_shares(df, label, order, [i / folds for i in range(1, folds)])
    fold = F.lit(0)
    for value, ends in cuts.items():
        place = sum((flag(order > F.lit(end)) for end in ends if end is not None), F.lit(0))
        fold = F.when(F.col(label) == F.lit(value), place).otherwise(fold)
    return df.withColumn("fold", fold)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """label, rows, weight = rows of all classes / (classes * rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    classes = Window.partitionBy(F.lit(1))  # over one row per class
    weight = F.sum("rows").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("rows"))
    return counts.select(label, "rows", weight.alias("weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """Attach each row's class weight. The weights are one number per class, kept as literals."""
    weight = F.lit(None).cast("double")
    for value, _, found in class_weights(df, label).collect():
        weight = F.when(F.col(label) == F.lit(value), F.lit(found)).otherwise(weight)
    return df.withColumn(name, weight)
