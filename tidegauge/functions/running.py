"""Running totals over an ordered column without a one-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.selection import SKETCH_GROUPS

MOST_SLICES = 512  # split points travel through the driver and become literals


def running_totals(
    df: DataFrame,
    order: str,
    totals: Sequence[str],
    by: str,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``run_<total>``: the inclusive sum of each total in ``order`` within ``by``.

    ``df`` has one row per (by, order) and is read three times, so pass a written table. ``by``
    must have few values (metrics, folds); rows where it is null form a group of their own. The
    order column is cut at sketched split points, each slice is summed in its own task, and the
    slice sums (few rows, at most values of ``by`` times ``buckets``) are broadcast back as
    offsets. Split points are taken once and become literals, so a re-run task slices the same
    way. Their sketches are merged in a few groups of tasks; where the groups disagree the middle
    is taken, which only moves the cuts.
    """
    spark = df.sparkSession
    buckets = buckets or min(MOST_SLICES, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    points = [i / buckets for i in range(1, buckets)]
    sketches = df.groupBy(by, (F.spark_partition_id() % SKETCH_GROUPS).alias("_group")).agg(
        F.percentile_approx(order, points, 10 * buckets).alias("at")
    )
    proposed: dict[Any, list[list[Any]]] = {}
    for key, _, at in sketches.collect():
        if at is not None:
            proposed.setdefault(key, []).append(at)
    splits = [(key, [sorted(cut)[len(cut) // 2] for cut in zip(*found)]) for key, found in proposed.items()]

    sliced = df.withColumn("_slice", _slice_of(F.col(by), F.col(order), splits))
    before = Window.partitionBy(by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy(by, "_slice").agg(*[F.sum(t).alias(t) for t in totals]).select(
        by, "_slice", *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"_before_{t}") for t in totals]
    )
    upto = Window.partitionBy(by, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    offsets = offsets.withColumnsRenamed({by: "_by", "_slice": "_at"})
    same = F.col(by).eqNullSafe(F.col("_by")) & (F.col("_slice") == F.col("_at"))
    return sliced.join(F.broadcast(offsets), same).select(
        *df.columns,
        *[(F.sum(t).over(upto) + F.col(f"_before_{t}")).alias(f"run_{t}") for t in totals],
    )


def _slice_of(group: Column, value: Column, splits: Sequence) -> Column:
    """Number of split points below the value, looked up in two steps of about sqrt(splits) each."""
    def below(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda cut: cut < value))

    chosen = F.lit(0)
    for key, at in splits:
        cuts = sorted(set(at))
        width = math.isqrt(len(cuts)) + 1
        chunks = [cuts[i:i + width] for i in range(0, len(cuts), width)]
        full = below(F.array(*[F.lit(chunk[-1]) for chunk in chunks]))
        rest = F.array(*[F.array(*[F.lit(x) for x in chunk]) for chunk in chunks])
        partly = F.coalesce(below(F.get(rest, full)), F.lit(0))
        # Past the last chunk there is nothing left to look up.
        place = F.when(full < len(chunks), full * width + partly).otherwise(len(cuts))
        chosen = F.when(group.eqNullSafe(F.lit(key)), place).otherwise(chosen)
    return chosen
