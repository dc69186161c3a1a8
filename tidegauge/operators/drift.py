"""Drift between a baseline and current events: percent change, PSI and Kolmogorov-Smirnov."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.expressions import null_if_nan, percent_text, psi_severity, rows_from
from tidegauge.functions.kolmogorov import two_sample_p
from tidegauge.functions.running import running_totals
from tidegauge.session import materialize

# Monitored metrics, limits, bin count and smoothing.
METRICS = ["latency_ms", "crash_flag", "feedback_score", "error_count"]
MEANS = {
    "latency_ms_mean": "latency_ms",
    "crash_flag_rate": "crash_flag",
    "feedback_score_mean": "feedback_score",
    "error_count_mean": "error_count",
}
CHANGE_LIMIT = 0.20
PSI_BINS = 10
PSI_EPSILON = 1e-6
KS_MIN_ROWS = 5
KS_P_LIMIT = 0.05


def current_means(df: DataFrame) -> DataFrame:
    """One row with the monitored means; a column the table lacks counts as 0."""
    return df.agg(*[
        (F.avg(column) if column in df.columns else F.max(F.lit(0.0))).alias(name)
        for name, column in MEANS.items()
    ])


def baseline_values(baseline: DataFrame) -> dict[str, float]:
    """The saved means as numbers; a missing or null one counts as 0."""
    row = baseline.first()
    known = row.asDict() if row else {}
    return {name: float(known.get(name) or 0.0) for name in MEANS}


def drift_pct_change(means: DataFrame, baseline: DataFrame, threshold: float = CHANGE_LIMIT) -> DataFrame:
    """position, metric, baseline, current, pct_change, alert; both inputs are one-row frames."""
    known = baseline_values(baseline)

    def line(position: int, name: str) -> Column:
        base, now = F.lit(known[name]), F.col(name)
        change = (now - base) / base if known[name] else F.lit(0.0)
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("metric"),
            base.alias("baseline"),
            now.alias("current"),
            change.alias("pct_change"),
            F.coalesce(F.abs(change) >= threshold, F.lit(False)).alias("alert"),
        )

    return rows_from(means, [line(i, n) for i, n in enumerate(MEANS, 1)])


def _wide(baseline: DataFrame, current: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """side (0 baseline, 1 current) and the metrics as doubles, NaN as null."""
    def tagged(df: DataFrame, side: int) -> DataFrame:
        return df.select(F.lit(side).alias("side"), *[null_if_nan(F.col(m).cast("double")).alias(m) for m in metrics])

    return tagged(baseline, 0).unionAll(tagged(current, 1))


def _long(wide: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """side, metric, value without nulls."""
    return wide.unpivot("side", list(metrics), "metric", "value").filter(F.col("value").isNotNull())


def counted_values(df: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """metric, value, n: how often each value of a metric occurs; a metric the table lacks has no rows.

    All that PSI and KS need of a table. Values are counted in each task first, so a hot value is one
    row per task in the shuffle.
    """
    kept = [m for m in metrics if m in df.columns]
    values = df.select([null_if_nan(F.col(m).cast("double")).alias(m) for m in kept]).unpivot([], kept, "metric", "value")
    return values.filter(F.col("value").isNotNull()).groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"))


def merged_counts(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """metric, value, base, now of two tables of counted values."""
    none = F.lit(0).cast("long")
    both = baseline.select("metric", "value", F.col("n").alias("base"), none.alias("now")).unionAll(
        current.select("metric", "value", none.alias("base"), F.col("n").alias("now"))
    )
    return both.groupBy("metric", "value").agg(F.sum("base").alias("base"), F.sum("now").alias("now"))


def _shared(baseline: DataFrame, current: DataFrame, metrics: Sequence[str]) -> list[str]:
    return [m for m in metrics if m in baseline.columns and m in current.columns]


def psi_edges(bounds: dict[str, tuple[float, float]], bins: int = PSI_BINS) -> dict[str, list[float]]:
    """Inner bin edges per metric, ``low + i * ((high - low) / bins)``; none for a constant."""
    return {
        metric: [low + i * ((high - low) / bins) for i in range(1, bins)] if high > low else []
        for metric, (low, high) in bounds.items()
    }


def drift_psi(
    baseline: DataFrame,
    current: DataFrame,
    metrics: Sequence[str] = METRICS,
    bins: int = PSI_BINS,
) -> DataFrame:
    """metric, psi, severity. Equal-width bins over the joint range, the last one closed.

    Two passes: the joint range (a few numbers, kept as literals), then counts per bin, which
    are partially summed in each task. Empty bins enter through the full bin grid.
    """
    kept = _shared(baseline, current, metrics)
    wide = _wide(baseline, current, kept)
    ranges = wide.agg(*[F.array(F.min(m), F.max(m)).alias(m) for m in kept]).first()
    edges = psi_edges({m: tuple(ranges[m]) for m in kept if ranges[m][0] is not None}, bins)

    def place(metric: str) -> Column:
        inner = sum(((F.col(metric) >= F.lit(cut)).cast("int") for cut in edges.get(metric, [])), F.lit(0))
        return F.when(F.col(metric).isNotNull(), inner).alias(metric)

    # Binned while wide, so that the unpivoted rows carry small integers only.
    binned = wide.select("side", *[place(m) for m in kept]).unpivot("side", kept, "metric", "bin")
    counts = binned.filter(F.col("bin").isNotNull()).groupBy("metric", "bin").agg(
        F.count_if(F.col("side") == 0).alias("base"), F.count_if(F.col("side") == 1).alias("now")
    )

    return _psi_scores(counts, kept, edges, bins)


def psi_of_counts(counts: DataFrame, metrics: Sequence[str] = METRICS, bins: int = PSI_BINS) -> DataFrame:
    """The same from merged counts, which are read twice, so pass a written table."""
    ends = counts.groupBy("metric").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    edges = psi_edges({r.metric: (r.low, r.high) for r in ends.filter(F.col("metric").isin(list(metrics))).collect()}, bins)
    place = F.lit(0)
    for metric, cuts in edges.items():
        inner = sum(((F.col("value") >= F.lit(cut)).cast("int") for cut in cuts), F.lit(0))
        place = F.when(F.col("metric") == metric, inner).otherwise(place)
    binned = counts.groupBy("metric", place.alias("bin")).agg(F.sum("base").alias("base"), F.sum("now").alias("now"))
    return _psi_scores(binned, metrics, edges, bins)


def _psi_scores(counts: DataFrame, kept: Sequence[str], edges: Mapping[str, Sequence[float]], bins: int) -> DataFrame:
    grid = counts.sparkSession.createDataFrame(
        [(i, m, b, bool(edges.get(m))) for i, m in enumerate(kept, 1) for b in range(bins)],
        "position int, metric string, bin int, varies boolean",
    )
    full = grid.join(F.broadcast(counts), ["metric", "bin"], "left").fillna(0, ["base", "now"])

    def smoothed(count: str, total: str) -> Column:
        return (F.col(count) + PSI_EPSILON) / (F.col(total) + PSI_EPSILON * bins)

    bins_of_metric = Window.partitionBy("metric")
    shares = full.withColumns({
        "base_rows": F.sum("base").over(bins_of_metric), "now_rows": F.sum("now").over(bins_of_metric)
    }).withColumns({"p_base": smoothed("base", "base_rows"), "p_now": smoothed("now", "now_rows")})
    term = (F.col("p_now") - F.col("p_base")) * F.log(F.col("p_now") / F.col("p_base"))
    usable = F.col("varies") & (F.col("base_rows") > 0) & (F.col("now_rows") > 0)
    scored = shares.groupBy("position", "metric").agg(
        F.round(F.sum(F.when(usable, term).otherwise(0.0)), 6).alias("psi")
    )
    return scored.withColumn("severity", psi_severity(F.col("psi")))


def drift_ks(
    baseline: DataFrame,
    current: DataFrame,
    metrics: Sequence[str] = METRICS,
    buckets: int | None = None,
) -> DataFrame:
    """position, metric, ks_statistic, p_value, drift_detected, note.

    Equal values are counted first (a hot value is one row per task before the shuffle), then
    both empirical distributions are running totals over the distinct values.
    """
    kept = _shared(baseline, current, metrics)
    counted = _long(_wide(baseline, current, kept), kept).groupBy("metric", "value").agg(
        F.count_if(F.col("side") == 0).alias("base"), F.count_if(F.col("side") == 1).alias("now")
    )
    return ks_of_counts(materialize(counted, "ks-values"), kept, buckets)


def ks_of_counts(counts: DataFrame, metrics: Sequence[str] = METRICS, buckets: int | None = None) -> DataFrame:
    """The same from merged counts, which are read four times, so pass a written table.

    The widest gap and the two sizes, three numbers per metric, come to the driver, where p is
    counted exactly for samples of up to 10,000 rows and to seven digits beyond.
    """
    running = running_totals(counts, "value", ["base", "now"], by="metric", buckets=buckets)
    sizes = counts.groupBy("metric").agg(F.sum("base").alias("base_rows"), F.sum("now").alias("now_rows"))
    gap = F.abs(F.col("run_base") / F.col("base_rows") - F.col("run_now") / F.col("now_rows"))
    enough = F.least("base_rows", "now_rows") >= KS_MIN_ROWS
    widest = running.join(F.broadcast(sizes.filter(enough)), "metric").groupBy("metric").agg(
        F.max(gap).alias("gap"), F.first("base_rows").alias("base_rows"), F.first("now_rows").alias("now_rows")
    )
    found = {row.metric: row for row in widest.filter(F.col("metric").isin(list(metrics))).collect()}
    lines = []
    for position, metric in enumerate(metrics, 1):
        if metric in found:
            seen = found[metric]
            p = two_sample_p(seen.gap, seen.base_rows, seen.now_rows)
            lines.append((position, metric, round(seen.gap, 6), round(p, 6), p < KS_P_LIMIT, None))
        else:  # too few rows, or none
            lines.append((position, metric, 0.0, 1.0, False, f"Insufficient data for KS test (need >= {KS_MIN_ROWS} samples)"))
    return SparkSession.active().createDataFrame(
        lines, "position int, metric string, ks_statistic double, p_value double, drift_detected boolean, note string"
    )


def _report_lines(df: DataFrame, method: int, alerting: Column, text: Column, *fields: str) -> DataFrame:
    """method, position, metric, alert (null when there is none), and the figures as ``m<method>``."""
    return df.select(
        F.lit(method).alias("method"), "position", "metric",
        F.when(alerting, text).alias("alert"),
        F.struct(*fields).alias(f"m{method}"),
    )


def drift_report(
    changes: DataFrame,
    psi: DataFrame | None = None,
    ks: DataFrame | None = None,
    threshold: float = CHANGE_LIMIT,
) -> DataFrame:
    """One row: alerts in the order change, PSI, KS, their count, and per-metric maps."""
    metric = F.col("metric")
    moved = F.concat(
        metric, F.lit(" drifted by "), percent_text(F.col("pct_change")), F.lit(f" (threshold {threshold:.0%})")
    )
    maps = {1: "drift"}
    lines = _report_lines(changes, 1, F.col("alert"), moved, "baseline", "current", "pct_change")
    if psi is not None:
        high = F.format_string("PSI ALERT: %s PSI=%.4f > 0.2 (HIGH drift)", metric, F.col("psi"))
        mild = F.format_string("PSI WARNING: %s PSI=%.4f — moderate drift, monitor closely", metric, F.col("psi"))
        text = F.when(F.col("severity") == "HIGH", high).otherwise(mild)
        more = _report_lines(psi, 2, F.col("severity") != "LOW", text, "psi", "severity")
        lines, maps[2] = lines.unionByName(more, allowMissingColumns=True), "psi_scores"
    if ks is not None:
        text = F.format_string(
            "KS ALERT: %s — KS=%.4f, p=%.4f →  Drift detected (p < 0.05)",
            metric, F.col("ks_statistic"), F.col("p_value"),
        )
        fields = ("ks_statistic", "p_value", "drift_detected", "note")
        more = _report_lines(ks, 3, F.col("drift_detected"), text, *fields)
        lines, maps[3] = lines.unionByName(more, allowMissingColumns=True), "ks_test_results"

    raised = F.sort_array(F.collect_list(
        F.when(F.col("alert").isNotNull(), F.struct("method", "position", "alert"))
    ))
    count = F.count("alert")
    per_metric = {
        name: F.map_from_entries(F.collect_list(F.when(F.col("method") == i, F.struct("metric", f"m{i}"))))
        for i, name in maps.items()
    }
    return lines.agg(
        F.transform(raised, lambda entry: entry["alert"]).alias("alerts"),
        count.alias("alert_count"),
        (count > 0).alias("overall_drift_detected"),
        *[figures.alias(name) for name, figures in per_metric.items()],
    )


def detect_data_drift(
    current: DataFrame,
    baseline: DataFrame,
    threshold: float = CHANGE_LIMIT,
    baseline_events: DataFrame | None = None,
) -> DataFrame:
    """The report on ``current`` against a one-row baseline; PSI and KS need baseline events."""
    changes = drift_pct_change(current_means(current), baseline, threshold)
    if baseline_events is None:
        return drift_report(changes, threshold=threshold)
    return distribution_report(changes, merged_counts(counted_values(baseline_events), counted_values(current)),
                               _shared(baseline_events, current, METRICS), threshold)


def distribution_report(changes: DataFrame, counts: DataFrame, metrics: Sequence[str] = METRICS,
                        threshold: float = CHANGE_LIMIT) -> DataFrame:
    """The report with PSI and KS from merged counts, which are written once and read by both."""
    counts = materialize(counts, "merged-values")
    return drift_report(changes, psi_of_counts(counts, metrics), ks_of_counts(counts, metrics), threshold)


def empty_drift_report(baseline: DataFrame) -> DataFrame:
    """What a first run reports: nothing to compare with yet."""
    return baseline.limit(1).select(
        F.array().cast("array<string>").alias("alerts"),
        F.lit(0).cast("long").alias("alert_count"),
        F.lit(False).alias("overall_drift_detected"),
    )
