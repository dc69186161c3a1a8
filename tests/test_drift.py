from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.functions import kolmogorov
from tidegauge.functions.kolmogorov import lattice_p, one_sample_p, two_sample_p
from tidegauge.operators import drift, rollup
from tidegauge.schema import BASELINE
from tidegauge.sources import reports


def metric(spark, values, name="latency_ms"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def baseline(spark, **values):
    row = {f.name: None for f in BASELINE.fields} | {"row_count": 1} | values
    return spark.createDataFrame([tuple(row[f.name] for f in BASELINE.fields)], BASELINE)


def test_large_shift_alerts(spark, events):
    current = events(*[{"latency_ms": float(v), "feedback_score": 4.2} for v in (400, 410, 420, 430, 440)])
    known = baseline(spark, latency_ms_mean=120.0, crash_flag_rate=0.02, feedback_score_mean=4.2, error_count_mean=0.1)
    report = drift.detect_data_drift(current, known).first()
    assert report.overall_drift_detected and report.alert_count == len(report.alerts) == 3
    assert report.alerts[0] == "latency_ms_mean drifted by 250.00% (threshold 20%)"
    assert report.drift["latency_ms_mean"].pct_change == pytest.approx(2.5)


@pytest.mark.parametrize("current, alert", [(120.0, True), (119.9, False), (80.0, True)])
def test_threshold_is_inclusive_both_ways(spark, events, current, alert):
    means = drift.current_means(events({"latency_ms": current}))
    line = drift.drift_pct_change(means, baseline(spark, latency_ms_mean=100.0)).first()
    assert line.alert is alert


def test_base_of_zero_or_missing_is_no_change(spark, events):
    means = drift.current_means(events({}).drop("error_count"))
    lines = drift.drift_pct_change(means, baseline(spark, latency_ms_mean=0.0)).collect()
    assert all(r.pct_change == 0.0 and not r.alert for r in lines)
    assert lines[3].current == 0.0  # a column that is not there


def psi_by_hand(base, now, bins=10):
    edges = np.linspace(min(*base, *now), max(*base, *now), bins + 1)
    share = lambda v: (np.histogram(v, bins=edges)[0] + 1e-6) / (len(v) + 1e-6 * bins)
    b, c = share(base), share(now)
    return round(float(np.sum((c - b) * np.log(c / b))), 6)


@pytest.mark.parametrize("base, now", [
    ([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10], [0, 10, 10, 10, 5, 5]),  # bin edges and the closed top
    ([1] * 50 + [2] * 50, [100] * 10 + [2] * 5),  # empty bins
    (list(range(100)), list(range(100))),
])
def test_psi_matches_a_histogram(spark, base, now):
    row = drift.drift_psi(metric(spark, base), metric(spark, now), ["latency_ms"]).first()
    assert row.psi == pytest.approx(psi_by_hand(base, now), abs=2e-6)


def test_psi_of_constant_or_empty_sides_is_zero(spark):
    both = drift.drift_psi(metric(spark, [5, 5]), metric(spark, [5]), ["latency_ms"]).first()
    empty = drift.drift_psi(metric(spark, [1, 2]), metric(spark, [None, float("nan")]), ["latency_ms"]).first()
    assert (both.psi, both.severity, empty.psi) == (0.0, "LOW", 0.0)


def test_severity_limits_are_strict(spark):
    from tidegauge.functions.expressions import psi_severity

    df = spark.createDataFrame([(0.1,), (0.11,), (0.2,), (0.21,)], "psi double")
    assert [r[0] for r in df.select(psi_severity(F.col("psi"))).collect()] == ["LOW", "MODERATE", "MODERATE", "HIGH"]


def ks_by_hand(base, now):
    grid = sorted({*base, *now})
    below = lambda v, x: sum(y <= x for y in v) / len(v)
    return max(abs(below(base, x) - below(now, x)) for x in grid)


@pytest.mark.parametrize("buckets", [2, 16])
def test_ks_statistic_with_ties(spark, buckets):
    rng = np.random.default_rng(3)
    base, now = rng.integers(0, 20, 300).tolist(), (rng.integers(0, 20, 200) + 2).tolist()
    row = drift.drift_ks(metric(spark, base), metric(spark, now), ["latency_ms"], buckets).first()
    assert row.ks_statistic == pytest.approx(ks_by_hand(base, now), abs=1e-6)
    assert row.drift_detected is (row.p_value < 0.05)


def test_ks_needs_five_rows_a_side(spark):
    row = drift.drift_ks(metric(spark, [1, 2, 3, 4]), metric(spark, range(50)), ["latency_ms"]).first()
    assert (row.ks_statistic, row.p_value, row.drift_detected) == (0.0, 1.0, False) and "Insufficient" in row.note
    none = drift.drift_ks(metric(spark, [None] * 9), metric(spark, range(50)), ["latency_ms"]).first()
    assert (none.ks_statistic, none.p_value) == (0.0, 1.0)


# The two-sample tails 90/252, 20/252 and 2/252 of five against five, and the paths of four against seven.
@pytest.mark.parametrize("gap, m, n, expected", [(0.6, 5, 5, 90 / 252), (0.8, 5, 5, 20 / 252), (1.0, 5, 5, 2 / 252), (0.0, 5, 9, 1.0)])
def test_exact_tails_of_two_samples(gap, m, n, expected):
    assert two_sample_p(gap, m, n) == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("m, n", [(4, 7), (5, 6), (3, 9)])
def test_lattice_counts_every_path(m, n):
    def share(reach):
        hits = []
        for steps in combinations(range(m + n), m):
            points = [(sum(s <= t for s in steps), t + 1) for t in range(m + n)]
            hits.append(any(abs(i * n - (t - i) * m) >= reach for i, t in points))
        return sum(hits) / len(hits)

    for reach in range(1, m * n + 1):
        assert lattice_p(reach, m, n) == pytest.approx(share(reach), abs=1e-12)
        assert lattice_p(reach, n, m) == pytest.approx(share(reach), abs=1e-12)


def test_published_one_sample_value():
    assert 1 - one_sample_p(0.274, 10) == pytest.approx(0.628479615456504, abs=1e-12)  # Marsaglia, Tsang and Wang (2003)


@pytest.mark.parametrize("z, expected", [(0.5, 0.9639), (1.0, 0.2700), (1.358, 0.0500), (1.628, 0.0100)])
def test_limit_distribution(z, expected):
    assert one_sample_p(z / 1e5, 10**10) == pytest.approx(expected, abs=1e-4)


def test_matrix_and_expansion_meet():
    for z in np.linspace(0.4, 2.5, 12):
        gap = z / math.sqrt(kolmogorov.MATRIX_ROWS)
        assert kolmogorov._matrix_cdf(gap, kolmogorov.MATRIX_ROWS) == pytest.approx(
            kolmogorov._expansion_cdf(gap, kolmogorov.MATRIX_ROWS), abs=1e-7)


def test_far_gaps_are_certain():
    assert two_sample_p(0.5, 5000, 5000) == 0.0 and type(two_sample_p(0.001, 20000, 30000)) is float
    at = math.sqrt(kolmogorov.CERTAIN / 2 / 50)  # just under the limit the exact tail has six zeros already
    assert lattice_p(round(at * 100 * 100), 100, 100) < 5e-7


def test_counted_values_give_the_same_report(spark, events):
    before = events(*[{"latency_ms": float(100 + i % 10), "feedback_score": None if i % 3 else 4.0} for i in range(60)])
    after = events(*[{"latency_ms": float(104 + i % 12), "crash_flag": int(i % 9 == 0)} for i in range(50)])
    counts = drift.merged_counts(drift.counted_values(before), drift.counted_values(after))
    assert drift.psi_of_counts(counts).orderBy("position").collect() == drift.drift_psi(before, after).orderBy("position").collect()
    assert drift.ks_of_counts(counts).collect() == drift.drift_ks(before, after).collect()


def test_saved_values_stand_for_the_baseline(spark, events, tmp_path):
    path = str(tmp_path / "values")
    assert reports.baseline_values(spark, path) is None
    values = drift.counted_values(events({"latency_ms": 5.0}, {"latency_ms": 5.0}, {"latency_ms": float("nan")}).drop("error_count"))
    reports.save_baseline_values(values, path)
    got = {(r.metric, r.value): r.n for r in reports.baseline_values(spark, path).collect()}
    assert got == {("latency_ms", 5.0): 2, ("crash_flag", 0.0): 3, ("feedback_score", 4.0): 3}


def test_report_orders_alerts_by_method(spark, events):
    before = events(*[{"latency_ms": float(100 + i % 10)} for i in range(100)])
    after = events(*[{"latency_ms": float(300 + i % 10)} for i in range(100)])
    report = drift.detect_data_drift(after, rollup.baseline_stats(before), baseline_events=before).first()
    assert [a.split()[0] for a in report.alerts] == ["latency_ms_mean", "PSI", "KS"]
    assert report.psi_scores["latency_ms"].severity == "HIGH"
    assert report.ks_test_results["latency_ms"].drift_detected and len(report.ks_test_results) == 4


def test_first_run_has_no_baseline(spark, events, tmp_path):
    path = str(tmp_path / "baseline")
    assert reports.baseline_read(spark, path) is None
    stats = rollup.baseline_stats(events({}, {"latency_ms": 400.0}))
    reports.save_baseline(stats, path)
    assert reports.baseline_read(spark, path).collect() == stats.collect()
    assert drift.empty_drift_report(stats).first().alert_count == 0
