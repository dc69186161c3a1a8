from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import features, rollup, star, validate
from tidegauge.sources import layers


def test_twelve_derived_columns(sample_events):
    out = features.engineer_features(sample_events)
    assert [c for c in out.columns if c not in sample_events.columns] == features.DERIVED
    assert len(features.DERIVED) == 12 and out.count() == 100


def test_bad_timestamps_are_dropped_and_counted(events):
    df = events({}, {"timestamp": "never"}, {"timestamp": None})
    assert features.parse_ts_drop_bad(df).count() == 1
    assert features.bad_timestamp_count(df).first()[0] == 2


def test_time_features(events):
    df = events({"timestamp": "2025-01-04 09:00:00"}, {"timestamp": "2025-01-06 17:59:59"}, {"timestamp": "2025-01-05 18:00:00"})
    rows = features.time_features(features.parse_ts_drop_bad(df)).collect()
    assert [(r.hour_of_day, r.day_of_week, r.is_weekend, r.is_business_hours) for r in rows] == [
        (9, 5, 1, 1), (17, 0, 0, 1), (18, 6, 1, 0)
    ]


@pytest.mark.parametrize("latency, bucket", [
    (None, "nan"), (-1.0, "nan"), (0.0, "nan"), (0.1, "excellent"), (100.0, "excellent"), (100.1, "good"), (300.0, "good"),
    (600.0, "moderate"), (600.1, "poor"), (1000.0, "poor"), (1000.1, "critical"), (math.inf, "critical"),
])
def test_latency_buckets(events, latency, bucket):
    assert features.add_latency_bucket(events({"latency_ms": latency})).first().latency_bucket == bucket


def test_anomaly_needs_all_three(events):
    scale = features.EventScale(500.0, 1.0)
    df = events(
        {"latency_ms": 501.0, "crash_flag": 1, "feedback_score": 1.9},
        {"latency_ms": 500.0, "crash_flag": 1, "feedback_score": 1.9},
        {"latency_ms": 501.0, "crash_flag": 0, "feedback_score": 1.9},
        {"latency_ms": 501.0, "crash_flag": 1, "feedback_score": 2.0},
        {"latency_ms": None, "crash_flag": 1, "feedback_score": 1.0},
    )
    assert [r.is_anomaly for r in features.add_anomaly_flag(df, scale).collect()] == [1, 0, 0, 0, 0]


def test_error_flags_treat_null_as_no(events):
    df = features.add_error_flags(events({"error_count": None}, {"error_count": 0}, {"error_count": 3}, {"error_count": 4}))
    assert [(r.has_errors, r.high_error) for r in df.collect()] == [(0, 0), (0, 0), (1, 0), (1, 1)]


def test_scale_without_positive_durations(events):
    df = features.parse_ts_drop_bad(events({"session_duration": 0.0}, {"session_duration": None}))
    assert features.EventScale.of(df).max_duration == 1.0


def test_event_formulas(events):
    row = features.engineer_features(events({"latency_ms": 99.0, "session_duration": 50.0, "feedback_score": 4.0})).first()
    assert row.quality_score == pytest.approx((1 / 100 + 1 + 0.8) / 3)
    assert row.session_quality_index == pytest.approx(0.9)
    assert row.log_latency == pytest.approx(math.log(100))


def test_empty_input_stays_empty(events):
    assert features.engineer_features(events({}).limit(0)).count() == 0


def test_daily_roll_up(events):
    df = events(
        {"timestamp": "2026-01-01T00:00:00Z", "latency_ms": 100.0, "crash_flag": 0, "feedback_score": 4.0, "error_count": 0},
        {"timestamp": "2026-01-01T01:00:00Z", "latency_ms": 200.0, "crash_flag": 1, "feedback_score": 3.0, "error_count": 1},
    )
    out = rollup.agg_daily(df)
    validate.validate_schema(out, "processed")
    assert out.collect() == [("search", "2026-01-01", 150.0, 0.5, 3.5, 2, 0.5)]


def test_roll_up_of_gaps(events):
    df = events({"user_id": None, "latency_ms": None}, {"latency_ms": 10.0}, {"timestamp": "bad"}, {"feature_name": None})
    rows = {r.date: r for r in rollup.agg_daily(df).collect()}
    assert set(rows) == {"2025-01-01", "NaT"}
    assert (rows["2025-01-01"].usage_count, rows["2025-01-01"].avg_latency) == (1, 10.0)


def days(spark, values):
    return spark.createDataFrame(
        [("f", f"2025-01-{i + 1:02d}", v, v / 1000, 4.0) for i, v in enumerate(values)],
        "feature_name string, event_date string, avg_latency double, crash_rate double, avg_feedback double",
    )


def test_windows_at_the_edges(spark):
    values = [float(10 * i) for i in range(1, 10)]
    rows = rollup.add_rolling_stats(days(spark, values)).orderBy("event_date").collect()
    assert rows[0].latency_dod_change is None and rows[1].latency_dod_change == 10.0
    assert rows[0].rolling_7d_avg_latency == 10.0
    assert rows[6].rolling_7d_avg_latency == pytest.approx(sum(values[:7]) / 7)
    assert rows[8].rolling_7d_avg_latency == pytest.approx(sum(values[2:9]) / 7)
    assert [r.recency_rank for r in rows] == list(range(9, 0, -1))


def test_windows_share_one_sort(spark):
    plan = rollup.add_rolling_stats(days(spark, [1.0, 2.0]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1


def test_silver_model_has_sixteen_columns(sample_events):
    silver = rollup.silver_feature_metrics(layers.bronze_typed_view(sample_events))
    assert len(silver.columns) == 16 and "null_latency_count" not in silver.columns


def test_trend_is_a_three_row_mean(events):
    df = events(*[{"timestamp": f"2025-01-{d:02d} 00:00:00", "latency_ms": float(d)} for d in (1, 2, 5, 9)])
    rows = rollup.daily_trends(df).orderBy("date").collect()
    assert [r.latency_trend for r in rows] == pytest.approx([1.0, 1.5, 8 / 3, 16 / 3])


def test_summary_flags_risk_above_one_half(spark, events):
    scored = spark.createDataFrame([("a", 0.5), ("b", 0.6)], "feature_name string, risk_probability double")
    df = events({"feature_name": "a"}, {"feature_name": "b"}, {"feature_name": "c"})
    rows = {r.feature_name: r.high_risk for r in rollup.feature_summary(df, scored).collect()}
    assert rows == {"a": 0, "b": 1, "c": 0}


def test_key_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1)], "feature_id string, event_date int")
    row = star.key_violations(df, ["feature_id", "event_date"]).first()
    assert (row.null_keys, row.duplicate_keys) == (1, 1)


def test_high_risk_owners_uses_a_strict_limit(spark):
    fact = spark.createDataFrame([("a", 0.75), ("b", 0.7), ("b", 0.9)], "feature_id string, risk_score double")
    dim = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "feature_id string, owner_team string")
    assert [(r.feature_id, r.owner_team) for r in star.high_risk_owners(fact, dim).collect()] == [("b", "y")]


def test_a_null_day_comes_last(spark):
    rows = [("f", None, 900.0, 0.0), ("f", "2025-01-01", 100.0, 0.0), ("f", "2025-01-02", 200.0, 0.0)]
    days = spark.createDataFrame(rows, "feature_name string, event_date string, avg_latency double, crash_rate double")
    found = {r.event_date: r for r in rollup.add_rolling_stats(days).collect()}
    assert found["2025-01-01"].rolling_7d_avg_latency == 100.0 and found["2025-01-01"].latency_dod_change is None
    assert (found["2025-01-02"].latency_dod_change, found[None].recency_rank) == (100.0, 1)


def test_slo_counts_days(spark):
    df = spark.createDataFrame(
        [("f", "d1", 100.0, 0)] * 19 + [("f", "d1", 9000.0, 0)] + [("f", "d2", 9000.0, 0)] + [("f", "d3", 1.0, 1)],
        "feature_name string, event_date string, latency_ms double, crash_flag int",
    )
    row = star.slo_tracking(df).first()
    assert (row.days, row.latency_ok_days, row.crash_ok_days) == (3, 2, 2)
    assert row.slo_share == pytest.approx(1 / 3)


def test_bronze_view_fails_on_bad_text(events):
    from pyspark.errors import PySparkException

    df = events({}).withColumn("latency_ms", F.lit("n/a"))
    with pytest.raises(PySparkException):
        layers.bronze_typed_view(df).collect()
