from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import quality, validate
from tidegauge.operators.validate import ValidationError

TEXT = ("user_id string, feature_name string, session_duration string, latency_ms string, crash_flag string, "
        "error_count string, feedback_score string, timestamp string")


def by_name(df, key):
    return {r[key]: r for r in df.collect()}


def test_valid_rows_pass_unchanged(sample_events):
    out = validate.validate_schema(sample_events, "raw")
    assert out.schema == sample_events.schema and out.count() == 100


def test_missing_columns_raise(spark):
    with pytest.raises(ValidationError, match="missing required columns"):
        validate.validate_schema(spark.createDataFrame([("search",)], "feature_name string"), "raw")
    with pytest.raises(ValidationError, match="Invalid stage"):
        validate.validate_schema(spark.range(1), "gold")


def test_empty_raises_and_few_rows_warn(events, caplog):
    with pytest.raises(ValidationError, match="no rows"):
        validate.validate_schema(events({}).limit(0), "raw")
    validate.validate_schema(events({}, {}), "raw")
    assert "very few rows" in caplog.text


def test_text_is_coerced_and_losses_counted(events):
    df = events({"latency_ms": "12.5"}, {"latency_ms": "n/a"}, {"latency_ms": None}, ddl=TEXT)
    rows = [r.latency_ms for r in validate.validate_schema(df, "raw").collect()]
    assert sorted(rows, key=str) == [12.5, None, None]
    line = by_name(validate.coercion_report(df), "column_name")["latency_ms"]
    assert (line.kept, line.coerced_nulls) == (1, 1)


@pytest.mark.parametrize("bad, critical", [(20, False), (21, True)])
def test_critical_share_is_strictly_above_a_fifth(events, bad, critical):
    df = events(*[{"feedback_score": 6.0}] * bad, *[{}] * (100 - bad))
    assert by_name(validate.range_report(df), "column_name")["feedback_score"].critical is critical
    if critical:
        with pytest.raises(ValidationError, match="feedback_score"):
            validate.validate_schema(df, "raw")
    else:
        validate.validate_schema(df, "raw")


def test_range_ends_are_inside(events):
    df = events({"latency_ms": 0.0}, {"latency_ms": 10_000.0}, {"latency_ms": 10_000.5}, {"latency_ms": None})
    line = by_name(validate.range_report(df), "column_name")["latency_ms"]
    assert (line.checked, line.outside) == (3, 1)


def test_fully_null_column_raises(events):
    with pytest.raises(ValidationError, match="entirely null"):
        validate.validate_schema(events({"error_count": None}, {"error_count": None}), "raw")


def test_suite_on_clean_rows(sample_events):
    report = quality.dq_report(quality.run_suite(sample_events)).first()
    assert (report.total_checks, report.passed, report.failed, report.score_pct) == (12, 12, 0, 100.0)
    assert report.overall_passed and report.failures == [] and len(report.results) == 12


def test_suite_on_dirty_rows(events):
    df = events(
        {"crash_flag": 2}, {"feedback_score": 0.0}, {"feature_name": " \t"}, {"feature_name": None},
        {"timestamp": "soon"}, {"timestamp": None}, {"latency_ms": 10_001.0}, {"latency_ms": None},
        {"user_id": None}, {"user_id": None},
    )
    lines = by_name(quality.run_suite(df), "expectation")
    failed = {name for name, line in lines.items() if not line.passed}
    assert failed == {
        "expect_no_duplicate_events", "expect_column_null_rate_below_threshold_latency_ms",
        "expect_latency_in_valid_range", "expect_crash_flag_is_binary", "expect_feedback_score_between_1_and_5",
        "expect_minimum_row_count", "expect_feature_name_not_null_or_empty", "expect_timestamp_parseable",
        "expect_no_extreme_latency_spikes",
    }
    assert lines["expect_no_duplicate_events"].detail.startswith("Found 6 ")  # nulls are equal keys
    report = quality.dq_report(quality.run_suite(df)).first()
    assert report.failed == len(report.failures) == 9 and report.score_pct == 25.0


@pytest.mark.parametrize("nulls, passed", [(5, True), (6, False)])
def test_null_rate_limit_is_inclusive(events, nulls, passed):
    df = events(*[{"latency_ms": None}] * nulls, *[{}] * (100 - nulls))
    line = quality.run_suite(df, ["expect_column_null_rate_below_threshold_latency_ms"]).first()
    assert line.passed is passed


def test_all_null_latency_fails_the_range(events):
    line = quality.run_suite(events({"latency_ms": None}), ["expect_latency_in_valid_range"]).first()
    assert line.passed is False


def test_missing_columns_skip_their_checks(sample_events):
    lines = by_name(quality.run_suite(sample_events.drop("crash_flag")), "expectation")
    assert len(lines) == 10 and not lines["expect_columns_to_exist"].passed


def test_null_gate(spark):
    clean = spark.createDataFrame([(100, "a"), (200, "b"), (300, "c")], "latency_ms int, feature_name string")
    dirty = spark.createDataFrame([(100.0, "a"), (None, "b"), (300.0, "c")], "latency_ms double, feature_name string")
    quality.null_rate_gate(clean)
    with pytest.raises(ValueError, match="latency_ms"):
        quality.null_rate_gate(dirty)
    quality.null_rate_gate(spark.range(5).select(F.when(F.col("id") > 0, 1).alias("x")))  # exactly 0.2


def test_latency_gate_is_strict(events):
    quality.latency_outlier_gate(events({"latency_ms": 5000.0}))
    with pytest.raises(ValueError):
        quality.latency_outlier_gate(events({"latency_ms": 5000.1}))


def test_profile_without_latency(spark):
    row = quality.data_profile(spark.range(3)).first()
    assert (row.row_count, row.column_count, row["columns"]) == (3, 1, ["id"])


def test_text_nan_is_no_value(spark, events):
    df = events(*[{"user_id": f"u{i}"} for i in range(10)]).withColumn("latency_ms", F.when(F.col("user_id") < "u3", "NaN").otherwise("200"))
    seen = validate.measured(df).first()
    assert (seen.present_latency_ms, seen.outside_latency_ms, seen.coerced_latency_ms) == (7, 0, 0)
    validate.validate_schema(df)


def test_unicode_blanks_are_no_feature_name(spark, events):
    df = events({"feature_name": "\u00a0"}, {})
    assert [r.passed for r in quality.suite_rows(quality.expectations(df), df.agg(*[
        c.alias(n) for n, c in quality.suite_measures(quality.expectations(df)).items()]), quality.duplicate_count(df)
    ).filter("expectation = 'expect_feature_name_not_null_or_empty'").collect()] == [False]


def test_duplicates_count_exact_keys(spark, monkeypatch):
    rows = [("a", "1"), ("a", "1"), ("a", "1"), ("a", None), (None, "a"), (None, "a"), (None, None), ("b", "1"), ("1", "b")]
    df = spark.createDataFrame(rows, "user_id string, timestamp string")
    assert quality.duplicate_count(df).first()[0] == 3
    # Rows whose hashes agree although their keys differ are told apart by the keys.
    monkeypatch.setattr(quality.F, "xxhash64", lambda *_: F.coalesce(F.length("user_id"), F.lit(0)))
    assert quality.duplicate_count(df).first()[0] == 3
    monkeypatch.undo()
    assert quality.duplicate_count(df.limit(0)).first()[0] == 0


def test_duplicate_keys_are_not_shuffled_whole(spark):
    df = spark.createDataFrame([("a", "1")], "user_id string, timestamp string")
    plan = quality.duplicate_count(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "Aggregate [pair" in plan
