from __future__ import annotations

import json
import shutil

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import serving
from tidegauge.operators.risk import RiskConfig
from tidegauge.plans import pipeline
from tidegauge.sources import layers, reports
from tidegauge.sources.raw import clip_range
from tidegauge.sources.telemetry import telemetry

CONFIG = RiskConfig(trees=10, folds=2)


def cards(spark, *probabilities):
    return spark.createDataFrame([(f"f{i}", p, 100.0) for i, p in enumerate(probabilities)],
                                 "feature_name string, risk_probability double, avg_latency_ms double")


def test_tiers_at_their_limits(spark):
    rows = serving.risk_ranking(cards(spark, 0.29, 0.3, 0.5, 0.7, None)).collect()
    assert [r.risk_tier for r in rows] == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "LOW"]


def test_kpis_count_strictly_above_one_half(spark):
    row = serving.kpi_overview(cards(spark, 0.5, 0.51), auc=0.9).first()
    assert (row.total_features, row.high_risk, row.avg_latency, row.model_auc, row.data_quality_pct) == (2, 1, 100.0, 0.9, None)


def test_advice_lines(spark):
    rows = serving.risk_recommendations(cards(spark, 0.9, 0.6, 0.1)).groupBy("feature_name").count()
    assert {r[0]: r[1] for r in rows.collect()} == {"f0": 4, "f1": 2, "f2": 1}


def test_deep_dive_accepts_both_names(spark):
    row = serving.feature_deep_dive(cards(spark, 0.6), "f0").first()
    assert (row.avg_latency, row.avg_feedback, row.risk_tier) == (100.0, 0, "HIGH")
    assert serving.feature_deep_dive(cards(spark, 0.6), "none").count() == 0


def test_drift_colours(spark):
    df = spark.createDataFrame([("a", 0.2), ("b", -0.21), ("c", 0.1), ("d", -0.11)], "metric string, pct_change double")
    assert [r.colour for r in serving.drift_status(df).collect()] == ["amber", "red", "green", "amber"]


def test_status_of_a_bare_report(spark):
    rows = serving.pipeline_status(spark.createDataFrame([(300,)], "rows_processed long")).collect()
    assert len(rows) == 9 and rows[0].detail == "300 rows loaded"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    from conftest import SF_DIR

    root = tmp_path_factory.mktemp("run")
    layers.export_csv(clip_range(telemetry(spark, SF_DIR), {"latency_ms": (0.0, 5000.0)}), str(root / "raw"))
    return root


def read_report(root, name):
    (file,) = [f for f in (root / "lake" / "reports" / name).iterdir() if f.suffix == ".json"]
    return json.loads(file.read_text())


def test_run_twice(spark, lake):
    config = pipeline.PipelineConfig(str(lake / "lake"), CONFIG)
    first = pipeline.run(spark, str(lake / "raw"), config)
    assert first.report["rows_ingested"] == 1000 and first.report["rows_processed"] == 150
    assert first.report["quality_checks_passed"] == 12 and first.report["drift_alerts"] == 0
    assert read_report(lake, "run_report")["status"] == "success"
    assert read_report(lake, "metrics")["test_rows"] == 30
    assert first.attribution.count() == 5 and first.importance.count() == 5

    # The second load carries slower events: it is compared with the first one's baseline and its
    # counted values, and does not look for the load that they came from.
    assert reports.baseline_values(spark, config.at(pipeline.BASELINE_VALUES)).agg({"n": "sum"}).first()[0] == 4000
    shutil.rmtree(lake / "lake" / "reports" / "baseline_load")
    slower = telemetry(spark, "/root/testdata/sf0.001").withColumn("latency_ms", F.least(F.lit(4999.0), F.col("latency_ms") * 2))
    layers.export_csv(slower, str(lake / "slower"))
    second = pipeline.run(spark, str(lake / "slower"), config)
    assert second.report["rows_ingested"] == 1000 and second.report["drift_detected"]
    assert layers.read_bronze(spark, config.lake).count() == 2000
    assert second.scored.count() == 150  # Silver holds this day once
    alerts = read_report(lake, "data_drift")["alerts"]
    assert alerts[0].startswith("latency_ms_mean drifted by")
    assert any("PSI" in a for a in alerts) and any("KS" in a for a in alerts)  # against the rows of the first load


def test_failed_run_is_reported_and_raised(spark, lake, tmp_path):
    spiky = telemetry(spark, "/root/testdata/sf0.001").withColumn("latency_ms", F.col("latency_ms") + 5000)
    layers.export_csv(spiky, str(tmp_path / "raw"))
    config = pipeline.PipelineConfig(str(tmp_path / "lake"), CONFIG)
    with pytest.raises(ValueError, match="latency"):
        pipeline.run(spark, str(tmp_path / "raw"), config)
    report = read_report(tmp_path, "run_report")
    assert report["status"] == "failed" and "latency" in report["error"]
