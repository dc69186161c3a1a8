"""The whole run: raw CSV to Bronze, gates, drift, quality, Silver, risk model, reports.

The CSV is read once, into Bronze, and that load's text is parsed once, into a written table that is
removed after the run. Every figure that validation, baseline, profile, gates and the quality suite
need is read from it in one aggregation.
"""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.expressions import nan_to_null, wall_time
from tidegauge.functions.selection import exact_quantiles
from tidegauge.operators import drift, features, forest, quality, risk, rollup, runs, validate
from tidegauge.schema import RAW_EVENT
from tidegauge.session import scratch
from tidegauge.sources import layers, reports
from tidegauge.sources.raw import read_raw_csv

logger = logging.getLogger(__name__)

PARALLEL_OUTPUTS = 4
BASELINE_VALUES = "reports/baseline_values"


@dataclass
class RunResult:
    report: dict[str, Any]
    scored: DataFrame
    quality: DataFrame
    drift: DataFrame
    importance: DataFrame
    attribution: DataFrame


@dataclass(frozen=True)
class PipelineConfig:
    lake: str
    risk: risk.RiskConfig = field(default_factory=risk.RiskConfig)
    drift_threshold: float = drift.CHANGE_LIMIT
    attribution: bool = True

    def at(self, name: str) -> str:
        return f"{self.lake}/{name}"


def run(spark: SparkSession, csv_path: str, config: PipelineConfig, baseline_events: DataFrame | None = None) -> RunResult:
    """Run all steps. A failure is written to the run report and raised again."""
    started = time.time()
    try:
        result = _run(spark, csv_path, config, baseline_events)
    except Exception as error:
        report = {"status": "failed", "rows_processed": 0, "error": str(error)}
        _save_report(spark, config, report, started)
        raise
    _save_report(spark, config, result.report, started)
    return result


def _save_report(spark: SparkSession, config: PipelineConfig, report: dict[str, Any], started: float) -> None:
    report["runtime_seconds"] = round(time.time() - started, 2)
    row = spark.range(1).select(*[_figure(v).alias(k) for k, v in report.items()])
    reports.json_report_sink(reports.stamped(row), config.at("reports/run_report"))


def ingest(spark: SparkSession, csv_path: str, lake: str) -> tuple[DataFrame, str]:
    """Append the CSV to Bronze as text; return exactly the rows of this load, and its stamp."""
    stamp = spark.range(1).select(layers.ingest_time()).first()[0]
    raw = read_raw_csv(spark, csv_path, typed=False)
    validate.check_required_columns(raw, "raw")
    layers.bronze_append(raw, lake, csv_path, ingested_at=stamp)
    return bronze_load(spark, lake, stamp), stamp


def bronze_load(spark: SparkSession, lake: str, stamp: str) -> DataFrame:
    """The raw columns, as text, of the rows that one load brought."""
    rows = layers.read_bronze(spark, lake, date=stamp[:10], typed=False)
    return rows.filter(F.col("_ingested_at") == stamp).select(*RAW_EVENT.fieldNames())


@dataclass
class Measured:
    """What one pass over the events tells, and the three exact figures that need ranks."""

    row: dict[str, Any]
    frame: DataFrame
    scale: features.EventScale
    p99: float | None


def typed(raw: DataFrame) -> DataFrame:
    return nan_to_null(validate.coerce_numeric(raw))


def parsed(raw: DataFrame) -> DataFrame:
    """The typed rows, with the text they came from in the struct ``text``."""
    return typed(raw.withColumn("text", F.struct(*raw.columns)))


def measure(both: DataFrame) -> Measured:
    """Validation figures of the text rows and all others of the typed rows, in one aggregation."""
    spark = both.sparkSession
    events = both.drop("text")
    raw = both.select("text.*")
    moment = wall_time(events, "timestamp")
    parsed = F.when(moment.isNotNull(), F.col("latency_ms"))
    aggregates: dict[str, Column] = {
        **validate.measures(raw, "raw", "text."),
        **rollup.baseline_measures(),
        **quality.suite_measures(quality.expectations(events)),
        **{f"nulls_{c}": F.avg(F.col(c).isNull().cast("int")) for c in events.columns},
        "known_p99": F.count("latency_ms"),
        "known_p95": F.count(parsed),
        "longest_session": F.max(F.when(moment.isNotNull(), F.col("session_duration"))),
    }
    frame = both.agg(*[c.alias(n) for n, c in aggregates.items()])
    row = frame.first()
    validate.verdict(row.asDict(), "raw")

    wanted = {"p99": [0.99], "p95": [features.ANOMALY_QUANTILE]}
    counts = {"p99": row.known_p99, "p95": row.known_p95}
    ranks = exact_quantiles(events, wanted, {"p99": F.col("latency_ms"), "p95": parsed}, counts)
    scale = features.EventScale.from_figures(ranks["p95"][0], row.longest_session)
    return Measured(row.asDict(), spark.createDataFrame([row], frame.schema), scale, ranks["p99"][0])


def _run(spark: SparkSession, csv_path: str, config: PipelineConfig, baseline_events: DataFrame | None) -> RunResult:
    raw, load = ingest(spark, csv_path, config.lake)
    # Every event is parsed once; each later step reads the columns it needs of the written rows.
    with scratch(parsed(raw), "typed-events") as both:
        return _steps(spark, both, load, config, baseline_events)


def _steps(spark: SparkSession, both: DataFrame, load: str, config: PipelineConfig, baseline_events: DataFrame | None) -> RunResult:
    events = both.drop("text")
    seen = measure(both)

    with ThreadPoolExecutor(1) as pool:  # drift and quality read the same rows and do not wait for one another
        drifted = pool.submit(_drift_step, spark, config, events, seen, baseline_events, load)
        quality_results = small(quality.suite_rows(
            quality.expectations(events, p99=seen.p99), seen.frame, quality.duplicate_count(events)
        ))
        quality_report = small(quality.dq_report(quality_results))
        reports.json_report_sink(reports.stamped(quality_report), config.at("reports/data_quality"))
        drift_report = drifted.result()
    _gates(seen.row, events.columns)

    today = spark.range(1).select(layers.today()).first()[0]  # one processing day, also past midnight
    silver = _through_silver(features.engineer_features(events, seen.scale), config.lake, "events", today)
    days = layers.materialize_table(rollup.agg_daily(silver), config.at("gold/feature_days"))
    validate.validate_schema(days, "processed")

    labelled = risk.risk_target(days, config.risk)
    trained = forest.train_risk_model(labelled, config.risk)
    scored = _through_silver(forest.score_rows(labelled, trained.model), config.lake, "scored", today)

    model_path = config.at(f"models/risk-{int(time.time() * 1000)}")
    # The outputs do not depend on one another, so their small jobs overlap.
    with ThreadPoolExecutor(PARALLEL_OUTPUTS) as pool:
        outputs = [
            pool.submit(forest.save_model, trained.model, model_path),
            pool.submit(layers.export_csv, trained.importance, config.at("reports/feature_importance")),
            pool.submit(layers.export_csv, scored, config.at("processed/feature_metrics")),
            pool.submit(_save_metrics, spark, trained.metrics, config.at("reports/metrics")),
        ]
        attribution = trained.importance.limit(0)
        if config.attribution:
            try:
                names = trained.metrics["feature_cols"]
                attribution = small(forest.mean_abs_attribution(scored, trained.model, features=names))
            except Exception:  # the run stands without it
                logger.warning("attribution failed, going on without it", exc_info=True)
        for output in outputs:
            output.result()
    try:
        runs.log_training_run(spark, config.at("runs"), trained.metrics, config.risk, model_path, "auto_run")
    except Exception:  # the run stands without its log entry
        logger.warning("the run could not be logged", exc_info=True)

    quality_row, drift_row = quality_report.first(), drift_report.first()
    totals = scored.agg(F.count(F.lit(1)), F.count_if(F.col("risk_probability") > 0.5)).first()
    report = {
        "status": "success",
        "rows_ingested": seen.row["row_count"],
        "rows_processed": totals[0],
        "output_path": config.at("processed/feature_metrics"),
        "ml_auc": trained.metrics["roc_auc"],
        "ml_accuracy": trained.metrics["accuracy"],
        "high_risk_features": totals[1],
        "quality_score_pct": quality_row.score_pct,
        "quality_checks_passed": quality_row.passed,
        "drift_alerts": drift_row.alert_count,
        "drift_detected": drift_row.overall_drift_detected,
    }
    return RunResult(report, scored, quality_results, drift_report, trained.importance, attribution)


def _through_silver(rows: DataFrame, lake: str, dataset: str, day: str) -> DataFrame:
    """Write a Silver dataset and go on from its files, by the columns just written."""
    layers.silver_overwrite(rows, lake, dataset, day)
    schema = T.StructType([*rows.schema.fields, T.StructField("_processing_date", T.StringType())])
    return layers.read_silver(rows.sparkSession, lake, dataset, day, schema).drop("_processing_date")


def _figure(value: Any) -> Column:
    """A literal; a figure that could not be computed is a null number."""
    return F.lit(None).cast("double") if value is None else F.lit(value)


def _save_metrics(spark: SparkSession, metrics: dict[str, Any], path: str) -> None:
    lines = metrics["classification_report"]
    report = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in line.items()]) for line in lines])
    figures = [_figure(v).alias(k) for k, v in metrics.items() if k != "classification_report"]
    row = spark.range(1).select(*figures, report.alias("classification_report"))
    reports.json_report_sink(reports.stamped(row), path)


def _drift_step(
    spark: SparkSession,
    config: PipelineConfig,
    events: DataFrame,
    seen: Measured,
    baseline_events: DataFrame | None,
    load: str,
) -> DataFrame:
    """First run: save the baseline with its counted values, and report nothing.

    Later: compare means with the baseline, and distributions (PSI, KS) with its counted values or with
    ``baseline_events`` where given; save the report. The events that the baseline came from are not
    read again.
    """
    path = config.at("reports/baseline_stats")
    current = seen.frame.select(*rollup.baseline_measures())
    baseline = reports.baseline_read(spark, path)
    if baseline is None:
        reports.json_report_sink(spark.range(1).select(F.lit(load).alias("ingested_at")), config.at("reports/baseline_load"))
        reports.save_baseline_values(drift.counted_values(events), config.at(BASELINE_VALUES))
        reports.save_baseline(current, path)
        return drift.empty_drift_report(current)
    changes = drift.drift_pct_change(current.select(*drift.MEANS), baseline, config.drift_threshold)
    known = _baseline_values(spark, config) if baseline_events is None else drift.counted_values(baseline_events)
    counts = drift.merged_counts(known, drift.counted_values(events))
    report = small(drift.distribution_report(changes, counts, threshold=config.drift_threshold))
    reports.json_report_sink(reports.stamped(report), config.at("reports/data_drift"))
    return report


def _baseline_values(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """The saved counted values; a baseline saved without them gets them from its Bronze load, once."""
    saved = reports.baseline_values(spark, config.at(BASELINE_VALUES))
    if saved is None:
        stamp = spark.read.schema("ingested_at string").json(config.at("reports/baseline_load")).first()[0]
        reports.save_baseline_values(drift.counted_values(typed(bronze_load(spark, config.lake, stamp))), config.at(BASELINE_VALUES))
        saved = reports.baseline_values(spark, config.at(BASELINE_VALUES))
    return saved


def small(report: DataFrame) -> DataFrame:
    """A report of a few rows as a local frame, so that reading it again runs nothing upstream."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def _gates(row: dict[str, Any], columns: list[str]) -> None:
    """The null-rate and latency gates on figures that are already there."""
    sparse = [c for c in columns if (row[f"nulls_{c}"] or 0.0) > quality.GATE_NULL_RATE]
    if sparse:
        raise quality.QualityGateError(f"null rate above {quality.GATE_NULL_RATE} in columns: {sparse}")
    highest = row["dq_latency_max"]
    if highest is not None and highest > quality.SPIKE_LATENCY:
        raise quality.QualityGateError(f"latency above {quality.SPIKE_LATENCY} ms")
