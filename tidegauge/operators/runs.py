"""Training-run log: an append-only table, its best run and the model that belongs to it."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.forest import load_model
from tidegauge.operators.risk import RiskConfig
from tidegauge.sources.layers import read_or_empty

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("model_path", T.StringType()),
])

# Tags of every run.
TAGS = {"model_type": "RandomForestClassifier", "data_layer": "silver"}
CELLS = [("true_negatives", 0, 0), ("false_positives", 0, 1), ("false_negatives", 1, 0), ("true_positives", 1, 1)]


def log_training_run(
    spark: SparkSession,
    path: str,
    metrics: dict[str, Any],
    config: RiskConfig,
    model_path: str,
    run_name: str = "training_run",
) -> str:
    """Append one run and return its id."""
    run_id = uuid.uuid4().hex
    params = {
        "trees": config.trees, "depth": config.depth, "test_share": config.test_share,
        "seed": config.seed, "features": list(config.features), "label": config.label,
    }
    figures = {k: float(metrics[k]) for k in ("accuracy", "roc_auc", "train_rows", "test_rows") if metrics.get(k) is not None}
    if "confusion_matrix" in metrics:
        figures.update({name: float(metrics["confusion_matrix"][a][p]) for name, a, p in CELLS})
    row = (run_id, run_name, datetime.now(timezone.utc), {k: str(v) for k, v in params.items()}, figures, TAGS, model_path)
    spark.createDataFrame([row], RUNS).write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, RUNS)


def best_run(runs: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The run with the highest metric, at most one row."""
    value = F.col("metrics")[metric]
    return runs.filter(value.isNotNull()).orderBy(value.desc(), F.col("started_at")).limit(1)


def load_best_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """The model of the best run, or ``None`` while there are no runs."""
    best = best_run(read_runs(spark, path)).first()
    return load_model(best.model_path) if best else None
