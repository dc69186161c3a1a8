"""JSON sinks for reports, and the saved baseline."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.schema import BASELINE, BASELINE_VALUES


def json_report_sink(report: DataFrame, path: str) -> None:
    """Replace the report at ``path``. Reports hold a handful of rows, thus one file."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def stamped(report: DataFrame) -> DataFrame:
    return report.withColumn("run_timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))


def save_baseline(baseline: DataFrame, path: str) -> None:
    json_report_sink(baseline, path)


def baseline_read(spark: SparkSession, path: str) -> DataFrame | None:
    """The saved baseline row, or ``None`` before the first run."""
    try:
        return spark.read.schema(BASELINE).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def save_baseline_values(values: DataFrame, path: str) -> None:
    """Replace the counted values (metric, value, n) that go with a baseline."""
    values.write.mode("overwrite").parquet(path)


def baseline_values(spark: SparkSession, path: str) -> DataFrame | None:
    """The counted values of the saved baseline, or ``None`` where there are none."""
    try:
        return spark.read.schema(BASELINE_VALUES).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
