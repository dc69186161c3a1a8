"""Session settings and the shared folder that jobs cut lineage into."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)

_local_roots: dict[str, str] = {}


def build_session(app: str = "tidegauge", **conf: str) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Call-site capture costs milliseconds per column expression; wide aggregations have hundreds.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session zone: every timestamp in the library is a UTC wall-clock time."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tidegauge-")
    return _local_roots[context.applicationId]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/tidegauge/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point RDD checkpoints (used by iterative MLlib fits) at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/tidegauge/checkpoints")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and continue from the written table.

    Used where several jobs follow on one expensive frame. The table is on shared storage,
    so a lost executor costs a re-read and not the upstream plan.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialize`` for steps that end inside the block: the written table is removed after it."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, on whatever store holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
