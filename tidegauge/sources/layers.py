"""Bronze and Silver layers: partitioned Parquet trees, their inventory, and CSV export.

Layout below a lake root: ``bronze/batch`` (append, one partition per ingest day),
``bronze/stream`` (written by the streaming sink, whose commit log must own its folder),
``silver/<dataset>`` (one partition per processing day, replaced on rerun) and
``gold/<dataset>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.schema import BRONZE_TEXT, STREAM_BRONZE_EVENT
from tidegauge.sources.raw import text_frame, typed_raw

BRONZE_BATCH = "bronze/batch"
BRONZE_STREAM = "bronze/stream"
INVENTORY_TASKS = 64


def utc_now() -> Column:
    """The present as a UTC wall-clock time, whatever the session's zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))


def today() -> Column:
    return F.date_format(utc_now(), "yyyy-MM-dd")


def ingest_time() -> Column:
    return F.date_format(utc_now(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def bronze_append(df: DataFrame, lake: str, source: str, ingested_at: str | None = None) -> None:
    """Append raw rows, all columns as text, plus ingest metadata, to today's Bronze partition.

    ``ingested_at`` (ISO time) lets the caller find the rows of this load again.
    """
    stamped = text_frame(df).withColumns({
        "_ingested_at": F.lit(ingested_at) if ingested_at else ingest_time(),
        "_source": F.lit(source),
        "_layer": F.lit("bronze"),
        "date": F.lit(ingested_at[:10]) if ingested_at else today(),
    })
    stamped.write.mode("append").partitionBy("date").parquet(f"{lake}/{BRONZE_BATCH}")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet tree, or an empty frame of the same schema where the path does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_bronze(
    spark: SparkSession,
    lake: str,
    date: str | None = None,
    typed: bool = True,
    further: Sequence[str] = (),
) -> DataFrame:
    """All Bronze rows, of files and of the stream, or one ``date`` partition (pruned before any
    file is opened).

    ``typed=False`` gives the raw columns as the text they came as. ``further`` names columns
    beyond the raw ones. A column that a load lacks is null in its rows; stream values that are
    no event are left to ``read_bronze_stream``.
    """
    schema = T.StructType([*BRONZE_TEXT.fields[:-1], *[T.StructField(c, T.StringType()) for c in further],
                           BRONZE_TEXT.fields[-1]])
    batch = read_or_empty(spark, f"{lake}/{BRONZE_BATCH}", schema)
    events = read_bronze_stream(spark, lake).filter(F.col("_corrupt_record").isNull())
    given = {"_layer": F.lit("bronze"), **{c: F.col(c).cast("string") for c in events.columns}}
    streamed = events.select([given.get(c, F.lit(None).cast("string")).alias(c) for c in schema.fieldNames()])
    rows = batch.select(*schema.fieldNames()).unionAll(streamed)
    rows = rows if date is None else rows.filter(F.col("date") == date)
    return typed_raw(rows) if typed else rows


def read_bronze_stream(spark: SparkSession, lake: str, date: str | None = None) -> DataFrame:
    rows = read_or_empty(spark, f"{lake}/{BRONZE_STREAM}", STREAM_BRONZE_EVENT)
    return rows if date is None else rows.filter(F.col("date") == date)


def bronze_typed_view(df: DataFrame, name: str | None = None, source_file: str = "raw_events") -> DataFrame:
    """Pin the types, derive event time and day, keep rows with a user and a feature.

    Bad text fails the job under ANSI casts, as a typed view should. ``name`` also registers
    the result as a temporary view.
    """
    moment = F.col("timestamp").cast("timestamp_ntz")
    view = df.filter(F.col("user_id").isNotNull() & F.col("feature_name").isNotNull()).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("feature_name").cast("string").alias("feature_name"),
        F.col("latency_ms").cast("double").alias("latency_ms"),
        F.col("crash_flag").cast("int").alias("crash_flag"),
        F.col("feedback_score").cast("double").alias("feedback_score"),
        F.col("error_count").cast("int").alias("error_count"),
        F.col("session_duration").cast("double").alias("session_duration"),
        moment.alias("event_timestamp"),
        moment.cast("date").alias("event_date"),
        F.current_timestamp().alias("_bronze_loaded_at"),
        F.lit(source_file).alias("_source_file"),
        F.lit("bronze").alias("_layer"),
    )
    if name:
        view.createOrReplaceTempView(name)
    return view


def silver_overwrite(df: DataFrame, lake: str, dataset: str, day: str | None = None) -> None:
    """Write one Silver dataset for a processing day; a rerun replaces that day only."""
    stamped = df.withColumn("_processing_date", F.lit(day) if day else today())
    (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("_processing_date").parquet(f"{lake}/silver/{dataset}"))


def read_silver(spark: SparkSession, lake: str, dataset: str, day: str | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """A Silver dataset; ``schema`` names its columns where files of different runs may differ."""
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(f"{lake}/silver/{dataset}")
    return rows if day is None else rows.filter(F.col("_processing_date") == day)


def materialize_table(df: DataFrame, path: str) -> DataFrame:
    """Rebuild a modelled table in full and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Header CSV, one file per partition; a small frame ends up in one."""
    df.write.mode("overwrite").option("header", True).csv(path)


def layer_inventory(spark: SparkSession, lake: str) -> DataFrame:
    """layer, files, size_mb: Parquet files and megabytes (1e6 bytes) per layer, from file listings alone.

    No file is opened. The listings are counted in at most ``INVENTORY_TASKS`` tasks a layer, however
    many bytes the files hold; the setting for that stays in a session of its own.
    """
    listing = spark.newSession()
    listing.conf.set("spark.sql.files.maxPartitionNum", INVENTORY_TASKS)
    rows = []
    for layer in ("bronze", "silver", "gold"):
        files = _listed(listing, f"{lake}/{layer}")
        count, size = files.agg(F.count("length"), F.sum("length")).first() if files is not None else (0, 0)
        rows.append((layer, count, (size or 0) / 1e6))
    return spark.createDataFrame(rows, "layer string, files long, size_mb double")


def _listed(spark: SparkSession, path: str) -> DataFrame | None:
    """``length`` of every Parquet file below a path; ``None`` where there is no such path."""
    try:
        return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.parquet").load(path).select("length"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def last_ingested(spark: SparkSession, lake: str) -> DataFrame:
    """Latest ingest stamp in Bronze, of files or stream; null when nothing was ingested."""
    return read_bronze(spark, lake, typed=False).agg(F.max("_ingested_at").alias("last_ingested"))
