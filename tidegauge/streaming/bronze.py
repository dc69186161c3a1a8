"""Event stream to Bronze: a pluggable source of JSON values, one parser, one file sink.

The Kafka source and sink need Spark's Kafka connector on the class path. Everything after the
source works on any streaming frame with a ``value`` column, such as a file stream.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.validate import check_required_columns
from tidegauge.schema import STREAM_EVENT
from tidegauge.sources.layers import BRONZE_STREAM, bronze_append, ingest_time, today
from tidegauge.sources.raw import read_raw_csv

logger = logging.getLogger(__name__)

TOPIC = "feature-telemetry-events"  # fixed value: topic name
CORRUPT = "_corrupt_record"

_PARSED = T.StructType([*STREAM_EVENT.fields, T.StructField(CORRUPT, T.StringType())])


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    max_messages: int | None = None,
) -> DataFrame:
    """JSON values of a topic from its earliest offset. The checkpoint holds the offsets.

    ``max_messages`` bounds a micro-batch; without it a batch takes what there is.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", "earliest"))
    if max_messages:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return (reader.load()
            .select(F.col("value").cast("string").alias("value")))


def file_source(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Text files with one JSON value per line."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)


def parse_events(values: DataFrame) -> DataFrame:
    """Event columns from JSON text; text that is no event is kept whole in ``_corrupt_record``."""
    parsed = F.from_json("value", _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return values.select(parsed.alias("event")).select("event.*")


def stamp(events: DataFrame, source: str) -> DataFrame:
    return events.withColumns({
        "_ingested_at": ingest_time(),
        "_source": F.lit(source),
        "_partition_date": today(),
        "date": today(),
    })


def stream_bronze_sink(values: DataFrame, lake: str, checkpoint: str, source: str = "kafka_consumer") -> bool:
    """Drain what the source holds into Bronze, then stop; tell whether anything arrived.

    A rerun continues at the checkpoint. The file sink commits each micro-batch once, so a
    retried batch leaves no second copy.
    """
    query = (stamp(parse_events(values), source).writeStream
             .format("parquet").partitionBy("date").outputMode("append")
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start(f"{lake}/{BRONZE_STREAM}"))
    query.awaitTermination()
    return any(progress["numInputRows"] for progress in query.recentProgress)


def csv_fallback(spark: SparkSession, csv_path: str, lake: str) -> None:
    """Batch-load a raw CSV into Bronze when the stream has nothing."""
    raw = read_raw_csv(spark, csv_path, typed=False)
    check_required_columns(raw, "raw")
    bronze_append(raw, lake, csv_path)


def ingest_topic_or_csv(
    spark: SparkSession,
    servers: str,
    lake: str,
    checkpoint: str,
    csv_path: str,
    topic: str = TOPIC,
    max_messages: int | None = None,
) -> str:
    """Drain the topic; load the CSV instead when the broker cannot be reached or nothing arrives.

    Returns which of the two was used.
    """
    return drain_or_csv(lambda: kafka_source(spark, servers, topic, max_messages), spark, lake, checkpoint, csv_path)


def drain_or_csv(source: Callable[[], DataFrame], spark: SparkSession, lake: str, checkpoint: str, csv_path: str) -> str:
    """Drain any source of JSON values; load the CSV when it is missing, fails or has nothing."""
    try:
        if stream_bronze_sink(source(), lake, checkpoint):
            return "stream"
        logger.info("no events, loading %s", csv_path)
    except (AnalysisException, StreamingQueryException) as error:
        logger.warning("cannot read the stream, loading %s: %s", csv_path, error.getCondition())
    csv_fallback(spark, csv_path, lake)
    return "csv"


def kafka_records(events: DataFrame) -> DataFrame:
    """key = feature name (one feature stays in one partition), value = the event as JSON."""
    return events.select(F.col("feature_name").alias("key"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def kafka_write_keyed(events: DataFrame, servers: str, topic: str = TOPIC) -> None:
    (kafka_records(events).write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save())
