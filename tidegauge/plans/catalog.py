"""Every operator as a named query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``.

Column names and values match ``oracles.py``. Means are rounded on both sides, since the order of a
parallel sum is free: to six digits, or to twelve where the summed values are small multiples of
one half and the sum is exact in any order. Plain row arithmetic is compared as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache, reduce
from operator import add

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.expressions import nan_to_null
from tidegauge.operators import drift, evaluate, features, forest, quality, risk, rollup, runs, serving, star, validate
from tidegauge.plans import pipeline
from tidegauge.schema import RAW_EVENT, RISK_FEATURES, STREAM_EVENT
from tidegauge.session import configure, materialize, shared_path
from tidegauge.sources import layers, raw, reports
from tidegauge.sources.telemetry import DRIFT_SPLIT, keyed_events, raw_text, telemetry
from tidegauge.streaming import archive
from tidegauge.streaming import bronze as stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

MODULUS, FACTOR = 2_147_483_647, 48_271  # a reproducible draw that any SQL engine can repeat


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, sf_dir: run(configure(spark), sf_dir)
    return run


def draw(key: Column, seed: int = 0) -> Column:
    """Pseudo-random integer of a row key."""
    return ((key + seed) % MODULUS * FACTOR) % MODULUS


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def no_zone(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The defective text rows with numbers coerced; ``timestamp`` is still text."""
    return nan_to_null(validate.coerce_numeric(raw_text(spark, sf_dir)))


def dirty_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.parse_ts_drop_bad(dirty(spark, sf_dir))


def typed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.bronze_typed_view(telemetry(spark, sf_dir))


def feature_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature-day rows with rounded means, so that quantile ties fall alike in every engine."""
    means = [c for c in RISK_FEATURES if c != "usage_count"]
    return rounded(rollup.agg_daily(telemetry(spark, sf_dir)), *means)


def day_key(df: DataFrame) -> Column:
    """A number per feature-day, to draw from."""
    day = F.date_diff(F.to_date("date"), F.lit("2024-01-01").cast("date"))
    return F.length("feature_name") * 100_003 + F.ascii("feature_name") * 1_009 + day * 31


def labelled_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.risk_target(feature_days(spark, sf_dir))


def drift_sides(spark: SparkSession, sf_dir: str, shift: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Events before and from the split day; ``shift`` scales the current latency."""
    events = telemetry(spark, sf_dir)
    split = F.lit(DRIFT_SPLIT).cast("timestamp_ntz")
    current = events.filter(F.col("timestamp") >= split)
    return events.filter(F.col("timestamp") < split), current.withColumn("latency_ms", F.col("latency_ms") * shift)


# ---- sources and sinks -------------------------------------------------------------------

@query
def read_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "raw-csv")
    events = telemetry(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    layers.export_csv(events, path)
    return raw.read_raw_csv(spark, path)


@query
def read_raw_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files whose headers differ in order and in a column each."""
    path = shared_path(spark, "raw-csv")
    before, after = drift_sides(spark, sf_dir)
    second = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    layers.export_csv(before.withColumn("timestamp", second).drop("error_count"), f"{path}/a")
    turned = after.withColumn("timestamp", second).drop("session_duration")
    layers.export_csv(turned.select(*reversed(turned.columns)), f"{path}/b")
    return raw.read_raw_csv(spark, f"{path}/*").select(*RAW_EVENT.fieldNames())


def _bronze_lake(spark: SparkSession, sf_dir: str) -> str:
    lake = shared_path(spark, "lake")
    events = telemetry(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    layers.bronze_append(events, lake, "events")
    return lake


@query
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and metadata of two loads into one tree."""
    lake = _bronze_lake(spark, sf_dir)
    layers.bronze_append(layers.read_bronze(spark, lake).select(*RAW_EVENT.fieldNames()), lake, "second load")
    loads = layers.read_bronze(spark, lake).groupBy("_source", "_layer").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("date").alias("partitions"),
        F.round(F.sum("latency_ms"), 3).alias("latency_sum"),
        F.count("_ingested_at").alias("stamped"),
    )
    return loads


@query
def read_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One existing partition; the partition filter never reaches the files."""
    lake = _bronze_lake(spark, sf_dir)
    day = layers.last_ingested(spark, lake).first()[0][:10]
    return layers.read_bronze(spark, lake, day).select(*RAW_EVENT.fieldNames(), "_source", "_layer")


@query
def union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = drift_sides(spark, sf_dir)
    return raw.union_files([before.drop("error_count"), after.drop("session_duration")])


@query
def layer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per layer after three loads and two datasets of one file each, and whether their listed
    size is that of the bytes in them.

    A file has one writer, so events are parsed and made text before, once and in parallel; loads that
    share no folder are written side by side.
    """
    lake = shared_path(spark, "lake")
    events = materialize(telemetry(spark, sf_dir), "events")
    text = materialize(raw.text_frame(events), "text-events")

    def bronze() -> None:
        for load in range(3):
            layers.bronze_append(text.coalesce(1), lake, f"load {load}", f"2024-02-0{load // 2 + 1}T00:00:00.000000Z")

    with ThreadPoolExecutor(3) as pool:
        written = [pool.submit(bronze)]
        written += [pool.submit(layers.silver_overwrite, events.coalesce(1), lake, dataset, "2024-02-01") for dataset in ("events", "more")]
        for each in written:
            each.result()
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    read = content.load([f"{lake}/bronze", f"{lake}/silver"]).select(
        F.regexp_extract("path", "/(bronze|silver)/", 1).alias("layer"), F.length("content").alias("bytes"))
    read = read.groupBy("layer").agg((F.sum("bytes") / 1e6).alias("read_mb"))
    return layers.layer_inventory(spark, lake).join(read, "layer", "left").select(
        "layer", "files", (F.col("size_mb") == F.coalesce("read_mb", F.lit(0.0))).alias("size_matches"))


@query
def bronze_typed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    text = raw.text_frame(keyed_events(spark, sf_dir)).withColumns({
        "user_id": F.when(k != 41, F.col("user_id")),
        "feature_name": F.when(k != 43, F.col("feature_name")),
    }).drop("k", "event_id")
    return layers.bronze_typed_view(text, "bronze_feature_events").drop("_bronze_loaded_at")


@query
def silver_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days written, the second day written again: only that day is replaced."""
    lake = shared_path(spark, "lake")
    before, after = drift_sides(spark, sf_dir)
    layers.silver_overwrite(features.add_latency_bucket(before), lake, "events", "2024-02-01")
    layers.silver_overwrite(features.add_latency_bucket(before), lake, "events", "2024-02-02")
    layers.silver_overwrite(features.add_latency_bucket(after), lake, "events", "2024-02-02")
    return layers.read_silver(spark, lake, "events").groupBy(
        F.col("_processing_date").cast("string").alias("processing_date"), "latency_bucket"
    ).agg(F.count(F.lit(1)).alias("rows"))


@query
def materialize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = layers.materialize_table(rollup.silver_daily(typed_bronze(spark, sf_dir)), shared_path(spark, "silver-daily"))
    return rounded(table, "avg_latency", "crash_rate", "avg_feedback", "avg_error_count", "avg_session_duration")


@query
def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "feature-days")
    days = labelled_days(spark, sf_dir)
    layers.export_csv(days, path)
    return spark.read.schema(days.schema).option("header", True).csv(path)


@query
def json_report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "profile")
    profile = quality.data_profile(telemetry(spark, sf_dir))
    reports.json_report_sink(profile, path)
    saved = spark.read.schema(profile.schema).json(path)
    return rounded(saved, "latency_mean").withColumn("columns", F.array_join("columns", ","))


@query
def baseline_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "baseline")
    reports.save_baseline(rollup.baseline_stats(telemetry(spark, sf_dir)), path)
    return rounded(reports.baseline_read(spark, path), *[n for n in reports.BASELINE.fieldNames() if n != "row_count"])


# ---- raw-source preparation --------------------------------------------------------------

CODES = [
    "electronics.smartphone", "electronics.audio.headphone", "electronics.clocks", "computers.notebook",
    "computers.desktop", "computers.ebooks", "appliances.kitchen.washer", "sport.trainer", "sport.bicycle",
    "kids.toys", "auto.accessories", "furniture.kitchen.chair", "medicine.tools", "construction.tools",
    "clothing.shoes", "stationery.paper", None,
]


def commerce_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the shape of a foreign log with gaps: event_time "... UTC", category_code."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    codes = F.array(*[F.lit(c) for c in CODES])
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
    return events.select(
        "event_id",
        F.when(k == 13, None).when(k == 29, "yesterday UTC").otherwise(stamp).alias("event_time"),
        F.when(k != 17, F.col("event_type")).alias("event_type"),
        F.when(k != 19, F.col("user_id")).alias("user_id"),
        F.get(codes, (F.col("event_id") % len(CODES)).cast("int")).alias("category_code"),
        ((F.col("value") - 20.0) / 10.0).alias("price"),
    )


@query
def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.drop_incomplete(commerce_log(spark, sf_dir))


@query
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = keyed_events(spark, sf_dir)
    return raw.sample_n(events, 500, draw(F.col("event_id"), 42)).select("event_id", "user_id", "latency_ms")


@query
def sample_n_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample by a key of ten values: how many rows of each key are in it."""
    events = keyed_events(spark, sf_dir)
    drawn = raw.sample_n(events, 4500, F.col("event_id") % 10)
    return drawn.groupBy((F.col("event_id") % 10).alias("key")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("event_id").alias("event_ids"))


@query
def map_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = commerce_log(spark, sf_dir)
    name = raw.map_category(F.col("category_code"), draw(F.col("event_id"), 7))
    return log.select("event_id", "category_code", name.alias("feature_name"))


@query
def clean_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.clean_timestamp(commerce_log(spark, sf_dir)).select("event_id", "event_time", "timestamp")


@query
def spread_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = raw.spread_days(F.col("timestamp"), draw(F.col("event_id"), 11))
    return raw.clean_timestamp(commerce_log(spark, sf_dir)).select("event_id", moved.alias("timestamp"))


@query
def clip_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = commerce_log(spark, sf_dir).withColumn("latency_ms", F.when(F.col("event_id") % 10 != 3, F.col("price") * 10))
    return raw.clip_range(log, {"price": (1.0, 5.0), "latency_ms": (80.0, 600.0)}).select("event_id", "price", "latency_ms")


@query
def project_raw_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    numeric_user = keyed_events(spark, sf_dir).withColumn("user_id", F.col("user_id").cast("long"))
    return raw.project_raw_schema(numeric_user)


@query
def profile_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(raw.profile_raw(telemetry(spark, sf_dir)), "crash_rate", "avg_latency", "avg_feedback")


# ---- schema validation -------------------------------------------------------------------

@query
def validate_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.required_report(raw_text(spark, sf_dir).drop("session_duration"))


@query
def validate_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.row_count_report(raw_text(spark, sf_dir))


@query
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.coercion_report(raw_text(spark, sf_dir))


@query
def coerced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.coerce_numeric(raw_text(spark, sf_dir)).drop("k")


@query
def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validate.range_report(raw_text(spark, sf_dir)), "share").drop("critical")


@query
def range_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback shifted so that more than a fifth of its values leave the range."""
    shifted = telemetry(spark, sf_dir).withColumn("feedback_score", F.col("feedback_score") + 1.5)
    return validate.range_report(shifted).filter("critical").select("column_name", "outside", "critical")


@query
def fully_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    emptied = telemetry(spark, sf_dir).withColumn("error_count", F.lit(None).cast("int"))
    return validate.fully_null_report(emptied)


@query
def validate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stages pass; the roll-up of the validated events comes out."""
    events = validate.validate_schema(raw_text(spark, sf_dir), "raw")
    days = rollup.agg_daily(events)
    passed = validate.validate_schema(days, "processed").select(*validate.PROCESSED_REQUIRED)
    return rounded(passed, "crash_rate", digits=12)


# ---- data quality ------------------------------------------------------------------------

def _expectation(name: str, *expectations: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.run_suite(dirty(spark, sf_dir).drop("event_id", "k"), expectations)

    run.__name__ = name
    query(run)


_expectation("dq_columns_exist", "expect_columns_to_exist", "expect_minimum_row_count")
_expectation("dq_no_duplicates", "expect_no_duplicate_events")
_expectation("dq_null_rate", *[f"expect_column_null_rate_below_threshold_{c}" for c in quality.NULL_RATE_COLUMNS])
_expectation("dq_latency_range", "expect_latency_in_valid_range")
_expectation("dq_crash_binary", "expect_crash_flag_is_binary")
_expectation("dq_feedback_range", "expect_feedback_score_between_1_and_5")
_expectation("dq_min_rows", "expect_minimum_row_count")
_expectation("dq_feature_name", "expect_feature_name_not_null_or_empty")
_expectation("dq_timestamp_parseable", "expect_timestamp_parseable")
_expectation("dq_no_spikes", "expect_no_extreme_latency_spikes")


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.dq_report(quality.run_suite(dirty(spark, sf_dir).drop("event_id", "k")))
    names = F.transform("failures", lambda failure: failure["expectation"])
    return report.withColumn("failures", F.array_join(names, ",")).drop("results")


@query
def null_rate_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.null_rates(raw_text(spark, sf_dir)), "null_rate")


@query
def latency_outlier_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before and after a shift that lifts the maximum above the limit."""
    events = telemetry(spark, sf_dir)
    lifted = events.withColumn("latency_ms", F.col("latency_ms") * 3)
    return (quality.latency_outliers(events).withColumn("side", F.lit("as is"))
            .unionByName(quality.latency_outliers(lifted).withColumn("side", F.lit("lifted"))))


@query
def data_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = quality.data_profile(dirty(spark, sf_dir).drop("event_id", "k"))
    return rounded(profile, "latency_mean").withColumn("columns", F.array_join("columns", ","))


# ---- event features ----------------------------------------------------------------------

@query
def parse_ts_drop_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_parsed(spark, sf_dir).select("event_id", "timestamp", "date")


@query
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = features.time_features(dirty_parsed(spark, sf_dir))
    return named.select("event_id", "hour_of_day", "day_of_week", "is_weekend", "is_business_hours")


@query
def event_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.add_quality_score(dirty(spark, sf_dir)).select("event_id", "quality_score"), "quality_score")


@query
def latency_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_latency_bucket(dirty(spark, sf_dir)).select("event_id", "latency_ms", "latency_bucket")


@query
def anomaly_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = dirty_parsed(spark, sf_dir)
    return features.add_anomaly_flag(parsed, features.EventScale.of(parsed)).select("event_id", "is_anomaly")


@query
def error_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_error_flags(dirty(spark, sf_dir)).select("event_id", "error_count", "has_errors", "high_error")


@query
def session_quality_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = dirty_parsed(spark, sf_dir)
    return features.add_session_quality(parsed, features.EventScale.of_sessions(parsed)).select("event_id", "session_quality_index")


@query
def log_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.add_log_latency(dirty(spark, sf_dir)).select("event_id", "log_latency"), "log_latency")


@query
def engineer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = features.engineer_features(dirty(spark, sf_dir)).drop("k")
    return rounded(made, "quality_score", "log_latency")


@query
def transform_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.transform_summary(features.engineer_features(dirty(spark, sf_dir)))


# ---- roll-ups and windows ----------------------------------------------------------------

@query
def agg_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = rollup.agg_daily(dirty(spark, sf_dir))
    return rounded(rounded(days, "avg_latency"), "crash_rate", "avg_feedback", "avg_error_count", digits=12)


_DAILY_MEANS = ["avg_latency", "crash_rate", "avg_feedback", "avg_error_count", "avg_session_duration"]


@query
def silver_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = dirty_parsed(spark, sf_dir)
    return rounded(rollup.silver_daily(layers.bronze_typed_view(gaps)), *_DAILY_MEANS)


@query
def silver_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = rounded(rollup.silver_daily(typed_bronze(spark, sf_dir)), *_DAILY_MEANS)
    return rollup.silver_quality_score(daily).select("feature_name", "event_date", "quality_score")


@query
def baseline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rollup.baseline_stats(dirty(spark, sf_dir))
    return rounded(stats, *[c for c in stats.columns if c != "row_count"])


@query
def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of a feature's high-risk days stands in for its model probability."""
    days = labelled_days(spark, sf_dir).withColumn("risk_probability", F.col("is_high_risk").cast("double"))
    summary = rollup.feature_summary(telemetry(spark, sf_dir), days)
    return rounded(summary, "avg_latency_ms", "crash_rate", "avg_error_count", "avg_feedback_score", "risk_probability")


def star_schema(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fact rows, and a dimension derived from the same events."""
    events = telemetry(spark, sf_dir)
    days = rollup.agg_daily(events).withColumnsRenamed({"feature_name": "feature_id", "date": "event_date"})
    score = F.least(F.lit(1.0), F.round(F.col("crash_rate") * 16.0, 6))
    days = rounded(days, "avg_latency", "crash_rate", "avg_feedback")
    fact = star.fact_feature_metrics(days, score, F.col("avg_latency") > 600.0)
    first_letter = F.substring("feature_name", 1, 1)
    dimension = events.groupBy("feature_name").agg(F.min(F.col("timestamp").cast("date")).alias("release_date")).select(
        F.col("feature_name").alias("feature_id"),
        F.initcap("feature_name").alias("feature_name"),
        F.concat(F.lit("team-"), first_letter).alias("owner_team"),
        "release_date",
        F.when(F.length("feature_name") > 5, "growth").otherwise("mature").alias("lifecycle_stage"),
    )
    return fact, dimension


@query
def fact_dim_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key checks of both tables, of the fact table doubled and of one without the day of some rows."""
    fact, dimension = star_schema(spark, sf_dir)

    def checked(name: str, df: DataFrame, key: tuple[str, ...]) -> DataFrame:
        return star.key_violations(df, key).withColumn("table_name", F.lit(name))

    gaps = fact.withColumn("event_date", F.when(F.day("event_date") != 5, F.col("event_date")))
    return (checked("fact", fact, star.FACT_KEY)
            .unionByName(checked("dimension", dimension, star.DIMENSION_KEY))
            .unionByName(checked("fact with gaps", gaps, star.FACT_KEY))
            .unionByName(checked("fact twice", fact.unionAll(fact), star.FACT_KEY)))


@query
def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema(spark, sf_dir)[0]


@query
def dim_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema(spark, sf_dir)[1]


@query
def high_risk_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(star.high_risk_owners(*star_schema(spark, sf_dir)), "avg_risk")


@query
def risk_by_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(star.risk_by_lifecycle(*star_schema(spark, sf_dir)), "avg_risk")


@query
def slo_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(star.slo_tracking(typed_bronze(spark, sf_dir)), "slo_share")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.silver_feature_metrics(typed_bronze(spark, sf_dir))


@query
def rolling_7d_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_silver(spark, sf_dir).select("feature_name", "event_date", "rolling_7d_avg_latency"), "rolling_7d_avg_latency")


@query
def rolling_7d_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_silver(spark, sf_dir).select("feature_name", "event_date", "rolling_7d_crash_rate"), "rolling_7d_crash_rate")


@query
def latency_dod_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_silver(spark, sf_dir).select("feature_name", "event_date", "latency_dod_change"), "latency_dod_change")


@query
def recency_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select("feature_name", "event_date", "recency_rank")


@query
def silver_feature_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = ["rolling_7d_avg_latency", "rolling_7d_crash_rate", "latency_dod_change"]
    return rounded(_silver(spark, sf_dir).drop("_silver_loaded_at"), *_DAILY_MEANS, *windows)


@query
def silver_null_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window with a day that is not known, which comes last."""
    k = F.col("k")
    events = keyed_events(spark, sf_dir).withColumn("timestamp", F.when(k != 47, F.col("timestamp"))).drop("k", "event_id")
    silver = rollup.silver_feature_metrics(layers.bronze_typed_view(events))
    windows = ["rolling_7d_avg_latency", "rolling_7d_crash_rate", "latency_dod_change"]
    return rounded(silver.select("feature_name", "event_date", "usage_count", *windows, "recency_rank"), *windows)


@query
def fact_rolling_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(star.fact_rolling_latency(star_schema(spark, sf_dir)[0]), "rolling_7d_latency")


@query
def daily_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    trends = rollup.daily_trends(telemetry(spark, sf_dir))
    return rounded(trends, "avg_latency_ms", "avg_feedback", "latency_trend", "feedback_trend")


# ---- drift -------------------------------------------------------------------------------

def _changes(spark: SparkSession, sf_dir: str, shift: float) -> DataFrame:
    before, after = drift_sides(spark, sf_dir, shift)
    return drift.drift_pct_change(drift.current_means(after), rollup.baseline_stats(before))


@query
def drift_pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_changes(spark, sf_dir, 1.5), "baseline", "current", "pct_change")


@query
def drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift_psi(*drift_sides(spark, sf_dir)).drop("severity")


@query
def psi_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift_psi(*drift_sides(spark, sf_dir, 2.5)).select("metric", "psi", "severity")


@query
def drift_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift_ks(*drift_sides(spark, sf_dir, 1.5)).drop("note")


@query
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = drift_sides(spark, sf_dir, 1.5)
    report = drift.detect_data_drift(after, rollup.baseline_stats(before), baseline_events=before)
    return report.select(F.array_join("alerts", " | ").alias("alerts"), "alert_count", "overall_drift_detected")


@query
def drift_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a saved baseline: its means and its counted values, not the events they came from."""
    path = shared_path(spark, "baseline")
    before, after = drift_sides(spark, sf_dir, 2.5)
    reports.save_baseline(rollup.baseline_stats(before), f"{path}/stats")
    reports.save_baseline_values(drift.counted_values(before), f"{path}/values")
    changes = drift.drift_pct_change(drift.current_means(after), reports.baseline_read(spark, f"{path}/stats"))
    counts = drift.merged_counts(reports.baseline_values(spark, f"{path}/values"), drift.counted_values(after))
    report = drift.distribution_report(changes, counts)
    return report.select(F.array_join("alerts", " | ").alias("alerts"), "alert_count", "overall_drift_detected")


@query
def drift_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run: nothing saved, so the statistics become the baseline and no alert is raised."""
    path = shared_path(spark, "baseline")
    current = rollup.baseline_stats(telemetry(spark, sf_dir))
    if reports.baseline_read(spark, path) is None:
        reports.save_baseline(current, path)
    saved = rounded(reports.baseline_read(spark, path), *[n for n in reports.BASELINE.fieldNames() if n != "row_count"])
    report = drift.empty_drift_report(saved).first()
    return saved.withColumns({
        "alerts": F.lit(len(report.alerts)),
        "alert_count": F.lit(report.alert_count).cast("long"),
        "overall_drift_detected": F.lit(report.overall_drift_detected),
    })


# ---- streaming ---------------------------------------------------------------------------

def event_json(spark: SparkSession, sf_dir: str, streaming: bool) -> DataFrame:
    """The events table as JSON values, as they would come from a topic; ``k = 13`` is cut short."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream if streaming else spark.read
    events = source.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")
    event = F.struct(
        F.concat(F.lit("evt_"), F.col("event_id")).alias("event_id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("user_id"),
        F.col("event_type").alias("feature_name"),
        (10 + (F.col("event_id") * 7919) % 590).cast("double").alias("session_duration"),
        F.round(F.col("value") * 10.0, 2).alias("latency_ms"),
        F.when(k < 5, 1).otherwise(0).alias("crash_flag"),
        (k % 7).alias("error_count"),
        (1.0 + (k % 9) * 0.5).cast("double").alias("feedback_score"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.element_at(F.array(F.lit("us-east-1"), F.lit("us-west-2"), F.lit("eu-west-1")), k % 3 + 1).alias("region"),
        F.element_at(F.array(F.lit("ios"), F.lit("android"), F.lit("web")), k % 3 + 1).alias("platform"),
        F.lit("3.1.0").alias("app_version"),
    )
    text = F.to_json(event, {"ignoreNullFields": "false"})
    return events.select("event_id", "event_type", F.when(k == 13, F.lit('{"event_id": "cut')).otherwise(text).alias("value"))


@query
def kafka_read_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parser on the values of the table; whole rows."""
    return stream.parse_events(event_json(spark, sf_dir, streaming=False))


@query
def stream_bronze_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs at one checkpoint: the second finds nothing new and adds nothing."""
    lake, checkpoint = shared_path(spark, "lake"), shared_path(spark, "stream-checkpoint")
    for _ in range(2):
        stream.stream_bronze_sink(event_json(spark, sf_dir, streaming=True), lake, checkpoint)
    return streamed(spark, lake)


def streamed(spark: SparkSession, lake: str) -> DataFrame:
    rows = layers.read_bronze_stream(spark, lake)
    same_day = (F.col("_partition_date") == F.col("date")) & (F.substring("_ingested_at", 1, 10) == F.col("date"))
    return rows.groupBy("feature_name", "_source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(stream.CORRUPT).alias("corrupt"),
        F.countDistinct("event_id").alias("event_ids"),
        F.round(F.sum("latency_ms"), 2).alias("latency_sum"),
        F.count_if(~same_day).alias("other_day"),
    )


@query
def archive_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as an archived topic of four partitions, replayed into Bronze: a run bounded to half of
    the messages, a run that fails within its batch, and runs from its checkpoint until nothing is left."""
    path, lake, checkpoint = (shared_path(spark, name) for name in ("topic", "lake", "stream-checkpoint"))
    messages = event_json(spark, sf_dir, streaming=False).select(
        (F.col("event_id") % 4).cast("int").alias("partition"), F.floor(F.col("event_id") / 4).alias("offset"),
        F.col("event_type").alias("key"), "value", F.lit(None).cast("timestamp").alias("timestamp"))
    archive.write_archive(messages, path)
    half = (spark.read.parquet(path).count() + 1) // 2
    source = lambda: archive.archive_source(spark, path, half, checkpoint)
    stream.stream_bronze_sink(source(), lake, checkpoint)
    first_run = layers.read_bronze_stream(spark, lake).count()
    lost = F.when(F.col("partition") == 3, F.raise_error(F.lit("planted failure"))).otherwise(F.col("value"))
    try:
        stream.stream_bronze_sink(source().withColumn("value", lost), lake, checkpoint)
    except StreamingQueryException:
        pass
    after_failure = layers.read_bronze_stream(spark, lake).count()
    while stream.stream_bronze_sink(source(), lake, checkpoint):
        pass
    return streamed(spark, lake).withColumns({
        "first_run": F.lit(first_run).cast("long"), "after_failure": F.lit(after_failure).cast("long")})


@query
def csv_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, lake = shared_path(spark, "raw-csv"), shared_path(spark, "lake")
    events = telemetry(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    layers.export_csv(events, path)
    stream.csv_fallback(spark, path, lake)
    return layers.read_bronze(spark, lake).select(*RAW_EVENT.fieldNames(), "_layer")


@query
def kafka_write_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream.parse_events(event_json(spark, sf_dir, streaming=False)).filter(F.col(stream.CORRUPT).isNull())
    return stream.kafka_records(events.select(*STREAM_EVENT.fieldNames()))


# ---- risk: labels, splits, metrics -------------------------------------------------------

@query
def risk_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_days(spark, sf_dir)


@query
def clean_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infinite latency, NaN crash rate and null feedback planted on some days."""
    days = feature_days(spark, sf_dir).withColumn("day", F.day(F.to_date("date")))
    planted = days.withColumns({
        "avg_latency": F.when(F.col("day") == 3, float("inf")).when(F.col("day") == 4, float("-inf")).otherwise(F.col("avg_latency")),
        "crash_rate": F.when(F.col("day") == 5, float("nan")).otherwise(F.col("crash_rate")),
        "avg_feedback": F.when(F.col("day") != 6, F.col("avg_feedback")),
    })
    return risk.clean_features(planted).drop("day")


@query
def robust_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = risk.clean_features(feature_days(spark, sf_dir))
    scaled = risk.robust_scale(days, risk.robust_scaling(days))
    return rounded(scaled.select("feature_name", "date", *[f"scaled_{c}" for c in RISK_FEATURES]),
                   *[f"scaled_{c}" for c in RISK_FEATURES])


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On events, by crash flag."""
    events = keyed_events(spark, sf_dir)
    split = risk.stratified_split(events, "crash_flag", draw(F.col("event_id"), 42))
    return split.select("event_id", "crash_flag", "is_test")


@query
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = risk.stratified_folds(keyed_events(spark, sf_dir), "crash_flag", draw(F.col("event_id"), 43), 5)
    return folds.groupBy("fold", "crash_flag").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("id_sum")
    )


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(risk.class_weights(labelled_days(spark, sf_dir), "is_high_risk"), "weight")


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a coarse score, so that many rows tie; the label is the crash flag."""
    score = F.floor(F.col("latency_ms") / 50.0) + F.when(F.col("error_count") < 5, 3).otherwise(0)
    return telemetry(spark, sf_dir).select(
        F.col("crash_flag").alias("label"),
        score.cast("double").alias("score"),
        (score > 14).cast("int").alias("predicted"),
    )


@query
def eval_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluate.ranking_metrics(scored_events(spark, sf_dir))
    return rounded(metrics.select("positives", "negatives", "roc_auc"), "roc_auc")


@query
def eval_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluate.ranking_metrics(scored_events(spark, sf_dir))
    return rounded(metrics.select("positives", "average_precision"), "average_precision")


@query
def eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(evaluate.confusion_counts(scored_events(spark, sf_dir)))


@query
def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = evaluate.confusion_counts(scored_events(spark, sf_dir))
    return rounded(evaluate.accuracy(counts), "accuracy", "positive_rate")


@query
def eval_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = evaluate.confusion_counts(scored_events(spark, sf_dir))
    return rounded(evaluate.class_report(counts), "precision", "recall", "f1")


# ---- risk model (rows only: forests differ between libraries) ----------------------------

@lru_cache(maxsize=4)
def _trained(sf_dir: str, app: str) -> tuple[DataFrame, forest.TrainedRisk]:
    """One fit per table set and session, shared by the model queries."""
    spark = SparkSession.active()
    labelled = materialize(labelled_days(spark, sf_dir), "labelled-days")
    return labelled, forest.train_risk_model(labelled, cross_validate=False)


def trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, forest.TrainedRisk]:
    return _trained(sf_dir, spark.sparkContext.applicationId)


@query
def train_risk_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fitted = trained(spark, sf_dir)
    names = ["roc_auc", "average_precision", "accuracy", "positive_rate", "train_rows", "test_rows"]
    return spark.range(1).select(*[F.lit(fitted.metrics[n]).alias(n) for n in names])


@query
def cv_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.cv_auc(trained(spark, sf_dir)[0])


@query
def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled, fitted = trained(spark, sf_dir)
    return forest.score_rows(labelled, fitted.model)


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trained(spark, sf_dir)[1].importance


@query
def importance_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.importance_sorted(trained(spark, sf_dir)[1].importance)


@query
def mean_abs_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled, fitted = trained(spark, sf_dir)
    return forest.mean_abs_attribution(labelled, fitted.model)


@query
def training_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a training run reports that does not depend on the forest: rows of either part, and positives."""
    _, fitted = trained(spark, sf_dir)
    tn_fp, fn_tp = fitted.metrics["confusion_matrix"]
    figures = {"train_rows": fitted.metrics["train_rows"], "test_rows": fitted.metrics["test_rows"],
               "test_positives": sum(fn_tp), "test_negatives": sum(tn_fp)}
    share = F.round(F.lit(fitted.metrics["positive_rate"]), 6).alias("positive_rate")
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in figures.items()], share)


@query
def importance_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per importance in the served order, its place, and whether none before is larger; their sum."""
    rows = serving.importance_sorted(trained(spark, sf_dir)[1].importance).collect()
    values = [r.importance for r in rows]
    lines = [(i, a >= b, abs(sum(values) - 1) < 1e-9, a >= 0) for i, (a, b) in enumerate(zip(values, [0.0, *values]), 1)]
    return spark.createDataFrame(lines, "place int, rising boolean, sums_to_one boolean, not_negative boolean")


@query
def scored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scored per feature, their labels, and whether prediction and probability agree on all."""
    labelled, fitted = trained(spark, sf_dir)
    scored = forest.score_rows(labelled, fitted.model)
    side = (F.col("risk_probability") > 0.5).cast("int") == F.col("risk_label")
    return scored.groupBy("feature_name").agg(
        F.count("risk_probability").alias("scored"), F.sum("is_high_risk").alias("high_risk"),
        F.bool_and(side | (F.col("risk_probability") == 0.5)).alias("agree"))


@query
def logged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run logged with figures of the scored events, read back from the run table."""
    scored = scored_events(spark, sf_dir)
    cells = evaluate.confusion_counts(scored).first()
    ranking = evaluate.ranking_metrics(scored).first()
    metrics = {"roc_auc": ranking.roc_auc, "accuracy": (cells.tn + cells.tp) / sum(cells), "test_rows": sum(cells),
               "confusion_matrix": [[cells.tn, cells.fp], [cells.fn, cells.tp]]}
    path = shared_path(spark, "runs")
    runs.log_training_run(spark, path, metrics, risk.RiskConfig(), "model", "events")
    logged = F.col("metrics")
    names = ["test_rows", "true_negatives", "false_positives", "false_negatives", "true_positives"]
    return runs.read_runs(spark, path).select(
        "run_name", *[logged[n].alias(n) for n in names], F.round(logged["roc_auc"], 6).alias("roc_auc"),
        F.round(logged["accuracy"], 6).alias("accuracy"), F.col("params")["trees"].alias("trees"), F.col("tags")["model_type"].alias("model_type"))


@query
def row_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feature-day, whether the attributions add up to its probability less the forest's mean."""
    labelled, fitted = trained(spark, sf_dir)
    keys, names = ["feature_name", "date"], fitted.metrics["feature_cols"]
    phis = forest.row_attribution(labelled, fitted.model, keys, names)
    scores = forest.score_rows(labelled, fitted.model).select(*keys, "risk_probability")
    total = reduce(add, [F.col(f"phi_{c}") for c in names], F.lit(forest.forest_mean(fitted.model, len(names))))
    return scores.join(phis, keys).select(*keys, (F.abs(total - F.col("risk_probability")) < 1e-9).alias("adds_up"))


@query
def save_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved, loaded again, and scored with the loaded model: per feature-day, whether the scores agree."""
    labelled, fitted = trained(spark, sf_dir)
    path = shared_path(spark, "model")
    forest.save_model(fitted.model, path)
    keys = ["feature_name", "date"]
    before = forest.score_rows(labelled, fitted.model).select(*keys, F.col("risk_probability").alias("before"))
    after = forest.score_rows(labelled, forest.load_model(path)).select(*keys, F.col("risk_probability").alias("after"))
    return before.join(after, keys).select(*keys, (F.col("before") == F.col("after")).alias("same"))


@query
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fitted = trained(spark, sf_dir)
    path = shared_path(spark, "runs")
    runs.log_training_run(spark, path, fitted.metrics, risk.RiskConfig(), shared_path(spark, "model"))
    return runs.read_runs(spark, path).select(
        "run_name", F.col("metrics")["roc_auc"].alias("roc_auc"), F.col("params")["trees"].alias("trees")
    )


@query
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each feature's mean crash rate plays the AUC of one logged run."""
    scores = rounded(telemetry(spark, sf_dir).groupBy("feature_name").agg(F.avg("crash_flag").alias("auc")), "auc")
    logged = scores.select(
        F.concat(F.lit("run-"), "feature_name").alias("run_id"),
        F.col("feature_name").alias("run_name"),
        F.lit("2024-02-01").cast("timestamp").alias("started_at"),
        F.create_map(F.lit("roc_auc"), F.col("auc")).alias("metrics"),
    )
    return runs.best_run(logged).select("run_id", "run_name", F.col("metrics")["roc_auc"].alias("roc_auc"))


# ---- serving -----------------------------------------------------------------------------

def scored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature cards with a spread of probabilities over all tiers, from the events themselves."""
    summary = rollup.feature_summary(telemetry(spark, sf_dir))
    probability = F.round((F.col("avg_latency_ms") * 7 % 97) / 97.0, 4)
    return rounded(summary, "avg_latency_ms", "crash_rate", "avg_error_count", "avg_feedback_score").withColumn(
        "risk_probability", probability
    )


def user_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cards with users in the place of features, for more rows."""
    events = telemetry(spark, sf_dir).withColumn("feature_name", F.concat(F.lit("user-"), "user_id"))
    summary = rollup.feature_summary(events)
    return rounded(summary, "avg_latency_ms", "crash_rate", "avg_error_count", "avg_feedback_score").withColumn(
        "risk_probability", F.round(F.col("usage_count") % 23 / 23.0, 4)
    )


@query
def kpi_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = user_cards(spark, sf_dir)
    return rounded(serving.kpi_overview(cards, 0.9, 91.7), "avg_latency", "avg_quality")


@query
def risk_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.risk_ranking(user_cards(spark, sf_dir)).select("feature_name", "risk_probability", "risk_tier")


@query
def risk_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = serving.risk_ranking(user_cards(spark, sf_dir))
    return ranked.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("features"), F.min("risk_probability").alias("lowest"), F.max("risk_probability").alias("highest")
    )


@query
def risk_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.risk_recommendations(user_cards(spark, sf_dir))


@query
def feature_deep_dive(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = rounded(rollup.feature_summary(telemetry(spark, sf_dir)), "avg_latency_ms", "crash_rate", "avg_feedback_score")
    scored = cards.withColumn("risk_probability", F.round(F.col("crash_rate") * 10, 4))
    return serving.feature_deep_dive(scored, "purchase")


@query
def feature_deep_dive_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From rows per day: the card shows the last one."""
    scored = feature_days(spark, sf_dir).withColumn("risk_probability", F.round(F.col("crash_rate") * 10, 4))
    return serving.feature_deep_dive(scored, "purchase")


@query
def feature_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trends = serving.feature_trend(rollup.daily_trends(telemetry(spark, sf_dir)), "purchase")
    return rounded(trends, "avg_latency_ms", "avg_feedback", "latency_trend", "feedback_trend")


@query
def drift_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.drift_status(_changes(spark, sf_dir, 1.15)), "change_pct")


@query
def pipeline_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.pipeline_status(run_figures(spark, sf_dir))


def run_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run report from the events: rows, quality score, drift alerts, high-risk days."""
    events = telemetry(spark, sf_dir)
    report = quality.dq_report(quality.run_suite(events)).first()
    alerts = _changes(spark, sf_dir, 1.5).filter("alert").count()
    days = labelled_days(spark, sf_dir)
    return days.agg(
        F.lit("success").alias("status"),
        F.sum("usage_count").alias("rows_ingested"),
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(F.col("is_high_risk") == 1).alias("high_risk_features"),
        F.lit(report.score_pct).alias("quality_score_pct"),
        F.lit(report.passed).cast("long").alias("quality_checks_passed"),
        F.lit(alerts).cast("long").alias("drift_alerts"),
    )


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary row written as JSON and read back."""
    path = shared_path(spark, "run-report")
    summary = run_figures(spark, sf_dir)
    reports.json_report_sink(summary, path)
    return spark.read.schema(summary.schema).json(path)


@query
def end_to_end_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to scored feature-days through all steps, with latency held below the spike gate.

    The probability depends on the forest's library, so only its range comes out.
    """
    root = shared_path(spark, "run")
    bounded = raw.clip_range(telemetry(spark, sf_dir), {"latency_ms": (0.0, 5000.0)})
    layers.export_csv(bounded, f"{root}/raw")
    config = pipeline.PipelineConfig(f"{root}/lake")
    scored = pipeline.run(spark, f"{root}/raw", config).scored
    means = [c for c in RISK_FEATURES if c != "usage_count"]
    return rounded(scored, *means).select(
        "feature_name", "date", *RISK_FEATURES, "is_high_risk", F.col("risk_probability").between(0, 1).alias("scored")
    )


@query
def gate_stops_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency above the spike gate: the run fails after Bronze, says so in its report, and scores nothing."""
    root = shared_path(spark, "run")
    lifted = telemetry(spark, sf_dir).withColumn("latency_ms", F.col("latency_ms") + 5000)
    layers.export_csv(lifted, f"{root}/raw")
    try:
        pipeline.run(spark, f"{root}/raw", pipeline.PipelineConfig(f"{root}/lake"))
    except quality.QualityGateError:
        pass  # what the report says of it is the result
    report = spark.read.schema("status string, rows_processed long, error string").json(f"{root}/lake/reports/run_report")
    landed = layers.read_bronze(spark, f"{root}/lake").agg(F.count(F.lit(1)).alias("landed"))
    files = layers.layer_inventory(spark, f"{root}/lake").filter("layer = 'silver'").select(F.col("files").alias("silver_files"))
    return report.join(landed).join(files)  # one row each
