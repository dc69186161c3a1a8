"""Reading raw events, and the preparation steps that bring a foreign log into raw shape."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.expressions import clip
from tidegauge.functions.selection import order_statistics
from tidegauge.schema import MISSING_WORDS, RAW_EVENT
from tidegauge.session import materialize

HEADER_READERS = 16


def read_raw_csv(spark: SparkSession, path: str, typed: bool = True) -> DataFrame:
    """Header CSV of raw events, by column name in any order; further columns are kept as text.

    Files may differ in their headers: those of one header are read together, the groups are united
    by name, and a column that a file lacks is null in its rows. A missing path is an
    ``AnalysisException``. Words for missing values become null. ``typed=False`` keeps every column
    as text, so that validation can count what it coerces.
    """
    groups = _files_by_header(spark, path)
    parts = []
    for files in groups:
        named = spark.read.option("header", True).csv(files[0]).schema
        # Every file must still agree with its group's names, else reading fails.
        parts.append(spark.read.schema(named).option("header", True).option("enforceSchema", False).csv(files))
    rows = union_files(parts) if parts else spark.read.option("header", True).csv(path)
    rows = rows.select([
        F.when(~F.col(f"`{c}`").isin(MISSING_WORDS), F.col(f"`{c}`")).alias(c) for c in rows.columns
    ])
    return typed_raw(rows) if typed else rows


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a path, grouped by their first line; empty files are left out.

    The driver reads one line of each file, through the store that holds it and the file's codec.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(name: str) -> str | None:
        file = jvm.org.apache.hadoop.fs.Path(name)
        stream, codec = file.getFileSystem(conf).open(file), codecs.getCodec(file)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    listed = sorted(spark.read.text(path).inputFiles())
    files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)).toString() for name in listed]
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(header, files))
    groups: dict[str, list[str]] = {}
    for name, line in zip(files, headers):
        if line:
            groups.setdefault(line, []).append(name)
    return list(groups.values())


def typed_raw(rows: DataFrame) -> DataFrame:
    """The raw columns of a text frame with their types; what does not parse is null."""
    casts = {}
    for field in RAW_EVENT:
        if field.name in rows.columns and field.dataType != T.StringType():
            number = F.col(field.name).try_cast("double")
            number = F.when(~F.isnan(number), number)
            whole = F.when(number == F.floor(number), number).try_cast("int")  # "1.0" is an int with gaps
            casts[field.name] = number if field.dataType == T.DoubleType() else whole
    return rows.withColumns(casts)


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column that a frame lacks is null in its rows."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def drop_incomplete(df: DataFrame, columns: Sequence[str] = ("event_time", "user_id", "event_type")) -> DataFrame:
    return df.dropna(subset=list(columns))


def sample_n(df: DataFrame, n: int, order: Column) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: those with the smallest ``order``.

    ``order`` is a reproducible pseudo-random key, e.g. ``xxhash64(id, seed)``. The n-th
    smallest key is found by counting, after which the sample is a plain filter; nothing is
    sorted or gathered. Rows that tie with that key, and rows without a key, which come last, are
    taken by a hash of their content in the same way, so a rerun draws the same ones. Only rows that
    agree in that too are told apart by their place in a written copy.
    """
    content = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    return _smallest(df, n, [order, content])


def _smallest(df: DataFrame, n: int, orders: Sequence[Column]) -> DataFrame:
    if n <= 0:
        return df.limit(0)
    if not orders:
        line = "_line"
        while line in df.columns:
            line = f"_{line}"
        written = materialize(df.withColumn(line, F.monotonically_increasing_id()), "sample-ties")
        return _smallest(written, n, [F.col(line)]).drop(line)
    order, *rest = orders
    total, rows = df.agg(F.count(order), F.count(F.lit(1))).first()
    if n >= rows:
        return df
    if n >= total:
        return df.filter(order.isNotNull()).unionAll(_smallest(df.filter(order.isNull()), n - total, rest))
    cut = order_statistics(df, [(order, n - 1, total)])[0]
    under, ties = df.agg(F.count_if(order < F.lit(cut)), F.count_if(order == F.lit(cut))).first()
    if under + ties == n:
        return df.filter(order <= F.lit(cut))
    return df.filter(order < F.lit(cut)).unionAll(_smallest(df.filter(order == F.lit(cut)), n - under, rest))


# Category prefixes (checked in this order), first words, and fallback names.
CATEGORY_PREFIXES = [
    ("electronics.smartphone", "Payments"),
    ("electronics.audio", "VideoPlayback"),
    ("electronics.tablet", "Search"),
    ("electronics.laptop", "Recommendations"),
    ("computers.notebook", "Recommendations"),
    ("computers.desktop", "Search"),
    ("appliances.kitchen", "Login"),
    ("appliances.environment", "Login"),
    ("sport.trainer", "Search"),
    ("kids.toys", "Recommendations"),
]
CATEGORY_WORDS = {
    "electronics": "VideoPlayback",
    "computers": "Recommendations",
    "appliances": "Login",
    "sport": "Search",
    "kids": "Recommendations",
    "auto": "Payments",
    "furniture": "Search",
    "medicine": "Login",
    "construction": "Payments",
    "clothing": "Search",
}
FALLBACK_UNKNOWN = ["Login", "Payments", "VideoPlayback"]
FALLBACK_NULL = ["Login", "Payments", "VideoPlayback", "Recommendations", "Search"]


def map_category(code: Column, pick: Column) -> Column:
    """Feature name of a category code: prefix, else first dotted word, else a picked name.

    ``pick`` is a non-negative integer that stands in for a random draw, so a rerun and a
    retried task give the same name.
    """
    def choose(names: Sequence[str]) -> Column:
        options = F.array(*[F.lit(n) for n in names])
        return F.get(options, (pick % len(names)).cast("int"))

    name = F.when(code.isNull(), choose(FALLBACK_NULL))
    for prefix, feature in CATEGORY_PREFIXES:
        name = name.when(code.startswith(prefix), F.lit(feature))
    word = F.split_part(code, F.lit("."), F.lit(1))
    for first, feature in CATEGORY_WORDS.items():
        name = name.when(word == first, F.lit(feature))
    return name.otherwise(choose(FALLBACK_UNKNOWN))


def clean_timestamp(df: DataFrame, source: str = "event_time", target: str = "timestamp") -> DataFrame:
    """Strip the " UTC" mark, parse, and drop rows that do not parse."""
    parsed = F.try_to_timestamp(F.regexp_replace(F.col(source), " UTC", "")).cast("timestamp_ntz")
    return df.withColumn(target, parsed).dropna(subset=[target])


def spread_days(moment: Column, pick: Column, days: int = 30) -> Column:
    """Move a timestamp by ``pick % days`` whole days and format it to seconds."""
    moved = moment + F.make_dt_interval(days=(pick % days).cast("int"))
    return F.date_format(moved, "yyyy-MM-dd HH:mm:ss")


def clip_range(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({name: clip(F.col(name), low, high) for name, (low, high) in limits.items()})


def project_raw_schema(df: DataFrame) -> DataFrame:
    """The raw columns in raw order, user_id as text; other columns are left out."""
    return df.select(F.col("user_id").cast("string").alias("user_id"), *RAW_EVENT.fieldNames()[1:])


def profile_raw(df: DataFrame) -> DataFrame:
    """Rows, crash rate, mean latency and feedback, and time range: per feature and in total.

    The total (feature_name null, ``is_total``) is summed up from the grouped rows, so the
    table is aggregated once.
    """
    means = {"crash_flag": "crash_rate", "latency_ms": "avg_latency", "feedback_score": "avg_feedback"}
    parts = [f"{kind}_{c}" for c in means for kind in ("sum", "n")]
    per_feature = df.groupBy("feature_name").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in means],
        *[F.count(c).alias(f"n_{c}") for c in means],
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )
    # Each grouped row also counts towards the total; the table itself is read once.
    both = per_feature.withColumn("is_total", F.explode(F.array(F.lit(False), F.lit(True))))
    feature = F.when(~F.col("is_total"), F.col("feature_name")).alias("feature_name")
    summed = both.groupBy("is_total", feature).agg(
        F.sum("rows").alias("rows"),
        *[F.sum(c).alias(c) for c in parts],
        F.min("first_timestamp").alias("first_timestamp"),
        F.max("last_timestamp").alias("last_timestamp"),
    )
    return summed.select(
        "is_total", "feature_name", "rows",
        *[F.try_divide(f"sum_{c}", f"n_{c}").alias(name) for c, name in means.items()],
        "first_timestamp", "last_timestamp",
    )


def text_frame(df: DataFrame) -> DataFrame:
    """Every column as text, the shape in which a CSV arrives."""
    return df.select([
        c if isinstance(df.schema[c].dataType, T.StringType) else F.col(c).cast("string").alias(c)
        for c in df.columns
    ])
