from __future__ import annotations

import gzip
import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from tidegauge import session
from tidegauge.operators.validate import ValidationError
from tidegauge.plans import catalog
from tidegauge.schema import RAW_EVENT, STREAM_EVENT
from tidegauge.sources import layers, raw, reports
from tidegauge.streaming import archive
from tidegauge.streaming import bronze as stream


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("user_id,feature_name,session_duration,latency_ms,crash_flag,error_count,feedback_score,timestamp\n"
                    "7,search,10,NaN,0,1,,2025-01-01 00:00:00\n")
    row = raw.read_raw_csv(spark, str(path)).first()
    assert row.user_id == "7" and row.latency_ms is None and row.feedback_score is None
    assert raw.read_raw_csv(spark, str(path), typed=False).dtypes == [(f.name, "string") for f in RAW_EVENT]
    with pytest.raises(AnalysisException):
        raw.read_raw_csv(spark, str(tmp_path / "none.csv"))


def test_csv_by_name_with_further_columns_and_odd_values(spark, tmp_path):
    path, lake = tmp_path / "raw.csv", str(tmp_path / "lake")
    path.write_text("timestamp,region,user_id,feature_name,latency_ms,crash_flag,error_count,feedback_score,session_duration\n"
                    "2025-01-01 00:00:00,eu,u1,search,n/a,1.0,2,oops,NaN\n"
                    "2025-01-01 01:00:00,us,u2,NULL,5,0.5,NA,4,3\n")
    rows = raw.read_raw_csv(spark, str(path)).orderBy("timestamp").collect()
    assert [r.user_id for r in rows] == ["u1", "u2"] and [r.region for r in rows] == ["eu", "us"]
    assert [r.crash_flag for r in rows] == [1, None] and [r.latency_ms for r in rows] == [None, 5.0]
    assert rows[1].feature_name is None and rows[1].error_count is None and rows[0].session_duration is None
    stream.csv_fallback(spark, str(path), lake)
    kept = layers.read_bronze(spark, lake, typed=False, further=["region"]).orderBy("timestamp").collect()
    assert [r.feedback_score for r in kept] == ["oops", "4"] and [r.crash_flag for r in kept] == ["1.0", "0.5"]
    assert [r.region for r in kept] == ["eu", "us"]
    assert layers.read_bronze(spark, lake).dtypes[2] == ("session_duration", "double")


def test_files_of_other_headers_are_united_by_name(spark, tmp_path):
    folder = tmp_path / "one folder"
    folder.mkdir()
    (folder / "a.csv").write_text("user_id,feature_name,latency_ms\nu,f,1.5\nv,f,NA\n")
    (folder / "b.csv").write_text("feature_name,user_id,extra\ng,w,x\n")
    with gzip.open(folder / "c.csv.gz", "wt") as packed:
        packed.write("user_id,feature_name,latency_ms\nz,h,2\n")
    (folder / "empty.csv").write_text("")
    (folder / "bare.csv").write_text("latency_ms,feature_name\n")
    rows = raw.read_raw_csv(spark, str(folder))
    assert set(rows.columns) == {"user_id", "feature_name", "latency_ms", "extra"}
    got = sorted(map(tuple, rows.select("user_id", "feature_name", "latency_ms", "extra").collect()))
    assert got == [("u", "f", 1.5, None), ("v", "f", None, None), ("w", "g", None, "x"), ("z", "h", 2.0, None)]


def test_many_files_of_one_header_are_one_scan(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(40):
        (folder / f"{i}.csv").write_text(f"user_id,feature_name\nu{i},f\n")
    rows = raw.read_raw_csv(spark, str(folder), typed=False)
    assert rows.count() == 40 and rows._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_a_missing_path_or_column_is_refused(spark, tmp_path):
    with pytest.raises(AnalysisException):
        raw.read_raw_csv(spark, str(tmp_path / "nowhere"))
    (tmp_path / "a.csv").write_text("user_id,feature_name\nu,f\n")
    with pytest.raises(ValidationError, match="missing required columns"):
        stream.csv_fallback(spark, str(tmp_path / "a.csv"), str(tmp_path / "lake"))


@pytest.mark.parametrize("n", [0, 1, 7, 10, 23, 25, 39, 40, 50])
def test_sample_with_ties_is_exact_and_repeats(spark, n):
    """A key of three values, rows without a key, and a row that occurs ten times."""
    rows = [(i % 3 if i % 5 else None, f"t{i}", None) for i in range(30)] + [(1, "same", 2.0)] * 10
    df = spark.createDataFrame(rows, "key int, text string, x double")
    first = sorted(map(tuple, raw.sample_n(df.repartition(3), n, F.col("key")).collect()), key=str)
    again = sorted(map(tuple, raw.sample_n(df.repartition(5, "text"), n, F.col("key")).collect()), key=str)
    assert first == again and len(first) == min(n, 40)
    keys = sorted((3 if k is None else k for k, _, _ in rows))[:n]
    assert sorted(3 if k is None else k for k, _, _ in first) == keys
    assert len({r for r in first if r[1] != "same"}) == len([r for r in first if r[1] != "same"])


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "y int, z int")
    assert sorted(raw.union_files([a, b]).collect(), key=str) == [(1, 2, None), (None, 3, 4)]


def test_category_mapping(spark):
    codes = ["electronics.smartphone.x", "electronics.audio", "electronics.video", "computers.desktop", "toys.kids", None]
    df = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "code string, pick int")
    names = [r[0] for r in df.select(raw.map_category(F.col("code"), F.col("pick"))).collect()]
    assert names == ["Payments", "VideoPlayback", "VideoPlayback", "Search", "Payments", "Login"]


def test_clipping_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.5,), (5.5,), (3.0,)], "x double")
    assert [r.x for r in raw.clip_range(df, {"x": (1.0, 5.0)}).collect()] == [None, 1.0, 5.0, 3.0]


def test_clean_and_spread(spark):
    df = spark.createDataFrame([("2019-10-01 00:00:00 UTC", 31), ("soon", 1), (None, 1)], "event_time string, pick int")
    rows = raw.clean_timestamp(df).select(raw.spread_days(F.col("timestamp"), F.col("pick"))).collect()
    assert [r[0] for r in rows] == ["2019-10-02 00:00:00"]


def test_bronze_grows_and_prunes(spark, events, tmp_path):
    lake = str(tmp_path)
    assert layers.read_bronze(spark, lake).count() == 0
    layers.bronze_append(events({}), lake, "a.csv")
    layers.bronze_append(events({}, {}), lake, "b.csv")
    rows = layers.read_bronze(spark, lake)
    assert rows.count() == 3 and rows.select("_layer").distinct().collect() == [("bronze",)]
    day = rows.first().date
    assert layers.read_bronze(spark, lake, day).count() == 3
    assert layers.read_bronze(spark, lake, "1999-01-01").count() == 0
    plan = layers.read_bronze(spark, lake, day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_older_bronze_files_lack_columns(spark, events, tmp_path):
    layers.bronze_append(events({}).drop("error_count"), str(tmp_path), "old.csv")
    assert layers.read_bronze(spark, str(tmp_path)).first().error_count is None


def test_silver_replaces_one_day(spark, tmp_path):
    for rows, day in ((3, "2025-01-01"), (5, "2025-01-02"), (2, "2025-01-02")):
        layers.silver_overwrite(spark.range(rows), str(tmp_path), "things", day)
    assert layers.read_silver(spark, str(tmp_path), "things").count() == 5
    assert layers.read_silver(spark, str(tmp_path), "things", "2025-01-02").count() == 2


def test_inventory(spark, events, tmp_path):
    lake = str(tmp_path)
    assert [r.files for r in layers.layer_inventory(spark, lake).collect()] == [0, 0, 0]
    layers.bronze_append(events({}).coalesce(1), lake, "a")
    found = {r.layer: r for r in layers.layer_inventory(spark, lake).collect()}
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert found["bronze"].files == 1 and found["bronze"].size_mb == pytest.approx(size / 1e6)
    assert layers.last_ingested(spark, lake).first()[0] is not None


def test_inventory_takes_few_tasks(spark, tmp_path, monkeypatch):
    """Files that would each be a task of their own are listed in a bounded number of tasks."""
    monkeypatch.setattr(layers, "INVENTORY_TASKS", 3)
    layers.bronze_append(spark.range(4000).repartition(40), str(tmp_path), "a")
    (tmp_path / "bronze" / "notes.txt").write_text("no data")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        listing = spark.newSession()
        listing.conf.set("spark.sql.files.maxPartitionNum", 3)
        listing.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        assert layers._listed(spark, str(tmp_path)).rdd.getNumPartitions() == 40
        assert layers._listed(listing, str(tmp_path)).rdd.getNumPartitions() <= 4
        found = {r.layer: (r.files, r.size_mb) for r in layers.layer_inventory(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert found == {"bronze": (40, pytest.approx(size / 1e6)), "silver": (0, 0.0), "gold": (0, 0.0)}


def test_inventory_loads_are_prepared_before_their_one_writer(spark, tmp_path, monkeypatch):
    """The single writing task of a load parses nothing and makes no text; all rows are in every file."""
    rows = [(i, datetime(2024, 1, 1 + i % 5), i % 3, "view" if i % 4 else None, i / 4, f'{{"k": {i}}}' if i % 7 else None) for i in range(60)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    loads = []

    def watched(write):
        def run(df, lake, *rest):
            plan = df._jdf.queryExecution().executedPlan().toString()
            loads.append((write.__name__, df.rdd.getNumPartitions(), df.count(), "get_json_object" in plan, "cast(" in plan))
            write(df, lake, *rest)
        return run

    monkeypatch.setattr(layers, "bronze_append", watched(layers.bronze_append))
    monkeypatch.setattr(layers, "silver_overwrite", watched(layers.silver_overwrite))
    found = {tuple(r) for r in catalog.layer_inventory(spark, str(tmp_path)).collect()}
    assert found == {("bronze", 3, True), ("silver", 2, True), ("gold", 0, True)}
    assert sorted(loads) == [("bronze_append", 1, 60, False, False)] * 3 + [("silver_overwrite", 1, 60, False, False)] * 2


def test_report_keeps_nulls(spark, tmp_path):
    path = str(tmp_path / "report")
    reports.json_report_sink(spark.createDataFrame([(1, None)], "a int, b string"), path)
    (file,) = [f for f in (tmp_path / "report").iterdir() if f.suffix == ".json"]
    assert json.loads(file.read_text()) == {"a": 1, "b": None}


def event(i, **over):
    row = {"event_id": f"evt_{i}", "user_id": "user_1", "feature_name": "search", "session_duration": 1.5, "latency_ms": 2.5,
           "crash_flag": 0, "error_count": 1, "feedback_score": 4.5, "timestamp": "2025-01-01T00:00:00+00:00",
           "region": "eu-west-1", "platform": "web", "app_version": "3.1.0"}
    return json.dumps({**row, **over})


def test_stream_continues_at_its_checkpoint(spark, tmp_path):
    inbox, lake, checkpoint = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "cp")
    inbox.mkdir()
    (inbox / "1.json").write_text("\n".join(event(i) for i in range(120)))
    source = lambda: stream.file_source(spark, str(inbox), max_files=1)
    stream.stream_bronze_sink(source(), lake, checkpoint)
    assert layers.read_bronze_stream(spark, lake).count() == 120
    stream.stream_bronze_sink(source(), lake, checkpoint)
    (inbox / "2.json").write_text("\n".join([event(500), '{"event_id": "cut', event(501, latency_ms=None)]))
    (inbox / "3.json").write_text(event(502))
    stream.stream_bronze_sink(source(), lake, checkpoint)
    rows = layers.read_bronze_stream(spark, lake)
    assert rows.count() == 124 and rows.filter("_corrupt_record IS NULL").select("event_id").distinct().count() == 123
    bad = rows.filter("_corrupt_record IS NOT NULL").first()
    assert bad._corrupt_record == '{"event_id": "cut' and bad._source == "kafka_consumer"
    assert rows.filter(F.col("_partition_date") != F.col("date")).count() == 0


def test_keyed_records_round_trip(spark):
    values = spark.createDataFrame([(event(1),), (event(2, feature_name="login"),)], "value string")
    events = stream.parse_events(values).select(*STREAM_EVENT.fieldNames())
    records = stream.kafka_records(events)
    assert [r.key for r in records.collect()] == ["search", "login"]
    assert stream.parse_events(records).select(*STREAM_EVENT.fieldNames()).collect() == events.collect()


def test_csv_fallback(spark, events, tmp_path):
    layers.export_csv(events({}, {}), str(tmp_path / "csv"))
    stream.csv_fallback(spark, str(tmp_path / "csv"), str(tmp_path / "lake"))
    assert layers.read_bronze(spark, str(tmp_path / "lake")).count() == 2


def test_csv_steps_in_for_a_missing_connector_or_an_empty_topic(spark, events, tmp_path, monkeypatch):
    lake, csv = str(tmp_path / "lake"), str(tmp_path / "csv")
    layers.export_csv(events({}), csv)
    assert stream.ingest_topic_or_csv(spark, "nowhere:1", lake, str(tmp_path / "cp0"), csv) == "csv"
    inbox = tmp_path / "in"
    inbox.mkdir()
    monkeypatch.setattr(stream, "kafka_source", lambda *a: stream.file_source(spark, str(inbox)))
    assert stream.ingest_topic_or_csv(spark, "any", lake, str(tmp_path / "cp"), csv) == "csv"
    assert layers.read_bronze(spark, lake).count() == 2
    (inbox / "1.json").write_text(event(1))
    assert stream.ingest_topic_or_csv(spark, "any", lake, str(tmp_path / "cp"), csv) == "stream"
    assert layers.read_bronze(spark, lake).count() == 3 and layers.read_bronze_stream(spark, lake).count() == 1
    assert layers.read_bronze(spark, lake).filter("_source = 'kafka_consumer'").first().latency_ms == 2.5


def archived(spark, path, sizes, first=0):
    """Events in partitions of the given sizes, offsets from ``first`` in steps of two (a compacted topic)."""
    rows = [(p, first + 2 * i, "search", event(1000 * p + first + 2 * i), None) for p, n in enumerate(sizes) for i in range(n)]
    archive.write_archive(spark.createDataFrame(rows, archive.MESSAGES), path)


def test_archived_topic_is_replayed_once(spark, tmp_path):
    path, lake, checkpoint = str(tmp_path / "topic"), str(tmp_path / "lake"), str(tmp_path / "cp")
    archived(spark, path, [60, 0, 7])
    assert stream.stream_bronze_sink(archive.archive_source(spark, path), lake, checkpoint)
    assert not stream.stream_bronze_sink(archive.archive_source(spark, path), lake, checkpoint)
    archived(spark, path, [5, 4, 0], first=500)
    assert stream.stream_bronze_sink(archive.archive_source(spark, path), lake, checkpoint)
    rows = layers.read_bronze_stream(spark, lake)
    assert rows.count() == 76 and rows.select("event_id").distinct().count() == 76


def test_a_failed_batch_is_replayed_with_its_offsets(spark, tmp_path):
    path, lake, checkpoint = str(tmp_path / "topic"), str(tmp_path / "lake"), str(tmp_path / "cp")
    position = tmp_path / "cp" / archive.POSITION
    archived(spark, path, [60, 30, 7])
    source = lambda: archive.archive_source(spark, path, 60, checkpoint)
    assert stream.stream_bronze_sink(source(), lake, checkpoint)
    done = layers.read_bronze_stream(spark, lake).count()
    assert 0 < done <= 60
    planned = json.loads(position.read_text())
    broken = source().withColumn("value", F.when(F.col("partition") == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(StreamingQueryException):
        stream.stream_bronze_sink(broken, lake, checkpoint)
    assert layers.read_bronze_stream(spark, lake).count() == done
    tried = json.loads(position.read_text())
    assert all(tried[p] >= planned[p] for p in planned) and tried != planned
    counts = []
    while stream.stream_bronze_sink(source(), lake, checkpoint):
        counts.append(layers.read_bronze_stream(spark, lake).count())
        assert len(counts) < 20
    steps = [b - a for a, b in zip([done, *counts], counts)]
    rows = layers.read_bronze_stream(spark, lake)
    assert rows.count() == 97 and rows.select("event_id").distinct().count() == 97
    assert all(0 < step <= 120 for step in steps)  # a restart runs the failed batch and at most one more


def test_an_empty_archive_and_the_bound(spark, tmp_path):
    path, lake, checkpoint = str(tmp_path / "topic"), str(tmp_path / "lake"), str(tmp_path / "cp")
    with pytest.raises(ValueError, match="checkpoint"):
        archive.archive_source(spark, path, 3)
    archived(spark, path, [0])
    assert not stream.stream_bronze_sink(archive.archive_source(spark, path, 3, checkpoint), lake, checkpoint)
    options = {"path": path, "max_messages": "10", "checkpoint": str(tmp_path / "fresh")}
    archived(spark, path, [100, 2, 0, 30], first=1000)
    reader = archive.ArchiveReader(options)
    assert reader.latestOffset() == {"1": 1003, "3": 1004, "0": 1003}  # 3, 4 and 3 offsets
    (tmp_path / "fresh" / "offsets").mkdir(parents=True)
    with pytest.raises(ValueError, match="without max_messages"):
        archive.ArchiveReader(options)


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": self.folder}.get(key, default)

    class Fake:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "applicationId": "a"})()

    Conf.folder = None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Fake())
    Conf.folder = "hdfs://shared/cp/"
    assert session.shared_root(Fake()) == "hdfs://shared/cp"


def test_materialized_table_cuts_the_plan(spark):
    table = session.materialize(spark.range(10).groupBy((F.col("id") % 3).alias("m")).count(), "cut")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert table.count() == 3 and "FileScan parquet" in plan and "Range" not in plan
