from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge.functions import selection
from tidegauge.functions.running import running_totals
from tidegauge.sources.raw import sample_n


def column(spark, values, parts=6):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)


@pytest.mark.parametrize("values", [
    [float(i) for i in range(1000)],
    [7.0] * 1000,
    [7.0] * 400 + [float(i) for i in range(600)],  # one value holds a large share
    np.random.default_rng(1).exponential(100, 1500).tolist(),
    [0.0] * 999 + [1e300],
])
def test_rounds_of_narrowing_agree_with_numpy(spark, values, monkeypatch):
    monkeypatch.setattr(selection, "SKETCH_ACCURACY", 100)
    shares = [0.0, 0.25, 0.95, 1.0]
    found = selection.exact_quantiles(column(spark, values), {"x": shares})["x"]
    assert found == pytest.approx(list(np.quantile(values, shares)), rel=1e-12)


def test_poor_proposals_still_end_at_the_right_rank(spark, monkeypatch):
    """Sorted partitions and a coarse sketch: groups of tasks see different value ranges."""
    monkeypatch.setattr(selection, "SKETCH_ACCURACY", 12)
    df = spark.range(2000, numPartitions=7).select(F.col("id").cast("double").alias("x"))
    assert selection.order_statistics(df, [(F.col("x"), r, 2000) for r in (0, 1, 999, 1999)]) == [0, 1, 999, 1999]


def test_nulls_and_nan_are_skipped(spark):
    df = column(spark, [1.0, None, float("nan"), 3.0])
    assert selection.exact_quantiles(df, {"x": [0.5]})["x"] == [2.0]
    assert selection.exact_quantiles(column(spark, [None, None]), {"x": [0.5, 0.9]})["x"] == [None, None]


def test_rank_out_of_range_is_refused(spark):
    with pytest.raises(ValueError):
        selection.order_statistics(column(spark, [1.0]), [(F.col("x"), 1, 1)])


@settings(max_examples=8, deadline=None)
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=60), share=st.floats(0, 1))
def test_any_small_list(spark, values, share):
    found = selection.exact_quantiles(column(spark, [float(v) for v in values], 2), {"x": [share]})["x"][0]
    assert found == pytest.approx(float(np.quantile(values, share)), abs=1e-9)


def test_first_shares_per_class(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    cuts = selection.first_shares(df, "label", F.col("id"), [0.2])
    assert cuts == {0: [19], 1: [16]}  # 15 of 75 rows, 5 of 25 rows


@pytest.mark.parametrize("n", [0, 1, 37, 200, 500])
def test_sample_is_exact_in_size_and_repeatable(spark, n):
    df = spark.range(200, numPartitions=5)
    key = F.xxhash64("id", F.lit(42))
    first = sorted(r.id for r in sample_n(df, n, key).collect())
    again = sorted(r.id for r in sample_n(df.repartition(3), n, key).collect())
    assert len(first) == min(n, 200) and first == again


def test_sample_with_tied_keys(spark):
    df = spark.range(100).withColumn("key", F.col("id") % 2)
    assert sample_n(df, 30, F.col("key")).count() == 30
    assert sample_n(df, 80, F.col("key")).filter("key = 0").count() == 50


@pytest.mark.parametrize("buckets", [2, 8, 50])
def test_running_totals_match_a_plain_cumsum(spark, buckets):
    rng = np.random.default_rng(2)
    rows = [(g, float(v), int(rng.integers(0, 9))) for g in ("a", "b") for v in sorted(set(rng.exponential(10, 120).round(1)))]
    df = spark.createDataFrame(rows, "g string, v double, n long").repartition(5)
    found = {(r.g, r.v): r.run_n for r in running_totals(df, "v", ["n"], "g", buckets).collect()}
    for group in ("a", "b"):
        total = 0
        for _, v, n in [r for r in rows if r[0] == group]:
            total += n
            assert found[group, v] == total


def test_interpolates_like_the_built_in(spark, monkeypatch):
    monkeypatch.setattr(selection, "SKETCH_ACCURACY", 50)
    values = [((i * 7919) % 2003) / 37 for i in range(2000)]
    df = column(spark, values)
    shares = [0.01, 0.25, 0.333, 0.75, 0.95, 0.99]
    assert selection.exact_quantiles(df, {"x": shares})["x"] == df.agg(F.percentile("x", shares)).first()[0]


def test_running_totals_keep_a_null_group(spark):
    df = spark.createDataFrame([(g, float(v), 1) for g in ("a", None) for v in range(20)], "g string, v double, n long")
    found = running_totals(df.repartition(3), "v", ["n"], "g", 4).collect()
    assert len(found) == 40 and all(r.run_n == r.v + 1 for r in found)


def test_tied_samples_agree(spark):
    df = spark.range(100, numPartitions=7).withColumn("key", F.lit(1))
    first = sorted(r.id for r in sample_n(df, 30, F.col("key")).collect())
    assert first == sorted(r.id for r in sample_n(df.repartition(3), 30, F.col("key")).collect())


def test_an_id_is_no_class_label(spark):
    with pytest.raises(ValueError, match="class label"):
        selection.group_counts(spark.range(2000), "id")


def test_sample_takes_rows_without_a_key_last(spark):
    df = spark.createDataFrame([(i, i if i < 5 else None) for i in range(10)], "id long, key long")
    assert sample_n(df, 5, F.col("key")).filter("key IS NULL").count() == 0 and sample_n(df, 5, F.col("key")).count() == 5
    assert sample_n(df, 7, F.col("key")).count() == 7 and sample_n(df, 12, F.col("key")).count() == 10
