from __future__ import annotations

import math
from datetime import datetime
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import evaluate, forest, risk, runs
from tidegauge.operators.risk import RiskConfig
from tidegauge.schema import RISK_FEATURES

SMALL = RiskConfig(trees=20)


@pytest.fixture(scope="module")
def days(spark):
    """Two hundred feature-days; the second half is unhealthy."""
    rows = [
        ("f", f"day-{i:03d}", float(50 + i), 0.01 if i < 100 else 0.20, 4.7 if i < 100 else 2.3,
         1000 if i < 100 else 200, 0.1 if i < 100 else 3.5)
        for i in range(200)
    ]
    return spark.createDataFrame(rows, "feature_name string, date string, avg_latency double, crash_rate double, "
                                       "avg_feedback double, usage_count long, avg_error_count double")


@pytest.fixture(scope="module")
def trained(days):
    return forest.train_risk_model(risk.risk_target(days), SMALL)


def test_label_counts_breaches(spark, days):
    labelled = risk.risk_target(days)
    assert labelled.groupBy("is_high_risk").count().orderBy("is_high_risk").collect() == [(0, 100), (1, 100)]
    with pytest.raises(ValueError, match="crash_rate"):
        risk.risk_target(days.drop("crash_rate"))


def test_label_limits_are_inclusive(spark):
    limits = {"crash_rate": 0.1, "avg_latency": 100.0, "avg_feedback": 3.0, "avg_error_count": 1.0}
    df = spark.createDataFrame([(0.1, 100.0, 4.0, 0.0), (0.1, 99.0, 3.1, 0.9), (None, 100.0, 3.0, None)],
                               "crash_rate double, avg_latency double, avg_feedback double, avg_error_count double")
    assert [r[0] for r in df.select(risk.breach_count(limits)).collect()] == [2, 1, 2]


def test_weak_labels_warn(caplog):
    risk.warn_on_weak_label(0.02)
    risk.warn_on_weak_label(0.40)
    assert not caplog.text
    risk.warn_on_weak_label(0.41)
    assert "weak" in caplog.text


def test_cleaning(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (None,), (2.5,)], "avg_latency double")
    assert [r[0] for r in risk.clean_features(df).collect()] == [0.0, 0.0, 0.0, 0.0, 2.5]


def test_scaling_of_a_constant_column(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "x double")
    scaling = risk.robust_scaling(df, ("x",))
    assert scaling == {"x": (5.0, 1.0)} and risk.robust_scale(df, scaling).first().scaled_x == 0.0


def test_split_is_stratified_and_repeatable(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    order = risk.row_order(42, "id")
    parts = [risk.stratified_split(d, "label", order) for d in (df, df.repartition(7))]
    counts = {(r.label, r.is_test): r["count"] for r in parts[0].groupBy("label", "is_test").count().collect()}
    assert counts == {(0, True): 180, (0, False): 720, (1, True): 20, (1, False): 80}
    tests = [sorted(r.id for r in p.filter("is_test").collect()) for p in parts]
    assert tests[0] == tests[1]


def test_split_of_a_class_with_one_row(spark):
    df = spark.range(50).withColumn("label", (F.col("id") == 0).cast("int"))
    assert risk.stratified_split(df, "label", F.col("id")).filter("is_test").count() == 10


def test_folds_are_even_in_each_class(spark):
    df = spark.range(103).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    folded = risk.stratified_folds(df, "label", risk.row_order(1, "id"), 5)
    sizes = [r["count"] for r in folded.groupBy("label", "fold").count().collect()]
    assert len(sizes) == 10 and set(sizes) <= {5, 6, 15, 16}


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(1,)] * 10, "label int")
    weights = {r.label: r.weight for r in risk.class_weights(df, "label").collect()}
    assert weights == pytest.approx({0: 40 / 60, 1: 2.0})
    assert risk.with_class_weight(df, "label").agg(F.sum("class_weight")).first()[0] == pytest.approx(40)


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double, predicted int")


def auc_by_hand(rows):
    pos, neg = [s for y, s, _ in rows if y], [s for y, s, _ in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def precision_by_hand(rows):
    total, area, last = sum(y for y, _, _ in rows), 0.0, 0.0
    for cut in sorted({s for _, s, _ in rows}, reverse=True):
        kept = [y for y, s, _ in rows if s >= cut]
        area += (sum(kept) / total - last) * sum(kept) / len(kept)
        last = sum(kept) / total
    return area


@pytest.mark.parametrize("rows", [
    [(0, 0.1, 0), (0, 0.4, 0), (1, 0.35, 0), (1, 0.8, 1)],
    [(0, 0.5, 0)] * 3 + [(1, 0.5, 0)] * 2,  # everything ties
    [(i % 3 == 0, (i * 7 % 11) / 11, 0) for i in range(60)],
])
def test_ranking_metrics(spark, rows):
    rows = [(int(y), s, p) for y, s, p in rows]
    for options in ({"buckets": 4}, {}):
        row = evaluate.ranking_metrics(scored(spark, rows), **options).first()
        assert row.roc_auc == pytest.approx(auc_by_hand(rows))
        assert row.average_precision == pytest.approx(precision_by_hand(rows))


def test_ranking_metrics_of_one_class_are_null(spark):
    row = evaluate.ranking_metrics(scored(spark, [(1, 0.5, 1)] * 3)).first()
    assert row.roc_auc is None and row.average_precision == 1.0


def test_confusion_and_report(spark):
    counts = evaluate.confusion_counts(scored(spark, [(0, 0.0, 0)] * 39 + [(0, 0.0, 1)] * 2 + [(1, 0.0, 0)] * 3 + [(1, 0.0, 1)] * 16))
    cells = {(r.actual, r.predicted): r.rows for r in evaluate.confusion_matrix(counts).collect()}
    assert cells == {(0, 0): 39, (0, 1): 2, (1, 0): 3, (1, 1): 16}
    lines = {r["name"]: r for r in evaluate.class_report(counts).collect()}
    assert lines["0"].precision == pytest.approx(0.9285714285714286)
    assert lines["1"].f1 == pytest.approx(0.8648648648648649)
    assert lines["macro avg"].recall == pytest.approx(0.8966623876765083)
    assert lines["weighted avg"].f1 == pytest.approx(0.9160425485726691) and lines["weighted avg"].support == 60
    assert evaluate.accuracy(counts).first().accuracy == pytest.approx(0.9166666666666666)


def test_report_with_an_empty_class(spark):
    lines = evaluate.class_report(evaluate.confusion_counts(scored(spark, [(0, 0.0, 0)] * 4))).collect()
    assert (lines[1].precision, lines[1].recall, lines[1].f1, lines[1].support) == (0.0, 0.0, 0.0, 0)


def test_training_beats_chance(trained):
    m = trained.metrics
    assert m["roc_auc"] > 0.9 and m["cv_auc_mean"] > 0.9 and 0 <= m["cv_auc_std"] < 0.2
    assert (m["train_rows"], m["test_rows"]) == (160, 40)
    assert sum(map(sum, m["confusion_matrix"])) == 40
    importances = [r.importance for r in trained.importance.collect()]
    assert importances == sorted(importances, reverse=True) and sum(importances) == pytest.approx(1.0)


def test_scores_are_probabilities(days, trained):
    out = forest.score_rows(days, trained.model)
    assert out.columns == [*days.columns, "risk_probability", "risk_label"]
    assert out.filter("risk_probability < 0 OR risk_probability > 1 OR risk_label NOT IN (0, 1)").count() == 0


def test_same_seed_same_forest(days, trained):
    again = forest.train_risk_model(risk.risk_target(days), SMALL, cross_validate=False)
    key = F.xxhash64("date", "risk_probability")
    sums = [forest.score_rows(days, m.model).agg(F.sum(F.shiftright(key, 20))).first() for m in (trained, again)]
    assert sums[0] == sums[1]


def test_training_refuses_too_little(days):
    labelled = risk.risk_target(days)
    with pytest.raises(ValueError, match="at least 20"):
        forest.train_risk_model(labelled.limit(19), SMALL)
    with pytest.raises(ValueError, match="single class"):
        forest.train_risk_model(labelled.filter("is_high_risk = 1"), SMALL)
    with pytest.raises(ValueError, match="at least 2 feature columns"):
        forest.train_risk_model(labelled.drop(*RISK_FEATURES[1:]), SMALL)


def shapley_by_hand(leaves, place):
    """All coalitions of a row at ``place``; features outside one follow the leaf's share."""
    players = range(len(place))

    def worth(inside):
        return sum(leaf.value * math.prod(
            float(leaf[f"low{j}"] < place[j] <= leaf[f"high{j}"]) if j in inside else leaf[f"share{j}"] for j in players
        ) for leaf in leaves)

    coalitions = [frozenset(c) for size in players for c in combinations(players, size)]
    known = {c: worth(c) for c in [*coalitions, frozenset(players)]}
    n = len(place)
    return known[frozenset()], [
        sum(math.factorial(len(c)) * math.factorial(n - len(c) - 1) / math.factorial(n) * (known[c | {j}] - known[c])
            for c in coalitions if j not in c)
        for j in players
    ]


def test_attribution_matches_all_coalitions(spark, days, trained):
    features = list(SMALL.features)
    few = days.filter("date IN ('day-000', 'day-050', 'day-150', 'day-199')")
    phis = {r.date: r for r in forest.row_attribution(few, trained.model, ["date"], features).collect()}
    leaves = forest.forest_leaves(trained.model, len(features)).collect()
    assert sum(math.prod(leaf[f"share{j}"] for j in range(5)) for leaf in leaves) == pytest.approx(SMALL.trees)
    own = {r.date: r.risk_probability for r in forest.score_rows(few, trained.model).collect()}
    assert len(phis) == 4
    for row in trained.model.stages[0].transform(few).collect():
        base, expected = shapley_by_hand(leaves, [row[f"scaled_{c}"] for c in features])
        found = [phis[row.date][f"phi_{c}"] for c in features]
        assert found == pytest.approx(expected, abs=1e-9)
        assert base + sum(found) == pytest.approx(own[row.date], abs=1e-9)


def test_mean_attribution_is_sorted(days, trained):
    rows = forest.mean_abs_attribution(days.filter("date LIKE '%0'"), trained.model).collect()
    values = [r.mean_abs_attribution for r in rows]
    assert len(rows) == 5 and values == sorted(values, reverse=True) and values[0] > 0


def test_run_log_and_best_model(spark, days, trained, tmp_path):
    table = str(tmp_path / "runs")
    assert runs.load_best_model(spark, table) is None
    model_path = str(tmp_path / "model")
    forest.save_model(trained.model, model_path)
    runs.log_training_run(spark, table, {**trained.metrics, "roc_auc": 0.4}, SMALL, "elsewhere", "weak")
    best = runs.log_training_run(spark, table, {**trained.metrics, "roc_auc": 0.9}, SMALL, model_path, "good")
    row = runs.best_run(runs.read_runs(spark, table)).first()
    assert (row.run_id, row.run_name) == (best, "good")
    assert row.metrics["true_positives"] == trained.metrics["confusion_matrix"][1][1]
    assert isinstance(row.started_at, datetime) and row.params["trees"] == "20"
    loaded = runs.load_best_model(spark, table)
    a, b = (forest.score_rows(days, m).orderBy("date").select("risk_probability").collect() for m in (trained.model, loaded))
    assert a == b
