"""Random-forest risk model on MLlib: training, cross-validation, scoring, attribution."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import mul
from typing import Any

from numpy.polynomial.legendre import leggauss
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.expressions import finite_or_zero, rows_from
from tidegauge.functions.selection import group_counts
from tidegauge.operators import evaluate
from tidegauge.operators.risk import (
    RiskConfig,
    robust_scaling,
    robust_scalings,
    row_order,
    stratified_folds,
    stratified_split,
    warn_on_weak_label,
    with_class_weight,
)
from tidegauge.session import ensure_checkpoint_dir, materialize, remove_folder, shared_path

logger = logging.getLogger(__name__)

CONCURRENT_FITS = 5
LOW_AUC = 0.60  # fixed value: below this a training run warns


class _ForestModel(RandomForestClassificationModel):
    """The parent's cached ``trees`` are all wrapped as soon as a model lists its params, which takes
    longer than fitting 300 of them; as a plain property they are wrapped when asked for."""

    @property
    def trees(self) -> list[DecisionTreeClassificationModel]:
        return [DecisionTreeClassificationModel(tree) for tree in self._call_java("trees")]


class _Forest(RandomForestClassifier):
    def _create_model(self, java_model: Any) -> _ForestModel:
        return _ForestModel(java_model)


@dataclass
class TrainedRisk:
    model: PipelineModel
    metrics: dict[str, Any]
    importance: DataFrame


def _clean_and_scale(scaling: dict[str, tuple[float, float]]) -> SQLTransformer:
    def scaled(name: str, median: float, spread: float) -> str:
        value = f"CAST(`{name}` AS DOUBLE)"
        usable = f"CASE WHEN abs({value}) < double('Infinity') THEN {value} ELSE 0D END"
        return f"({usable} - {median!r}D) / {spread!r}D AS `scaled_{name}`"

    columns = ", ".join(scaled(n, median, spread) for n, (median, spread) in scaling.items())
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def _cleaned(df: DataFrame, columns: Sequence[str], *kept: str) -> DataFrame:
    return df.select(*kept, *[finite_or_zero(F.col(c)).alias(c) for c in columns])


def fit_forest(
    train: DataFrame,
    config: RiskConfig,
    features: Sequence[str],
    scaling: dict[str, tuple[float, float]] | None = None,
) -> PipelineModel:
    """Fit clean → scale → assemble → forest as one savable pipeline, with balanced classes.

    ``train`` is read by several jobs, so pass a written table. Its partitions decide the
    bootstrap draws. ``scaling`` is that of ``train`` where it is known.
    """
    ensure_checkpoint_dir(train.sparkSession)
    scaling = scaling or robust_scaling(_cleaned(train, features), tuple(features))
    forest = _Forest(
        featuresCol="risk_features", labelCol=config.label, weightCol="class_weight",
        numTrees=config.trees, maxDepth=config.depth, minInstancesPerNode=config.min_leaf, seed=config.seed,
    )
    assembler = VectorAssembler(inputCols=[f"scaled_{c}" for c in features], outputCol="risk_features")
    weighted = with_class_weight(train, config.label)
    return Pipeline(stages=[_clean_and_scale(scaling), assembler, forest]).fit(weighted)


def score_rows(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add risk_probability (class 1) and risk_label (predicted class)."""
    scored = model.transform(df)
    return scored.select(
        *df.columns,
        vector_to_array("probability")[1].alias("risk_probability"),
        F.col("prediction").cast("int").alias("risk_label"),
    )


def usable_features(df: DataFrame, config: RiskConfig) -> list[str]:
    features = [c for c in config.features if c in df.columns]
    if len(features) < 2:
        raise ValueError(f"training needs at least 2 feature columns, found {features}")
    return features


def class_counts(labelled: DataFrame, config: RiskConfig) -> dict[int, int]:
    counts = group_counts(labelled, config.label)
    if sum(counts.values()) < config.min_rows:
        raise ValueError(f"only {sum(counts.values())} rows, training needs at least {config.min_rows}")
    if len(counts) < 2:
        raise ValueError("the label has a single class; a classifier cannot be trained")
    return counts


def train_risk_model(
    labelled: DataFrame,
    config: RiskConfig = RiskConfig(),
    keys: Sequence[str] = ("feature_name", "date"),
    cross_validate: bool = True,
) -> TrainedRisk:
    """Split, fit on the training part, evaluate on the rest, cross-validate.

    ``keys`` identify a row and drive the reproducible split. Scaling and class weights are
    taken from training rows only.
    """
    features = usable_features(labelled, config)
    order = row_order(config.seed, *keys)
    split = materialize(stratified_split(labelled, config.label, order, config.test_share), "risk-split")
    counts = class_counts(split, config)
    total = sum(counts.values())
    positive_share = counts.get(1, 0) / total
    warn_on_weak_label(positive_share)

    with ThreadPoolExecutor(1) as pool:  # cross-validation overlaps with the main fit
        folds = None
        if cross_validate and total >= config.fold_min_rows:
            folds = pool.submit(lambda: cv_auc(split, config, keys).first())
        model = fit_forest(split.filter(~F.col("is_test")), config, features)
        metrics = evaluate_model(split.filter("is_test"), model, config)
        metrics["cv_auc_mean"], metrics["cv_auc_std"] = folds.result() if folds else (metrics["roc_auc"], 0.0)
    metrics.update(positive_rate=positive_share, train_rows=total - metrics["test_rows"], feature_cols=features)
    if metrics["roc_auc"] is not None and metrics["roc_auc"] < LOW_AUC:
        logger.warning("low AUC (%.4f): consider more features or more data", metrics["roc_auc"])
    return TrainedRisk(model, metrics, feature_importance(model, features))


def evaluate_model(test: DataFrame, model: PipelineModel, config: RiskConfig) -> dict[str, Any]:
    """Ranking metrics, confusion matrix and class report on held-out rows."""
    scored = score_rows(test, model).select(
        F.col(config.label).alias("label"),
        F.col("risk_probability").alias("score"),
        F.col("risk_label").alias("predicted"),
    )
    scored = materialize(scored, "risk-test")
    ranking = evaluate.ranking_metrics(scored).first()
    counted = evaluate.confusion_counts(scored)
    cells = counted.first()
    counted = test.sparkSession.createDataFrame([cells], counted.schema)
    tested = sum(cells)
    return {
        "roc_auc": ranking.roc_auc,
        "average_precision": ranking.average_precision,
        "accuracy": (cells.tn + cells.tp) / tested if tested else None,
        "confusion_matrix": [[cells.tn, cells.fp], [cells.fn, cells.tp]],
        "classification_report": [r.asDict() for r in evaluate.class_report(counted).collect()],
        "test_rows": tested,
    }


def cv_auc(
    labelled: DataFrame,
    config: RiskConfig = RiskConfig(),
    keys: Sequence[str] = ("feature_name", "date"),
) -> DataFrame:
    """One row: mean and population deviation of the AUC over stratified folds."""
    features = usable_features(labelled, config)
    order = row_order(config.seed + 1, *keys)
    folded = materialize(stratified_folds(labelled, config.label, order, config.folds), "risk-folds")

    # The quartiles of every fold's training rows are found together.
    parts = {str(fold): F.col("fold") != fold for fold in range(config.folds)}
    scalings = robust_scalings(_cleaned(folded, features, "fold"), parts, tuple(features))

    def held_out(fold: int) -> DataFrame:
        model = fit_forest(folded.filter(F.col("fold") != fold), config, features, scalings[str(fold)])
        return score_rows(folded.filter(F.col("fold") == fold), model).select(
            "fold", F.col(config.label).alias("label"), F.col("risk_probability").alias("score")
        )

    with ThreadPoolExecutor(CONCURRENT_FITS) as pool:
        scored = reduce(DataFrame.unionAll, pool.map(held_out, range(config.folds)))
    # All folds are ranked together, each within itself.
    return evaluate.ranking_metrics(scored, by="fold").agg(
        F.avg("roc_auc").alias("cv_auc_mean"), F.stddev_pop("roc_auc").alias("cv_auc_std")
    )


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """feature, importance by falling importance."""
    importances = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(features, importances)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def forest_leaves(model: PipelineModel, players: int) -> DataFrame:
    """A row per leaf: ``tree``, ``value``, its part of the class-1 probability, and per feature position
    the scaled values that reach it, ``low < x <= high``, and ``share``, the part of the training
    weight that the splits on this feature send its way.

    At most trees * 2**depth rows, whatever the size of the data; the fitted forest itself is as large.
    Reads the table of nodes that MLlib saves with a forest: ``treeID, nodeData`` as of Spark 4.
    """
    spark = SparkSession.active()
    path = shared_path(spark, "forest-nodes")
    model.stages[-1].write().save(path)
    trees: dict[int, dict[int, Row]] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData").toLocalIterator():
        trees.setdefault(row.treeID, {})[row.nodeData.id] = row.nodeData
    remove_folder(spark, path)
    leaves = [(tree, *leaf) for tree, nodes in trees.items() for leaf in _leaves(nodes, players, len(trees))]
    fields = [f"{name}{j} double" for name in ("low", "high", "share") for j in range(players)]
    return spark.createDataFrame(leaves, ", ".join(["tree int", "value double", *fields]))


def _cuts_below(j: int, value: str, or_at: bool = False) -> Column:
    x = F.col(value)
    return F.size(F.filter(f"cuts{j}", lambda cut: (cut <= x) if or_at else (cut < x)))


def leaf_cells(leaves: DataFrame, players: int) -> tuple[DataFrame, DataFrame]:
    """The thresholds of each tree, ``tree, cuts<j>``, and its leaves by the numbers of the intervals
    between them that reach a leaf, ``tree, value, from<j>, to<j>, share<j>``.

    A threshold is the upper end of some leaf, so the ends of the leaves are all thresholds.
    """
    cuts = leaves.groupBy("tree").agg(*[
        F.sort_array(F.collect_set(F.when(F.col(f"high{j}") < math.inf, F.col(f"high{j}")))).alias(f"cuts{j}")
        for j in range(players)
    ])
    ends = []
    for j in range(players):
        ends += [_cuts_below(j, f"low{j}", True).alias(f"from{j}"), _cuts_below(j, f"high{j}").alias(f"to{j}"), F.col(f"share{j}")]
    return cuts, leaves.join(F.broadcast(cuts), "tree").select("tree", "value", *ends)


def _leaves(nodes: dict[int, Row], players: int, trees: int) -> Iterator[tuple[float, ...]]:
    todo = [(nodes[0], (-math.inf,) * players, (math.inf,) * players, (1.0,) * players)]
    while todo:
        node, low, high, share = todo.pop()
        weight = sum(node.impurityStats)
        if node.leftChild < 0:
            yield (node.impurityStats[1] / weight / trees, *low, *high, *share)
            continue
        at, (threshold,) = node.split.featureIndex, node.split.leftCategoriesOrThreshold
        for child in (nodes[node.leftChild], nodes[node.rightChild]):
            part = share[at] * sum(child.impurityStats) / weight
            left = child.id == node.leftChild
            todo.append((
                child,
                low if left else _with(low, at, max(low[at], threshold)),
                _with(high, at, min(high[at], threshold)) if left else high,
                _with(share, at, part),
            ))


def _with(values: tuple[float, ...], at: int, value: float) -> tuple[float, ...]:
    return (*values[:at], value, *values[at + 1:])


def row_attribution(df: DataFrame, model: PipelineModel, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Exact Shapley values of the class-1 probability: ``phi_<feature>`` per row.

    A feature outside a coalition follows both sides of its splits in proportion to the training
    weight, as tree explainers do, so no background rows are needed and a row's values add up to
    its probability less the forest's mean. A leaf is then a product over the features, whose
    Shapley values are integrals over [0, 1] of a polynomial of degree features - 1; as many
    Gauss points as half the features give these exactly.

    A tree cannot tell rows apart that fall between the same thresholds. Rows are therefore placed in
    each tree's cells first, every cell that occurs meets the leaves of its own tree once, and rows
    add up the cells they are in. The thresholds and leaves that are broadcast are at most
    trees * 2**depth, set by the model. ``keys`` identify a row.
    """
    positions = range(len(features))
    clean = df.select(*keys, *[finite_or_zero(F.col(c)).alias(c) for c in features])
    scaled = model.stages[0].transform(clean).select(
        F.struct(*keys).alias("row"), *[F.col(f"scaled_{c}").alias(f"x{j}") for j, c in enumerate(features)]
    )
    cuts, leaves = leaf_cells(forest_leaves(model, len(features)), len(features))
    cell = [f"cell{j}" for j in positions]
    trees = F.sequence(F.lit(0), F.lit(model.stages[-1].getNumTrees - 1))
    placed = scaled.withColumn("tree", F.explode(trees)).join(F.broadcast(cuts), "tree").select("row", "tree", *[
        _cuts_below(j, f"x{j}").alias(cell[j]) for j in positions
    ])
    reached = [F.col(cell[j]).between(F.col(f"from{j}"), F.col(f"to{j}")) for j in positions]
    points, weights = leggauss((len(features) + 1) // 2)

    def blend(j: int, point: float) -> Column:
        outside = F.col(f"share{j}") * (1 - point)
        return F.when(reached[j], outside + point).otherwise(outside)

    def contribution(j: int) -> Column:
        own = F.when(reached[j], 1.0).otherwise(0.0) - F.col(f"share{j}")
        integral = sum(
            (reduce(mul, [blend(k, (1 + float(x)) / 2) for k in positions if k != j], F.lit(float(w) / 2))
             for x, w in zip(points, weights)),
            F.lit(0.0),
        )
        return F.sum(F.col("value") * own * integral)

    occurring = placed.select("tree", *cell).distinct().join(F.broadcast(leaves), "tree")
    priced = occurring.groupBy("tree", *cell).agg(*[contribution(j).alias(f"phi{j}") for j in positions])
    priced = materialize(priced, "attribution-cells")
    summed = placed.join(priced, ["tree", *cell]).groupBy("row").agg(*[
        F.sum(f"phi{j}").alias(f"phi_{c}") for j, c in enumerate(features)
    ])
    return summed.select("row.*", *[f"phi_{c}" for c in features])


def forest_mean(model: PipelineModel, players: int) -> float:
    """The class-1 probability with no feature known, which a row's attributions start from."""
    share = reduce(mul, [F.col(f"share{j}") for j in range(players)])
    return forest_leaves(model, players).agg(F.sum(F.col("value") * share)).first()[0]


def mean_abs_attribution(
    df: DataFrame,
    model: PipelineModel,
    keys: Sequence[str] = ("feature_name", "date"),
    features: Sequence[str] = RiskConfig().features,
) -> DataFrame:
    """feature, mean_abs_attribution by falling value."""
    phis = row_attribution(df, model, keys, features)
    means = phis.agg(*[F.avg(F.abs(f"phi_{c}")).alias(c) for c in features])
    return rows_from(means, [
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs_attribution")) for c in features
    ]).orderBy(F.desc("mean_abs_attribution"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
