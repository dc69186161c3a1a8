"""Classifier metrics as relational aggregates over (label, score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.expressions import rows_from
from tidegauge.functions.running import running_totals
from tidegauge.session import materialize


def ranking_metrics(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    by: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``by`` (or one row), positives, negatives, roc_auc, average_precision.

    Equal scores are counted first, so ties share a threshold and count half in the AUC. Both
    metrics then come from one running total over the distinct scores, which are written once.
    """
    group = by or "_all"
    rows = scored if by else scored.withColumn("_all", F.lit(1))
    # Running totals from the highest score down: what a threshold at this score catches.
    counted = rows.filter(F.col(score).isNotNull()).groupBy(group, (-F.col(score)).alias("_depth")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    counted = materialize(counted, "scores")
    running = running_totals(counted, "_depth", ["pos", "neg"], by=group, buckets=buckets)
    pos, neg = F.col("pos"), F.col("neg")
    raised = F.col("run_pos") + F.col("run_neg")
    result = running.groupBy(group).agg(
        F.max("run_pos").alias("positives"),
        F.max("run_neg").alias("negatives"),
        F.sum(pos * (F.col("run_neg") - neg / 2)).alias("_outranked"),
        F.sum(F.try_divide(pos * F.col("run_pos"), raised)).alias("_precision"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    result = result.select(
        group, "positives", "negatives",
        F.try_divide(pairs - F.col("_outranked"), pairs).alias("roc_auc"),
        F.try_divide("_precision", "positives").alias("average_precision"),
    )
    return result if by else result.drop("_all")


def confusion_counts(scored: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """One row: tn, fp, fn, tp."""
    def cell(actual: int, guess: int) -> Column:
        return F.count_if((F.col(label) == actual) & (F.col(predicted) == guess))

    return scored.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """actual, predicted, rows: the full 2 x 2 grid."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return rows_from(counts, [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("rows"))
        for a, p, c in cells
    ])


def accuracy(counts: DataFrame) -> DataFrame:
    """rows, accuracy, positive_rate."""
    rows = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return counts.select(
        rows.alias("rows"),
        F.try_divide(F.col("tn") + F.col("tp"), rows).alias("accuracy"),
        F.try_divide(F.col("fn") + F.col("tp"), rows).alias("positive_rate"),
    )


def class_report(counts: DataFrame) -> DataFrame:
    """name, precision, recall, f1, support for both classes, macro and weighted averages.

    A division by zero counts as 0.
    """
    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    def scores(hit: str, extra: str, lost: str) -> tuple[Column, Column, Column, Column]:
        precision = ratio(F.col(hit), F.col(hit) + F.col(extra))
        recall = ratio(F.col(hit), F.col(hit) + F.col(lost))
        f1 = ratio(2 * precision * recall, precision + recall)
        return precision, recall, f1, F.col(hit) + F.col(lost)

    zero, one = scores("tn", "fn", "fp"), scores("tp", "fp", "fn")
    support = zero[3] + one[3]
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [ratio(a * zero[3] + b * one[3], support) for a, b in zip(zero[:3], one[:3])]
    lines = [("0", *zero), ("1", *one), ("macro avg", *macro, support), ("weighted avg", *weighted, support)]
    return rows_from(counts, [
        F.struct(
            F.lit(name).alias("name"), p.alias("precision"), r.alias("recall"), f.alias("f1"), n.alias("support")
        )
        for name, p, r, f, n in lines
    ])
