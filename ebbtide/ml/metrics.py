"""Evaluation of scored rows: label (0/1), prediction (0/1) and probability of class 1.

Every metric is a DataFrame computed by one aggregation, apart from the ROC curve,
which first reduces the rows to one per distinct score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.ml.split import random_rows
from ebbtide.names import CUSTOMER, LABEL, SCORE, SEED
from ebbtide.operators.running import running_totals

PREDICTION = "prediction"


def _divide(part: Column, whole: Column) -> Column:
    """part / whole, and 0.0 where nothing was predicted or present."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _divide(2 * precision * recall, precision + recall)


def outcome_counts(scored: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, tn."""
    actual, predicted = F.col(LABEL) == 1, F.col(PREDICTION) == 1
    return scored.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )


def classification_metrics(scored: DataFrame) -> DataFrame:
    """One row: accuracy, and precision, recall and F1 of class 1."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _divide(tp, tp + fp), _divide(tp, tp + fn)
    return outcome_counts(scored).select(
        _divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1_score"),
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Rows per (actual, predicted)."""
    return scored.groupBy(
        F.col(LABEL).cast("int").alias("actual"), F.col(PREDICTION).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("count"))


def classification_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and the two means.

    The accuracy row holds the accuracy as f1_score and leaves the other two NULL.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    support = {"0": tn + fp, "1": tp + fn}
    precision = {"0": _divide(tn, tn + fn), "1": _divide(tp, tp + fp)}
    recall = {"0": _divide(tn, tn + fp), "1": _divide(tp, tp + fn)}
    f1 = {c: _f1(precision[c], recall[c]) for c in support}
    total = tp + fp + fn + tn
    nothing = F.lit(None).cast("double")

    def row(name: str, *values: Column) -> Column:
        names = ("precision", "recall", "f1_score", "support")
        return F.struct(
            F.lit(name).alias("class"), *[v.alias(n) for v, n in zip(values, names, strict=True)]
        )

    def macro(by_class: dict[str, Column]) -> Column:
        return (by_class["0"] + by_class["1"]) / 2

    def weighted(by_class: dict[str, Column]) -> Column:
        return _divide(sum((by_class[c] * support[c] for c in support), F.lit(0.0)), total)

    rows = [row(c, precision[c], recall[c], f1[c], support[c]) for c in support]
    rows.append(row("accuracy", nothing, nothing, _divide(tp + tn, total), total))
    rows.append(row("macro avg", macro(precision), macro(recall), macro(f1), total))
    rows.append(row("weighted avg", weighted(precision), weighted(recall), weighted(f1), total))
    return outcome_counts(scored).select(F.inline(F.array(*rows)))


def _score_counts(scored: DataFrame) -> DataFrame:
    """Distinct scores with their positives and negatives, and the totals above each."""
    positive = F.col(LABEL) == 1
    counts = scored.groupBy(F.col(SCORE).alias("threshold")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    return running_totals(counts, "threshold", ["pos", "neg"])


def roc_curve(scored: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """Points (threshold, fpr, tpr) from (0, 0) at an infinite threshold to (1, 1).

    ``drop_intermediate`` leaves out points on the straight line between their
    neighbours, which do not change the curve.
    """
    points = _score_counts(scored)
    if drop_intermediate:
        corner = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        first = (F.col("above_pos") == 0) & (F.col("above_neg") == 0)
        points = points.where(corner | first | F.col("next_pos").isNull())
    curve = points.select(
        "threshold",
        F.try_divide(F.col("above_neg") + F.col("neg"), F.col("total_neg")).alias("fpr"),
        F.try_divide(F.col("above_pos") + F.col("pos"), F.col("total_pos")).alias("tpr"),
    )
    start = scored.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(curve)


def roc_auc(scored: DataFrame) -> DataFrame:
    """One row: the exact area under the ROC curve, equal scores counting half."""
    pairs_won = F.sum(F.col("neg") * (F.col("above_pos") + F.col("pos") / 2))
    all_pairs = F.sum("pos") * F.sum("neg")
    return _score_counts(scored).agg(F.try_divide(pairs_won, all_pairs).alias("roc_auc"))


def spot_check(scored: DataFrame, n: int = 10, seed: int = SEED) -> DataFrame:
    """n pseudo-random scored rows with the outcome Correct or Incorrect."""
    rows = with_outcome(scored).select(
        CUSTOMER, SCORE, "predicted_churn", "actual_churn", "prediction_status"
    )
    return random_rows(rows, n, seed)


def with_outcome(scored: DataFrame) -> DataFrame:
    """Add actual_churn, predicted_churn and prediction_status."""
    hit = F.col(PREDICTION) == F.col(LABEL)
    return scored.withColumns(
        {
            "actual_churn": F.col(LABEL).cast("int"),
            "predicted_churn": F.col(PREDICTION).cast("int"),
            "prediction_status": F.when(hit, "Correct").otherwise("Incorrect"),
        }
    )
