"""Exact evaluation of scored rows: ROC and precision-recall curves, areas, per-class report.

Rows shrink to their distinct scores, whatever the range and the digits of a score. Running counts over the scores come
from range partitions and one row of totals per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.ordering import with_running_totals


def _by_score(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Distinct scores with positives and negatives at and above each, and the overall totals."""
    distinct = (
        scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    return with_running_totals(
        distinct, [F.col("score").desc()], {"tp": "pos", "fp": "neg"},
        totals_as={"positives": "pos", "negatives": "neg"},
    )


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """False and true positive rate at every distinct threshold, and the (0, 0) start with a null threshold."""
    points = _by_score(scored, label, score).select(
        F.col("score").alias("threshold"),
        F.try_divide("fp", "negatives").alias("fpr"),
        F.try_divide("tp", "positives").alias("tpr"),
    )
    start = points.agg(
        F.max("threshold").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    ).withColumn("threshold", F.lit(None).cast("double"))
    return points.unionByName(start)


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision and recall at every distinct threshold, and the (1, 0) end with a null threshold."""
    points = _by_score(scored, label, score).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "positives").alias("recall"),
    )
    end = points.agg(
        F.max("threshold").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    ).withColumn("threshold", F.lit(None).cast("double"))
    return points.unionByName(end)


def areas(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: area under the ROC curve (ties count half) and average precision."""
    steps = _by_score(scored, label, score)
    pairs = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2))
    gain = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return steps.agg(
        F.max("positives").alias("positives"),
        F.max("negatives").alias("negatives"),
        pairs.alias("pairs"),
        gain.alias("gain"),
    ).select(
        "positives",
        "negatives",
        F.round(F.try_divide(F.col("pairs"), F.col("positives").cast("double") * F.col("negatives")), 6).alias(
            "auc_roc"
        ),
        F.round(F.try_divide(F.col("gain"), F.col("positives").cast("double")), 6).alias("avg_precision"),
    )


def classification_report(
    scored: DataFrame, label: str = "label", score: str = "score", cut: float = 0.5
) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted means and the accuracy."""
    guess = F.when(F.col(score) >= cut, 1).otherwise(0)
    cells = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).agg(
        *[
            F.count_if((F.col(label) == a) & (guess == b)).cast("double").alias(f"c{a}{b}")
            for a in (0, 1)
            for b in (0, 1)
        ]
    )

    def scores(hit: str, wrong: str, missed: str):
        """``wrong``: other class taken for this one; ``missed``: this class taken for the other."""
        h, w, m = F.col(hit), F.col(wrong), F.col(missed)
        or_zero = lambda c: F.coalesce(c, F.lit(0.0))
        return [
            or_zero(F.try_divide(h, h + w)), or_zero(F.try_divide(h, h + m)),
            or_zero(F.try_divide(2 * h, 2 * h + w + m)), h + m,
        ]

    names = ["precision", "recall", "f1", "support"]
    zero, one = scores("c00", "c10", "c01"), scores("c11", "c01", "c10")
    total = zero[3] + one[3]
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])] + [total]
    weighted = [
        F.coalesce(F.try_divide(a * zero[3] + b * one[3], total), F.lit(0.0)) for a, b in zip(zero[:3], one[:3])
    ] + [total]
    right = F.coalesce(F.try_divide(F.col("c00") + F.col("c11"), total), F.lit(0.0))
    lines = {"0": zero, "1": one, "accuracy": [right, right, right, total], "macro avg": macro,
             "weighted avg": weighted}
    rows = [
        F.struct(
            F.lit(name).alias("class"),
            *[F.round(v, 6).alias(n) for n, v in zip(names[:3], values[:3])],
            values[3].cast("bigint").alias("support"),
        )
        for name, values in lines.items()
    ]
    return cells.select(F.inline(F.array(*rows)))
