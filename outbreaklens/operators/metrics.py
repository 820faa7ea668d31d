"""Evaluation of binary classifiers: confusion matrix, report, precision-recall curve, average precision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outbreaklens.operators.ordered import running_totals


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two means; 0 for an empty denominator.

    Starts from the four cells of the confusion matrix, so everything after it is tiny.
    """
    counts = df.agg(
        *[
            F.count_if((F.col(label) == y) & (F.col(prediction) == p)).alias(f"n{y}{p}")
            for y in (0, 1)
            for p in (0, 1)
        ]
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def scores(y: int) -> dict:
        right = F.col(f"n{y}{y}")
        missed, wrong = F.col(f"n{y}{1 - y}"), F.col(f"n{1 - y}{y}")
        precision, recall = ratio(right, right + wrong), ratio(right, right + missed)
        f1 = ratio(2 * precision * recall, precision + recall)
        return {"precision": precision, "recall": recall, "f1": f1, "support": right + missed}

    classes = {0: scores(0), 1: scores(1)}
    total = classes[0]["support"] + classes[1]["support"]
    names = ("precision", "recall", "f1")

    def line(name: str, values: dict):
        return F.struct(
            F.lit(name).alias("class"),
            *[values[c].cast("double").alias(c) for c in names],
            values["support"].cast("bigint").alias("support"),
        )

    accuracy = ratio(F.col("n00") + F.col("n11"), total)
    macro = {c: (classes[0][c] + classes[1][c]) / 2 for c in names}
    weighted = {
        c: ratio(classes[0][c] * classes[0]["support"] + classes[1][c] * classes[1]["support"], total)
        for c in names
    }
    lines = F.array(
        line("no new case", classes[0]),
        line("new case", classes[1]),
        line("accuracy", {c: accuracy for c in names} | {"support": total}),
        line("macro avg", macro | {"support": total}),
        line("weighted avg", weighted | {"support": total}),
    )
    return counts.select(F.explode(lines).alias("r")).select("r.*")


def _score_totals(df: DataFrame, label: str, score: str) -> tuple[DataFrame, int]:
    """Per distinct score, highest first: positives and rows at or above it; and all positives."""
    groups = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    cumulated, totals = running_totals(groups, [F.col("threshold").desc()], ["pos", "n"])
    return cumulated, totals["pos"]


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score and the closing point (recall 0, precision 1) without a threshold."""
    totals, positives = _score_totals(df, label, score)
    points = totals.select(
        "threshold",
        (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        (F.col("cum_pos") / F.lit(positives) if positives else F.lit(1.0)).alias("recall"),
    )
    closing = df.sparkSession.range(1).select(
        F.lit(None).cast(points.schema["threshold"].dataType).alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(closing)


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Sum over scores of the recall step times the precision; not the trapezoid area. 0 without positives."""
    totals, positives = _score_totals(df, label, score)
    step = F.col("pos") / F.lit(max(positives, 1)) * F.col("cum_pos") / F.col("cum_n")
    return totals.agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("average_precision"))
