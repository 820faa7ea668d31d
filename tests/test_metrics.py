import random

import pytest

from outbreaklens.operators import metrics


def brute_average_precision(rows):
    positives = sum(y for y, _ in rows)
    total, recall = 0.0, 0.0
    for s in sorted({s for _, s in rows}, reverse=True):
        above = [y for y, t in rows if t >= s]
        now = sum(above) / positives
        total += (now - recall) * sum(above) / len(above)
        recall = now
    return total


@pytest.mark.parametrize("seed", [1, 2])
def test_average_precision(spark, seed):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "y int, s double")
    assert metrics.average_precision(df, "y", "s").first()[0] == pytest.approx(brute_average_precision(rows))


def test_equal_scores_and_no_positives(spark):
    flat = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5), (1, 0.5)], "y int, s double")
    assert metrics.average_precision(flat, "y", "s").first()[0] == 0.5
    points = metrics.pr_curve(flat, "y", "s").collect()
    assert [(p["precision"], p["recall"]) for p in points] == [(0.5, 1.0), (1.0, 0.0)]
    none = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, s double")
    assert metrics.average_precision(none, "y", "s").first()[0] == 0.0
    assert {p["recall"] for p in metrics.pr_curve(none, "y", "s").where("threshold IS NOT NULL").collect()} == {1.0}


def test_report(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4, "y int, p int")
    got = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert got["new case"]["precision"] == pytest.approx(0.6) and got["new case"]["recall"] == pytest.approx(0.75)
    assert got["new case"]["f1"] == pytest.approx(2 / 3) and got["new case"]["support"] == 4
    assert got["accuracy"]["f1"] == pytest.approx(0.7)
    assert got["macro avg"]["recall"] == pytest.approx((0.75 + 4 / 6) / 2)
    assert got["weighted avg"]["precision"] == pytest.approx(0.4 * 0.6 + 0.6 * 0.8)
    matrix = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert matrix == {(1, 1): 3, (1, 0): 1, (0, 1): 2, (0, 0): 4}


def test_report_with_an_empty_class(spark):
    df = spark.createDataFrame([(0, 0)] * 3, "y int, p int")
    got = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert (got["new case"]["precision"], got["new case"]["recall"], got["new case"]["f1"]) == (0.0, 0.0, 0.0)
