"""One-class SVM: optimality of the solution, equality of both solvers, scoring paths."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from outbreaklens.operators import anomaly

SCHEMA = "new_cases double, rolling_3d_new_cases double"


def baseline(seed: int, n: int, values: int = 6) -> list[tuple]:
    rng = random.Random(seed)
    return [(float(rng.randint(0, values)), rng.randint(0, 3 * values) / 3) for _ in range(n)]


def pairs_of(df):
    return anomaly.feature_pairs(df, F.lit(True))


def fit(df, **options):
    return anomaly.fit_one_class(pairs_of(df), **options)


def decisions(rows, model) -> np.ndarray:
    x = model.scale.apply(np.array(rows))
    squared = ((x[:, None, :] - model.vectors[None, :, :]) ** 2).sum(axis=2)
    return np.exp(-model.gamma * squared) @ model.alpha - model.rho


@pytest.mark.parametrize("seed, n", [(1, 60), (2, 300), (3, 900)])
def test_solution_is_optimal(spark, seed, n):
    """Conditions of the nu-SVM: mass nu*n, weights within their box, and the margin where they say it is."""
    rows = baseline(seed, n)
    model = fit(spark.createDataFrame(rows, SCHEMA))
    x = np.array(rows)
    assert model.scale.mean == pytest.approx(tuple(x.mean(axis=0)))
    assert model.scale.sd == pytest.approx(tuple(x.std(axis=0)))
    assert model.gamma == pytest.approx(0.5)
    assert model.alpha.sum() == pytest.approx(0.1 * n)
    values = decisions(rows, model)
    # At most a share nu of the rows lies outside, and points at their bound never lie inside.
    assert (values < -1e-8).mean() <= 0.1 + 1e-9
    counts = {}
    for r in rows:
        counts[r] = counts.get(r, 0) + 1
    weight = {tuple(np.round(v, 9)): a for v, a in zip(model.vectors, model.alpha)}
    for point, count in counts.items():
        a = weight.get(tuple(np.round(model.scale.apply(np.array([point]))[0], 9)), 0.0)
        value = decisions([point], model)[0]
        if a <= 0:
            assert value >= -1e-8
        elif a >= count:
            assert value <= 1e-8
        else:
            assert abs(value) < 1e-8


def test_equal_to_the_expanded_problem(spark):
    """Grouping equal rows does not change the decision values: solve row by row with projected gradients."""
    rows = baseline(5, 40, values=3)
    model = fit(spark.createDataFrame(rows, SCHEMA), nu=0.3)
    x = model.scale.apply(np.array(rows))
    kernel = np.exp(-model.gamma * ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    mass, alpha = 0.3 * len(rows), np.full(len(rows), 0.3)
    for _ in range(60_000):
        moved = alpha - 0.02 * (kernel @ alpha)
        low, high = moved.min() - 1, moved.max()
        for _ in range(60):  # shift so that the clipped weights keep their sum
            middle = (low + high) / 2
            low, high = (middle, high) if np.clip(moved - middle, 0, 1).sum() > mass else (low, middle)
        alpha = np.clip(moved - low, 0, 1)
    assert decisions(rows, model) + model.rho == pytest.approx(kernel @ alpha, abs=1e-4)


def test_decomposition_equals_whole_solution(spark):
    rows = baseline(8, 500, values=12)
    df = spark.createDataFrame(rows, SCHEMA)
    whole = fit(df)
    parts = fit(df, working_set=40)
    assert parts.points is not None and whole.points is None
    assert parts.rho == pytest.approx(whole.rho, abs=1e-7)
    order = list(anomaly.FEATURES)
    pairs = pairs_of(df)
    one = anomaly.anomaly_score(df.distinct(), whole, pairs).orderBy(order).collect()
    other = anomaly.anomaly_score(df.distinct(), parts, pairs, broadcast_pairs=0).orderBy(order).collect()
    assert [tuple(r)[:2] for r in one] == [tuple(r)[:2] for r in other]
    assert [r["anomaly_score"] for r in one] == pytest.approx([r["anomaly_score"] for r in other], abs=2e-6)
    assert [r["anomaly_score"] for r in one] == pytest.approx(list(-decisions([tuple(r)[:2] for r in one], whole)), abs=1e-6)


def test_constant_features(spark):
    flat = spark.createDataFrame([(0.0, 0.0)] * 30, SCHEMA)
    model = fit(flat)
    assert model.gamma == 1.0
    assert {r["anomaly_score"] for r in anomaly.anomaly_score(flat, model, pairs_of(flat)).collect()} == {0.0}
    half = spark.createDataFrame([(0.0, float(i % 3)) for i in range(30)], SCHEMA)
    assert fit(half).gamma == pytest.approx(1.0)


def test_no_baseline(spark):
    with pytest.raises(ValueError):
        fit(spark.createDataFrame([], SCHEMA))


def test_zone_length_rule(spark):
    rows = [("short", 20), ("long", 21)]
    df = spark.createDataFrame(rows, "nom_clean string, zone_rows int")
    assert [r[0] for r in anomaly.usable_zones(df).collect()] == ["long"]


def test_evaluation_rows(spark):
    df = spark.createDataFrame(
        [(13, 3.0, 1.0), (14, None, 1.0), (14, 2.0, 1.0), (15, 2.1, -1.0), (16, 9.0, 0.0)],
        "day_idx int, rt_proxy double, anomaly_score double",
    )
    got = [(r["true_surge"], r["flagged"]) for r in anomaly.evaluation_rows(df).orderBy("day_idx").collect()]
    assert got == [(0, 1), (1, 0), (1, 0)]


def test_standardise_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], SCHEMA)
    got = anomaly.standardise(df, anomaly.standardiser(df), anomaly.FEATURES).orderBy("new_cases").collect()
    assert [(r["new_cases_std"], r["rolling_3d_new_cases_std"]) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]
    assert math.isclose(anomaly.standardiser(df).first()["new_cases_sd"], 1.0)


def test_scale_of_the_counts_does_not_matter(spark):
    """The same shares of rows give the same ranking, and scores in proportion, however many rows there are."""
    df = spark.createDataFrame(baseline(9, 700, values=9), SCHEMA)
    pairs = pairs_of(df)
    many = pairs.withColumn("box", F.col("box") * 1e8)
    order = list(anomaly.FEATURES)
    small, large = (
        anomaly.anomaly_score(df.distinct(), anomaly.fit_one_class(p, working_set=size), p).orderBy(order).collect()
        for p, size in ((pairs, 2_000), (many, 2_000))
    )
    assert [r["anomaly_score"] * 1e8 for r in small] == pytest.approx([r["anomaly_score"] for r in large], rel=1e-6, abs=1e-2)
    rank = [sorted(range(len(rows)), key=lambda i: (-rows[i]["anomaly_score"], i)) for rows in (small, large)]
    assert rank[0] == rank[1]


def test_solver_raises_when_it_cannot_close_the_gap():
    kernel = np.array([[1.0, 0.5], [0.5, 1.0]])
    with pytest.raises(RuntimeError):
        anomaly._solve(kernel, np.array([1.0, 1.0]), np.array([1.0, 0.0]), np.array([0.0, np.nan]), -1.0)


def test_above_one_working_set_equals_the_whole_solution(spark):
    """More distinct points than the default working set."""
    rng = random.Random(11)
    rows = [(float(rng.randint(0, 60)), rng.randint(0, 180) / 3) for _ in range(2_600)]
    pairs = pairs_of(spark.createDataFrame(rows, SCHEMA))
    assert pairs.count() > anomaly.WORKING_SET
    whole, parts = anomaly.fit_one_class(pairs, working_set=5_000), anomaly.fit_one_class(pairs)
    assert whole.points is None and parts.points is not None
    assert parts.rho == pytest.approx(whole.rho, rel=1e-9)


def test_grid_sums_equal_full_sums(spark):
    """Sums over cells against all pairs, within the stated bound, for near, far and lonely points."""
    draw = random.Random(3)
    vectors = [(draw.gauss(0, 1), draw.gauss(0, 1), draw.random()) for _ in range(400)] + [(40.0, -30.0, 5.0), (7.9, 0.0, 1.0)]
    targets = [v[:2] for v in vectors[:60]] + [(39.0, -29.0), (8.01, 0.01), (500.0, 500.0), (-7.999, 8.001)]
    names, scale = ["a", "b"], anomaly.Scale((0.1, -0.2), (1.5, 0.7))
    weighted = spark.createDataFrame(vectors, "a double, b double, alpha double")
    for size in (200_000, 7):
        sums = anomaly.kernel_sums(spark.createDataFrame(targets, "a double, b double"), weighted, names, scale, 0.5, size)
        got = {(r["a"], r["b"]): r["_sum"] for r in sums.collect()}
        assert len(got) == len(set(targets))
        points = scale.apply(np.array([v[:2] for v in vectors]))
        alpha = np.array([v[2] for v in vectors])
        for target in targets:
            full = np.exp(-0.5 * ((points - scale.apply(np.array(target))) ** 2).sum(axis=1)) @ alpha
            assert abs(got[target] - full) <= anomaly.LOST * alpha.sum()


def test_cascade_keeps_counts_and_needs_no_driver_rounds(spark):
    """Many small leaves, counts far apart: the same weights add up, and every point obeys the solution."""
    draw = random.Random(21)
    rows = [(float(draw.randint(0, 30)), draw.randint(0, 60) / 3) for _ in range(900)] + [(2.0, 1.0)] * 5000
    pairs = pairs_of(spark.createDataFrame(rows, SCHEMA))
    whole, parts = anomaly.fit_one_class(pairs), anomaly.fit_one_class(pairs, working_set=25)
    assert parts.rho == pytest.approx(whole.rho, rel=1e-8)
    assert parts.points.agg(F.sum("alpha")).first()[0] == pytest.approx(whole.alpha.sum(), rel=1e-9)


def test_gradients_that_are_not_finite_stop_the_solver():
    with pytest.raises(RuntimeError, match="finite"):
        anomaly._solve(np.eye(2), np.array([1.0, 1.0]), np.array([1.0, 0.0]), np.array([0.0, np.inf]), 1e-9)
