"""Node table of a forest: walked by columns, by hand and by the library; importances from the nodes."""

import random

import pytest
from pyspark.sql import functions as F

from outbreaklens.operators import forest, models

SCHEMA = "cumulative_confirmed_cases double, days_since_first_case double, population_density double, label_next_7d_onset int"


@pytest.fixture(scope="module")
def train(spark):
    draw = random.Random(4)
    rows = [(draw.uniform(0, 100), float(draw.randrange(60)), draw.random()) for _ in range(500)]
    return spark.createDataFrame([(*r, int(r[0] + draw.gauss(0, 15) > 50)) for r in rows], SCHEMA).cache()


@pytest.fixture(scope="module")
def fitted(train):
    return models.train_forest(train, trees=15, depth=4)


def test_walk_equals_library_and_hand(spark, train, fitted):
    table = forest.nodes(fitted, spark)
    scored = forest.with_probability(models.with_probability(fitted, train, "library"), table, models.FEATURES, 4, "walked").collect()
    trees = {}
    for node in table.collect():
        trees.setdefault(node["tree"], {})[node["id"]] = node
    assert len(trees) == 15 and max(len(t) for t in trees.values()) <= 31
    for row in scored:
        shares = []
        for tree in trees.values():
            at = tree[0]
            while at["feature"] >= 0:
                at = tree[at["left"] if row[models.FEATURES[at["feature"]]] <= at["threshold"] else at["right"]]
            shares.append(at["positive"])
        assert row["walked"] == pytest.approx(row["library"], abs=1e-12) == pytest.approx(sum(shares) / 15, abs=1e-12)


def test_importances(spark, train, fitted):
    own = {r["feature"]: r["importance"] for r in forest.importances(forest.nodes(fitted, spark), models.FEATURES).collect()}
    assert own == pytest.approx(dict(models.importances(fitted))) and sum(own.values()) == pytest.approx(1)


def test_a_forest_without_a_split(spark, train):
    flat = train.withColumn("label_next_7d_onset", F.lit(1))
    fitted = models.train_forest(flat, trees=3)
    table = forest.nodes(fitted, spark)
    assert {r["importance"] for r in forest.importances(table, models.FEATURES).collect()} == {0.0}
    scored = forest.with_probability(train, table, models.FEATURES, models.DEPTH)
    assert {r[0] for r in scored.select("onset_probability").distinct().collect()} == {1.0}
    assert forest.with_probability(train.limit(0), table, models.FEATURES, models.DEPTH).collect() == []


def test_every_cell_is_walked_once(spark, train, fitted, monkeypatch):
    """Many rows cost no more walks than there are cells; at, beside and far from a threshold, and with nothing, they go as a row that is walked."""
    table = forest.nodes(fitted, spark)
    cuts = [sorted({r["threshold"] for r in table.collect() if r["feature"] == i}) for i in range(3)]
    draw = random.Random(5)
    sides = [[*own, *[cut + 1e-9 for cut in own], *[cut - 1e-9 for cut in own], -1e300, float("inf"), float("nan"), None] for own in cuts]
    rows = spark.createDataFrame([tuple(draw.choice(side) for side in sides) for _ in range(2000)], SCHEMA.rsplit(",", 1)[0]).coalesce(1)
    by_cell = forest.with_probability(rows, table, models.FEATURES, 4, "p")
    plan = by_cell._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0]
    assert "_trees" not in plan  # the rows themselves are not walked
    monkeypatch.setattr(forest, "GRID_CELLS", 0)
    by_row = forest.with_probability(rows, table, models.FEATURES, 4, "p")
    assert [r["p"] for r in by_cell.collect()] == [r["p"] for r in by_row.collect()]
