"""The distributed network against a plain version that keeps every row: steps, stopping, weights."""

import datetime as dt
import math
import random

import numpy as np
import pytest

from outbreaklens.operators import models, network

SCHEMA = (
    "date date, cumulative_confirmed_cases double, days_since_first_case int, population_density double, label_next_7d_onset int"
)


def rows_of(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        cases = float(draw.randint(0, 100))
        label = int(cases + draw.gauss(0, 10) > 70)
        rows.append((dt.date(2026, 5, 1) + dt.timedelta(days=i // 10), cases, draw.randint(0, 60), draw.random(), label))
    return rows


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(rows_of(11, 400) + rows_of(11, 40), SCHEMA).cache()  # some rows twice


def plain(spark, train, iterations, patience, drop=network.DROP):
    """Row by row: forward, masks, backward and Adam written out; (losses, weights of the lowest)."""
    from pyspark.sql import functions as F

    from outbreaklens.operators.anomaly import standardise, standardiser
    from outbreaklens.operators.ordered import date_at_fraction

    cutoff = date_at_fraction(train, "date", 0.85).first()[0]
    inputs = [f"{name}_std" for name in models.FEATURES]
    scaled = standardise(train, standardiser(train, models.FEATURES), models.FEATURES)
    marked = scaled.select(
        F.col(models.LABEL).cast("double").alias("y"), (F.col("date") >= F.lit(cutoff)).cast("double").alias("out"),
        *[F.col(name).cast("double").alias(name) for name in models.FEATURES], *inputs,
    )
    rows = marked.select("*", F.xxhash64("y", "out", *models.FEATURES).alias("row")).collect()
    own, held = [r for r in rows if not r["out"]], [r for r in rows if r["out"]]
    n_pos = sum(r["y"] for r in own)
    weight = {1.0: (len(own) - n_pos) / n_pos, 0.0: 1.0}
    layers = network.started((3, 32, 16, 1))
    moments = [[np.zeros_like(p) for p in layer] + [np.zeros_like(p) for p in layer] for layer in layers]
    losses, best, lowest, waited = [], None, math.inf, 0
    for iteration in range(iterations + 1):
        missed = 0.0
        for r in held:
            x = np.array([r[name] for name in inputs])
            for w, b in layers[:-1]:
                x = np.maximum(w.T @ x + b, 0)
            p = 1 / (1 + math.exp(-(layers[-1][0].T @ x + layers[-1][1])[0]))
            missed -= math.log(min(max(p if r["y"] else 1 - p, 1e-7), 1 - 1e-7))
        losses.append(missed / len(held))
        if losses[-1] < lowest:
            best, lowest, waited = [(w.copy(), b.copy()) for w, b in layers], losses[-1], 0
        else:
            waited += 1
        if waited >= patience or iteration == iterations:
            return losses, best
        sums = [[np.zeros_like(p) for p in layer] for layer in layers]
        for r in own:
            hashed = np.array([r["row"]], np.int64).view(np.uint64)
            x, seen = np.array([r[name] for name in inputs]), []
            for at, (w, b) in enumerate(layers[:-1]):
                reached = w.T @ x + b
                mask = network.kept_units(hashed, iteration, at, len(b), drop)[0] * (reached > 0) / (1 - drop)
                seen.append((x, mask))
                x = reached * mask
            out = 1 / (1 + math.exp(-(layers[-1][0].T @ x + layers[-1][1])[0]))
            back = np.array([(out - r["y"]) * weight[r["y"]]])
            sums[-1][0] += np.outer(x, back)
            sums[-1][1] += back
            for at in range(len(layers) - 2, -1, -1):
                x, mask = seen[at]
                back = (layers[at + 1][0] @ back) * mask
                sums[at][0] += np.outer(x, back)
                sums[at][1] += back
        for at, layer in enumerate(layers):
            moved = []
            for i, part in enumerate(layer):
                g = sums[at][i] / len(own)
                m, v = moments[at][i], moments[at][2 + i]
                m[...] = 0.9 * m + 0.1 * g
                v[...] = 0.999 * v + 0.001 * g * g
                moved.append(part - network.RATE * (m / (1 - 0.9 ** (iteration + 1))) / (np.sqrt(v / (1 - 0.999 ** (iteration + 1))) + 1e-7))
            layers[at] = tuple(moved)


def test_equal_to_the_plain_version(spark, train):
    losses, best = plain(spark, train, 12, 8)
    fitted = network.train(train, iterations=12)
    assert fitted.losses == pytest.approx(losses, rel=1e-8)
    for (w, b), (v, c) in zip(fitted.layers, best):
        assert np.allclose(w, v, rtol=1e-6, atol=1e-8) and np.allclose(b, c, rtol=1e-6, atol=1e-8)


def test_stops_where_the_plain_version_stops(spark, train):
    losses, best = plain(spark, train, 60, 1)
    fitted = network.train(train, iterations=60, patience=1)
    assert len(fitted.losses) == len(losses) < 61
    assert np.allclose(fitted.layers[0][0], best[0][0], rtol=1e-5, atol=1e-7)
    assert fitted.losses.index(min(fitted.losses)) == len(losses) - 2


def test_rerun_and_dealing(spark, train):
    one, two = network.train(train, iterations=4), network.train(train.repartition(7), iterations=4)
    assert all(np.array_equal(a, b) for x, y in zip(one.layers, two.layers) for a, b in zip(x, y))
    three = network.train(train, iterations=4, shard_rows=4)  # more shards than one group
    assert all(np.allclose(a, b, rtol=1e-9) for x, y in zip(one.layers, three.layers) for a, b in zip(x, y))


def test_learns_and_stores(spark, train):
    from pyspark.sql import functions as F

    from outbreaklens.operators import metrics

    fitted = network.train(train, iterations=60)
    assert min(fitted.losses) < fitted.losses[0] - 0.1
    scored = train.withColumn("onset_probability", network.probability(fitted))
    base = train.agg(F.avg(models.LABEL)).first()[0]
    assert metrics.average_precision(scored, models.LABEL, "onset_probability").first()[0] > base + 0.3
    again = network.from_table(network.table(fitted, spark))
    assert all(np.array_equal(a, b) for x, y in zip(fitted.layers, again.layers) for a, b in zip(x, y))


def test_missing_values_stop_training(spark):
    broken = spark.createDataFrame([(dt.date(2026, 5, 1), 1.0, 1, None, 0)], SCHEMA)
    with pytest.raises(ValueError, match="population_density"):
        network.train(broken)
