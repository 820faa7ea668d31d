"""One-class SVM on the early rows of every zone, and the anomaly score of every row.

Rows with equal features carry equal dual weight, so Spark first groups the baseline rows by feature
pair. The dual is solved on the distinct points by a cascade: points are dealt to leaves of at most one working
set, every leaf solves its own share in a task, and only points with weight go on, a few leaves together, until one
problem is left. Then every point is held against that solution; points that violate it join the last problem, until
there are none. A cascade has as many levels as the logarithm of the number of leaves. No point but support vectors
and violators leaves its leaf, and none of the solving happens on the driver.

Sums of kernels over many support vectors go through a grid. Vectors of a small cell are replaced by the moments of a
power series around its centre, and a point meets only the cells within the distance `REACH`. What the sums lose by that is
at most `LOST` of the total weight.

Counts enter as shares of all rows, so the problem has the same scale for any number of rows; offset and
weights are scaled back at the end. A solution is accepted only when the optimality gap, from a gradient
computed anew, is at most `GAP` of the largest gradient. There is no limit on steps or rounds: a solver that
no longer gets closer raises an error.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outbreaklens.operators.series import BASELINE_ROWS, WEEK_ROWS
from outbreaklens.session import checkpointed

FEATURES = ("new_cases", "rolling_3d_new_cases")
MIN_ROWS = BASELINE_ROWS + WEEK_ROWS
NU = 0.1
SURGE_RATIO = 2.0
WORKING_SET = 2_000
GAP = 1e-12  # of the largest gradient
STALLS = 3  # sweeps or gradients computed anew that bring nothing before the solver gives up
FAN = 4  # leaves that are merged into one
VIOLATION = 1e-11  # of the largest gradient, by which a point has to fall short to join the problem again
# The grid, in units in which the kernel is exp(-d^2 / 2).
CELL = 0.5
ORDERS = 14  # terms of the series a feature
REACH = 8.0
LOST = 1e-12
BROADCAST_PAIRS = 200_000
# Points on the boundary have score 0 up to solver error; scores below this share of the offset become 0.
BOUNDARY = 1e-7


def usable_zones(inputs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Rows of zones with enough rows for a baseline and a later period."""
    return inputs.where(F.col("zone_rows") >= min_rows)


def is_baseline(rows: int = BASELINE_ROWS) -> Column:
    return F.col("day_idx") < rows


def selection_summary(inputs: DataFrame, min_rows: int = MIN_ROWS, rows: int = BASELINE_ROWS) -> DataFrame:
    """Zones kept and dropped by the length rule, baseline rows to fit on and rows to score, as one row."""
    kept, first = F.col("zone_rows") >= min_rows, F.col("day_idx") == 0
    return inputs.agg(
        F.count_if(kept & first).alias("zones_kept"),
        F.count_if(~kept & first).alias("zones_dropped"),
        F.count_if(kept & (F.col("day_idx") < rows)).alias("baseline_rows"),
        F.count_if(kept).alias("scored_rows"),
    )


def standardiser(df: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Mean and population standard deviation per feature, as one row."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in features],
        *[F.stddev_pop(c).alias(f"{c}_sd") for c in features],
    )


def standardise(df: DataFrame, stats: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """Add `<feature>_std` from the one-row frame `stats`; a constant feature is only centred."""
    row = stats.select(F.struct("*")).scalar()
    return df.select(
        "*",
        *[
            (
                (F.col(c) - row[f"{c}_mean"])
                / F.when(row[f"{c}_sd"] > 0, row[f"{c}_sd"]).otherwise(F.lit(1.0))
            ).alias(f"{c}_std")
            for c in features
        ],
    )


@dataclass(frozen=True)
class Scale:
    mean: tuple[float, ...]
    sd: tuple[float, ...]

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.mean)) / np.array(self.sd)


@dataclass(frozen=True)
class OneClassModel:
    """Scale, kernel width, offset, and the weighted support vectors.

    `vectors` and `alpha` hold them when all points fitted on fit into one working set; otherwise `points` is
    a stored table (features, alpha).
    """

    features: tuple[str, ...]
    scale: Scale
    gamma: float
    rho: float
    vectors: np.ndarray | None = None
    alpha: np.ndarray | None = None
    points: DataFrame | None = None


def _kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    squared = sum((a[:, i][:, None] - b[:, i][None, :]) ** 2 for i in range(a.shape[1]))
    return np.exp(-gamma * squared)


def _gap(alpha: np.ndarray, box: np.ndarray, grad: np.ndarray) -> float:
    """Optimality gap as a share of the largest gradient."""
    up, down = grad[alpha < box], grad[alpha > 0]
    return float((down.max() - up.min()) / np.abs(grad).max()) if up.size and down.size else 0.0


def _descend(kernel: np.ndarray, box: np.ndarray, alpha: np.ndarray, grad: np.ndarray, gap: float, steps: int) -> None:
    """Steps of pairwise descent on 1/2 a'Ka with fixed sum and 0 <= a <= box; changes alpha and grad in place."""
    least = gap * np.abs(grad).max()
    for _ in range(steps):
        up = np.where(alpha < box, grad, np.inf)
        down = np.where(alpha > 0, grad, -np.inf)
        i = int(np.argmin(up))
        excess = down - up[i]
        if excess.max() <= least:
            return
        curvature = np.maximum(2.0 - 2.0 * kernel[i], 1e-12)
        j = int(np.argmax(np.where(excess > 0, excess**2 / curvature, -np.inf)))
        step = min(excess[j] / curvature[j], box[i] - alpha[i], alpha[j])
        # Land exactly on the bound, so that it is recognised as one in the next round.
        alpha[i] = box[i] if step == box[i] - alpha[i] else alpha[i] + step
        alpha[j] = 0.0 if step == alpha[j] else alpha[j] - step
        grad += step * (kernel[i] - kernel[j])


def _solve(kernel: np.ndarray, box: np.ndarray, alpha: np.ndarray, outside: np.ndarray | float, gap: float) -> np.ndarray:
    """Descend until the gap is closed; `outside` is the gradient that other points add. Returns the gradient.

    The gradient is computed anew after every sweep, and only such a gradient ends the search.
    """
    lowest, nearest, stalls = math.inf, math.inf, 0
    while True:
        own = kernel @ alpha
        grad = own + outside
        if not np.isfinite(grad).all():
            raise RuntimeError("the one-class SVM did not converge: the gradient is not finite")
        open_gap, value = _gap(alpha, box, grad), float(alpha @ (own / 2 + outside))
        if open_gap <= gap:
            return grad
        stalls = 0 if value < lowest or open_gap < nearest else stalls + 1
        if stalls > STALLS:
            raise RuntimeError(f"the one-class SVM did not converge: gap {open_gap:.3g}")
        lowest, nearest = min(lowest, value), min(nearest, open_gap)
        _descend(kernel, box, alpha, grad, gap / 2, 20 * len(box) + 1_000)


def _offset(alpha: np.ndarray, box: np.ndarray, grad: np.ndarray) -> float:
    free = (alpha > 0) & (alpha < box)
    if free.any():
        return float(grad[free].mean())
    below = grad[alpha >= box].max()
    above = grad[alpha <= 0]
    return float((below + above.min()) / 2) if above.size else float(below)


def feature_pairs(rows: DataFrame, fitted: Column, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Distinct feature values of all rows, stored, with the number of rows to fit on as `box`.

    One pass over the rows, aggregated on the map side, serves both the fit and the scoring.
    """
    return checkpointed(rows.groupBy(*features).agg(F.count_if(fitted).cast("double").alias("box")))


def _solve_points(x: np.ndarray, box: np.ndarray, alpha: np.ndarray, gamma: float, size: int) -> np.ndarray:
    """Solve for any number of points with kernels of at most `size` of them at a time; changes alpha, returns the gradient.

    Beyond `size` points the worst violators are solved for, and all gradients follow the change.
    """
    if len(x) <= size:
        return _solve(_kernel(x, x, gamma), box, alpha, 0.0, GAP)

    def sums(vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
        found = np.zeros(len(x))
        for at, to in itertools.product(range(0, len(x), size), range(0, len(vectors), size)):
            found[at : at + size] += _kernel(x[at : at + size], vectors[to : to + size], gamma) @ weights[to : to + size]
        return found

    def anew() -> np.ndarray:
        held = alpha > 0
        return sums(x[held], alpha[held])

    grad, fresh, nearest, stalls = anew(), True, math.inf, 0
    while True:
        open_gap = _gap(alpha, box, grad)
        if open_gap <= GAP and fresh:
            return grad
        moved = np.zeros(0, int)
        if open_gap > GAP:
            up, down = np.flatnonzero(alpha < box), np.flatnonzero(alpha > 0)
            up, down = up[np.argsort(grad[up], kind="stable")[: size // 2]], down[np.argsort(-grad[down], kind="stable")[: size // 2]]
            work = np.union1d(up, down)
            kernel, own = _kernel(x[work], x[work], gamma), alpha[work].copy()
            _solve(kernel, box[work], own, grad[work] - kernel @ alpha[work], GAP / 2)
            moved, change = work[own != alpha[work]], (own - alpha[work])[own != alpha[work]]
            alpha[work] = own
        if len(moved):
            grad, fresh = grad + sums(x[moved], change), False
            continue
        stalls = stalls + 1 if fresh or open_gap >= nearest else 0
        if stalls > STALLS:
            raise RuntimeError(f"the one-class SVM did not converge: gap {open_gap:.3g}")
        nearest, grad, fresh = min(nearest, open_gap), anew(), True


def fit_one_class(
    pairs: DataFrame, features: tuple[str, ...] = FEATURES, nu: float = NU, working_set: int = WORKING_SET
) -> OneClassModel:
    """Fit on the pairs that hold rows to fit on, by a cascade of leaves of at most `working_set` points."""
    points = pairs.where("box > 0")
    total = F.sum("box")
    told = points.agg(
        F.count(F.lit(1)).alias("n"),
        total.alias("rows"),
        *[(F.sum(F.col(c) * F.col("box")) / total).alias(c) for c in features],
        *[(F.min(c) < F.max(c)).alias(f"{c}_varies") for c in features],
    ).first()
    if not told["n"]:
        raise ValueError("no baseline rows to fit on")
    spread = points.agg(
        *[F.sqrt(F.sum(F.col("box") * F.pow(F.col(c) - F.lit(told[c]), 2)) / total).alias(c) for c in features]
    ).first()
    scale, gamma = _scale([told[c] for c in features], [spread[c] if told[f"{c}_varies"] else 0.0 for c in features])
    rows, leaves = float(told["rows"]), max(1, math.ceil(told["n"] / working_set))
    names = list(features)
    schema = ", ".join([*(f"{c} double" for c in names), "box double, alpha double, leaf int, offset double"])

    def solved(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["box", *names], ascending=[False, *[True] * len(names)])
        x, box = scale.apply(frame[names].to_numpy(float)), frame["box"].to_numpy(float)
        alpha = frame["alpha"].to_numpy(float).copy()
        if np.isnan(alpha).any():  # a leaf: its own mass, on the most frequent points first
            alpha = np.clip(nu * box.sum() - (box.cumsum() - box), 0.0, box)
        grad = _solve_points(x, box, alpha, gamma, working_set)
        found = frame.assign(alpha=alpha, offset=_offset(alpha, box, grad))
        return found[found["alpha"] > 0][[*names, "box", "alpha", "leaf", "offset"]]

    def merged(df: DataFrame, count: int) -> DataFrame:
        return checkpointed(df.withColumn("leaf", F.pmod("leaf", F.lit(count)).cast("int")).groupBy("leaf").applyInPandas(solved, schema))

    dealt = points.select(
        *[F.col(c).cast("double").alias(c) for c in names],
        (F.col("box") / F.lit(rows)).alias("box"),
        F.lit(None).cast("double").alias("alpha"),
        F.pmod(F.xxhash64(*names), F.lit(leaves)).cast("int").alias("leaf"),
        F.lit(None).cast("double").alias("offset"),
    )
    held, width = merged(dealt, leaves), leaves
    while width > 1:
        width = math.ceil(width / FAN)
        held = merged(held, width)
    while leaves > 1:
        joined = _violators(dealt, held, names, scale, gamma)
        if joined.isEmpty():
            break
        held = merged(held.unionByName(joined), 1)
    offset = held.select(F.max("offset")).first()[0]
    held = held.select(*names, (F.col("alpha") * rows).alias("alpha"))
    if leaves == 1:
        own = held.toPandas()
        vectors = scale.apply(own[names].to_numpy(float))
        return OneClassModel(features, scale, gamma, rows * offset, vectors, own["alpha"].to_numpy(float))
    return OneClassModel(features, scale, gamma, rows * offset, points=held)


def _violators(dealt: DataFrame, held: DataFrame, names: list[str], scale: Scale, gamma: float) -> DataFrame:
    """Points without weight whose gradient lies below the offset, stored; they join the last problem with weight 0."""
    sums = kernel_sums(dealt.select(*names), held, names, scale, gamma).withColumnRenamed("_sum", "_grad")
    told = held.agg(F.max("offset").alias("offset"))
    least = told.scalar() - F.lit(VIOLATION) * sums.agg(F.max(F.abs("_grad"))).scalar()
    short = sums.where(F.col("_grad") < least).join(held.select(*names), names, "left_anti")
    return checkpointed(
        dealt.join(short.select(*names), names, "left_semi").withColumn("alpha", F.lit(0.0)).select(*held.columns)
    )


def _scale(mean, deviation) -> tuple[Scale, float]:
    """The scale, where a constant feature is only centred, and the kernel width that goes with it:
    1 / (features x variance of the standardised matrix)."""
    varying = sum(float(sd) > 0 for sd in deviation)
    sd = tuple(float(sd) if sd > 0 else 1.0 for sd in deviation)
    return Scale(tuple(map(float, mean)), sd), 1.0 / varying if varying else 1.0


def _places(names: list[str], scale: Scale, gamma: float) -> list[Column]:
    """The features in units in which the kernel is exp(-d^2 / 2)."""
    unit = math.sqrt(2 * gamma)
    return [(F.col(c) - F.lit(mean)) / F.lit(sd) * F.lit(unit) for c, mean, sd in zip(names, scale.mean, scale.sd)]


def moments(vectors: DataFrame, names: list[str], scale: Scale, gamma: float) -> DataFrame:
    """Weighted vectors by grid cell: (cell, moments) with `ORDERS` powers a feature around the centre of the cell.

    exp(-|x - y|^2 / 2) = exp(-|t|^2 / 2) * prod sum_j (t d)^j / j! * exp(-|d|^2 / 2) with t = x - c and d = y - c.
    """
    places = _places(names, scale, gamma)
    cells = [F.floor(place / F.lit(CELL)) for place in places]
    known = vectors.select(
        F.array(*cells).alias("cell"),
        *[(place - (cell + 0.5) * CELL).alias(f"_d{i}") for i, (place, cell) in enumerate(zip(places, cells))],
        F.col("alpha"),
    )
    squared = sum((F.col(f"_d{i}") * F.col(f"_d{i}") for i in range(len(names))), F.lit(0.0))
    known = known.withColumn("alpha", F.col("alpha") * F.exp(-squared / 2))

    def power(orders: tuple[int, ...]) -> Column:
        term = F.col("alpha")
        for i, order in enumerate(orders):
            if order:
                term = term * F.pow(F.col(f"_d{i}"), F.lit(float(order)))
        return term

    every = list(itertools.product(range(ORDERS), repeat=len(names)))
    sums = known.groupBy("cell").agg(*[F.sum(power(orders)).alias(f"_m{i}") for i, orders in enumerate(every)])
    return sums.select("cell", F.array(*[F.col(f"_m{i}") for i in range(len(every))]).alias("moments"))


def series_sums(x: np.ndarray, cells: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Kernel sums at the points `x`, in grid units, of the vectors in `cells` with these moments."""
    width = x.shape[1]
    factor = np.cumprod([1.0, *range(1, ORDERS)])
    found = np.zeros(len(x))
    for cell, own in zip(cells, sums):
        t = x - (cell + 0.5) * CELL
        near = np.flatnonzero((t * t).sum(axis=1) < (REACH + CELL) ** 2)
        if not len(near):
            continue
        t = t[near]
        powers = t[:, :, None] ** np.arange(ORDERS) / factor
        part = powers[:, 0, :] @ own.reshape(ORDERS, -1)
        for i in range(1, width):
            part = (powers[:, i, :, None] * part.reshape(len(t), ORDERS, -1)).sum(axis=1)
        found[near] += np.exp(-(t * t).sum(axis=1) / 2) * part.reshape(len(t))
    return found


def kernel_sums(
    targets: DataFrame, vectors: DataFrame, names: list[str], scale: Scale, gamma: float, size: int = BROADCAST_PAIRS
) -> DataFrame:
    """Kernel sum of all weighted `vectors` at every distinct target: (names, _sum).

    Targets meet the cells of their own and of the neighbouring large squares, whose side is `REACH`. A square with very
    many targets is dealt to several tasks. The moments are as many rows as there are cells with vectors in them.
    """
    schema = ", ".join(f"{c} double" for c in [*names, "_sum"])
    parts = max(1, math.ceil(targets.count() / size))
    ratio = round(REACH / CELL)
    squares = F.transform("cell", lambda c: F.floor(c / ratio))
    packed = (
        moments(vectors, names, scale, gamma)
        .groupBy(squares.alias("square"))
        .agg(F.collect_list(F.struct("cell", "moments")).alias("cells"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    )
    places = _places(names, scale, gamma)
    around = F.array(*[F.array(*[F.lit(step) for step in steps]) for steps in itertools.product((-1, 0, 1), repeat=len(names))])
    own = F.array(*[F.floor(place / F.lit(REACH)) for place in places])
    located = targets.select(
        F.struct(*names).alias("_row"),
        F.array(*places).alias("_place"),
        F.pmod(F.xxhash64(*names), F.lit(parts)).cast("int").alias("part"),
        F.explode(F.transform(around, lambda step: F.zip_with(own, step, lambda a, b: a + b))).alias("square"),
    )
    # Rows of a square come in lists of bounded length; the cells stand in a list once a square and part.
    lists = located.groupBy("square", "part", F.pmod(F.xxhash64("_row"), F.lit(64)).alias("_list")).agg(
        F.collect_list(F.struct("_row", "_place")).alias("rows")
    )
    met = lists.join(packed, ["square", "part"]).select("rows", "cells")

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows, cells in zip(batch["rows"], batch["cells"]):
                x = np.array([list(row["_place"]) for row in rows], float)
                total = series_sums(x, np.array([list(c["cell"]) for c in cells]), np.array([c["moments"] for c in cells]))
                part = pd.DataFrame([[row["_row"][c] for c in names] for row in rows], columns=names)
                yield part.assign(_sum=total)

    near = met.mapInPandas(add, schema)
    # A target far from every vector has the sum 0.
    return near.unionByName(targets.select(*names, F.lit(0.0).alias("_sum"))).groupBy(*names).agg(F.sum("_sum").alias("_sum"))


def _kernel_sum(model: OneClassModel) -> Column:
    """Kernel sum over literal support vectors, as a native expression."""
    scaled = [
        (F.col(c) - F.lit(mean)) / F.lit(sd) for c, mean, sd in zip(model.features, model.scale.mean, model.scale.sd)
    ]
    axes = [F.array(*[F.lit(float(v)) for v in axis]) for axis in model.vectors.T]
    weights = F.array(*[F.lit(float(a)) for a in model.alpha])
    vectors = F.arrays_zip(*[a.alias(f"x{i}") for i, a in enumerate(axes)], weights.alias("alpha"))

    def term(total: Column, v: Column) -> Column:
        squared = sum((F.pow(s - v[f"x{i}"], 2) for i, s in enumerate(scaled)), F.lit(0.0))
        return total + v["alpha"] * F.exp(F.lit(-model.gamma) * squared)

    return F.aggregate(vectors, F.lit(0.0), term)


def anomaly_score(
    rows: DataFrame, model: OneClassModel, pairs: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """Add `anomaly_score`, the negated decision value: higher is more anomalous.

    Every distinct feature pair is scored once and joined back to the rows. Few pairs are broadcast;
    many take part in a shuffle join, where AQE splits the frequent ones.
    """
    features = list(model.features)
    scored = pairs.select(*features)
    if model.points is None:
        scored = scored.withColumn("_kernel_sum", _kernel_sum(model))
    else:
        sums = kernel_sums(scored, model.points, features, model.scale, model.gamma)
        scored = checkpointed(sums.withColumnRenamed("_sum", "_kernel_sum"))
    value = F.lit(model.rho) - F.col("_kernel_sum")
    value = F.when(F.abs(value) < BOUNDARY * abs(model.rho), F.lit(0.0)).otherwise(value)
    scored = scored.select(*features, value.alias("anomaly_score"))
    if pairs.limit(broadcast_pairs + 1).count() <= broadcast_pairs:
        scored = F.broadcast(scored)
    return rows.join(scored, features).select(*rows.columns, "anomaly_score")


def evaluation_rows(scored: DataFrame, surge_ratio: float = SURGE_RATIO, baseline: int = BASELINE_ROWS) -> DataFrame:
    """Rows after the baseline with a known growth ratio, with the surge label and the SVM's own class."""
    later = scored.where((F.col("day_idx") >= baseline) & F.col("rt_proxy").isNotNull())
    return later.withColumn("true_surge", (F.col("rt_proxy") > surge_ratio).cast("int")).withColumn(
        "flagged", (F.col("anomaly_score") > 0).cast("int")
    )
