"""Feed-forward network with drop-out, class weight in the loss, Adam and early stopping, trained data-parallel.

Rows are standardised, dealt by hash into shards and stored as one packed row a shard. An iteration is one pass over the
shards: each gives the sum of its weighted gradients and its part of the loss on the held-out rows, sums are added up
in groups and then in all, in the order of the shards, and one Adam step follows on the 673 numbers of the network. So an
iteration moves a few kilobytes a shard however many rows there are, and a rerun gives the same weights to the last bit.

The positive class weighs n_neg / n_pos inside the gradient; no row is copied, and equal rows are one with a number. Drop-out
masks come from a hash of row, iteration and unit, so they depend on neither the dealing nor the order of rows. The latest dates are held out; when their
loss has not fallen for `PATIENCE` iterations, training ends and the weights with the lowest loss are kept.

An iteration steps on the whole gradient, not on batches of 64 rows: with rows on a thousand machines, a step of
64 rows would leave all but one of them idle. The step is larger in turn (`RATE`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outbreaklens.operators.anomaly import Scale, standardiser
from outbreaklens.operators.models import FEATURES, LABEL, SEED, VALIDATION_FRACTION, loss_weight, require_complete
from outbreaklens.operators.ordered import date_at_fraction
from outbreaklens.session import checkpointed

HIDDEN = (32, 16)
DROP = 0.3
ITERATIONS = 100
PATIENCE = 8
RATE = 0.02
BETAS = (0.9, 0.999)
SHARD_ROWS = 50_000
GROUP = 64  # sums that one task, or the driver, adds up
LEAST = 1e-7  # probabilities are kept this far from 0 and 1 in the loss

Layers = list[tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Network:
    """Weights (inputs x units) and biases of every layer, mean and deviation of the inputs.

    `losses` is the loss on the held-out rows before each step, `own_losses` the weighted one on the rows trained on.
    """

    layers: Layers
    mean: tuple[float, ...]
    sd: tuple[float, ...]
    losses: tuple[float, ...] = ()
    own_losses: tuple[float, ...] = ()


def started(sizes: tuple[int, ...], seed: int = SEED) -> Layers:
    """Weights drawn evenly from +-sqrt(6 / (inputs + units)), biases zero."""
    draw = np.random.default_rng(seed)
    return [
        (draw.uniform(-1, 1, (a, b)) * math.sqrt(6 / (a + b)), np.zeros(b)) for a, b in zip(sizes[:-1], sizes[1:])
    ]


def kept_units(rows: np.ndarray, iteration: int, layer: int, units: int, drop: float) -> np.ndarray:
    """Which units of a layer stay for every row, by a hash of row, iteration, layer and unit."""
    start = np.uint64((iteration * 64 + layer) * 0x9E3779B97F4A7C15 % 2**64)
    place = start + np.arange(units, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = rows.astype(np.uint64)[:, None] ^ place[None, :]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return (mixed ^ (mixed >> np.uint64(31))) >= np.uint64(int(drop * 2**64))


def forward(layers: Layers, x: np.ndarray) -> np.ndarray:
    """Probability of the positive class, nothing dropped."""
    for weights, bias in layers[:-1]:
        x = np.maximum(x @ weights + bias, 0)
    weights, bias = layers[-1]
    return 1 / (1 + np.exp(-(x @ weights + bias)[:, 0]))


def loss(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    p = np.clip(p, LEAST, 1 - LEAST)
    return -np.where(y == 1, np.log(p), np.log(1 - p))


def gradients(layers: Layers, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rows: np.ndarray, iteration: int, drop: float) -> np.ndarray:
    """Sum over rows of the weighted gradient of the loss, all layers in one array; drop-out scales what stays."""
    inputs, held = [x], []
    for layer, (weights, bias) in enumerate(layers[:-1]):
        reached = np.maximum(inputs[-1] @ weights + bias, 0)
        stay = kept_units(rows, iteration, layer, len(bias), drop) / (1 - drop)
        held.append((reached > 0) * stay)
        inputs.append(reached * stay)
    weights, bias = layers[-1]
    p = 1 / (1 + np.exp(-(inputs[-1] @ weights + bias)[:, 0]))
    back = ((p - y) * weight)[:, None]
    found = []
    for at in range(len(layers) - 1, -1, -1):
        found.append(np.concatenate([(inputs[at].T @ back).ravel(), back.sum(axis=0)]))
        if at:
            back = (back @ layers[at][0].T) * held[at - 1]
    return np.concatenate(found[::-1])


def _apart(flat: np.ndarray, layers: Layers) -> Layers:
    found, at = [], 0
    for weights, bias in layers:
        size = weights.size
        found.append((flat[at : at + size].reshape(weights.shape), flat[at + size : at + size + len(bias)]))
        at += size + len(bias)
    return found


def _together(layers: Layers) -> np.ndarray:
    return np.concatenate([part.ravel() for layer in layers for part in layer])


class Descent:
    """Adam on all numbers of the network, and early stopping on the held-out loss."""

    def __init__(self, layers: Layers, rate: float = RATE, patience: int = PATIENCE) -> None:
        self.layers, self.rate, self.patience = layers, rate, patience
        self.flat = _together(layers)
        self.mean, self.square, self.step = np.zeros_like(self.flat), np.zeros_like(self.flat), 0
        self.best, self.lowest, self.waited, self.losses = layers, math.inf, 0, []

    def seen(self, held_out_loss: float) -> bool:
        """Note the loss of the present weights; true when training should end."""
        self.losses.append(held_out_loss)
        if held_out_loss < self.lowest:
            self.best, self.lowest, self.waited = self.layers, held_out_loss, 0
        else:
            self.waited += 1
        return self.waited >= self.patience

    def move(self, gradient: np.ndarray) -> None:
        self.step += 1
        self.mean = BETAS[0] * self.mean + (1 - BETAS[0]) * gradient
        self.square = BETAS[1] * self.square + (1 - BETAS[1]) * gradient**2
        mean, square = self.mean / (1 - BETAS[0] ** self.step), self.square / (1 - BETAS[1] ** self.step)
        self.flat = self.flat - self.rate * mean / (np.sqrt(square) + 1e-7)
        self.layers = _apart(self.flat, self.layers)


def shards(
    rows: DataFrame, features: tuple[str, ...], scale: Scale, held_out: Column, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Stored rows (shard, n, payload): hash, label, held-out mark, number and scaled features of every distinct row of a shard.

    Equal rows are one row with their number as weight, so a shard cannot fill up with copies. The hash is that of the
    features as they are, which no rounding of the scale can change.
    """
    names = [f"x{i}" for i in range(len(features))]
    marked = rows.select(
        F.col(LABEL).cast("double").alias("y"),
        held_out.cast("double").alias("out"),
        *[F.col(c).cast("double").alias(name) for c, name in zip(features, names)],
    )
    folded = checkpointed(marked.groupBy("y", "out", *names).agg(F.count(F.lit(1)).cast("double").alias("copies")))
    count = max(1, math.ceil(folded.count() / shard_rows))
    hashed = folded.withColumn("row", F.xxhash64("y", "out", *names))
    dealt = hashed.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([(name, "ascending") for name in ("row", "y", "out", *names)])
        hashes = table.column("row").to_numpy()
        values = np.stack([table.column(name).to_numpy() for name in ("y", "out", "copies", *names)])
        values[3:] = scale.apply(values[3:].T).T
        payload = hashes.astype(np.int64).tobytes() + values.astype(np.float64).tobytes()
        return pa.table(
            [pa.array([table.column("shard")[0].as_py()], pa.int32()), pa.array([len(table)], pa.int64()), pa.array([payload], pa.binary())],
            names=["shard", "n", "payload"],
        )

    return checkpointed(dealt.groupBy("shard").applyInArrow(pack, "shard int, n long, payload binary"))


def opened(n: int, payload: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row hashes, labels, held-out marks, copies and inputs of a packed shard."""
    values = np.frombuffer(payload, np.float64, offset=8 * n).reshape(3 + width, n)
    return np.frombuffer(payload, np.uint64, n), values[0], values[1] > 0, values[2], values[3:].T


def _pass(packed: DataFrame, count: int, layers: Layers, width: int, positive: float, iteration: int, drop: float) -> np.ndarray:
    """One pass: (rows, gradient..., weighted loss, held-out rows, held-out loss) over all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, payload in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows, y, out, copies, x = opened(n, payload, width)
                own, weight = ~out, np.where(y == 1, positive, 1.0) * copies
                sums = gradients(layers, x[own], y[own], weight[own], rows[own], iteration, drop)
                missed = loss(forward(layers, x), y)
                found.append([
                    float(copies[own].sum()), *sums, float(missed[own] @ weight[own]), float(copies[out].sum()), float(missed[out] @ copies[out])
                ])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["shard", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        total = np.sum(np.array(table.column("sums").to_pylist()), axis=0)
        return pa.table([pa.array([table.column("team")[0].as_py()], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["team", "sums"])

    parts = packed.select("shard", "n", "payload").mapInArrow(run, "shard int, sums array<double>")
    # Tree-wise: groups of shards are added up by tasks until few enough sums are left for the driver.
    parts = parts.withColumnRenamed("shard", "team")
    while count > GROUP:
        teams = parts.select(F.col("team").alias("shard"), F.expr(f"team div {GROUP}").cast("int").alias("team"), "sums")
        parts, count = teams.groupBy("team").applyInArrow(add, "team int, sums array<double>"), math.ceil(count / GROUP)
    rows = sorted(parts.collect(), key=lambda row: row["team"])
    return np.sum(np.array([row["sums"] for row in rows]), axis=0)


def train(
    rows: DataFrame,
    features: tuple[str, ...] = FEATURES,
    hidden: tuple[int, ...] = HIDDEN,
    iterations: int = ITERATIONS,
    patience: int = PATIENCE,
    drop: float = DROP,
    seed: int = SEED,
    shard_rows: int = SHARD_ROWS,
) -> Network:
    """Train on `rows` (date, label, features); the last `VALIDATION_FRACTION` of the dates is held out."""
    require_complete(rows, features)
    told = standardiser(rows, features).first()
    # Sums may differ in their last bits from run to run; ten digits do not.
    mean, sd = (tuple(float(f"{told[f'{name}_{kind}']:.10g}") for name in features) for kind in ("mean", "sd"))
    scale = Scale(mean, tuple(value or 1.0 for value in sd))
    cutoff = date_at_fraction(rows, "date", 1 - VALIDATION_FRACTION).first()[0]
    held_out = F.col("date") >= F.lit(cutoff)
    positive = loss_weight(rows.where(~held_out)).first()["positive_weight"] or 1.0
    packed = shards(rows, features, scale, held_out, shard_rows)
    own_losses = []
    count = packed.agg(F.max("shard")).first()[0] + 1
    descent = Descent(started((len(features), *hidden, 1), seed), patience=patience)
    for iteration in range(iterations + 1):
        sums = _pass(packed, count, descent.layers, len(features), positive, iteration, drop)
        own_losses.append(sums[-3] / max(sums[0], 1))
        if descent.seen(sums[-1] / max(sums[-2], 1)) or iteration == iterations:
            break
        descent.move(sums[1:-3] / max(sums[0], 1))
    return Network(descent.best, scale.mean, scale.sd, tuple(descent.losses), tuple(own_losses))


def probability(network: Network, features: tuple[str, ...] = FEATURES) -> Column:
    """Probability of the positive class by one native expression on the raw features.

    The values of a layer are an array that is named once; every unit of the next is a plain sum over it.
    """
    number = lambda value: f"({float(value)!r}D)"
    scaled = [f"(CAST(`{name}` AS DOUBLE) - {number(mean)}) / {number(sd)}" for name, mean, sd in zip(features, network.mean, network.sd)]
    values = f"array({', '.join(scaled)})"
    for at, (weights, bias) in enumerate(network.layers):
        sums = [
            " + ".join([f"get(v, {i}) * {number(w)}" for i, w in enumerate(column)] + [number(b)]) for column, b in zip(weights.T, bias)
        ]
        last = at == len(network.layers) - 1
        units = sums if last else [f"greatest({one}, 0D)" for one in sums]
        values = f"get(transform(array({values}), v -> array({', '.join(units)})), 0)"
    return F.expr(f"1 / (1 + exp(-get({values}, 0)))")


def table(network: Network, spark: SparkSession) -> DataFrame:
    """The network as rows (layer, unit, weights, bias); layer -1 holds mean and deviation of every input."""
    rows = [(-1, i, [mean, sd], 0.0) for i, (mean, sd) in enumerate(zip(network.mean, network.sd))]
    for layer, (weights, bias) in enumerate(network.layers):
        rows += [(layer, unit, [float(w) for w in column], float(b)) for unit, (column, b) in enumerate(zip(weights.T, bias))]
    return spark.createDataFrame(rows, "layer int, unit int, weights array<double>, bias double")


def from_table(stored: DataFrame) -> Network:
    """The network of a stored table, of some fifty rows."""
    rows = stored.orderBy("layer", "unit").collect()
    scale = [row["weights"] for row in rows if row["layer"] < 0]
    layers = []
    for layer in range(rows[-1]["layer"] + 1):
        own = [row for row in rows if row["layer"] == layer]
        layers.append((np.array([row["weights"] for row in own]).T, np.array([row["bias"] for row in own])))
    return Network(layers, tuple(s[0] for s in scale), tuple(s[1] for s in scale))
