"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other knowledge is unlabelled text, which holds toxic documents at the
rate of the class prior. A classifier is trained by the non-negative risk estimator: with prior p and logistic loss l,

    p * mean_P l(f) + max(0, mean_U l(-f) - p * mean_P l(-f)),

where a step that finds the second term negative climbs back on it alone, so that the corrected risk of the negative
class cannot be driven below zero by learning positives by heart.

The fit reads a bounded sample: at most `POSITIVES` confirmed texts and `UNLABELLED` of all, those of the least row hash,
whole and each once however often it is repeated. Features are at most `FEATURES` terms, present or absent, that positives
hold most significantly more often than clean texts. `MEMBERS` classifiers are trained with numpy, each in its own task on
all positives and all but its own share of the unlabelled texts; a score is the mean of their probabilities. The constant
is raised, by `MOST_SHIFT` at most, until `CAUGHT` of the prior's share of unlabelled texts scores one half; a text
without any of the terms stays at the prior. The prior is the share of confirmed documents among labelled ones unless it
is given. Only term numbers and weights reach the driver.

Labels of one id are combined: confirmed means that all of them say 1; null labels say nothing. Rows without an id teach
nothing and count as held out. Null and empty texts score what the absence of all terms says. Without a confirmed
document every score is 0. Repeated rows are scored each; an empty table gives no rows; other columns are not read. A
text is scored whole, so it has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outbreaklens.llm.wordhash import terms
from outbreaklens.session import checkpointed

POSITIVES = 4_000
UNLABELLED = 16_000
FEATURES = 1024
LEAST_TEXTS = 3  # positives that hold a term before it may be a feature
LEAST_GAP = 2.5  # standard errors between a term's frequencies
CAUGHT = 0.9  # share of the prior that scores 0.5 or more among unlabelled texts
MOST_SHIFT = 2.0
MEMBERS = 5
EPOCHS = 20
BATCH = 1024  # unlabelled rows a step
LEAST_POSITIVES = 64  # positives a step, if there are as many
RATE = 0.05
PENALTY = 1e-4
SEED = 11


class Model(NamedTuple):
    """Sorted hashes of the feature terms, and for each classifier the weights with the constant last."""

    words: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(texts))
        bits = present(texts, self.words)
        reach = bits @ self.weights[:, :-1].T + self.weights[:, -1]
        return (1 / (1 + np.exp(-np.clip(reach, -50, 50)))).mean(axis=1)


def present(texts: list[str | None], words: np.ndarray) -> np.ndarray:
    """One row a text: which of the sorted `words` it holds."""
    bits = np.zeros((len(texts), len(words)), np.float32)
    found = terms(texts)
    if len(words) and len(found.hashes):
        at = np.minimum(np.searchsorted(words, found.hashes), len(words) - 1)
        hit = words[at] == found.hashes
        bits[found.text[hit], at[hit]] = 1
    return bits


def held_out(key: str = "doc_id") -> Column:
    """True for the rows whose labels the fit must not see; a null id belongs to them."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """The two terms of the estimator for values of the classifier, the second one before it is cut at zero."""
    own = prior * np.logaddexp(0, -positive).mean()
    return own, np.logaddexp(0, unlabelled).mean() - prior * np.logaddexp(0, positive).mean()


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of one linear classifier, by batches of unlabelled rows, each with its share of positives, and Adam."""

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))

    def back(bits: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(slope @ bits, slope.sum()) / len(bits)

    draw = np.random.default_rng(seed)
    weights = np.zeros(positive.shape[1] + 1)
    mean, square, step = np.zeros_like(weights), np.zeros_like(weights), 0
    batches = max(1, min(len(unlabelled) // BATCH, len(positive) // LEAST_POSITIVES))
    for _ in range(epochs):
        orders = [draw.permutation(len(rows)) for rows in (positive, unlabelled)]
        for at in range(batches):
            step += 1
            own, rest = positive[orders[0][at::batches]], unlabelled[orders[1][at::batches]]
            p, u = own @ weights[:-1] + weights[-1], rest @ weights[:-1] + weights[-1]
            negative = back(rest, sigmoid(u)) - prior * back(own, sigmoid(p))
            if risk(p, u, prior)[1] >= 0:
                gradient = prior * back(own, -sigmoid(-p)) + negative
            else:
                gradient = -negative
            gradient[:-1] += PENALTY * weights[:-1]
            mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
            weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights[-1] += shift(unlabelled @ weights[:-1] + weights[-1], weights[-1], prior)
    return weights


def shift(values: np.ndarray, constant: float, prior: float) -> float:
    """What to add so that `CAUGHT` of the prior lies at zero or above: regularised weights alone say too little.

    A text without any of the terms stays at the prior or below.
    """
    wanted = -np.quantile(values, 1 - CAUGHT * prior) if len(values) else 0.0
    return float(max(min(wanted, MOST_SHIFT, np.log(prior / (1 - prior)) - constant), 0.0))


def _sample(df: DataFrame, labels: DataFrame, key: str, text: str, positives: int, unlabelled: int) -> tuple[DataFrame, float]:
    """Stored rows (draw, confirmed, open, text) of the sample, and the share of confirmed ids among the labelled."""
    judged = (
        labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull() & ~held_out(key))
        .groupBy(F.col(key).cast("long").alias("id"))
        .agg((F.min("toxic") == 1).alias("confirmed"))
    )
    judged = checkpointed(judged)
    share = judged.agg(F.avg(F.col("confirmed").cast("double"))).first()[0] or 0.0
    # The draw depends on the text alone where ids repeat, so equal rows are one.
    rows = df.where(F.col(key).isNotNull() & ~held_out(key)).select(
        F.col(key).cast("long").alias("id"), F.xxhash64(F.lit(SEED), key, text).alias("draw"), F.col(text).alias("text")
    )
    drawn = rows.select("id", "draw").distinct()
    confirmed = drawn.join(judged.where("confirmed").select("id"), "id", "left_semi").select("draw")
    chosen = confirmed.orderBy("draw").limit(positives).select("draw", F.lit(True).alias("confirmed"), F.lit(False).alias("open"))
    others = drawn.select("draw").orderBy("draw").limit(unlabelled).select("draw", F.lit(False).alias("confirmed"), F.lit(True).alias("open"))
    chosen = checkpointed(chosen.unionByName(others).groupBy("draw").agg(F.max("confirmed").alias("confirmed"), F.max("open").alias("open")))
    # At most `positives` + `unlabelled` numbers: small enough to broadcast whatever the corpus.
    sample = rows.join(F.broadcast(chosen), "draw").groupBy("draw").agg(
        F.first("confirmed").alias("confirmed"), F.first("open").alias("open"), F.min("text").alias("text")
    )
    return checkpointed(sample), share


def _features(sample: DataFrame, prior: float, most: int) -> np.ndarray:
    """Sorted hashes of the terms that confirmed texts hold far more often than clean ones.

    How often clean texts hold a term follows from the unlabelled ones and the prior.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = terms(batch.column(2).to_pylist())
            flags = [np.array(batch.column(i).to_pylist(), bool) for i in (0, 1)]
            words, at = np.unique(found.hashes, return_inverse=True)
            once = np.unique(at * np.int64(batch.num_rows) + found.text)
            at, texts = np.divmod(once, max(batch.num_rows, 1))
            counts = [np.bincount(at, flag[texts], len(words)).astype(np.int64) for flag in flags]
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), *map(pa.array, counts)], ["word", "p", "u"])

    counts = (
        sample.select("confirmed", "open", "text").mapInArrow(run, "word long, p long, u long")
        .groupBy("word").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where(F.col("p") >= LEAST_TEXTS)
    )
    n_p, n_u = sample.agg(F.count_if("confirmed"), F.count_if("open")).first()
    p, u = F.col("p") / F.lit(n_p), F.col("u") / F.lit(max(n_u, 1))
    clean = F.greatest((u - F.lit(prior) * p) / F.lit(1 - prior), F.lit(0.0))
    error = F.sqrt(p * (1 - p) / F.lit(n_p) + (clean * (1 - clean) + F.lit(1 / max(n_u, 1))) / F.lit(max(n_u, 1)))
    gap = (p - clean) / error
    rows = counts.where(gap >= LEAST_GAP).orderBy(gap.desc(), "word").limit(most).collect()
    return np.sort(np.array([row["word"] & (1 << 64) - 1 for row in rows], np.uint64))


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", prior: float | None = None,
    positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES, members: int = MEMBERS,
) -> Model:
    """Classifiers learned from the texts of `df` and the confirmed ids of `labels` (doc_id, toxic) outside the held-out rows."""
    sample, share = _sample(df, labels, key, text, positives, unlabelled)
    if not share or sample.where("confirmed").isEmpty():
        return Model(np.zeros(0, np.uint64), np.zeros((0, 1)))
    rate = min(max(share if prior is None else prior, 1e-6), 1 - 1e-6)
    words = _features(sample, rate, features)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                bits = np.packbits(present(part.column(3).to_pylist(), words).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([row.tobytes() for row in bits], pa.binary())], ["draw", "confirmed", "open", "bits"]
                )

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("draw")
        member = table.column("member")[0].as_py()
        packed = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(len(table), -1)
        bits = np.unpackbits(packed, axis=1, count=len(words)).astype(np.float32)
        confirmed, unknown = (table.column(name).to_numpy(zero_copy_only=False) for name in ("confirmed", "open"))
        weights = train(bits[confirmed], bits[unknown], rate, SEED + member)
        return pa.table([pa.array([member], pa.int32()), pa.array([weights.tolist()], pa.list_(pa.float64()))], ["member", "weights"])

    rows = sample.select("draw", "confirmed", "open", "text").mapInArrow(coded, "draw long, confirmed boolean, open boolean, bits binary")
    share_of = F.pmod(F.xxhash64(F.lit(SEED + 1), "draw"), F.lit(members))
    dealt = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(members - 1))).alias("member"))
    dealt = dealt.withColumn("open", F.col("open") & ((share_of != F.col("member")) | F.lit(members == 1)))
    found = dealt.where("confirmed or open").groupBy("member").applyInArrow(learn, "member int, weights array<double>").collect()
    return Model(words, np.array([row["weights"] for row in sorted(found, key=lambda row: row["member"])]))


def predict(text: Column | str, model: Model) -> Column:
    """Score of a text column, 0 to 1."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        parts = [model.scores(values[at : at + 256]) for at in range(0, len(values), 256)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return run(F.col(text) if isinstance(text, str) else text)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score and prediction for every row of `df`."""
    judged = df.select(F.col(key), held_out(key).alias("held_out"), predict(text, model).alias("score"))
    return judged.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
