import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from outbreaklens.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    values, at, n = np.unique(scores, return_inverse=True, return_counts=True)
    rank = (n.cumsum() - (n - 1) / 2)[at]
    p = truth.sum()
    return (rank[truth == 1].sum() - p * (p + 1) / 2) / (p * (len(order) - p))


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_held_out_accuracy(tables, model):
    documents, labels = tables
    judged = toxicity.score(documents, model).join(labels, "doc_id").toPandas()
    assert (judged.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in judged.doc_id]).all()
    unseen = judged[judged.held_out]
    caught = unseen[unseen.toxic == 1].predicted.mean()
    spared = 1 - unseen[unseen.toxic == 0].predicted.mean()
    assert auc(unseen.score.to_numpy(), unseen.toxic.to_numpy()) > 0.94 and caught > 0.8 and spared > 0.98
    assert judged.score.between(0, 1).all() and ((judged.score >= 0.5) == (judged.predicted == 1)).all()


def test_fit_sees_no_held_out_label(tables):
    documents, labels = (df.where("doc_id < 2000") for df in tables)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.fit(documents, labels, members=2), toxicity.fit(documents.withColumn("source", F.lit("x")), turned, members=2)
    assert (one.words == two.words).all() and np.allclose(one.weights, two.weights)


def test_scores_equal_a_plain_version(spark, model):
    texts = ["You idiot, you MORON.", "a clean text", "", None, "x " * 200_000 + "trash", "Réeuxment"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    found = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    for i, text in enumerate(texts):
        held = toxicity.present([text], model.words)[0]
        reach = [w[-1] + sum(x for x, b in zip(w, held) if b) for w in model.weights]
        assert found[i] == pytest.approx(np.mean([1 / (1 + np.exp(-x)) for x in reach]), abs=1e-6)
    assert found[0] > 0.5 > found[1] and found[2] == found[3]


def test_corrected_risk_never_goes_far_below_zero():
    """Positives that each have a term of their own can be learned by heart; the estimator must not reward it."""
    draw = np.random.default_rng(3)
    positive = np.concatenate([np.eye(40), np.ones((40, 1))], axis=1).astype(np.float32)
    unlabelled = (draw.random((400, 41)) < 0.05).astype(np.float32)
    unlabelled[:, -1] = draw.random(400) < 0.2
    weights = toxicity.train(positive, unlabelled, 0.2, 1, 60)
    values = [bits @ weights[:-1] + weights[-1] for bits in (positive, unlabelled)]
    own, rest = toxicity.risk(*values, 0.2)
    assert own > 0 and rest > -0.05
    assert (values[1][unlabelled[:, -1] == 1] > values[1][unlabelled[:, -1] == 0].mean()).mean() > 0.9
    assert np.array_equal(weights, toxicity.train(positive, unlabelled, 0.2, 1, 60))


def test_edge_rows(spark):
    rows = [(i, "bad awful text" if i % 4 == 0 else "a calm and clean text", "x") for i in range(200)]
    rows += [(None, "bad", "x"), (1, None, "x"), (2, "", "x")] + [(8, "bad awful text", "x")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, draw string")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(0, 200)] + [(None, 1, 1), (8, 1, None), (12, 1, 0)]
    told = spark.createDataFrame(labels, LABELS)
    model = toxicity.fit(df, told, positives=30, unlabelled=60, members=2)
    judged = toxicity.score(df, model)
    assert judged.count() == len(rows) and judged.where("score < 0 or score > 1 or score is null").count() == 0
    assert judged.where("doc_id is null and not held_out").count() == 0
    assert set(judged.where("doc_id = 8").select("predicted").distinct().toPandas().predicted) == {1}
    assert toxicity.score(df.limit(0), model).collect() == []
    nothing = toxicity.fit(df, told.limit(0))
    assert {r["score"] for r in toxicity.score(df, nothing).collect()} == {0.0}
    assert len(toxicity.fit(df.limit(0), told).weights) == 0
