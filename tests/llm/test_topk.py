import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from outbreaklens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank string"


def plain(rows, every=100, k=10):
    vectors = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            one = (i, tuple(math.floor(1024 * x) for x in v))
            if one not in vectors:
                vectors.append(one)
    found = []
    for i, q in vectors:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vectors if j != i)[:k]
            found += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    return sorted(found)


def searched(spark, rows, every=100, **sizes):
    df = spark.createDataFrame([(i, v, "x", "x") for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % every == 0, **sizes).collect()))


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0, block_vectors=90, query_vectors=7).collect()))
    assert found == plain(rows, 20)


def close_vectors(n=3000, width=16):
    """Vectors with one large component each, and queries along one axis."""
    draw = np.random.default_rng(5)
    matrix = draw.integers(-20, 20, (n, width))
    matrix[np.arange(n), draw.integers(0, width, n)] += draw.integers(500, 1024, n)
    return matrix, np.eye(width, dtype=np.int64)[:8] * 1000


def test_early_stop_is_proved():
    """A few segments settle such queries, postings stay unread, and the answer is still exact."""
    matrix, queries = close_vectors()
    index = topk.BlockIndex(np.arange(3000), matrix)
    assert len(index.values) == np.count_nonzero(matrix) == index.ends[-1]
    for query in queries:
        ids, scores = index.best(-1, query)
        expected = sorted(zip((-(matrix @ query)).tolist(), range(3000)))[:10]
        assert list(zip((-scores).tolist(), ids.tolist())) == expected
    assert index.visited + index.skipped == 8 * len(index.values)
    assert index.skipped > 0.8 * (index.visited + index.skipped)


def test_scores_of_earlier_blocks_spare_postings():
    """The k-th score carried from block to block rules vectors out sooner, ties included."""
    draw = np.random.default_rng(8)
    blocks = [draw.integers(-1000, 1000, (400, 8)) // 2**i for i in range(4)]
    blocks.append(blocks[0])  # every score of the first block again, under larger ids
    queries = draw.integers(-1000, 1000, (6, 8))
    carried, counts = topk.Best(np.full(6, -1), queries), []
    for i, matrix in enumerate(blocks):
        alone, after = (topk.BlockIndex(np.arange(400) + 400 * i, matrix) for _ in range(2))
        for query in queries:
            alone.best(-1, query)
        carried.add(after)
        counts.append((alone.visited, after.visited))
    assert all(after <= alone for alone, after in counts) and sum(a for _, a in counts) < 0.8 * sum(a for a, _ in counts)
    everything = np.concatenate(blocks)
    for (ids, scores), query in zip(carried.found, queries):
        expected = sorted(zip((-(everything @ query)).tolist(), range(2000)))[:10]
        assert list(zip((-scores).tolist(), ids.tolist())) == expected


def test_ties_nulls_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    draw = random.Random(4)
    rows = [(i, [0.25, -0.5, 0.125]) for i in range(40)]
    rows += [(i, [draw.uniform(-1, 1) for _ in range(3)]) for i in range(40, 60)]
    rows += [(0, [0.25, -0.5, 0.125]), (7, [0.25, -0.5, 0.125]), (None, [1.0, 1.0, 1.0])]
    rows += [(70, None), (71, [nan, 0.0, 0.0]), (72, [inf, 0.0, 0.0]), (73, [None, 1.0, 0.0]), (80, []), (81, [1.0]), (90, [0.0] * 5)]
    for sizes in ({}, {"block_vectors": 5, "query_vectors": 2}, {"block_vectors": 2, "query_vectors": 1, "span_blocks": 3}):
        assert searched(spark, rows, 20, **sizes) == plain(rows, 20)


def test_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [-3.0, 0.0])]
    assert searched(spark, rows) == [(0, 1, 1, 1024 * 512), (0, 2, 2, -3072 * 1024)]
    assert searched(spark, [(0, [1.0])]) == []
    assert searched(spark, [(1, [1.0]), (2, [1.0])]) == []
    df = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(df, F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("scale", [1e3, 1e4])
def test_large_components(spark, scale):
    draw = random.Random(6)
    rows = [(i, [float(draw.randrange(-100, 100)) * scale for _ in range(4)]) for i in range(60)]
    assert searched(spark, rows, 30) == plain(rows, 30)
