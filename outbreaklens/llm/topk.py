"""Exact top-k inner products with an impact-ordered index, processed score at a time.

Vectors are whole numbers: `floor(scale * x)`. The index cuts the vectors into blocks; a block holds postings
(dimension, vector, value) in segments of equal quantised impact, highest first. Zeros have no posting. A query adds
segment after segment to its accumulators. What the open segments can still add to a score is bounded by the norms of
query and open postings; vectors whose upper bound stays below the k-th lower bound, or below the k-th score of blocks
done before, are ruled out by that proof. Work on a block stops once exact scores of the vectors left read less than
the open segments hold, or all segments are done; all that are left are scored exactly.

Spans of query blocks meet spans of vector blocks; a task holds one of each, builds the index of a block once, and
carries every query's k-th score from block to block. Each gives at most k rows a query, and the best k of those are
the result. Ties go to the smaller id.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an id; where none are
left, an empty table included, there are no rows. Shorter vectors count as padded with zeros. Rows that repeat id and
vector count once. A query is not its own candidate, nor is any row of its id. Scores have to fit into a long. Columns
but id and vector are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from outbreaklens.session import checkpointed, shuffle_partitions

K = 10
SCALE = 1024.0
LEVELS = 12
BLOCK_VECTORS = 4096
QUERY_VECTORS = 512
SPAN_BLOCKS = 16  # most blocks of vectors, and of queries, that one task holds
EXACT_FLOAT = 1 << 53

INDEX = "block int, payload binary"
FOUND = "query_id long, query int, query_block int, vec_id long, score long"
FOUND_ARROW = pa.schema(
    [("query_id", pa.int64()), ("query", pa.int32()), ("query_block", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]
)
EMPTY = np.zeros(0, np.int64)


def whole(vector: str, scale: float = SCALE) -> Column:
    """floor(scale * x) of every component, or null when a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _matrix(lists: list[list[int]], width: int) -> np.ndarray:
    found = np.zeros((len(lists), width), np.int64)
    for row, values in zip(found, lists):
        row[: len(values)] = values
    return found


def _packed(ids: np.ndarray, matrix: np.ndarray) -> bytes:
    return np.array(matrix.shape, np.int64).tobytes() + ids.tobytes() + matrix.tobytes()


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width = np.frombuffer(payload, np.int64, 2)
    return np.frombuffer(payload, np.int64, n, 16), np.frombuffer(payload, np.int64, n * width, 16 + 8 * n).reshape(n, width)


class BlockIndex:
    """Postings (dimension, vector, value) of a block of vectors in segments by descending quantised impact."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, levels: int = LEVELS) -> None:
        self.ids, self.matrix = ids, matrix
        rows, dimensions = np.nonzero(matrix)
        values = matrix[rows, dimensions].astype(np.float64)
        size = np.abs(values)
        level = np.floor(size * levels / (size.max(initial=0.0) + 1)).astype(np.int64)
        order = np.lexsort((dimensions, -level))
        self.rows, self.dimensions, self.values = rows[order], dimensions[order], values[order]
        self.ends = np.cumsum(np.bincount(levels - 1 - level, minlength=levels))  # of the segments, in postings
        self.norms = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))
        # What stays open of every vector after a segment, as a norm; summed from the last segment on.
        squares = np.zeros(len(ids))
        self.open: list[np.ndarray] = []
        for low, high in zip(self.ends[::-1], [len(values), *self.ends[:0:-1]]):
            squares = squares + np.bincount(self.rows[low:high], self.values[low:high] ** 2, len(ids))
            self.open.append(np.sqrt(squares))
        self.open.reverse()
        self.visited = self.skipped = 0  # postings, over all queries

    def best(self, query_id: int, query: np.ndarray, k: int = K, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of at most k best vectors, best first; those that score below `floor` may be left out."""
        width = self.matrix.shape[1]
        query = np.pad(query, (0, max(0, width - len(query))))[:width]
        q = query.astype(np.float64)
        norm = math.sqrt(float(q @ q))
        slack = 1e-9 * norm * self.norms + 1e-6
        candidates = np.flatnonzero(self.ids != query_id)
        if not len(candidates):
            return EMPTY, EMPTY
        sums, left, low = np.zeros(len(self.ids)), candidates, 0
        for high, still_open in zip(self.ends.tolist(), self.open):
            if high == low:
                continue
            part = slice(low, high)
            sums += np.bincount(self.rows[part], q[self.dimensions[part]] * self.values[part], len(self.ids))
            low = high
            reach = norm * still_open[left] + slack[left]
            proof = floor
            if len(left) > k:
                proof = max(proof, np.partition(sums[left] - reach, -k)[-k])
            left = left[sums[left] + reach >= proof]
            if len(left) * width <= len(self.values) - low:
                break
        self.visited += low
        self.skipped += len(self.values) - low
        bound = int(np.abs(query).max(initial=0)) * int(np.abs(self.matrix).max(initial=0)) * width
        if bound < EXACT_FLOAT:
            scores = (self.matrix[left].astype(np.float64) @ q).astype(np.int64)
        else:
            scores = self.matrix[left] @ query
        order = np.lexsort((self.ids[left], -scores))[:k]
        return self.ids[left][order], scores[order]


class Best:
    """The k best of every query of a block over the vector blocks seen so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int = K) -> None:
        self.ids, self.queries, self.k = ids, queries, k
        self.found = [(EMPTY, EMPTY)] * len(ids)

    def add(self, index: BlockIndex) -> None:
        for row, (own, query) in enumerate(zip(self.ids.tolist(), self.queries)):
            ids, scores = self.found[row]
            floor = float(scores[-1]) * (1 - 1e-15 * np.sign(scores[-1])) - 1e-6 if len(scores) == self.k else -np.inf
            more = index.best(own, query, self.k, floor)
            ids, scores = np.concatenate([ids, more[0]]), np.concatenate([scores, more[1]])
            order = np.lexsort((ids, -scores))[: self.k]
            self.found[row] = ids[order], scores[order]

    def batch(self, query_block: int) -> pa.RecordBatch:
        n = [len(ids) for ids, _ in self.found]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(self.ids, n), pa.int64()),
                pa.array(np.repeat(np.arange(len(n)), n), pa.int32()),
                pa.array(np.full(sum(n), query_block), pa.int32()),
                pa.array(np.concatenate([EMPTY, *(ids for ids, _ in self.found)]), pa.int64()),
                pa.array(np.concatenate([EMPTY, *(scores for _, scores in self.found)]), pa.int64()),
            ],
            ["query_id", "query", "query_block", "vec_id", "score"],
        )


def _blocks(vectors: DataFrame, blocks: int) -> DataFrame:
    """Rows (id, vector) as one packed row per block."""

    def run(table: pa.Table) -> pa.Table:
        lists = table.column("vector").to_pylist()
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        matrix = _matrix(lists, max(map(len, lists)))[order]
        return pa.table(
            [pa.array([table.column("block")[0].as_py()], pa.int32()), pa.array([_packed(ids[order], matrix)], pa.binary())],
            names=["block", "payload"],
        )

    dealt = vectors.select(F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int").alias("block"), "id", "vector")
    return dealt.groupBy("block").applyInArrow(run, INDEX)


def top_k(
    df: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    block_vectors: int = BLOCK_VECTORS,
    query_vectors: int = QUERY_VECTORS,
    span_blocks: int = SPAN_BLOCKS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of `df` where `is_query` holds, against all rows.

    Stores the whole-number vectors once. A repeated query id with different vectors has one list for each of them.
    """
    vectors = checkpointed(
        df.where(F.col(key).isNotNull())
        .select(F.col(key).cast("long").alias("id"), whole(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        .where(F.col("vector").isNotNull())
        .distinct()
    )
    n, asking = vectors.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, asking_blocks = max(1, math.ceil(n / block_vectors)), max(1, math.ceil(asking / query_vectors))
    # Spans grow only as far as every core still has a task of its own.
    room = max(1, blocks * asking_blocks // shuffle_partitions(df.sparkSession))
    along = min(span_blocks, blocks, room)
    across = min(span_blocks, asking_blocks, max(1, room // along))
    spans, asking_spans = math.ceil(blocks / along), math.ceil(asking_blocks / across)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    index = _blocks(vectors, blocks).select(
        (F.col("block") % spans).alias("span"), "block", "payload", every(asking_spans).alias("asking")
    )
    queries = _blocks(vectors.where("asks"), asking_blocks).select(
        every(spans).alias("span"), "block", "payload", (F.col("block") % asking_spans).alias("asking")
    )

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        found = {
            number: Best(*_unpacked(payload), k)
            for number, payload in zip(asked.column("block").to_pylist(), asked.column("payload").to_pylist())
        }
        for payload in own.column("payload"):
            block = BlockIndex(*_unpacked(payload.as_py()))
            for one in found.values():
                one.add(block)
        return pa.Table.from_batches([one.batch(number) for number, one in found.items()], FOUND_ARROW)

    met = index.groupBy("span", "asking").cogroup(queries.groupBy("span", "asking")).applyInArrow(run, FOUND)
    best = Window.partitionBy("query_block", "query").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
