"""Exact ranked lexical search by MaxScore with bounds for pairs of terms.

Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case, told apart by 64-bit hashes.
`index` cuts the documents into blocks of about `BLOCK_TEXT` bytes where they lie, without a shuffle: a block is an
inverted index of all its terms, (document, frequency) lists in document order, with the documents' lengths.

`search` first derives impacts from corpus-wide counts. For the `PAIR_TERMS` most widespread terms every block gets a list
for each pair: the highest joint impacts in the intersection of both postings lists. Every block is then searched by
document at a time in arrays. Terms are ordered by their largest impact in the block, and the low end of that order, whose
combined bound stays below the k-th best score so far, opens no document (MaxScore). The bound of a set of terms takes
disjoint pairs out of it: a pair adds its joint maximum, or the larger single one, in place of the sum of both, which is
what independent maxima would say. So more terms stay closed, documents leave earlier, and a block may be skipped
whole. The k-th joint impact of a pair list is a score that k documents reach, and starts the threshold. A document is left
out only when its bound is below the threshold; all that may be among the best are scored exactly, in whole numbers.

Every task keeps the best k of an item over all its blocks, so what is ranked at the end is k rows an item and task.
Items are handled in blocks of at most `QUERY_TERMS` terms in all; each such block of queries is one pass over the index.

Null and empty texts have no terms. Repeated documents count and rank each for itself; documents without an id count,
and stand last among equal scores. Items without an id take no part; rows that share an item id are one item with the
terms of all. Empty tables give no rows. Other columns are not read. A single text has to fit into one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappush, heapreplace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from outbreaklens.llm.wordhash import terms
from outbreaklens.session import checkpointed

K = 10
BLOCK_TEXT = 8 << 20
BLOCK_DOCS = 8192
PAIR_TERMS = 64  # terms whose pairs have lists
WIDEST = 128  # terms that a block names as its most widespread
QUERY_TERMS = 1 << 20

INDEX = "n_docs long, n_terms long, wide array<long>, wide_n array<long>, payload binary"
FOUND = "item_id long, doc_id long, score long"


class Block(NamedTuple):
    """Inverted index of some documents: list i of `words` is `docs` and `tf` from `starts[i]` to `starts[i + 1]`."""

    ids: np.ndarray
    has_id: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    tf: np.ndarray

    def packed(self) -> bytes:
        parts = [np.array([len(self.ids), len(self.words), len(self.docs)], np.int64), *self]
        return zstandard.compress(b"".join(part.tobytes() for part in parts), 1)

    @staticmethod
    def unpacked(payload: bytes) -> "Block":
        data = zstandard.decompress(payload)
        n, words, postings = np.frombuffer(data, np.int64, 3)
        parts, at = [], 24
        for size, kind in (
            (n, np.int64), (n, np.bool_), (n, np.int64), (words, np.uint64), (words + 1, np.int64), (postings, np.uint16), (postings, np.uint32)
        ):
            parts.append(np.frombuffer(data, kind, size, at))
            at += int(size) * np.dtype(kind).itemsize
        return Block(*parts)


def _block(ids: list[int | None], texts: list[str | None]) -> Block:
    found = terms(texts)
    order = np.lexsort((found.text, found.hashes))
    word, doc = found.hashes[order], found.text[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    word, doc, tf = word[first], doc[first], np.diff(np.append(first, len(new)))
    begins = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
    return Block(
        np.array([one or 0 for one in ids], np.int64),
        np.array([one is not None for one in ids], bool),
        np.bincount(found.text, minlength=len(ids)).astype(np.int64),
        word[begins],
        np.append(begins, len(word)).astype(np.int64),
        doc.astype(np.uint16),
        tf.astype(np.uint32),
    )


def index(df: DataFrame, key: str = "doc_id", text: str = "text", block_text: int = BLOCK_TEXT, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """A stored row per block of documents; it holds all their terms and can serve any number of searches."""

    def row(ids: list[int | None], texts: list[str | None]) -> pa.RecordBatch:
        block = _block(ids, texts)
        widths = np.diff(block.starts)
        widest = np.lexsort((block.words, -widths))[:WIDEST]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int((block.lengths > 0).sum())]),
                pa.array([int(block.lengths.sum())]),
                pa.array([block.words[widest].view(np.int64).tolist()], pa.list_(pa.int64())),
                pa.array([widths[widest].tolist()], pa.list_(pa.int64())),
                pa.array([block.packed()], pa.binary()),
            ],
            ["n_docs", "n_terms", "wide", "wide_n", "payload"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for one, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(one)
                texts.append(content)
                size += len(content or "")
                if size >= block_text or len(ids) == block_docs:
                    yield row(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield row(ids, texts)

    return checkpointed(df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, INDEX))


class Corpus(NamedTuple):
    """What impacts need to know of the whole corpus; `weights` of the terms in the sorted `words`."""

    n_docs: int
    n_terms: int
    words: np.ndarray
    weights: np.ndarray
    pair_words: np.ndarray

    def impacts(self, block: Block, at: int, weight: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of postings list `at` of a block."""
        low, high = block.starts[at], block.starts[at + 1]
        docs, tf = block.docs[low:high].astype(np.int64), block.tf[low:high].astype(np.int64)
        m = 10 + (90 * block.lengths[docs] * self.n_docs) // self.n_terms
        return docs, weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Searcher:
    """A block with its pair lists; `opened` counts postings that were read for a query, `closed` those that were not."""

    def __init__(self, block: Block, corpus: Corpus, k: int = K, pairs: bool = True) -> None:
        self.block, self.corpus, self.k = block, corpus, k
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        at = np.searchsorted(block.words, corpus.words)
        for number, (place, word) in enumerate(zip(at.tolist(), corpus.words)):
            if place < len(block.words) and block.words[place] == word:
                docs, impacts = corpus.impacts(block, place, int(corpus.weights[number]))
                self.lists[int(word)] = (docs, impacts, int(impacts.max()))
        self.joint: dict[tuple[int, int], np.ndarray] = {}
        if pairs:
            self._pair_lists()
        self.opened = self.closed = 0

    def _pair_lists(self) -> None:
        """The k highest joint impacts in the intersection of every two widespread terms, falling; fewer if it is smaller."""
        held = [int(word) for word in self.corpus.pair_words if int(word) in self.lists]
        dense = np.zeros((len(held), len(self.block.ids)), np.int64)
        for row, word in zip(dense, held):
            docs, impacts, _ = self.lists[word]
            row[docs] = impacts
        present = dense > 0
        for i, word in enumerate(held):
            for j in range(i + 1, len(held)):
                both = np.flatnonzero(present[i] & present[j])
                sums = dense[i, both] + dense[j, both]
                if len(sums) > self.k:
                    sums = np.partition(sums, -self.k)[-self.k :]
                self.joint[min(word, held[j]), max(word, held[j])] = np.sort(sums)[::-1]

    def bounds(self, ordered: list[int]) -> list[int]:
        """Bound of what the first 0, 1, 2, ... of these terms add to any one document, disjoint pairs taken jointly."""
        found, alone = [0], []
        for word in ordered:
            own, best, mate = self.lists[word][2], 0, None
            if word in self._paired:
                for other in alone:
                    joint = self.joint.get((min(word, other), max(word, other)))
                    if joint is not None:
                        both = self.lists[other][2]
                        saving = own + both - max(own, both, int(joint[0]) if len(joint) else 0)
                        if saving > best:
                            best, mate = saving, other
            if mate is None:
                alone.append(word)
            else:
                alone.remove(mate)
            found.append(found[-1] + own - best)
        return found

    @property
    def _paired(self) -> set[int]:
        if not hasattr(self, "_paired_words"):
            self._paired_words = {word for pair in self.joint for word in pair}
        return self._paired_words

    def search(self, words: list[int], threshold: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the block that may be among the best k with a score of `threshold` or more, with their scores."""
        held = sorted((word for word in words if word in self.lists), key=lambda word: (self.lists[word][2], word))
        total = sum(len(self.lists[word][0]) for word in held)
        bounds = self.bounds(held)
        paired = [word for word in held if word in self._paired]
        for i, word in enumerate(paired):
            for other in paired[:i]:
                joint = self.joint[min(word, other), max(word, other)]
                if len(joint) == self.k:
                    threshold = max(threshold, int(joint[-1]))
        opening = next((at for at in range(len(held), -1, -1) if bounds[at] < threshold), 0)
        if opening == len(held):
            self.closed += total
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        scores = np.zeros(len(self.block.ids), np.int64)
        read = 0
        for word in held[opening:]:
            docs, impacts, _ = self.lists[word]
            scores[docs] += impacts
            read += len(docs)
        left = np.flatnonzero(scores)
        found = scores[left]
        for at in range(opening, -1, -1):
            if len(found) > self.k:
                threshold = max(threshold, int(np.partition(found, -self.k)[-self.k]))
            stay = found + bounds[at] >= threshold
            left, found = left[stay], found[stay]
            if at and len(left):
                docs, impacts, _ = self.lists[held[at - 1]]
                place = np.minimum(np.searchsorted(docs, left), len(docs) - 1)
                hit = docs[place] == left
                found = found + np.where(hit, impacts[place], 0)
                read += min(len(left), len(docs))
        self.opened += read
        self.closed += total - read
        return left, found


def _terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, words) with the distinct terms of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = terms(batch.column(1).to_pylist())
            ids = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids[found.text]), pa.array(found.hashes.view(np.int64))], ["item_id", "word"])

    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("item_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "item_id long, word long").distinct().groupBy("item_id").agg(F.collect_list("word").alias("words"))


def _frequencies(blocks: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """Number of documents of each of the `wanted` terms, sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                block = Block.unpacked(payload)
                at = np.searchsorted(block.words, wanted)
                seen = np.flatnonzero(at < len(block.words))
                seen = seen[block.words[at[seen]] == wanted[seen]]
                counts[seen] += block.starts[at[seen] + 1] - block.starts[at[seen]]
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[seen].view(np.int64)), pa.array(counts[seen])], ["word", "n"])

    found = blocks.select("payload").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n")).collect()
    return {word & (1 << 64) - 1: n for word, n in found}


def _best(blocks: DataFrame, items: list[tuple[int, list[int]]], corpus: Corpus, k: int) -> DataFrame:
    """At most k rows (item_id, doc_id, score) for every item and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, int]]] = [[] for _ in items]  # heaps: least score first, then no id, then large id
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                searcher = Searcher(Block.unpacked(payload), corpus, k)
                ids, has_id = searcher.block.ids, searcher.block.has_id
                for heap, (_, words) in zip(best, items):
                    docs, scores = searcher.search(words, heap[0][0] if len(heap) == k else 1)
                    if len(docs) > k:
                        docs, scores = _foremost(docs, scores, ids, has_id, k)
                    for doc, score in zip(docs.tolist(), scores.tolist()):
                        entry = (score, bool(has_id[doc]), -int(ids[doc]))
                        if len(heap) < k:
                            heappush(heap, entry)
                        elif entry > heap[0]:
                            heapreplace(heap, entry)
        rows = [(item, -number if known else None, score) for (item, _), heap in zip(items, best) for score, known, number in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in rows], pa.int64()) for i in range(3)], ["item_id", "doc_id", "score"]
        )

    return blocks.select("payload").mapInArrow(run, FOUND)


def _foremost(docs: np.ndarray, scores: np.ndarray, ids: np.ndarray, has_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids[docs], ~has_id[docs], -scores))[:k]
    return docs[order], scores[order]


def search(
    blocks: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", k: int = K,
    pair_terms: int = PAIR_TERMS, query_terms: int = QUERY_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of the index `blocks` for every item, score above 0."""
    spark = blocks.sparkSession
    n_docs, n_terms = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    queries = checkpointed(_terms(items, key, text))
    total = queries.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    wide = (
        blocks.select(F.explode(F.arrays_zip("wide", "wide_n")).alias("x"))
        .groupBy("x.wide").agg(F.sum("x.wide_n").alias("n")).orderBy(F.desc("n"), "wide").limit(pair_terms).collect()
    )
    pair_words = np.array(sorted(row["wide"] & (1 << 64) - 1 for row in wide), np.uint64)
    passes = max(1, math.ceil(total / query_terms))
    found = spark.createDataFrame([], FOUND)
    for number in range(passes if n_docs and total else 0):
        rows = queries.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number).collect()
        asked = [(row["item_id"], [word & (1 << 64) - 1 for word in row["words"]]) for row in rows]
        if not asked:
            continue
        wanted = np.union1d(np.array(list({word for _, words in asked for word in words}), np.uint64), pair_words)
        frequency = _frequencies(blocks, wanted)
        words = np.array(sorted(frequency), np.uint64)
        weights = np.array([weight(n_docs, frequency[int(word)]) for word in words], np.int64)
        found = found.unionByName(_best(blocks, asked, Corpus(n_docs, n_terms, words, weights, pair_words), k))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
