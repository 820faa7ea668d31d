"""Substring deduplication with prefix-partitioned suffix trees over words.

A suffix starts at every word and is cut after `WINDOW` words. Suffixes go to groups by a prefix of one, two, four
or all words: the shortest one that no more than a group's share of all suffixes begin with. Each group's suffixes,
sorted, with the lengths of their common prefixes, are its subtree; internal nodes at depth `WINDOW` are repeated
passages, and consecutive ones add up to the maximal repeat. A word goes when a window over it also starts in a
document with a smaller id; windows are judged on the input, not on what is left.

The tables move in packed blocks of about `BLOCK_BYTES` of text, dealt by a hash of id and text, so that no source,
copy group or passage is dealt together. Copies of a whole text are settled by their digest. A window can only
repeat in another block if the least hash of its five-word runs does, so only those suffixes are sent, each once
a block, and a frequent passage makes at most one row a block and window. A suffix travels as 16-bit codes of its
words, which order the tree, and a 64-bit fingerprint over all of them; in a tree equality is that of both, 272 bits.
Windows of one block, and the removals sent back to it, are matched by the fingerprint alone.

Ids that repeat are not smaller than each other. A null id counts as larger than any other. A null text has no words.
Texts of fewer than `WINDOW` words stay as they are. A single text has to fit into one task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outbreaklens.llm.wordhash import Words, grams, mixed, sliding_min, words
from outbreaklens.session import checkpointed, shuffle_partitions

WINDOW = 13
RUN = 5  # words of the runs whose least hash stands for a window
LEVELS = (1, 2, 4, WINDOW)  # prefix lengths
BLOCK_BYTES = 2 << 20
GROUP_ROWS = 1 << 20  # suffixes of one subtree, about
MOST_HEAVY = 1 << 20  # most prefixes that the list of frequent ones may hold
NO_ID = np.iinfo(np.int64).max

PACKED = "block int, payload binary"
NOTES = "block int, kind int, payload binary"
MESSAGES = "bucket int, block int, payload binary"
RESULT = "id long, n_words long, n_removed long, kept_text string, removed array<struct<first:int,last:int>>, carried string"
COPY, REPEATED, REMOVED = range(3)

_RESULT = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_text", pa.string()),
        ("removed", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
        ("carried", pa.string()),
    ]
)


def _squeeze(*arrays: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(bytes(a) if isinstance(a, bytes) else a.tobytes() for a in arrays))


def _loosen(payload: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(payload)


def _messages(rows: list[tuple], ddl: str) -> pa.Table:
    names = [part.split()[0] for part in ddl.split(", ")]
    kinds = [pa.int32()] * (len(names) - 1) + [pa.binary()]
    return pa.table([pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names=names)


class Block:
    """Documents of one block with the words of all of them."""

    def __init__(self, packs: list[bytes]) -> None:
        self.ids: list[int] = []
        self.known: list[bool] = []
        self.texts: list[bytes] = []
        self.carried: list[bytes] = []
        for data in map(_loosen, packs):
            n = int.from_bytes(data[:8], "little")
            ids = np.frombuffer(data, np.int64, n, 8)
            ends = np.frombuffer(data, np.int64, n, 8 + 8 * n)
            also = np.frombuffer(data, np.int64, n, 8 + 16 * n)
            known = np.frombuffer(data, np.uint8, n, 8 + 24 * n)
            base = 8 + 25 * n
            for low, middle, high in zip([0, *also.tolist()], ends.tolist(), also.tolist()):
                self.texts.append(data[base + low : base + middle])
                self.carried.append(data[base + middle : base + high])
            self.ids.extend(ids.tolist())
            self.known.extend(known.astype(bool).tolist())
        self.words: Words = words(self.texts)
        self.id_of_text = np.array(self.ids, np.int64)

    def windows(self, left_out: np.ndarray | None = None) -> np.ndarray:
        """First words of the windows that lie in one text, of texts not left out."""
        text = self.words.text
        if len(text) < WINDOW:
            return np.zeros(0, np.int64)
        whole = text[: len(text) - WINDOW + 1] == text[WINDOW - 1 :]
        if left_out is not None:
            whole &= ~left_out[text[: len(whole)]]
        return np.flatnonzero(whole)

    def copies(self, notes: list[tuple[int, bytes]]) -> np.ndarray:
        """True for the texts that the notes name as copies of a text with a smaller id."""
        named = {payload for kind, payload in notes if kind == COPY}
        return np.array([bool(named) and self.mark(i) in named for i in range(len(self.texts))], bool)

    def mark(self, i: int) -> bytes:
        return self.ids[i].to_bytes(8, "big", signed=True) + hashlib.sha256(self.texts[i]).digest()

    def least(self) -> np.ndarray:
        """For every window the least hash of its runs."""
        return sliding_min(grams(self.words.hashes, RUN), WINDOW - RUN + 1)


def pack(df: DataFrame) -> DataFrame:
    """Rows (block, id, text, carried) as compressed packs of texts of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0).to_numpy()
            ids, texts, carried = (batch.column(i).to_pylist() for i in range(1, 4))
            order = np.argsort(block, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                if not len(part):
                    continue
                own = [(one[i] or "").encode() for i in part for one in (texts, carried)]
                ends = np.cumsum([len(one) for one in own], dtype=np.int64)
                payload = _squeeze(
                    len(part).to_bytes(8, "little"),
                    np.array([NO_ID if ids[i] is None else ids[i] for i in part], np.int64),
                    ends[0::2],
                    ends[1::2],
                    np.array([ids[i] is not None for i in part], np.uint8),
                    *own,
                )
                row = _messages([(int(block[part[0]]), payload)], PACKED)
                yield from row.to_batches()

    return df.select("block", "id", "text", "carried").mapInArrow(run, PACKED)


def frequent_prefixes(texts: DataFrame, limit: float, total: int) -> np.ndarray:
    """Hashes of all prefixes of `LEVELS` words that more than `limit` of `total` suffixes begin with.

    A prefix that frequent is so in some batch. Batches name the prefixes that reach half of its share there;
    those that reach half of `limit` in all are the list, which has at most 2 * len(LEVELS) * total / limit entries.
    """
    share = limit / max(total, 1) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words([(text or "").encode() for text in batch.column(0).to_pylist()]).hashes
            for level in LEVELS[:-1]:
                prefix, n = np.unique(grams(found, level), return_counts=True)
                often = n >= max(2.0, share * len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["prefix", "n"]
                )

    sums = texts.select("text").mapInArrow(run, "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
    often = [row["prefix"] for row in sums.where(F.col("n") >= limit / 2).select("prefix").collect()]
    return np.sort(np.array(often, np.int64).view(np.uint64))


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def _packs(table: pa.Table) -> list[bytes]:
    return table.column("payload").to_pylist()


def _notes(table: pa.Table) -> list[tuple[int, bytes]]:
    return list(zip(table.column("kind").to_pylist(), table.column("payload").to_pylist()))


def _dealt(values: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the values of every bucket."""
    bucket = (values % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(part):
            yield int(bucket[part[0]]), part


def window_marks(packed: DataFrame, notes: DataFrame, buckets: int) -> DataFrame:
    """The distinct least hashes of every block, dealt over buckets."""

    def run(key: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(_packs(own))
        at = block.windows(block.copies(_notes(told)))
        marks = np.unique(block.least()[at]) if len(at) else np.zeros(0, np.uint64)
        number = key[0].as_py()
        return _messages([(bucket, number, marks[part].tobytes()) for bucket, part in _dealt(marks, buckets)], MESSAGES)

    return packed.groupBy("block").cogroup(notes.groupBy("block")).applyInArrow(run, MESSAGES)


def repeated_marks(marks: DataFrame) -> DataFrame:
    """For every block those of its hashes that another block has too."""

    def run(table: pa.Table) -> pa.Table:
        blocks, parts = table.column("block").to_pylist(), [np.frombuffer(p, np.uint64) for p in _packs(table)]
        values, n = np.unique(np.concatenate(parts), return_counts=True)
        twice = values[n > 1]
        rows = [(b, REPEATED, part[_is_in(part, twice)].tobytes()) for b, part in zip(blocks, parts)]
        return _messages([row for row in rows if row[2]], NOTES)

    return marks.groupBy("bucket").applyInArrow(run, NOTES)


def suffixes(packed: DataFrame, notes: DataFrame, heavy: np.ndarray, buckets: int) -> DataFrame:
    """The distinct suffixes of every block that may repeat in others, with the least id, dealt by prefix."""

    def run(key: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        heard = _notes(told)
        marks = [np.frombuffer(payload, np.uint64) for kind, payload in heard if kind == REPEATED]
        if not marks:
            return _messages([], MESSAGES)
        block = Block(_packs(own))
        at = block.windows(block.copies(heard))
        at = at[_is_in(block.least()[at], np.sort(np.concatenate(marks)))]
        hashes = block.words.hashes
        prints, ids = grams(hashes, WINDOW)[at], block.id_of_text[block.words.text[at]]
        order = np.lexsort((ids, prints))
        first = order[np.flatnonzero(np.concatenate([[True], prints[order][1:] != prints[order][:-1]]))] if len(at) else order
        at, prints, ids = at[first], prints[first], ids[first]
        prefix = grams(hashes, LEVELS[0])[at]
        for level in LEVELS[1:]:
            longer = _is_in(prefix, heavy)
            if not longer.any():
                break
            prefix[longer] = grams(hashes, level)[at[longer]]
        codes = (hashes >> np.uint64(48)).astype(np.uint16)
        number, rows = key[0].as_py(), []
        for bucket, part in _dealt(mixed(prefix), buckets):
            matrix = codes[at[part][None, :] + np.arange(WINDOW)[:, None]]  # one row per depth
            rows.append((bucket, number, _squeeze(len(part).to_bytes(8, "little"), prints[part], ids[part], matrix)))
        return _messages(rows, MESSAGES)

    return packed.groupBy("block").cogroup(notes.groupBy("block")).applyInArrow(run, MESSAGES)


class Subtree:
    """Suffixes of one group in order, with the number of words each shares with the one before."""

    def __init__(self, codes: np.ndarray, prints: np.ndarray) -> None:
        depth, n = codes.shape
        self.order = np.lexsort((prints, *codes[::-1]))
        self.shared = np.zeros(n, np.int64)
        going = np.ones(max(n - 1, 0), bool)
        for level in range(depth):
            row = codes[level][self.order]
            going &= row[1:] == row[:-1]
            self.shared[1:] += going
        in_order = prints[self.order]
        # Whole suffixes also have to agree in the fingerprint, which covers every bit of their words.
        self.shared[1:][(self.shared[1:] == depth) & (in_order[1:] != in_order[:-1])] = depth - 1

    def nodes(self, depth: int) -> np.ndarray:
        """First places, in order, of the suffixes below the nodes at a depth."""
        return np.flatnonzero(self.shared < depth) if len(self.shared) else np.zeros(0, np.int64)


def removals(sent: DataFrame) -> DataFrame:
    """For every block the fingerprints of its windows that start in a document with a smaller id elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        blocks, prints, ids, codes, sizes = table.column("block").to_pylist(), [], [], [], []
        for data in map(_loosen, _packs(table)):
            n = int.from_bytes(data[:8], "little")
            prints.append(np.frombuffer(data, np.uint64, n, 8))
            ids.append(np.frombuffer(data, np.int64, n, 8 + 8 * n))
            codes.append(np.frombuffer(data, np.uint16, n * WINDOW, 8 + 16 * n).reshape(WINDOW, n))
            sizes.append(n)
        prints, ids = np.concatenate(prints), np.concatenate(ids)
        tree = Subtree(np.concatenate(codes, axis=1), prints)
        starts = tree.nodes(WINDOW)
        least = np.repeat(np.minimum.reduceat(ids[tree.order], starts), np.diff(np.concatenate([starts, [len(ids)]])))
        gone = np.empty(len(ids), bool)
        gone[tree.order] = least < ids[tree.order]
        ends = np.cumsum(sizes)
        rows = [
            (block, REMOVED, prints[low:high][gone[low:high]].tobytes())
            for block, low, high in zip(blocks, [0, *ends[:-1].tolist()], ends.tolist())
        ]
        return _messages([row for row in rows if row[2]], NOTES)

    return sent.groupBy("bucket").applyInArrow(run, NOTES)


def _covered(block: Block, heard: list[tuple[int, bytes]]) -> np.ndarray:
    """True for the words to remove."""
    text = block.words.text
    copies = block.copies(heard)
    covered = np.zeros(len(text) + 1, np.int64)
    at = block.windows()
    if len(at):
        prints, ids = grams(block.words.hashes, WINDOW)[at], block.id_of_text[text[at]]
        order = np.lexsort((ids, prints))
        starts = np.flatnonzero(np.concatenate([[True], prints[order][1:] != prints[order][:-1]]))
        least = np.repeat(ids[order][starts], np.diff(np.concatenate([starts, [len(at)]])))
        gone = np.empty(len(at), bool)
        gone[order] = ids[order] > least
        told = [np.frombuffer(payload, np.uint64) for kind, payload in heard if kind == REMOVED]
        if told:
            gone |= _is_in(prints, np.sort(np.concatenate(told)))
        gone |= copies[text[at]]
        covered[at[gone]] += 1
        np.subtract.at(covered, at[gone] + WINDOW, 1)
    return np.cumsum(covered)[:-1] > 0


def kept(packed: DataFrame, notes: DataFrame) -> DataFrame:
    """Every document with its words counted, its removed spans (word numbers, inclusive) and what is left."""

    def run(key: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(_packs(own))
        gone = _covered(block, _notes(told))
        found = block.words
        bounds = np.searchsorted(found.text, np.arange(len(block.texts) + 1))
        base = np.cumsum([0, *(len(text) + 1 for text in block.texts)])
        rows = []
        for i, text in enumerate(block.texts):
            low, high = bounds[i], bounds[i + 1]
            own_gone = gone[low:high]
            spans = []
            if own_gone.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own_gone.view(np.int8), [0]])))
                pieces, done = [], 0
                for first, after in zip(edges[0::2].tolist(), edges[1::2].tolist()):
                    spans.append({"first": first, "last": after - 1})
                    pieces.append(text[done : int(found.start[low + first] - base[i])])
                    done = int(found.start[low + after] - base[i]) if low + after < high else len(text)
                text = b"".join([*pieces, text[done:]])
            rows.append((block.ids[i] if block.known[i] else None, int(high - low), int(own_gone.sum()), text.decode(), spans, block.carried[i].decode()))
        return pa.table([pa.array([row[j] for row in rows], field.type) for j, field in enumerate(_RESULT)], schema=_RESULT)

    return packed.groupBy("block").cogroup(notes.groupBy("block")).applyInArrow(run, RESULT)


def remove_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: Column | None = None,
    block_bytes: int = BLOCK_BYTES,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(id, n_words, n_removed, kept_text, removed, carried) for every row of `df`.

    `carry` is a text that travels with the row; no other columns are read. Stores ids and digests of the texts; the texts themselves cross the network once.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.lit("") if carry is None else carry).alias("carried"),
    )
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    keys = checkpointed(rows.select("id", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes")))
    total = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    suffix_bound = total // 2 + 1  # a word takes two bytes at least, with the space
    limit = max(group_rows / 4, 2 * len(LEVELS) * suffix_bound / MOST_HEAVY)
    buckets = max(shuffle_partitions(spark), math.ceil(suffix_bound / group_rows))

    def block_of(digest_column: Column) -> Column:
        return F.pmod(F.xxhash64("id", digest_column), F.lit(blocks)).cast("int")

    ordered = F.coalesce("id", F.lit(int(NO_ID)))
    # Stored, so that no aggregation stands between the join and its exchanges: AQE then splits a frequent text's rows.
    first = checkpointed(
        keys.groupBy("digest").agg(F.min(ordered).alias("least"), F.max(ordered).alias("most")).where("least < most")
    )
    copies = (
        keys.join(first, "digest")
        .where(ordered > F.col("least"))
        .select(
            block_of(F.col("digest")).alias("block"),
            F.lit(COPY).alias("kind"),
            F.concat(F.unhex(F.lpad(F.hex(ordered), 16, "0")), "digest").alias("payload"),
        )
        .distinct()
    )
    heavy = frequent_prefixes(rows, limit, suffix_bound)
    packed = pack(rows.select(block_of(digest).alias("block"), "id", "text", "carried"))
    repeated = repeated_marks(window_marks(packed, copies, buckets))
    sent = suffixes(packed, copies.unionByName(repeated), heavy, buckets)
    return kept(packed, copies.unionByName(removals(sent)))
