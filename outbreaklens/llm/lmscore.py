"""Language-model scores by cross-entropy difference.

Two bigram models of the same form share one vocabulary: every word of the whole corpus. The background model counts
every document, the target model the documents marked as target. A document's score is its loss per token under the
target model minus that under the background model: the lower, the more it reads like the target.

The counts are exact for every word and every pair of words, told apart by 64-bit hashes. Frequent ones, at most
`VOCABULARY` words and `HELD_PAIRS` pairs, are counted by every task for itself, and their sums are held by every task.

All others are counted slice by slice. The texts cross the network once, to meet their labels, and are stored as slices of
about `SLICE_TEXT` bytes. A slice adds up its own words and pairs and sends each of them once: sorted hashes with their
counts, cut into runs by the range of the hash (`sent`). Where the runs of a range meet, they are added up, and every run is
answered by the totals of its items in its own order, without their hashes (`answered`). The answers go back to their
slice, which scores its texts (`scored`). So what is shuffled of a pair is some six bytes a slice that holds it, however often
it stands there, and a range holds at most one item a slice of any pair. Which words and pairs are held decides where
something is counted, never what comes out but for the last digits of a sum.

P(w | v) = (pairs(v, w) + PRIOR * P(w)) / (words(v) + PRIOR), P(w) = (words(w) + 1) / (all words + vocabulary + 1).

A document without words scores 0 with both losses 0. Null texts have no words. Labels of one id are combined: a
target needs quality 1 on all and toxic on none. Repeated rows count and score as often as they stand there.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outbreaklens.llm.wordhash import mixed, words
from outbreaklens.session import checkpointed

VOCABULARY = 1 << 16  # words held by every task
HELD_PAIRS = 1 << 18  # pairs held by every task
OFTEN = 4  # times that a pair to be held stands in some slice of texts
CELLS = (1 << 64) - 1  # pairs differ by their hash modulo this
PRIOR = 50.0
BATCH_TEXT = 4 << 20
SLICE_TEXT = 8 << 20
MEETING_ROWS = 1 << 20  # words of text for each range of hashes
FINE = 16  # steps of counts per power of two, when the most frequent are taken

COUNTS = "place long, background long, target long"
SLICES = "slice long, words long, ids array<long>, own array<boolean>, payload binary"
RUNS = "slice long, bucket int, n_words int, n_pairs int, payload binary"
ANSWERS = "slice long, bucket int, n_words int, n_pairs int, payload binary"
LOSSES = "id long, n_tokens long, target_loss double, background_loss double"
_PAIR = np.uint64(0x9FB21C651E98DF25)
_START = np.uint64(0x5851F42D4C957F2D)


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of texts of about BATCH_TEXT bytes."""
    low, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append((text or "").encode())
        size += len(held[-1])
        if size >= BATCH_TEXT:
            yield low, i + 1, held
            low, held, size = i + 1, [], 0
    if held:
        yield low, len(texts), held


def _word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(item, n) of every word of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [words(held).hashes for _, _, held in _slices(batch.column(0).to_pylist())]
            if parts:
                word, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["item", "n"]
                )

    counts = texts.select(text).mapInArrow(run, "item long, n long").groupBy("item").agg(F.sum("n").alias("n"))
    return checkpointed(counts)


def _most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, int]:
    """At most `most` items of (item, n), those of equal frequency in or out together, and the number of all items.

    A histogram of the counts, of at most 64 * FINE rows, tells where to cut.
    """
    step = F.floor(F.log2("n") * FINE)
    steps = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    lowest, total = None, 0
    for row in steps:
        total += row["count"]
        if total > most:
            break
        lowest = row["step"]
    everything = sum(row["count"] for row in steps)
    if lowest is None:
        return np.zeros(0, np.int64), everything
    return counts.where(step >= lowest).select("item").toArrow().column("item").to_numpy(), everything


def vocabulary(texts: DataFrame, text: str = "text", most: int = VOCABULARY) -> np.ndarray:
    """Sorted hashes of the most frequent words of the corpus, words of equal frequency in or out together."""
    return np.sort(_most_frequent(_word_counts(texts, text), most)[0].view(np.uint64))


class Tokens(NamedTuple):
    """Hash and number of the word and of the word before, text number and whether a word follows, of every token."""

    word: np.ndarray
    before: np.ndarray
    number: np.ndarray
    number_before: np.ndarray
    text: np.ndarray
    followed: np.ndarray


class Coder:
    """Words to numbers; number 0 is a word that is not held, the last the start of a text."""

    def __init__(self, known: np.ndarray) -> None:
        self.known, self.size = known, len(known) + 2

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.known, hashes)
        at[at == len(self.known)] = 0
        return np.where(self.known[at] == hashes, at + 1, 0)

    def coded(self, texts: list[bytes]) -> Tokens:
        found = words(texts)
        word, number = found.hashes, self.numbers(found.hashes)
        first, followed = np.ones(len(word), bool), np.zeros(len(word), bool)
        first[1:] = found.text[1:] != found.text[:-1]
        followed[:-1] = ~first[1:]
        before, number_before = np.roll(word, 1), np.roll(number, 1)
        before[first], number_before[first] = _START, self.size - 1
        return Tokens(word, before, number, number_before, found.text, followed)


class Held(NamedTuple):
    """Words and pairs of held words that every task holds; `distinct` words are in the corpus."""

    coder: Coder
    pairs: np.ndarray
    distinct: int

    def places(self, tokens: Tokens) -> np.ndarray:
        """Number of each token's pair, -1 for a pair that is not held."""
        if not len(self.pairs):
            return np.full(len(tokens.word), -1)
        code = tokens.number_before * self.coder.size + tokens.number
        at = np.searchsorted(self.pairs, code)
        at[at == len(self.pairs)] = 0
        return np.where((self.pairs[at] == code) & (tokens.number > 0) & (tokens.number_before > 0), at, -1)


def frequent_pairs(texts: DataFrame, coder: Coder, most: int = HELD_PAIRS) -> np.ndarray:
    """Sorted codes of pairs of held words that stand `OFTEN` times in some slice of texts, the most frequent of them."""
    shared = texts.sparkSession.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in batches:
            for _, _, held in _slices(batch.column(0).to_pylist()):
                tokens = coder.coded(held)
                both = (tokens.number > 0) & (tokens.number_before > 0)
                code, n = np.unique((tokens.number_before * coder.size + tokens.number)[both], return_counts=True)
                often = n >= OFTEN
                yield pa.RecordBatch.from_arrays([pa.array(code[often]), pa.array(n[often].astype(np.int64))], ["item", "n"])

    counts = texts.select("text").mapInArrow(run, "item long, n long").groupBy("item").agg(F.sum("n").alias("n"))
    return np.sort(_most_frequent(checkpointed(counts), most)[0])


def sliced(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts of (id, text) with the mark of their label, stored in numbered slices of about SLICE_TEXT bytes."""
    chosen = checkpointed(targets(labels))
    # The labels grow with the documents: a shuffle at every size, never a broadcast that a small table would get.
    marked = texts.join(chosen.hint("merge"), texts["id"] == chosen["target_id"], "left").select(
        "id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), F.col("target_id").isNotNull().alias("own")
    )

    def row(number: int, ids: list[int | None], held: list[bytes], own: list[bool]) -> pa.RecordBatch:
        part = (TaskContext.get().partitionId() << 32) + number
        lengths = np.array([len(text) for text in held], np.int64)
        payload = zstandard.compress(lengths.tobytes() + b"".join(held), 3)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int64()), pa.array([len(words(held).hashes)], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())), pa.array([own], pa.list_(pa.bool_())), pa.array([payload], pa.binary()),
            ],
            [field.split()[0] for field in SLICES.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = 0, 0
        rows: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            for one in zip(*(column.to_pylist() for column in batch.columns)):
                for held, value in zip(rows, one):
                    held.append(value)
                size += len(one[1])
                if size >= SLICE_TEXT:
                    yield row(number, *rows)
                    number, size, rows = number + 1, 0, ([], [], [])
        if rows[0]:
            yield row(number, *rows)

    return checkpointed(marked.mapInArrow(run, SLICES))


def _texts(payload: bytes, n: int) -> list[bytes]:
    data = zstandard.decompress(payload)
    ends = np.cumsum(np.frombuffer(data, np.int64, n)) + 8 * n
    return [data[low:high] for low, high in zip([8 * n, *ends[:-1].tolist()], ends.tolist())]


def counts(slices: DataFrame, held: Held) -> DataFrame:
    """(place, background, target) over all texts of the slices: words by number, then held pairs.

    Number 0 counts all words that are not held. Every task adds up its own texts before anything is shuffled.
    """
    shared = slices.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = shared.value
        size = kept.coder.size
        tables = np.zeros((2, size + len(kept.pairs)), np.int64)
        for batch in batches:
            for marks, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = kept.coder.coded(_texts(payload, len(marks)))
                place, own = kept.places(tokens), np.array(marks, bool)[tokens.text]
                for table, mask in zip(tables, (np.ones(len(own), bool), own)):
                    table[:size] += np.bincount(tokens.number[mask], minlength=size)
                    table[size - 1] += np.count_nonzero(tokens.number_before[mask] == size - 1)
                    table[size:] += np.bincount(place[mask & (place >= 0)], minlength=len(kept.pairs))
        seen = np.flatnonzero(tables[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(tables[0][seen]), pa.array(tables[1][seen])], ["place", "background", "target"]
        )

    parts = slices.select("own", "payload").mapInArrow(run, COUNTS)
    return parts.groupBy("place").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


class Model:
    """Losses of one model; the start of a text counts as a word before, never as a word."""

    def __init__(self, table: np.ndarray, held: Held) -> None:
        size = held.coder.size
        self.words, self.pairs = table[:size], table[size:]
        self.all = self.words[: size - 1].sum() + held.distinct + 1
        self.single = (self.words + 1) / self.all

    def pair_loss(self, pairs: np.ndarray, single: np.ndarray) -> np.ndarray:
        return -np.log(pairs + PRIOR * single)

    def before_loss(self, words: np.ndarray) -> np.ndarray:
        return np.log(words + PRIOR)

    def held_loss(self, tokens: Tokens, place: np.ndarray, texts: int) -> np.ndarray:
        """What the held counts tell of the losses of `texts` texts."""
        known, seen = tokens.number_before > 0, place >= 0
        before = self.before_loss(self.words[tokens.number_before[known]])
        pair = self.pair_loss(self.pairs[place[seen]], self.single[tokens.number[seen]])
        found = np.bincount(tokens.text[known], before, texts) + np.bincount(tokens.text[seen], pair, texts)
        return found.astype(float)  # counts of nothing are whole numbers


def fit(slices: DataFrame, held: Held) -> tuple[Model, Model]:
    """Held counts of target and background model; only these reach the driver."""
    table = counts(slices, held).toArrow()
    both = np.zeros((2, held.coder.size + len(held.pairs)), np.int64)
    for row, name in zip(both, ("target", "background")):
        row[table.column("place").to_numpy()] = table.column(name).to_numpy()
    return Model(both[0], held), Model(both[1], held)


class Rest(NamedTuple):
    """Words and pairs of a slice that are not held: sorted hashes and the place of each token's word and pair in them.

    `word_at` and `pair_at` hold tokens that have such a word or pair, `word_is` and `pair_is` which one it is.
    """

    words: np.ndarray
    word_at: np.ndarray
    word_is: np.ndarray
    pairs: np.ndarray
    pair_at: np.ndarray
    pair_is: np.ndarray


def _rest(tokens: Tokens, place: np.ndarray) -> Rest:
    word_at, pair_at = np.flatnonzero(tokens.number == 0), np.flatnonzero(place < 0)
    found, word_is = np.unique(tokens.word[word_at], return_inverse=True)
    pairs = mixed(tokens.before[pair_at] * _PAIR + tokens.word[pair_at]) % np.uint64(CELLS)
    pairs, pair_is = np.unique(pairs, return_inverse=True)
    return Rest(found, word_at, word_is, pairs, pair_at, pair_is)


def _pressed(arrays: list[np.ndarray]) -> bytes:
    """64-bit whole numbers, bytes of equal rank together, so that zstandard finds the many zeros."""
    planes = (np.ascontiguousarray(one.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes() for one in arrays)
    return zstandard.compress(b"".join(planes), 3)


def _released(payload: bytes, sizes: list[int]) -> list[np.ndarray]:
    data, at, found = zstandard.decompress(payload), 0, []
    for size in sizes:
        planes = np.frombuffer(data, np.uint8, 8 * size, at).reshape(8, size)
        found.append(np.ascontiguousarray(planes.T).view(np.uint64).reshape(size))
        at += 8 * size
    return found


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=np.uint64(0))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Range of the hash, of equal widths and rising with it."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _named(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds)], ["slice", "bucket", "n_words", "n_pairs", "payload"]
    )


def sent(slices: DataFrame, shared: Broadcast, buckets: int) -> DataFrame:
    """Runs of the words and pairs of every slice that are not held: hashes as steps, counts over all texts and the target's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value[0]
        for batch in batches:
            for number, marks, payload in zip(*(column.to_pylist() for column in batch.columns)):
                tokens = held.coder.coded(_texts(payload, len(marks)))
                rest, own = _rest(tokens, held.places(tokens)), np.array(marks, bool)[tokens.text]
                parts = []
                for items, at, which in ((rest.words, rest.word_at, rest.word_is), (rest.pairs, rest.pair_at, rest.pair_is)):
                    n = [np.bincount(some, minlength=len(items)) for some in (which, which[own[at]])]
                    cuts = np.searchsorted(_bucket(items, buckets), np.arange(buckets + 1))
                    parts.append((items, *n, cuts))
                rows = []
                for bucket in np.unique(np.concatenate([_bucket(part[0], buckets) for part in parts])).tolist():
                    found = [[values[cuts[bucket] : cuts[bucket + 1]] for values in part] for *part, cuts in parts]
                    arrays = [one for items, n, mine in found for one in (_steps(items), n, mine)]
                    rows.append((number, bucket, len(found[0][0]), len(found[1][0]), _pressed(arrays)))
                for low in range(0, len(rows), 64):
                    yield _named(rows[low : low + 64])

    return slices.select("slice", "own", "payload").mapInArrow(run, RUNS)


def answered(runs: DataFrame) -> DataFrame:
    """For every run the totals of its words and pairs over all slices, in the order of the run."""

    def add(table: pa.Table) -> pa.Table:
        sizes = list(zip(table.column("n_words").to_pylist(), table.column("n_pairs").to_pylist()))
        opened = [
            _released(payload, [w, w, w, p, p, p]) for payload, (w, p) in zip(table.column("payload").to_pylist(), sizes)
        ]
        totals = []
        for kind in (0, 3):
            items, which = np.unique(np.concatenate([np.cumsum(one[kind]) for one in opened]), return_inverse=True)
            for at in (kind + 1, kind + 2):
                sums = np.bincount(which, np.concatenate([one[at] for one in opened]), len(items))
                totals.append(np.split(sums[which], np.cumsum([len(one[kind]) for one in opened])[:-1]))
        payloads = [_pressed(list(arrays)) for arrays in zip(*totals)]
        return table.set_column(table.schema.get_field_index("payload"), "payload", pa.array(payloads, pa.binary()))

    return runs.groupBy("bucket").applyInArrow(add, ANSWERS)


def scored(slices: DataFrame, answers: DataFrame, shared: Broadcast) -> DataFrame:
    """Losses of every text of the slices, from what is held and from the answers to the slice."""
    kept = slices.select("slice", F.lit(-1).alias("bucket"), F.lit(0).alias("n_words"), F.lit(0).alias("n_pairs"), "payload", "ids")
    both = kept.unionByName(answers.withColumn("ids", F.lit(None).cast("array<long>")))

    def run(table: pa.Table) -> pa.Table:
        held, models = shared.value
        table = table.sort_by("bucket")
        payloads = table.column("payload").to_pylist()
        ids = table.column("ids")[0].as_py()
        sizes = zip(table.column("n_words").to_pylist()[1:], table.column("n_pairs").to_pylist()[1:])
        opened = [_released(payload, [w, w, p, p]) for payload, (w, p) in zip(payloads[1:], sizes)]
        background_words, target_words, background_pairs, target_pairs = (
            np.concatenate([one[i] for one in opened]).astype(np.float64) if opened else np.zeros(0) for i in range(4)
        )
        tokens = held.coder.coded(_texts(payloads[0], len(ids)))
        place = held.places(tokens)
        rest, n = _rest(tokens, place), len(ids)
        losses = []
        for model, own_words, own_pairs in ((models[0], target_words, target_pairs), (models[1], background_words, background_pairs)):
            single = model.single[tokens.number]
            single[rest.word_at] = (own_words[rest.word_is] + 1) / model.all
            loss = model.held_loss(tokens, place, n)
            pair = model.pair_loss(own_pairs[rest.pair_is], single[rest.pair_at])
            loss += np.bincount(tokens.text[rest.pair_at], pair, n)
            before = np.where(tokens.followed[rest.word_at], model.before_loss(own_words[rest.word_is]), 0.0)
            losses.append(loss + np.bincount(tokens.text[rest.word_at], before, n))
        many = np.bincount(tokens.text, minlength=n)
        per_token = [pa.array(loss / np.maximum(many, 1)) for loss in losses]
        return pa.table(
            [pa.array(ids, pa.int64()), pa.array(many.astype(np.int64)), *per_token],
            names=["id", "n_tokens", "target_loss", "background_loss"],
        )

    return both.groupBy("slice").applyInArrow(run, LOSSES)


def targets(labels: DataFrame) -> DataFrame:
    """Ids of the documents that stand for the target."""
    return (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.min("quality") == 1).alias("good"), F.coalesce(F.max("toxic") == 1, F.lit(False)).alias("toxic"))
        .where("good and not toxic")
        .select(F.col("doc_id").alias("target_id"))
    )


def score(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Losses and score of every row of `df`; the models are fitted on all of it."""
    plain = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    known, distinct = _most_frequent(_word_counts(plain), VOCABULARY)
    coder = Coder(np.sort(known.view(np.uint64)))
    held = Held(coder, frequent_pairs(plain, coder, HELD_PAIRS), distinct)
    slices = sliced(plain, labels)
    shared = df.sparkSession.sparkContext.broadcast((held, fit(slices, held)))
    total = slices.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    answers = answered(sent(slices, shared, max(1, -(-total // MEETING_ROWS))))
    return scored(slices, answers, shared).select(
        F.col("id").alias(key),
        "n_tokens",
        "target_loss",
        "background_loss",
        (F.col("target_loss") - F.col("background_loss")).alias("score"),
    )
