"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; a bit is set when more than half of a text's word shingles have it in their XXH64 hash.
Fingerprints within `BITS` bits are linked. They are cut into `SEGMENTS` segments, so two linked ones differ by at
most BITS // SEGMENTS bits in some segment: every fingerprint stands in one table per segment under its segment,
and looks up the Hamming ball of that radius around it. Each match is verified by its complete distance.

Documents with equal fingerprints are one vertex. Inside one bucket only a spanning forest of the verified links
leaves the task, never all pairs; components come from those links. Buckets are streamed in sorted order. A bucket
of more than `BLOCK_ROWS` table rows is cut into blocks that each meet all look-ups of the bucket.

A null text and a text without words have fingerprint zero, linked like any other. Repeated rows share a
fingerprint and so a component. The component is the smallest id reachable; null ids count only if there is no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outbreaklens.llm.components import components
from outbreaklens.session import checkpointed

SHINGLE = 3
SEED = 42
BITS = 3
SEGMENTS = 2
BLOCK_ROWS = 200_000
BIT_ROWS = 1 << 15

LINKS = "a long, b long"


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned XXH64 of every shingle of lower-cased words; one of the whole sequence if it is shorter."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[shingle - 1 :]) if len(words) >= shingle else [(0, len(joined))]
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint as a signed number."""
    hashes = shingle_hashes(text, shingle)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BIT_ROWS):
        part = hashes[at : at + BIT_ROWS].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(text: Column | str, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(one, shingle) for one in texts.to_pylist()], pa.int64())

    return run(text)


def ball(width: int, radius: int) -> list[int]:
    """All masks of `width` bits with at most `radius` set, the empty one first."""
    return [sum(1 << bit for bit in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def bucket_rows(prints: DataFrame, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """(segment, value, seeks, fp): the table row of every fingerprint and its look-ups.

    Of two segments one bit apart, the one without the bit looks up the other, so for balls of radius one only
    unset bits are tried; larger balls are enumerated whole.
    """
    edges = [64 * i // segments for i in range(segments + 1)]
    radius = bits // segments
    parts = []
    for number, (low, high) in enumerate(zip(edges, edges[1:])):
        width = high - low
        value = F.shiftrightunsigned("fp", low).bitwiseAND(_long((1 << width) - 1))
        part = prints.select(F.lit(number).cast("byte").alias("segment"), value.alias("own"), "fp")
        masks = F.array(*[_long(mask) for mask in ball(width, radius) if mask])
        found = F.transform(masks, lambda mask: F.when(F.col("own").bitwiseAND(mask) == 0, F.col("own").bitwiseOR(mask)))
        if radius > 1:
            found = F.transform(masks, lambda mask: F.col("own").bitwiseXOR(mask))
        table = part.select("segment", F.col("own").alias("value"), F.lit(False).alias("seeks"), "fp")
        parts.append(table)
        if radius:
            tried = part.select("segment", F.explode(found).alias("value"), F.lit(True).alias("seeks"), "fp")
            parts.append(tried.where(F.col("value").isNotNull()))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _forest(table: np.ndarray, seekers: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """Spanning links of the verified matches of a bucket: breadth first, each member is reached once.

    Table members are compared with each other and with the seekers; two seekers meet in other buckets.
    """
    table_left, seekers_left = table, seekers
    while len(table_left):
        front_t, front_s = table_left[:1], seekers_left[:0]
        table_left = table_left[1:]
        while len(front_t) or len(front_s):
            next_t, next_s = [], []
            for one in front_t:
                near = np.bitwise_count(table_left ^ one) <= bits
                next_t.append(table_left[near])
                table_left = table_left[~near]
                yield from ((int(one), int(other)) for other in next_t[-1])
                near = np.bitwise_count(seekers_left ^ one) <= bits
                next_s.append(seekers_left[near])
                seekers_left = seekers_left[~near]
                yield from ((int(one), int(other)) for other in next_s[-1])
            for one in front_s:
                if not len(table_left):
                    break
                near = np.bitwise_count(table_left ^ one) <= bits
                next_t.append(table_left[near])
                table_left = table_left[~near]
                yield from ((int(one), int(other)) for other in next_t[-1])
            front_t = np.concatenate(next_t) if next_t else front_t[:0]
            front_s = np.concatenate(next_s) if next_s else front_s[:0]


def _bucket_links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple[int, int]]:
    """Links of the buckets in rows sorted by bucket; a bucket may run over several batches."""
    held: list[np.ndarray] = []
    for batch in batches:
        segment, block, value, seeks, fp = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
        rows = np.empty(len(fp), [("segment", "i1"), ("block", "i4"), ("value", "i8"), ("seeks", "?"), ("fp", "i8")])
        rows["segment"], rows["block"], rows["value"], rows["seeks"], rows["fp"] = segment, block, value, seeks, fp
        rows = np.concatenate([*held, rows])
        new = np.flatnonzero(
            (rows["segment"][1:] != rows["segment"][:-1])
            | (rows["block"][1:] != rows["block"][:-1])
            | (rows["value"][1:] != rows["value"][:-1])
        )
        cut = new[-1] + 1 if len(new) else 0
        held = [rows[cut:]]
        yield from _sorted_links(rows[:cut], bits)
    for rows in held:
        yield from _sorted_links(rows, bits)


def _sorted_links(rows: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    if not len(rows):
        return
    keys = rows[["segment", "block", "value"]]
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    sizes = np.diff(np.concatenate([starts, [len(rows)]]))
    tables = np.add.reduceat((~rows["seeks"]).astype(np.int64), starts)
    for at in np.flatnonzero((sizes > 1) & (tables > 0)):
        start, n = starts[at], tables[at]  # table rows come first
        fp = rows["fp"][start : start + sizes[at]].view(np.uint64)  # bit counts of negative numbers are of their size
        yield from _forest(fp[:n], fp[n:], bits)


def links(prints: DataFrame, bits: int = BITS, segments: int = SEGMENTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b) links that connect the distinct fingerprints `fp` within `bits` bits, without listing all pairs."""
    rows = bucket_rows(prints, bits, segments)
    large = checkpointed(
        rows.where(~F.col("seeks"))
        .groupBy("segment", "value")
        .count()
        .where(F.col("count") > block_rows)
        .select("segment", "value", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks"))
    )
    if large.isEmpty():
        dealt = rows.withColumn("block", F.lit(0))
    else:
        # The table rows of a large bucket are dealt over its blocks; in its other blocks they seek.
        n = F.coalesce("blocks", F.lit(1))
        dealt = rows.join(large, ["segment", "value"], "left").select(
            "*", F.explode(F.sequence(F.lit(0), n - 1)).alias("block")
        )
        dealt = dealt.withColumn("seeks", F.col("seeks") | (F.pmod(F.xxhash64("fp"), n) != F.col("block")))
    streamed = (
        dealt.select("segment", "block", "value", "seeks", "fp")
        .repartition("segment", "block", "value")
        .sortWithinPartitions("segment", "block", "value", "seeks")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        for pair in _bucket_links(batches, bits):
            held.append(pair)
            if len(held) == 100_000:
                yield _link_batch(held)
                held = []
        if held:
            yield _link_batch(held)

    return streamed.mapInArrow(run, LINKS)


def _link_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def with_components(classes: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of `classes`, one per fingerprint `fp`, with the `component` of the fingerprint, itself a fingerprint."""
    joined = components(links(classes.select("fp"), bits))
    return classes.join(joined, classes["fp"] == joined["vertex"], "left").select(
        *[classes[name] for name in classes.columns], F.coalesce("component", "fp").alias("component")
    )


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """Fingerprint and component of every row of `df`; other columns are not read. Stores the fingerprints once."""
    rows = checkpointed(df.select(F.col(key).alias("key"), fingerprints(text, shingle).alias("fp")))
    classes = checkpointed(rows.groupBy("fp").agg(F.min("key").alias("least")))
    labelled = with_components(classes, bits)
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(smallest, "component").select(F.col("fp").alias("class_fp"), "component_id")
    return rows.join(named, rows["fp"] == named["class_fp"]).select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
