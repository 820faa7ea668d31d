"""Sharding by best-fit-decreasing bin packing of groups of equal texts.

A group is never split. Groups are packed in decreasing size, each into the bin with the least remaining capacity that
still holds it. Groups of one size are alike to that rule: the tightest bin takes as many of them as it holds, then the
next one. So the driver packs size classes with their numbers of groups, and Spark deals the groups of a class to its
bins by their rank in it. Sizes are exact up to 2^13 bytes and rounded up to `BITS` leading bits beyond, so there are at
most some 200,000 classes whatever the table.

The capacity is the smallest one (found by bisection) at which best fit decreasing needs no more than the given
number of shards. A group larger than an equal share of what is left takes a shard for itself; the others
then share the rest equally. The law is `bytes`: sizes of shards are as equal as whole groups allow.

Null and empty texts form one group of size 8 a row. Repeated rows are rows like any other and share a shard.
An empty table gives no rows; other columns are not read. A text of any length counts by its bytes alone. Slots count the
rows of a shard from 0, in an order that depends on ids and texts only.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Hashable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from outbreaklens.llm.prefixtrie import numbered
from outbreaklens.session import checkpointed

SHARDS = 24
BITS = 13  # leading bits of a size that tell classes apart
HEAVY = 1536  # groups of more than this share of all rows are broadcast
ROW_BYTES = 8
SLOT_ROWS = 50_000  # rows numbered by one window partition, about


class CapacityTree:
    """Open bins ordered by remaining capacity: a treap, balanced by random priorities."""

    def __init__(self) -> None:
        self._root: list | None = None  # [key, priority, left, right]
        self._draw = random.Random(0).random

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The bin with the least remaining capacity of at least `size`."""
        node, found = self._root, None
        while node:
            if node[0][0] >= size:
                node, found = node[2], node[0]
            else:
                node = node[3]
        return found

    def add(self, key: tuple[int, int]) -> None:
        low, high = self._split(self._root, key)
        self._root = self._merge(self._merge(low, [key, self._draw(), None, None]), high)

    def remove(self, key: tuple[int, int]) -> None:
        low, rest = self._split(self._root, key)
        _, high = self._split(rest, (key[0], key[1] + 1))
        self._root = self._merge(low, high)

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], key)
        return low, [node[0], node[1], high, node[3]]

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return [low[0], low[1], low[2], self._merge(low[3], high)]
        return [high[0], high[1], self._merge(low, high[2]), high[3]]


Spans = list[tuple[int, int]]  # (bin, number of groups) in the order in which a class is dealt


def best_fit_classes(classes: list[tuple[int, int]], capacity: int, most: int) -> list[Spans] | None:
    """Where the groups of each class (size, number) go, or None when more than `most` bins are needed.

    `classes` are in decreasing size.
    """
    tree, bins, found = CapacityTree(), 0, []
    for size, number in classes:
        spans: Spans = []
        while number:
            spot = tree.tightest(size)
            if spot is None:
                if bins == most or size > capacity:
                    return None
                spot, bins = (capacity, bins), bins + 1
            else:
                tree.remove(spot)
            taken = min(number, spot[0] // size)
            spans.append((spot[1], taken))
            tree.add((spot[0] - taken * size, spot[1]))
            number -= taken
        found.append(spans)
    return found


def pack_classes(classes: Iterable[tuple[int, int]], shards: int) -> dict[int, Spans]:
    """For each size the shards of its groups, at the smallest capacity that `shards` bins need."""
    queue = sorted(classes, reverse=True)
    placed: dict[int, Spans] = {size: [] for size, _ in queue}
    total = sum(size * number for size, number in queue)
    alone = 0
    while queue and shards - alone > 1 and queue[0][0] * (shards - alone) >= total:
        size, number = queue[0]
        total -= size
        placed[size].append((alone, 1))
        alone += 1
        queue = ([(size, number - 1)] if number > 1 else []) + queue[1:]
    if not queue:
        return placed
    bins = shards - alone
    low = max(queue[0][0], math.ceil(total / bins))
    high = math.ceil(total / bins) + queue[0][0]  # any-fit never needs more
    best = best_fit_classes(queue, high, bins)
    while low < high:
        capacity = (low + high) // 2
        found = best_fit_classes(queue, capacity, bins)
        if found is None:
            low = capacity + 1
        else:
            best, high = found, capacity
    for (size, _), spans in zip(queue, best):
        placed[size] += [(alone + at, number) for at, number in spans]
    return placed


def _dealt(names: list[tuple[int, Hashable]], spans: dict[int, Spans]) -> dict[Hashable, int]:
    """Bins of named items, those of one size in their order."""
    bins = {size: iter([at for at, number in own for _ in range(number)]) for size, own in spans.items()}
    return {name: next(bins[size]) for size, name in names}


def best_fit_decreasing(items: list[tuple[int, Hashable]], capacity: int, most: int) -> dict[Hashable, int] | None:
    """Bin of every item, or None when more than `most` bins are needed. `items` are in decreasing size."""
    classes = sorted(Counter(size for size, _ in items).items(), reverse=True)
    found = best_fit_classes(classes, capacity, most)
    return None if found is None else _dealt(items, {size: spans for (size, _), spans in zip(classes, found)})


def pack(items: Iterable[tuple[int, Hashable]], shards: int) -> dict[Hashable, int]:
    """Shard of every item at the smallest capacity that `shards` bins need."""
    queue = sorted(items, key=lambda item: (-item[0], str(item[1])))
    return _dealt(queue, pack_classes(Counter(size for size, _ in queue).items(), shards))


def _class(size: Column) -> Column:
    """The size, rounded up to its leading `BITS` bits."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(size)) - (BITS - 1), F.lit(0))).cast("long")
    return (F.call_function("div", size + step - 1, step) * step).cast("long")


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every row of `df`. Stores ids and digests once."""
    spark = df.sparkSession
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = checkpointed(
        df.select(
            F.col(key).alias("key"),
            (F.octet_length(plain) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(plain.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(plain.cast("binary"), 256)).alias("digest"),
        )
    )
    groups = checkpointed(
        rows.groupBy("digest")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        .select("digest", "n", _class(F.col("bytes")).alias("class"))
    )
    n_rows = rows.count()
    classes = [(r["class"], r["count"]) for r in groups.groupBy("class").count().collect()]
    spans = []
    for size, own in pack_classes(classes, shards).items():
        first = 1
        for at, number in own:
            spans.append((size, first, first + number, at))
            first += number
    # As many rows as there are classes, and up to a few more for each bin.
    dealt = spark.createDataFrame(spans, "size_class long, first long, after long, shard int")
    placed = checkpointed(
        numbered(groups, "class", "digest")
        .join(F.broadcast(dealt), (F.col("class") == F.col("size_class")) & (F.col("place") >= F.col("first")) & (F.col("place") < F.col("after")))
        .select("digest", "n", "shard")
    )
    # Fewer than HEAVY groups hold such a share of the rows.
    often = F.col("n") * HEAVY > n_rows
    heavy = F.broadcast(placed.where(often).select("digest", "shard"))
    found = rows.join(heavy, "digest").unionByName(
        rows.join(heavy.select("digest"), "digest", "left_anti").join(placed.where(~often).select("digest", "shard"), "digest")
    )
    found = found.withColumn("part", F.pmod(F.xxhash64("key", "digest"), F.lit(max(1, math.ceil(n_rows / SLOT_ROWS)))))
    ranked = found.withColumn(
        "inside", F.row_number().over(Window.partitionBy("shard", "part").orderBy("key", "digest")) - 1
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        found.groupBy("shard", "part")
        .count()
        .select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    return ranked.join(offsets, ["shard", "part"]).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.col("inside")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
