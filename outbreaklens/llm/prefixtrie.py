"""Trie of conversation prefixes: who shares which first turns, and what a shared prefix saves below each node.

A node is a distinct sequence of first turns; it is named by its smallest member and its depth. Sequences are told
apart by SHA-256 (128 bits of it travel): turns are hashed in a scan, so texts are read once and never shuffled, and a
long conversation is hashed in chunks of `CHUNK` turns whose digests are chained afterwards, so no task needs all of it.

The tree is handled by the Euler tour technique. Every node has an enter and an exit arc; an arc's successor follows
from first children and next siblings. The tour is list-ranked distributedly (`listrank`), with a leaf's one and a node's
saving as weights of the enter arcs, and a subtree's total is the prefix sum at its exit less that at its entrance.

Positions of turns come from a range partitioning with offsets of partitions, siblings are ordered in hash buckets of
about `SIBLINGS`, the few parents of very many children are broadcast (at most `HEAVY` of them can exist), and ids of the
members that end at a node are hashed in packs: no conversation, prefix or node has to fit into one task.

Rows without conv_id take no part. Null role and text are empty. Turns of equal number are ordered by the SHA-256 of
role and text, which makes repeated rows adjacent; each counts as a turn. An empty table has no conversation, hence no
node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from outbreaklens.llm.listrank import ALONE, prefix_sums
from outbreaklens.session import checkpointed, shuffle_partitions

EVERY = 100  # conversations that share the first turns of one
MOST = 6  # shared turns are fewer than this
CHUNK = 4096  # turns hashed in one go
SIBLINGS = 1024  # children of a node that are ordered together
HEAVY = 4096  # parents with more than this share of all nodes as children are broadcast
PACK = 4096  # ids of members hashed as one row
ROOT = bytes(16)
NO_IDS = hashlib.sha256(b"").hexdigest()


def _runs(values: np.ndarray) -> np.ndarray:
    """For every row the row at which its run of equal values begins."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


def numbered(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """`df` with `place`, the number from 1 of a row among those of its key in the given order; `key` is a long, not null.

    Rows are range-partitioned by key and order, so the rows of one key may lie in many partitions; what stands in
    front of a partition is told by one row per partition.
    """
    spark = df.sparkSession
    salted = df.withColumn("__salt", F.monotonically_increasing_id())  # equal rows need not meet in one task
    keys = [key, *order, "__salt"]
    ranged = salted.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).drop("__salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(key).to_numpy()
            place = np.arange(1, len(values) + 1) - _runs(values)
            if last == values[0]:
                place[: np.searchsorted(values, last, "right")] += count
            last, count = values[-1], place[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place.astype(np.int64)), pa.array(np.full(len(values), part))],
                [*batch.schema.names, "place", "__part"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    placed = checkpointed(ranged.mapInArrow(run, f"{schema}, place long, __part long"))
    edges = placed.groupBy("__part").agg(F.min(key), F.max(F.struct(key, "place"))).orderBy("__part").collect()
    offsets, last, count = [], None, 0
    for part, first, (end, place) in edges:
        before = count if first == last else 0
        if before:
            offsets.append((part, first, before))
        last, count = end, place + (before if end == first else 0)
    moved = spark.createDataFrame(offsets, "__part long, __first long, __before long")
    return (
        placed.join(F.broadcast(moved), "__part", "left")
        .withColumn("place", F.col("place") + F.when(F.col(key) == F.col("__first"), F.col("__before")).otherwise(0))
        .drop("__part", "__first", "__before")
    )


def turns(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """(conv_id, place, digest, chars) of every turn, places from 1 by turn number, null first."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    hashed = df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    return numbered(hashed, "conv_id", F.col("turn").asc_nulls_first(), "digest").drop("turn")


def rebuilt(placed: DataFrame, every: int = EVERY, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of the one whose id ends their hundred.

    Of conversation c the first h = crc32(c) mod `most` turns are replaced by those of c - c mod `every`. Returns the
    rows (conv_id, depth, digest, chars, last) and the conversations without a turn.
    """
    placed = checkpointed(placed)
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = (
        placed.where((F.col("place") < most) & (F.col("conv_id") % every == 0))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("first"))
    )
    convs = placed.groupBy("conv_id").agg(F.max("place").alias("n"))
    convs = convs.withColumn("h", shared).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    convs = checkpointed(
        convs.join(heads, "base", "left").select(
            "conv_id", "n", "h", F.coalesce(F.slice("first", F.lit(1), F.col("h").cast("int")), F.array()).alias("first")
        )
    )
    borrowed = convs.select(
        "conv_id",
        F.posexplode("first").alias("at", "turn"),
        ((F.col("n") <= F.col("h")) & (F.col("at") == F.size("first") - 1)).alias("last"),
    ).select("conv_id", (F.col("at") + 1).cast("long").alias("depth"), "turn.digest", "turn.chars", "last")
    # Rows of a conversation meet its numbers piece by piece: a long one is many small keys.
    pieces = convs.select(
        "conv_id", "n", (F.size("first") - F.col("h")).alias("shift"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n div {CHUNK}"))).alias("piece"),
    )
    own = (
        placed.where(F.col("place") > shared)
        .withColumn("piece", F.expr(f"place div {CHUNK}"))
        .join(pieces, ["conv_id", "piece"])
        .select("conv_id", (F.col("place") + F.col("shift")).alias("depth"), "digest", "chars", (F.col("place") == F.col("n")).alias("last"))
    )
    return borrowed.unionByName(own), convs.where((F.size("first") == 0) & (F.col("n") <= F.col("h"))).select("conv_id")


def _chained(df: DataFrame, by: list[str], order: str, digest: str) -> DataFrame:
    """`df` with `run`, the chained SHA-256 of the digests so far in its group, and `before`, that of the row in front."""
    ordered = df.repartition(*by).sortWithinPartitions(*by, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, now = None, b""
        for batch in batches:
            chained, before = [], []
            for own, value in zip(zip(*[batch.column(name).to_pylist() for name in by]), batch.column(digest).to_pylist()):
                if own != group:
                    group, now = own, b""
                before.append(now)
                now = hashlib.sha256(now + value).digest()
                chained.append(now)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chained, pa.binary()), pa.array(before, pa.binary())],
                [*batch.schema.names, "run", "before"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
    return ordered.mapInArrow(run, f"{schema}, run binary, before binary")


def _short(digest: Column) -> Column:
    return F.substring(F.unhex(F.sha2(digest, 256)), 1, 16)


def prefixes(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows (conv_id, depth, chars, last, ...) with the keys of the prefix that ends here and of the one in front of it."""
    chunked = rows.withColumn("chunk", F.floor((F.col("depth") - 1) / F.lit(chunk)))
    runs = checkpointed(_chained(chunked, ["conv_id", "chunk"], "depth", "digest").drop("digest"))
    whole = runs.where(F.col("depth") % chunk == 0).select("conv_id", "chunk", F.col("run").alias("digest"))
    starts = _chained(whole, ["conv_id"], "chunk", "digest").select(
        "conv_id", (F.col("chunk") + 1).alias("chunk"), F.col("run").alias("start")
    )
    first = runs.where("chunk = 0").withColumn("start", F.lit(b""))
    later = runs.where("chunk > 0").join(starts, ["conv_id", "chunk"])
    begins = F.length("before") == 0
    front = F.when(F.col("depth") == 1, F.lit(ROOT)).otherwise(
        F.when(begins, F.substring("start", 1, 16)).otherwise(_short(F.concat("start", "before")))
    )
    return first.unionByName(later).select(
        "conv_id", "depth", "chars", "last", _short(F.concat("start", "run")).alias("key"), front.alias("parent")
    )


def _ends(ends: DataFrame, pack: int) -> DataFrame:
    """(key, ends_sha256): digest of the ascending ids of every key, joined by commas."""
    parts = shuffle_partitions(ends.sparkSession)
    ordered = ends.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            found = []
            for key, group in groupby(rows, itemgetter(0)):
                ids = [number for _, number in group]
                found += [(key, ids[at], ",".join(map(str, ids[at : at + pack]))) for at in range(0, len(ids), pack)]
            columns = list(zip(*found)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                ["key", "first", "ids"],
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            found = []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own == key:
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    found.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
            yield _digests(found)
        if key is not None:
            yield _digests([(key, state.hexdigest())])

    def _digests(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.string())], ["end_key", "ends_sha256"]
        )

    packs = ordered.mapInArrow(packed, "key binary, first long, ids string")
    return packs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "end_key binary, ends_sha256 string")


def trie(
    rows: DataFrame, turnless: DataFrame, chunk: int = CHUNK, siblings: int = SIBLINGS, pack: int = PACK, alone: int = ALONE
) -> DataFrame:
    """Nodes of the trie over rows (conv_id, depth, digest, chars, last) and conversations without a turn.

    `depth` counts a conversation's turns from 1 without a gap; `last` marks its last one.
    """
    members = prefixes(rows, chunk)
    nodes = members.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        F.max("chars").alias("chars"),
        F.count(F.lit(1)).alias("n_convs"),
    )
    everyone = members.where("depth = 1").select("conv_id").unionByName(turnless)
    root = (
        everyone.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
        .where("n_convs > 0")
        .select(
            F.lit(ROOT).alias("key"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"),
            F.lit(0).cast("long").alias("chars"), "n_convs",
        )
    )
    nodes = checkpointed(nodes.unionByName(root))
    counted = nodes.where("depth > 0").groupBy(F.col("parent").alias("up")).agg(F.count(F.lit(1)).alias("n"))
    nodes = checkpointed(
        nodes.join(counted, F.col("key") == F.col("up"), "left").select(
            "key", "conv_id", "depth", "parent", "chars", "n_convs", F.coalesce("n", F.lit(0)).alias("n_children")
        )
    )

    # Children learn their parent's name. Parents of more than 1/HEAVY of all nodes are fewer than HEAVY.
    many = max(siblings, nodes.count() // HEAVY)
    parents = nodes.where("n_children > 0").select(
        F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_siblings")
    )
    children = nodes.where("depth > 0")
    heavy = F.broadcast(parents.where(F.col("n_siblings") > many))
    of_heavy = children.join(heavy, F.col("parent") == F.col("up"))
    of_others = children.join(heavy, F.col("parent") == F.col("up"), "left_anti").join(
        parents.where(F.col("n_siblings") <= many), F.col("parent") == F.col("up")
    )
    bucket = F.pmod(F.xxhash64("conv_id"), F.ceil(F.col("n_siblings") / F.lit(siblings)))
    children = of_heavy.unionByName(of_others).withColumn("bucket", bucket)
    following = F.lead("conv_id").over(Window.partitionBy("parent", "bucket").orderBy("conv_id"))
    children = checkpointed(
        children.select("key", "parent", "bucket", "conv_id", "depth", "parent_conv_id", following.alias("following"))
    )
    in_order = Window.partitionBy("parent").orderBy("bucket")
    buckets = checkpointed(
        children.groupBy("parent", "bucket")
        .agg(F.min("conv_id").alias("first"))
        .select(
            F.col("parent").alias("of"), F.col("bucket").alias("in"), "first",
            F.lead("first").over(in_order).alias("later"), (F.row_number().over(in_order) == 1).alias("leads"),
        )
    )

    # Successors: enter to the first child or to the own exit, exit to the next sibling or to the parent's exit.
    child = nodes.join(buckets.where("leads").select("of", "first"), F.col("key") == F.col("of"), "left")
    leaf = F.col("first").isNull()
    enter = child.select(
        "conv_id",
        (F.col("depth") * 2).alias("arc"),
        F.coalesce("first", "conv_id").alias("next_conv"),
        F.when(leaf, F.col("depth") * 2 + 1).otherwise(F.col("depth") * 2 + 2).alias("next_arc"),
        leaf.cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    nothing = [F.lit(0).cast("long").alias(name) for name in ("leaves", "saved")]
    sibling = children.where("following is null").join(
        buckets, (F.col("parent") == F.col("of")) & (F.col("bucket") == F.col("in"))
    ).select("conv_id", "depth", "parent_conv_id", F.col("later").alias("following"))
    sibling = sibling.unionByName(children.where("following is not null").select("conv_id", "depth", "parent_conv_id", "following"))
    leave = sibling.select(
        "conv_id",
        (F.col("depth") * 2 + 1).alias("arc"),
        F.coalesce("following", "parent_conv_id").alias("next_conv"),
        (F.col("depth") * 2 - F.col("following").isNull().cast("int")).alias("next_arc"),
        *nothing,
    )
    end = nodes.where("depth = 0").select(
        "conv_id", F.lit(1).cast("long").alias("arc"), F.lit(None).cast("long").alias("next_conv"),
        F.lit(None).cast("long").alias("next_arc"), *nothing,
    )
    sums = prefix_sums(
        enter.unionByName(leave).unionByName(end), ["conv_id", "arc"], ["next_conv", "next_arc"], ["leaves", "saved"], alone
    )
    sign = F.when(F.col("arc") % 2 == 1, 1).otherwise(-1)
    totals = sums.groupBy(F.col("conv_id").alias("c"), F.expr("arc div 2").alias("d")).agg(
        F.sum(F.col("leaves") * sign).alias("n_leaves"), F.sum(F.col("saved") * sign).alias("saved_tokens")
    )

    ends = members.where("last").select("key", "conv_id").unionByName(turnless.select(F.lit(ROOT).alias("key"), "conv_id"))
    named = children.select(F.col("conv_id").alias("child"), F.col("depth").alias("at"), "parent_conv_id")
    return (
        nodes.join(totals, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d")))
        .join(named, (F.col("conv_id") == F.col("child")) & (F.col("depth") == F.col("at")), "left")
        .join(_ends(ends, pack), F.col("key") == F.col("end_key"), "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
        )
    )


def conversation_trie(df: DataFrame) -> DataFrame:
    """Trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    return trie(*rebuilt(turns(df)))
