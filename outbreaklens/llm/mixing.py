"""Mixing sources to target weights.

The words of a source, document after document in a pseudorandom order, are packed into blocks of fixed length.
The mix is a number of slots, dealt over output shards; every slot of a shard draws its source, so the source
counts of a shard are multinomial. Draws beyond a source's whole number of slots pass to sources that drew too
few, which makes the totals exact. The slots of a source, counted over all shards, are mapped to its blocks by a
pseudorandom permutation for every pass over the source, and blocks are joined by index: `shards` has the words of
every slot of every shard, piece by piece with the row they come from, and `mix` adds up these pieces by row.

Targets: weights repeat over the sources in code point order, null last. The sources share `share` times all
words by weight, no source gets more than `cap` times its words, and what is cut off goes to the others by weight.

A null text has size 0 and is never taken, nor is an empty one. Null is a source of its own. Repeated rows are folded into
one with a number before anything else and packed copy by copy, and rows that share an id are dealt by their text as
well, so no id and no text fills a window. Texts of any length are cut into pieces of at most a block. An empty table has
an empty mix; other columns are not read.
Only columns and joins are used. Every draw is a hash of seed and index, so reruns give the same mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from outbreaklens.llm.quality import words
from outbreaklens.session import checkpointed

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK = 64
SHARD_SLOTS = 4096
TASK_SLOTS = 1 << 18
CELLS = 4096
PACK_ROWS = 10_000
SMALL_SOURCES = 10_000  # a table of so many sources is broadcast
SEED = 42
IDENTITY = ["sid", "part", "tie", "key", "source", "size", "source_size", "target"]
# Primes above any number of blocks, so that each is a step through all blocks.
STEPS = (2305843009213693951, 1152921504606846883, 576460752303423619, 288230376151711717)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size) with sid, weight and target: the water level at which the shares add up."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    named = sizes.withColumn("sid", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights)) + 1).cast("double")
    )
    limit = F.col("source_size") * F.lit(float(cap))
    # Sources reach their limit in this order while the level rises.
    filling = Window.orderBy(limit / F.col("weight"), "sid")
    before, everything = filling.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    levels = named.withColumn(
        "level",
        (
            F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
        )
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    ).withColumn("free", F.col("level") * F.col("weight") <= limit)
    water = F.min_by(F.when(F.col("free"), F.col("level")), F.when(F.col("free"), limit / F.col("weight"))).over(everything)
    return levels.withColumn("water", water).select(
        "source",
        "sid",
        "source_size",
        F.when(F.col("water").isNull(), limit).otherwise(F.least(limit, F.col("water") * F.col("weight"))).alias("target"),
    )


def _uniform(below: Column, *of: Column) -> Column:
    """A pseudorandom whole number in [0, below)."""
    return F.pmod(F.xxhash64(F.lit(SEED), *of), below)


def _permuted(index: Column, blocks: Column, sid: Column, turn: Column) -> Column:
    """The block of an index: an affine permutation of [0, blocks) chosen by source and pass."""
    step = F.element_at(F.array(*map(F.lit, STEPS)), (_uniform(F.lit(len(STEPS)), sid, turn) + 1).cast("int"))
    wide = (step % blocks).cast("decimal(19,0)") * index.cast("decimal(19,0)") + _uniform(blocks, turn, sid)
    return (wide % blocks.cast("decimal(19,0)")).cast("long")


def slots(sources: DataFrame, total: int) -> DataFrame:
    """(shard, sid, index): the source and the running number in it of each of `total` slots.

    `sources` has sid and wanted (slots of the source).
    """
    spark = sources.sparkSession
    few = sources.count() <= SMALL_SOURCES
    order = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sources.where("wanted > 0").withColumn("low", F.coalesce(F.sum("wanted").over(order), F.lit(0)))
    width = max(1, math.ceil(total / CELLS))
    cells = ranges.select(
        "sid",
        "low",
        (F.col("low") + F.col("wanted")).alias("high"),
        F.explode(
            F.sequence(F.floor(F.col("low") / width), F.floor((F.col("low") + F.col("wanted") - 1) / width))
        ).alias("cell"),
    )
    drawn = (
        spark.range(total)
        .select((F.col("id") / SHARD_SLOTS).cast("long").alias("shard"), "id", _uniform(F.lit(total), F.col("id")).alias("at"))
        .withColumn("cell", F.floor(F.col("at") / width))
        .join(F.broadcast(cells) if few else cells.hint("merge"), "cell")
        .where((F.col("at") >= F.col("low")) & (F.col("at") < F.col("high")))
        .select("shard", "id", "sid")
    )
    counts = checkpointed(drawn.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n")))
    got = sources.join(counts.groupBy("sid").agg(F.sum("n").alias("got")), "sid", "left").select(
        "sid", "wanted", F.coalesce("got", F.lit(0)).alias("got")
    )
    over, under = F.greatest(F.col("got") - F.col("wanted"), F.lit(0)), F.greatest(F.col("wanted") - F.col("got"), F.lit(0))
    moved = got.select(
        "sid",
        "wanted",
        "got",
        F.coalesce(F.sum(over).over(order), F.lit(0)).alias("over_before"),
        F.coalesce(F.sum(under).over(order), F.lit(0)).alias("under_before"),
    )
    # Runs of slots meet their sources as runs and are dealt to tasks by their slots. A plan takes the slots of a run for one
    # row: it would broadcast them all, or leave them to one task, so joins of what is spread out are told how to be done.
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.select(
        "shard", "sid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.col("n").alias("length")
    ).join(moved, "sid").repartition(max(1, math.ceil(total / TASK_SLOTS)), "shard")
    end = F.col("first") + F.col("length")
    surplus = (
        runs.where(end > F.col("wanted"))
        .select("shard", "over_before", "wanted", F.explode(F.sequence(F.greatest("first", "wanted"), end - 1)).alias("index"))
        .select("shard", (F.col("over_before") + F.col("index") - F.col("wanted")).alias("ordinal"))
    )
    missing = (
        moved.where("got < wanted")
        .select("sid", "under_before", "got", F.explode(F.sequence(F.col("got"), F.col("wanted") - 1)).alias("index"))
        .select("sid", "index", (F.col("under_before") + F.col("index") - F.col("got")).alias("ordinal"))
    )
    return (
        runs.where("first < wanted")
        .select("shard", "sid", F.explode(F.sequence(F.col("first"), F.least(end, F.col("wanted")) - 1)).alias("index"))
        .unionByName(surplus.hint("merge").join(missing, "ordinal").select("shard", "sid", "index"))
    )


def packed(rows: DataFrame, n_rows: int) -> DataFrame:
    """Rows (sid, key, size, mark, copy) with the place of their first word in their source.

    `mark` tells rows of one key apart and `copy` equal rows, so the parts are of about equal size whatever the keys.
    """
    one = [F.col(name) for name in ("key", "mark", "copy")]
    parts = rows.withColumn("part", _uniform(F.lit(max(1, math.ceil(n_rows / PACK_ROWS))), *one))
    inside = Window.partitionBy("sid", "part").orderBy(F.xxhash64(*one), "key", "size", "mark", "copy")
    before = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("sid", "part")
        .agg(F.sum("size").alias("words"))
        .select("sid", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    )
    return (
        parts.withColumn(
            "inside", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        )
        .withColumn("tie", F.row_number().over(inside))
        .join(offsets, ["sid", "part"])
        .withColumn("start", F.col("offset") + F.col("inside"))
        .drop("offset", "inside")
    )


def _laid_out(
    df: DataFrame, key: str, text: str, source: str, weights, share: float, cap: float, block: int, content: bool
) -> tuple[DataFrame, DataFrame]:
    """The packed rows of `df`, and a row for every piece of a row in a slot of a shard, with its words if `content`."""
    kept = [words(text).alias("tokens")] if content else []
    rows = checkpointed(
        df.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            F.size(words(text)).cast("long").alias("size"),
            F.xxhash64(text).alias("mark"),
            *kept,
        )
        .groupBy("key", "source", "size", "mark")
        .agg(F.count(F.lit(1)).alias("copies"), *[F.first("tokens").alias("tokens") for _ in kept])
    )
    counted = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    sizes = targets(counted, weights, share, cap)
    blocks = F.ceil(F.col("source_size") / block)
    sources = checkpointed(
        sizes.withColumn("blocks", blocks).withColumn(
            "wanted",
            F.when(F.col("source_size") > 0, F.round(F.col("target") * blocks / F.col("source_size")))
            .otherwise(0)
            .cast("long"),
        )
    )
    n_sources, total = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("wanted"), F.lit(0))).first()
    side = F.broadcast(sources) if n_sources <= SMALL_SOURCES else sources
    known = rows.alias("r").join(side.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))).select(
        "r.key", "r.size", "r.mark", "r.source", "s.sid", "s.source_size", "s.target", *(["r.tokens"] if content else []),
        F.explode(F.sequence(F.lit(1).cast("long"), "r.copies")).alias("copy"),
    )
    placed = packed(known, rows.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0])

    turn, index = F.floor(F.col("index") / F.col("blocks")), F.col("index") % F.col("blocks")
    in_shard = Window.partitionBy("shard").orderBy(_uniform(F.lit(1 << 62), F.col("sid"), F.col("index")), "sid", "index")
    mapped = (
        slots(sources.select("sid", "wanted"), total)
        .withColumn("slot", F.row_number().over(in_shard) - 1)
        .join(side.select("sid", "blocks"), "sid")
        .select("shard", "slot", "sid", turn.alias("turn"), _permuted(index, F.col("blocks"), F.col("sid"), turn).alias("block"))
    )

    def piece(number: Column) -> Column:
        low = F.greatest(number * block, F.col("start"))
        n = F.least((number + 1) * block, F.col("start") + F.col("size")) - low
        first = low - F.col("start")
        content_of = [F.array_join(F.slice("tokens", (first + 1).cast("int"), n.cast("int")), " ").alias("words")]
        return F.struct(
            number.alias("block"), (low - number * block).alias("place"), first.alias("first"), n.alias("n_words"),
            *(content_of if content else []),
        )

    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = (
        placed.where("size > 0")
        .select(*IDENTITY, F.explode(F.transform(F.sequence(first, last), piece)).alias("piece"))
        .select(*IDENTITY, "piece.*")
    )
    return placed, pieces.hint("merge").join(mapped, ["sid", "block"])


def shards(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block: int = BLOCK,
) -> DataFrame:
    """The mix itself: (shard, slot, source, place, key, first, n_words, words) for every piece of a block in a slot.

    The words of a slot are its pieces in the order of `place`, the place of the piece in the block; `first` is the
    place of the piece's first word in its row. The slots of a shard are in pseudorandom order.
    """
    laid = _laid_out(df, key, text, source, weights, share, cap, block, True)[1]
    return laid.select("shard", "slot", "source", "place", F.col("key").alias(key), "first", "n_words", "words")


def copies(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block: int = BLOCK,
) -> DataFrame:
    """What the slots of all shards hold of a row, pass by pass: (key, size, spans) with spans (first, n_words) in word order.

    In a whole pass over a source all words of a row are there, in the last one those whose blocks were drawn. Spans that
    touch are separate; a row that no slot holds is not there.
    """
    laid = _laid_out(df, key, text, source, weights, share, cap, block, False)[1]
    spans = F.sort_array(F.collect_list(F.struct("first", "n_words")))
    return laid.groupBy("sid", "part", "tie", "key", "size", "turn").agg(spans.alias("spans")).select(
        F.col("key").alias(key), "size", "spans"
    )


def mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block: int = BLOCK,
) -> DataFrame:
    """For every row of `df` its size, its source's size and target, and the words that the slots of all shards hold of it."""
    placed, laid = _laid_out(df, key, text, source, weights, share, cap, block, False)
    taken = (
        laid.select(*IDENTITY, "n_words")
        .unionByName(placed.select(*IDENTITY, F.lit(0).cast("long").alias("n_words")))
        .groupBy(*IDENTITY)
        .agg(F.sum("n_words").alias("taken"))
    )
    return taken.select(F.col("key").alias(key), "size", "source_size", "target", "taken")
