"""Prefix sums along a linked list whose elements lie anywhere: list ranking by random mates.

In a round every element draws heads or tails by a hash. An element with heads absorbs its successor with tails: their
weights add up and the successor leaves the list, with a record of who absorbed it and what lay in front of it. About
a quarter of the list goes a round, so all rounds together move a few times the list, and a hot spot cannot arise: an
element takes part in one join row. When at most `ALONE` elements are left, one task walks them. Then the records give
the absorbed elements their sums, last round first.

Every round is stored, so a lost executor repeats no more than the round it was in.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outbreaklens.session import checkpointed

ALONE = 1 << 16  # elements that one task walks


def _heads(names: Sequence[str], turn: int) -> Column:
    return F.xxhash64(F.lit(turn), *names) % 2 == 0


def _walked(df: DataFrame, ids: list[str], after: list[str], weights: list[str]) -> DataFrame:
    """Sums in front of every element of a list that fits into one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {}
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in (*ids, *after, *weights)]
            for row in zip(*columns):
                rows[row[: len(ids)]] = row[len(ids) :]
        followers = {row[: len(ids)] for row in rows.values()}
        found = []
        for first in rows.keys() - followers:
            at, sums = first, [0] * len(weights)
            while at in rows:
                found.append((*at, *sums))
                step = rows[at]
                at, sums = step[: len(ids)], [a + b for a, b in zip(sums, step[len(ids) :])]
        columns = list(zip(*found)) or [()] * (len(ids) + len(weights))
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], [*ids, *weights])

    schema = ", ".join(f"{name} long" for name in (*ids, *weights))
    return df.repartition(1).mapInArrow(run, schema)


def prefix_sums(elements: DataFrame, ids: list[str], after: list[str], weights: list[str], alone: int = ALONE) -> DataFrame:
    """(ids, weights): for every element the sums of the weights of all elements in front of it.

    `elements` has columns `ids` that name an element, `after` that name its successor (null at the end of a list) and
    `weights`, whole numbers all. Several lists may share the table. An empty table gives no rows.
    """
    columns = [*ids, *after, *weights]
    state = checkpointed(elements.select(*[F.col(name).cast("long") for name in columns]))
    records: list[DataFrame] = []
    turn = 0
    while state.count() > alone:
        turn += 1
        absorbs = _heads(ids, turn) & F.col(after[0]).isNotNull() & ~_heads(after, turn)
        absorber = state.where(absorbs).select(*[F.col(name).alias(f"by_{name}") for name in columns])
        met = state.where(~_heads(ids, turn)).join(
            absorber, [F.col(a) == F.col(f"by_{b}") for a, b in zip(ids, after)], "left"
        )
        # One row of the join becomes the absorber with its new successor and the record of the absorbed element.
        alone_row = F.struct(F.lit(False).alias("gone"), *columns)
        joined = F.struct(
            F.lit(False).alias("gone"),
            *[F.col(f"by_{name}").alias(name) for name in ids],
            *after,
            *[(F.col(name) + F.col(f"by_{name}")).alias(name) for name in weights],
        )
        record = F.struct(
            F.lit(True).alias("gone"),
            *ids,
            *[F.col(f"by_{a}").alias(b) for a, b in zip(ids, after)],
            *[F.col(f"by_{name}").alias(name) for name in weights],
        )
        rows = F.when(F.col(f"by_{ids[0]}").isNull(), F.array(alone_row)).otherwise(F.array(joined, record))
        rest = state.where(_heads(ids, turn) & ~absorbs).select(F.lit(False).alias("gone"), *columns)
        step = checkpointed(met.select(F.inline(rows)).unionByName(rest))
        state = step.where(~F.col("gone")).select(*columns)
        records.append(step.where("gone").select(*columns))
    done = checkpointed(_walked(state, ids, after, weights))
    for record in reversed(records):
        known = done.select(*[F.col(name).alias(f"by_{name}") for name in (*ids, *weights)])
        found = record.join(known, [F.col(a) == F.col(f"by_{b}") for a, b in zip(after, ids)]).select(
            *ids, *[(F.col(name) + F.col(f"by_{name}")).alias(name) for name in weights]
        )
        done = done.unionByName(checkpointed(found))
    return done
