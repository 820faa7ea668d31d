"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outbreaklens.session import checkpointed


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each vertex (the larger ones, or the smaller ones and itself) on its least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both if large else both.where("b < a")
    least = seen.groupBy("a").agg(F.least("a", F.min("b")).alias("top"))
    hung = seen.join(least, "a")
    if large:
        hung = hung.where("b > a").select(F.col("b").alias("a"), F.col("top").alias("b"))
    else:
        hung = hung.select(F.col("b").alias("a"), F.col("top").alias("b")).unionByName(
            least.select("a", F.col("top").alias("b"))
        )
    return hung.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(vertex, component) for the vertices of links (a, b), numbers both; the component is its least vertex.

    Links are made distinct and loops dropped. Each round is stored, so that no lost executor undoes it, and
    the rounds go on until the links no longer change.
    """
    state, before = checkpointed(links.where("a <> b").select("a", "b").distinct()), None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return state.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
                state.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
            )
        before, state = mark, checkpointed(_star(_star(state, True), False))
