"""How the rows of one zone are laid out for window functions.

A zone that reports at most one row per day holds at most one row per calendar day, so a plain window
partition is small. A table without that property may put a large share of its rows under one zone.
`zone_layout` counts rows per zone in that case and, when one zone is too long for one task, cuts the
zones into chunks of consecutive rows. Each chunk starts with copies of the rows its frames look back
on, so bounded row frames give the same values as over the whole zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from outbreaklens.session import checkpointed, shuffle_partitions

ZONE = "nom_clean"
DATE = "date"
DAY = "day_number"  # the date as an integer: row and day frames can then share one sort
ROW = "zone_row"  # row number in the zone, kept by the first step so that later steps see the same order
CHUNK = "_chunk"
POSITION = "_pos"

CASE_TIES = ("nom", "cumulative_confirmed_cases")  # order of the rows of one zone and day
COPY_TIES = ("cumulative_confirmed_deaths",)

LOOK_BACK = 14  # seven rows of lag, over sums of seven rows of differences
MAX_ZONE_ROWS = 2_000_000
CHUNK_ROWS = 500_000


@dataclass(frozen=True)
class ZoneLayout:
    df: DataFrame
    order: tuple[str, ...]
    split: bool
    chunk_rows: int = CHUNK_ROWS

    @property
    def keys(self) -> list[str]:
        return [ZONE, CHUNK] if self.split else [ZONE]

    def rows(self) -> WindowSpec:
        """Rows of a zone in report order."""
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def looked_back(self) -> Column:
        """True for the copies in front of a chunk."""
        return F.col(POSITION) < F.col(CHUNK) * F.lit(self.chunk_rows) if self.split else F.lit(False)

    def with_df(self, df: DataFrame) -> "ZoneLayout":
        return ZoneLayout(df, self.order, self.split, self.chunk_rows)

    def drop_look_back(self) -> DataFrame:
        return self.df.where(~self.looked_back()) if self.split else self.df


def zone_layout(
    df: DataFrame,
    one_row_per_day: bool = False,
    max_zone_rows: int = MAX_ZONE_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> ZoneLayout:
    """Lay out `df` by zone and day; several rows of one day keep the order of the first step."""
    # Copies of a row that a join with several death rows made share its number.
    numbered = (ROW, *[c for c in COPY_TIES if c in df.columns])
    ties = () if one_row_per_day else numbered if ROW in df.columns else CASE_TIES
    dated = df if DAY in df.columns else df.withColumn(DAY, F.unix_date(DATE))
    whole = ZoneLayout(dated, (DAY, *ties), split=False)
    if one_row_per_day:
        return whole
    longest = df.groupBy(ZONE).count().agg(F.max("count")).first()[0] or 0
    if longest <= max_zone_rows:
        return whole
    return ZoneLayout(_chunked(dated, ties, chunk_rows), (POSITION,), split=True, chunk_rows=chunk_rows)


def report_order(columns: list[str]) -> Column:
    """Order of a zone's reports: by date, and on one day by the row number or else by the count."""
    return F.struct(DATE, ROW if ROW in columns else CASE_TIES[-1])


def _chunked(df: DataFrame, ties: tuple[str, ...], chunk_rows: int) -> DataFrame:
    """Rows with their exact position in the zone, spread over chunks of `chunk_rows` positions.

    Equal rows are folded into one row with a count before anything is shuffled, so a zone made of
    copies shrinks first, and every remaining row has its own sort key: a range partitioning can cut
    a zone anywhere. Partition numbers are stored by a checkpoint, as the position depends on them.
    """
    columns = df.columns
    keys = [ZONE, DAY, *ties, *[c for c in columns if c not in (ZONE, DAY, *ties)]]
    runs = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    ranged = checkpointed(
        runs.repartitionByRange(shuffle_partitions(df.sparkSession), *keys)
        .withColumn("_part", F.spark_partition_id())
    )

    before = Window.partitionBy(ZONE).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part", ZONE).agg(F.sum("_copies").alias("_n")).select(
        "_part", ZONE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_part", ZONE).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(
        offsets, ["_part", ZONE]
    )

    size = F.lit(chunk_rows)
    first = F.col("_offset") + F.col("_before")
    last = first + F.col("_copies") - 1
    pieces = (
        placed.withColumn("_first", first)
        .withColumn("_last", last)
        .withColumn(CHUNK, F.explode(F.sequence(F.floor(first / size), F.floor((last + LOOK_BACK) / size))))
        .repartition(ZONE, CHUNK)
    )
    begin = F.greatest(F.col("_first"), F.col(CHUNK) * size - LOOK_BACK)
    end = F.least(F.col("_last"), (F.col(CHUNK) + 1) * size - 1)
    return pieces.withColumn(POSITION, F.explode(F.sequence(begin, end))).select(*columns, CHUNK, POSITION)
