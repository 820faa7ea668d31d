"""Global order statistics without a one-task sort of the data.

Rows are first grouped by the ordered value. Running totals over the groups use one window while the
groups are few, and range partitions with per-partition offsets beyond that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outbreaklens.session import checkpointed, shuffle_partitions

SINGLE_WINDOW_ROWS = 1_000_000


def running_totals(
    groups: DataFrame, order: list[Column], sums: list[str], single_window_rows: int = SINGLE_WINDOW_ROWS
) -> tuple[DataFrame, dict[str, int]]:
    """`groups` with `cum_<s>` for every column in `sums`, and the grand totals.

    `groups` holds one row per order key.
    """
    stored = checkpointed(groups)
    counted = stored.agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(s).alias(s) for s in sums]).first()
    totals = {s: counted[s] or 0 for s in sums}
    upto = (Window.unboundedPreceding, Window.currentRow)
    if counted["_rows"] <= single_window_rows:
        everything = Window.orderBy(*order).rowsBetween(*upto)
        return stored.select("*", *[F.sum(s).over(everything).alias(f"cum_{s}") for s in sums]), totals
    parts = checkpointed(
        stored.repartitionByRange(shuffle_partitions(groups.sparkSession), *order)
        .withColumn("_part", F.spark_partition_id())
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition, so the single window and the broadcast are bounded.
    offsets = parts.groupBy("_part").agg(*[F.sum(s).alias(s) for s in sums]).select(
        "_part", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_off_{s}") for s in sums]
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(*upto)
    local = parts.select("*", *[F.sum(s).over(inside).alias(f"_in_{s}") for s in sums])
    joined = local.join(F.broadcast(offsets), "_part").select(
        *groups.columns, *[(F.col(f"_in_{s}") + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums]
    )
    return joined, totals


def _ranked_values(df: DataFrame, column: str, weight: str | None) -> tuple[DataFrame, int]:
    size = F.sum(weight) if weight else F.count(F.lit(1))
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(size.alias("n"))
    ranked, totals = running_totals(values, [F.col("v")], ["n"])
    return ranked, totals["n"]


def _value_at(index: int) -> Column:
    """The value at a 0-based index of the sorted values."""
    return F.min(F.when(F.col("cum_n") > index, F.col("v")))


def median(df: DataFrame, column: str, out: str = "median", weight: str | None = None) -> DataFrame:
    """Exact median (mean of the two middle values) as one row; NULL when there is no value.

    With `weight`, each row stands for that many equal rows.
    """
    ranked, n = _ranked_values(df, column, weight)
    return ranked.agg(((_value_at((n - 1) // 2) + _value_at(n // 2)) / 2).alias(out))


def upper_median(df: DataFrame, column: str, out: str = "upper_median") -> DataFrame:
    """The value at index n // 2 of the sorted values, as one row."""
    ranked, n = _ranked_values(df, column, None)
    return ranked.agg(_value_at(n // 2).alias(out))


def date_at_fraction(df: DataFrame, date: str, fraction: float) -> DataFrame:
    """The date at index int(n * fraction) of the date-sorted rows, as one row.

    Counts per date come first, so the window runs over calendar days. The product is taken in
    binary floating point: a decimal fraction picks another row for some n.
    """
    days = df.groupBy(date).agg(F.count(F.lit(1)).alias("n"))
    running = days.select(
        date,
        F.sum("n").over(Window.orderBy(date).rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    index = F.floor(F.col("total").cast("double") * F.lit(float(fraction)))
    return running.where(F.col("cum") > index).agg(F.min(date).alias("cutoff_date"))
