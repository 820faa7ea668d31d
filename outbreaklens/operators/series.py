"""Per-zone time series: new cases, rolling sums, growth ratio, ages, label, date split.

Rolling frames count rows of a zone, not days; the label and the full-window test count days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outbreaklens.operators.layout import CHUNK, DATE, DAY, POSITION, ROW, ZONE, ZoneLayout, report_order, zone_layout
from outbreaklens.operators.ordered import date_at_fraction

WEEK_ROWS = 7
SMOOTH_ROWS = 3
HORIZON_DAYS = 7
TRAIN_FRACTION = 0.70
BASELINE_ROWS = 14


def _visible(df: DataFrame) -> DataFrame:
    """Without layout columns; the day number stays, so that the next step finds its rows sorted."""
    return df.drop(CHUNK, POSITION, "_prev_week")


def new_cases(layout: ZoneLayout, cumulative: str = "cumulative_confirmed_cases") -> ZoneLayout:
    """Difference to the previous row, 0 on the first row, downward revisions floored at 0."""
    c = F.col(cumulative)
    step = F.coalesce(c - F.lag(c).over(layout.rows()), F.lit(0.0))
    return layout.with_df(layout.df.withColumn("new_cases", F.greatest(step, F.lit(0.0))))


def rolling_sum(layout: ZoneLayout, out: str, rows: int = WEEK_ROWS) -> ZoneLayout:
    """Sum of new cases over the last `rows` rows, partial at the start."""
    frame = layout.rows().rowsBetween(1 - rows, 0)
    return layout.with_df(layout.df.withColumn(out, F.sum("new_cases").over(frame)))


def rolling_mean(layout: ZoneLayout, out: str, rows: int = SMOOTH_ROWS) -> ZoneLayout:
    frame = layout.rows().rowsBetween(1 - rows, 0)
    return layout.with_df(layout.df.withColumn(out, F.avg("new_cases").over(frame)))


def growth_ratio(layout: ZoneLayout, rolling: str, out: str = "rt_proxy", rows: int = WEEK_ROWS) -> ZoneLayout:
    """This week's rolling sum over the one `rows` rows earlier; NULL when that one is 0 or absent."""
    with_prev = layout.df.withColumn("_prev_week", F.lag(rolling, rows).over(layout.rows()))
    ratio = F.when(F.col("_prev_week") > 0, F.col(rolling) / F.col("_prev_week"))
    return layout.with_df(with_prev.withColumn(out, ratio))


def row_index(layout: ZoneLayout, out: str) -> ZoneLayout:
    """0-based row number in the zone."""
    index = F.col(POSITION) if layout.split else (F.row_number().over(layout.rows()) - 1).cast("bigint")
    return layout.with_df(layout.df.withColumn(out, index))


def case_series(cases: DataFrame, one_row_per_day: bool = False, **limits: int) -> DataFrame:
    """Cleaned case reports with `new_cases`, `rolling_7` and `rt_proxy`."""
    layout = zone_layout(cases, one_row_per_day, **limits)
    layout = rolling_sum(new_cases(layout), "rolling_7")
    layout = layout if one_row_per_day else row_index(layout, ROW)
    return _visible(growth_ratio(layout, "rolling_7").drop_look_back())


def anomaly_inputs(series: DataFrame, one_row_per_day: bool = False, **limits: int) -> DataFrame:
    """Case series with `day_idx`, the 3-row mean and the number of rows of the zone."""
    layout = zone_layout(series, one_row_per_day, **limits)
    layout = row_index(rolling_mean(layout, "rolling_3d_new_cases"), "day_idx")
    rows = layout.drop_look_back()
    if not layout.split:
        return _visible(rows.withColumn("zone_rows", F.count(F.lit(1)).over(Window.partitionBy(ZONE))))
    lengths = rows.groupBy(ZONE).agg(F.count(F.lit(1)).alias("zone_rows"))
    return _visible(rows.join(lengths, ZONE))


def trend_features(series: DataFrame, one_row_per_day: bool = False, **limits: int) -> DataFrame:
    """Features known on the day of each row: zone age, 7-row sum, days since the last earlier case day."""
    layout = rolling_sum(zone_layout(series, one_row_per_day, **limits), "rolling_7d_new_cases")
    case_day = F.when((F.col("new_cases") > 0) & ~layout.looked_back(), F.col(DAY))
    earlier = layout.rows().rowsBetween(Window.unboundedPreceding, -1)
    df = layout.df.withColumn("_last_case", F.last(case_day, ignorenulls=True).over(earlier))
    if layout.split:
        df = layout.with_df(df).drop_look_back()
        chunks = df.groupBy(ZONE, CHUNK).agg(
            F.max(F.when(F.col("new_cases") > 0, F.col(DAY))).alias("_m"), F.min(DAY).alias("_d")
        )
        past = Window.partitionBy(ZONE).orderBy(CHUNK)
        carried = chunks.select(
            ZONE,
            CHUNK,
            F.max("_m").over(past.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"),
            F.min("_d").over(Window.partitionBy(ZONE)).alias("_first"),
        )
        df = df.join(carried, [ZONE, CHUNK]).withColumn("_last_case", F.coalesce("_last_case", "_carried"))
    else:
        df = df.withColumn("_first", F.min(DAY).over(Window.partitionBy(ZONE)))
    age = F.col(DAY) - F.col("_first")
    return _visible(
        df.withColumn("days_since_first_case", age)
        .withColumn("days_since_last_case", F.coalesce(F.col(DAY) - F.col("_last_case"), age))
        .drop("_last_case", "_first", "_carried")
    )


def onset_label(
    series: DataFrame, one_row_per_day: bool = False, horizon: int = HORIZON_DAYS, **limits: int
) -> DataFrame:
    """Whether the zone reports a new case in the next `horizon` days, and whether its data reach that far."""
    layout = zone_layout(series, one_row_per_day, **limits)
    ahead = Window.partitionBy(ZONE).orderBy(DAY).rangeBetween(1, horizon)
    rows, cases = layout.drop_look_back(), F.col("new_cases")
    if layout.split:
        # The label depends on zone and day only: sum the rows of a day before shuffling them.
        rows = rows.drop(CHUNK, POSITION)
        days = rows.groupBy(ZONE, DAY).agg(F.sum("new_cases").alias("_cases"))
        outlook = days.select(ZONE, DAY, *_outlook(F.col("_cases"), ahead, horizon))
        return _visible(rows.join(outlook, [ZONE, DAY]))
    return _visible(rows.select("*", *_outlook(cases, ahead, horizon)))


def _outlook(cases: Column, ahead, horizon: int) -> list[Column]:
    onset = F.coalesce(F.sum(cases).over(ahead), F.lit(0.0)) > 0
    last_day = F.max(DAY).over(Window.partitionBy(ZONE))
    return [
        onset.cast("int").alias("label_next_7d_onset"),
        (last_day >= F.col(DAY) + horizon).alias("has_full_future_window"),
    ]


def split_by_date(model_rows: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Add `is_train`: rows dated before the date found at `fraction` of the date-sorted rows."""
    cutoff = date_at_fraction(model_rows, DATE, fraction)
    return model_rows.withColumn("is_train", F.col(DATE) < cutoff.scalar())


def full_window_cutoff(series: DataFrame, fraction: float = TRAIN_FRACTION, horizon: int = HORIZON_DAYS) -> DataFrame:
    """The split date of the rows with a full future window, from zones and dates alone, as one row."""
    ends = series.groupBy(ZONE).agg(F.max(DATE).alias("_last"))
    rows = series.select(ZONE, DATE).join(ends, ZONE).where(F.col("_last") >= F.date_add(DATE, horizon))
    return date_at_fraction(rows, DATE, fraction)


def latest_trend(series: DataFrame, fallback: Column) -> DataFrame:
    """Serving features per zone at its latest row; here the current row counts as a case day.

    `fallback` is the growth ratio to use where the latest row has none. One aggregation per zone
    with partial results on the map side; no window. Of several rows on the latest day the last one counts.
    """
    order = report_order(series.columns)
    case_date = F.when(F.col("new_cases") > 0, F.col(DATE))
    since = F.datediff(F.max(DATE), F.coalesce(F.max(case_date), F.min(DATE)))
    return series.groupBy(ZONE).agg(
        F.max_by("rolling_7", order).alias("rolling_7d_new_cases"),
        since.cast("bigint").alias("days_since_last_case"),
        F.max_by("rt_proxy", order).alias("_rt"),
    ).select(
        ZONE, "rolling_7d_new_cases", "days_since_last_case", F.coalesce("_rt", fallback).alias("rt_proxy")
    )
