"""Read queries over the star tables, as parameterised DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outbreaklens.functions.display import SCORE_FLOOR, bar_percent, score_tier
from outbreaklens.functions.text import most_severe
from outbreaklens.operators.bulletins import latest
from outbreaklens.operators.series import BASELINE_ROWS
from outbreaklens.operators.star import latest_rows, on_latest_date, with_cfr

# The watched provinces and the limits of the ranking.
CROSS_BORDER_PROVINCES = ("Nord-Kivu", "Sud-Kivu")
DEFAULT_LIMIT, MAX_LIMIT = 20, 200


def _by_score() -> list:
    return [F.desc("anomaly_score"), F.asc("nom")]


def early_warning(
    scores: DataFrame,
    zones: DataFrame,
    limit: int = DEFAULT_LIMIT,
    cross_border_only: bool = False,
    provinces: tuple[str, ...] = CROSS_BORDER_PROVINCES,
    one_row_per_day: bool = False,
) -> DataFrame:
    """Latest score per zone, highest first, with a 1-based rank over the returned rows."""
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must lie between 1 and {MAX_LIMIT}")
    latest = latest_rows(scores.select("nom", "date", "anomaly_score"), one_row_per_day)
    joined = latest.join(zones.select("nom", "province"), "nom")
    watch = F.coalesce(F.col("province").isin(*provinces), F.lit(False))
    if cross_border_only:
        joined = joined.where(watch)
    top = joined.orderBy(*_by_score(), "date").limit(limit)
    # The rank runs over the limited rows only: at most MAX_LIMIT of them reach one task.
    rank = F.row_number().over(Window.orderBy(*_by_score(), "date"))
    return top.select(
        F.col("nom").alias("zone"),
        "province",
        watch.alias("cross_border_watch"),
        "date",
        F.round("anomaly_score", 4).alias("anomaly_score"),
        rank.cast("bigint").alias("rank"),
    )


def ranking_header(ranking: DataFrame) -> DataFrame:
    """Date and size of the returned rows."""
    return ranking.agg(F.max("date").alias("generated_from_date"), F.count(F.lit(1)).alias("zone_count"))


def _with_top_score(ranking: DataFrame) -> DataFrame:
    top = F.greatest(F.max("anomaly_score").over(Window.partitionBy()), F.lit(SCORE_FLOOR))
    return ranking.withColumn("max_score", top)


def watchlist_chips(ranking: DataFrame) -> DataFrame:
    """Cross-border zones of a ranking with the tier of their score."""
    tiered = _with_top_score(ranking)
    return tiered.where("cross_border_watch").select(
        "zone", "province", "rank", "anomaly_score", score_tier(F.col("anomaly_score"), F.col("max_score")).alias("tier")
    )


def ranking_page(ranking: DataFrame, rows: int = 15, cross_border_only: bool = False) -> DataFrame:
    """The first rows of a ranking, renumbered, with bar length and tier."""
    tiered = _with_top_score(ranking)
    if cross_border_only:
        tiered = tiered.where("cross_border_watch")
    shown = tiered.orderBy("rank").limit(rows)
    return shown.select(
        F.row_number().over(Window.orderBy("rank")).cast("bigint").alias("row"),
        "zone",
        "cross_border_watch",
        "anomaly_score",
        bar_percent(F.col("anomaly_score"), F.col("max_score")).alias("bar_percent"),
        score_tier(F.col("anomaly_score"), F.col("max_score")).alias("tier"),
    )


def latest_picture(zones: DataFrame, cases: DataFrame, scores: DataFrame, limit: int = 10) -> DataFrame:
    """Zones, cases and scores on the latest case date, highest score first."""
    latest = F.col("date") == cases.agg(F.max("date")).scalar()
    joined = cases.where(latest).join(scores.where(latest), ["nom", "date"]).join(zones, "nom")
    return joined.select(
        "nom",
        "province",
        "population_density",
        "healthsite_density",
        "date",
        "cumulative_confirmed_cases",
        "new_cases",
        "rt_proxy",
        "anomaly_score",
    ).orderBy(*_by_score()).limit(limit)


def watchlist_history(
    zones: DataFrame,
    cases: DataFrame,
    scores: DataFrame,
    provinces: tuple[str, ...] = CROSS_BORDER_PROVINCES,
    limit: int = 10,
) -> DataFrame:
    """Case history of the watched provinces, most recent day first."""
    watched = zones.where(F.col("province").isin(*provinces)).select("nom", "province")
    joined = cases.join(watched, "nom").join(scores, ["nom", "date"])
    return (
        joined.select("nom", "province", "date", "new_cases", "rt_proxy", "anomaly_score")
        .orderBy(F.desc("date"), *_by_score())
        .limit(limit)
    )


def zone_history(cases: DataFrame, zone: str) -> DataFrame:
    """Reports of one zone by date; no rows when the zone is unknown."""
    return cases.where(F.col("nom") == zone).orderBy("date")


def zone_prediction(predictions: DataFrame, zone: str) -> DataFrame:
    """The record of one zone out of the batch of predictions; no rows when the zone is unknown."""
    return predictions.where(F.col("nom") == zone)


def epidemic_curve(national: DataFrame) -> DataFrame:
    return national.select("date", "national_cumulative_confirmed_cases").orderBy("date")


def cfr_trend(national: DataFrame) -> DataFrame:
    return with_cfr(national).select("date", "cfr").orderBy("date")


def top_zones(series: DataFrame, limit: int = 15) -> DataFrame:
    """Zones with the most cumulative cases on the latest date."""
    return (
        on_latest_date(series)
        .select("nom_clean", "cumulative_confirmed_cases")
        .orderBy(F.desc("cumulative_confirmed_cases"), "nom_clean")
        .limit(limit)
    )


def trending_up(series: DataFrame) -> DataFrame:
    """Number of zones whose growth ratio exceeds 1 on the latest date."""
    return on_latest_date(series).where("rt_proxy > 1").agg(F.countDistinct("nom_clean").alias("zones_trending_up"))


def longest_zone(rows: DataFrame) -> DataFrame:
    """The zone with the most rows, first by name on ties."""
    counts = rows.groupBy("nom_clean").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), "nom_clean").limit(1)


def zone_timeline(scored: DataFrame, baseline: int = BASELINE_ROWS) -> DataFrame:
    """Timeline of the longest zone with the date its baseline ends."""
    example = longest_zone(scored).select("nom_clean").scalar()
    rows = scored.where(F.col("nom_clean") == example)
    marker = rows.where(F.col("day_idx") == baseline).agg(F.min("date")).scalar()
    return rows.select(
        "nom_clean", "date", "new_cases", "anomaly_score", marker.alias("baseline_ends")
    ).orderBy("date")


def briefing(records: DataFrame, count: Column | None = None) -> DataFrame:
    """The latest extraction record with its most severe paragraph and the number of bulletins.

    `count` is that number when `records` holds a part of them only.
    """
    count = records.agg(F.count(F.lit(1))).scalar() if count is None else count
    return latest(records).select(
        "*",
        most_severe(F.col("paragraph_severity")).alias("most_severe_paragraph"),
        count.alias("bulletin_count"),
    )
