"""Joins of the star schema: national table, deaths, density, latest state of a zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outbreaklens.operators.cleaning import DEATHS, ENTRY, last_entry
from outbreaklens.operators.layout import report_order
from outbreaklens.operators.ordered import median


def national_table(cases: DataFrame, deaths: DataFrame) -> DataFrame:
    """Full outer join of the two national series on date."""
    return cases.join(deaths.select("date", "national_cumulative_confirmed_deaths"), "date", "full")


def with_cfr(national: DataFrame) -> DataFrame:
    """Deaths per hundred cases; NULL where there are no cases."""
    ratio = F.try_divide("national_cumulative_confirmed_deaths", "national_cumulative_confirmed_cases")
    return national.withColumn("cfr", ratio * 100)


def with_deaths(series: DataFrame, deaths: DataFrame) -> DataFrame:
    """Deaths of the same zone and day; several death rows for one key give several rows."""
    return series.join(deaths.select("nom_clean", "date", DEATHS), ["nom_clean", "date"], "left")


def known_density(zones: DataFrame) -> DataFrame:
    return last_entry(zones, "nom", "population_density").withColumnRenamed("nom", "nom_clean")


def median_density(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """Row-weighted median density: rows are counted per zone before they meet the zone table."""
    per_zone = rows.groupBy("nom_clean").agg(F.count(F.lit(1)).alias("rows"))
    return median(per_zone.join(known_density(zones), "nom_clean"), "population_density", weight="rows")


def with_density(rows: DataFrame, zones: DataFrame, all_rows: DataFrame | None = None) -> DataFrame:
    """Population density per row, a flag where it was missing, and the row-weighted median in its place.

    The median is that of `all_rows` when `rows` is a part of them. When every row lacks the density
    it is 0.
    """
    middle = median_density(rows if all_rows is None else all_rows, zones).scalar()
    joined = rows.join(known_density(zones), "nom_clean", "left")
    return joined.withColumn(
        "population_density_was_missing", F.col("population_density").isNull().cast("int")
    ).withColumn("population_density", F.coalesce("population_density", middle, F.lit(0.0)))


def health_zones(features: DataFrame, entry: bool = False) -> DataFrame:
    """Zone dimension out of exploded GeoJSON features; absent paths give NULL.

    With `entry`, the place of each feature comes along, so that of repeated zones the last one holds.
    """
    p = "properties."
    return features.select(
        F.col(p + "nom").alias("nom"),
        F.col(p + "province").alias("province"),
        F.col(p + "worldpop.pop_density.pop_density").alias("population_density"),
        F.col(p + "grid3_healthsites.healthsite_density.healthsite_density").alias("healthsite_density"),
        F.col(p + "gdp_pc.gdp_pc.gdp_pc").alias("gdp_per_capita"),
        *([ENTRY] if entry else []),
    )


def daily_cases(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        F.col("nom_clean").alias("nom"), "date", "cumulative_confirmed_cases", "new_cases", "rt_proxy", DEATHS
    )


def anomaly_scores(scored: DataFrame) -> DataFrame:
    return scored.select(F.col("nom_clean").alias("nom"), "date", "anomaly_score")


def latest_rows(fact: DataFrame, one_row_per_day: bool = False) -> DataFrame:
    """Rows of each zone at its latest date.

    With one row per zone and day a single hash aggregation finds them. Otherwise the latest date
    per zone is joined back, which keeps all rows of that date.
    """
    if one_row_per_day:
        others = [F.max_by(c, "date").alias(c) for c in fact.columns if c not in ("nom", "date")]
        return fact.groupBy("nom").agg(F.max("date").alias("date"), *others).select(*fact.columns)
    latest = fact.groupBy("nom").agg(F.max("date").alias("date"))
    return fact.join(latest, ["nom", "date"], "left_semi")


def on_latest_date(df: DataFrame) -> DataFrame:
    """Rows on the latest date of the whole table."""
    return df.where(F.col("date") == df.agg(F.max("date")).scalar())


def zone_state(zones: DataFrame, fact: DataFrame) -> DataFrame:
    """Every official zone with its latest cumulative count and age; zones without reports stay.

    One aggregation per zone gives first date, latest date and latest count together; of several reports on the
    latest day the last one counts.
    """
    state = fact.groupBy("nom").agg(
        F.max_by("cumulative_confirmed_cases", report_order(fact.columns)).alias("latest"),
        F.datediff(F.max("date"), F.min("date")).alias("age"),
    )
    return zones.join(state, "nom", "left").select(
        "nom",
        "province",
        "population_density",
        F.col("age").isNotNull().alias("has_case_data"),
        F.coalesce("latest", F.lit(0.0)).alias("cumulative_confirmed_cases"),
        F.coalesce("age", F.lit(0)).cast("bigint").alias("days_since_first_case"),
    )


def only_new(manifest: DataFrame, stored: DataFrame, key: str = "name") -> DataFrame:
    """Manifest entries that are not stored yet."""
    return manifest.join(stored.select(key), key, "left_anti")
