"""The batch steps, from raw reports to cleaned, labelled and scored zone-day tables.

`one_row_per_day` states that a zone has at most one case row per day after cleaning. Without it the
series steps count rows per zone and cut long zones into chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outbreaklens.operators import anomaly, cleaning, series, star
from outbreaklens.session import checkpointed


def case_series(cases: DataFrame, aliases: DataFrame, one_row_per_day: bool = False) -> DataFrame:
    """Cleaned cases with new cases and growth ratio."""
    return series.case_series(cleaning.clean_cases(cases, aliases), one_row_per_day)


def cleaned(cases: DataFrame, deaths: DataFrame, aliases: DataFrame, one_row_per_day: bool = False) -> DataFrame:
    """Case series with the deaths of the same zone and day."""
    rows = case_series(cases, aliases, one_row_per_day)
    return star.with_deaths(rows, cleaning.clean_deaths(deaths, aliases))


def featured(cases: DataFrame, one_row_per_day: bool = False) -> DataFrame:
    """Trend features, label and full-window flag for every row of a case series."""
    return series.onset_label(series.trend_features(cases, one_row_per_day), one_row_per_day)


def labelled(cases: DataFrame, zones: DataFrame, one_row_per_day: bool = False) -> DataFrame:
    """The modelling table: rows of a case series with a full future window, with imputed density.

    The density joins last, so the windows run on rows that are still sorted; its median is that of
    all rows.
    """
    rows = featured(cases, one_row_per_day).where("has_full_future_window")
    return star.with_density(rows, zones, all_rows=cases)


def scored(cases: DataFrame, one_row_per_day: bool = False, min_rows: int = anomaly.MIN_ROWS) -> DataFrame:
    """Anomaly scores of every row of the usable zones of a case series."""
    # Stored, as the feature pairs and the scoring both read the rows.
    return score(checkpointed(series.anomaly_inputs(cases, one_row_per_day)), min_rows)


def score(inputs: DataFrame, min_rows: int = anomaly.MIN_ROWS) -> DataFrame:
    """Scores for stored anomaly inputs."""
    rows = anomaly.usable_zones(inputs, min_rows)
    pairs = anomaly.feature_pairs(rows, anomaly.is_baseline())
    return anomaly.anomaly_score(rows, anomaly.fit_one_class(pairs), pairs)


def latest_scores(inputs: DataFrame, one_row_per_day: bool = False, min_rows: int = anomaly.MIN_ROWS) -> DataFrame:
    """Scores of the latest rows of every usable zone of stored anomaly inputs: (nom, date, anomaly_score).

    The model is fitted on all zones; only the latest rows are scored.
    """
    rows = anomaly.usable_zones(inputs, min_rows)
    model = anomaly.fit_one_class(anomaly.feature_pairs(rows, anomaly.is_baseline()))
    facts = rows.select(F.col("nom_clean").alias("nom"), "date", *anomaly.FEATURES)
    latest = checkpointed(star.latest_rows(facts, one_row_per_day))
    return anomaly.anomaly_score(latest, model, latest.select(*anomaly.FEATURES).distinct()).select(
        "nom", "date", "anomaly_score"
    )


def national(cases: DataFrame, deaths: DataFrame, aliases: DataFrame) -> DataFrame:
    """National series out of the zone reports: sums per date."""

    def per_date(rows: DataFrame, column: str) -> DataFrame:
        return rows.groupBy("date").agg(F.sum(column).alias(f"national_{column}"))

    return star.national_table(
        per_date(cleaning.clean_cases(cases, aliases), cleaning.CASES),
        per_date(cleaning.clean_deaths(deaths, aliases), cleaning.DEATHS),
    )
