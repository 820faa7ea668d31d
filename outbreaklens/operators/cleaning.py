"""Repair of raw situation reports: names, counts, dates, official-list check, cleaning report.

"Not reported" stays missing everywhere; nothing is filled with 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outbreaklens.functions.text import clean_date_text, date_or_error, is_number, strip, to_number
from outbreaklens.session import checkpointed

CASES = "cumulative_confirmed_cases"
DEATHS = "cumulative_confirmed_deaths"
ENTRY = "_entry"  # place of an entry in its files, which the readers carry from the scan


def drop_unattributed(reports: DataFrame) -> DataFrame:
    """Rows without a zone name cannot be assigned to a zone."""
    return reports.where(F.col("nom").isNotNull())


def last_entry(table: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key; of several entries the last one of the files holds.

    The readers carry the place of an entry in its files. A table without it, one made in memory, counts in the
    order of its rows.
    """
    known = table.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    place = F.col(ENTRY) if ENTRY in table.columns else F.monotonically_increasing_id()
    return known.select(key, value, place.alias("_place")).groupBy(key).agg(F.max_by(value, "_place").alias(value))


def clean_zone_names(reports: DataFrame, aliases: DataFrame) -> DataFrame:
    """Add `nom_clean`: the stripped name, or its canonical form where the alias table has one.

    No broadcast hint: the planner broadcasts the alias side when its size allows, and splits a
    skewed name otherwise.
    """
    lookup = last_entry(aliases, "observed_name", "canonical_nom")
    named = reports.withColumn("_stripped", strip(F.col("nom")))
    joined = named.join(lookup, F.col("_stripped") == F.col("observed_name"), "left")
    return joined.withColumn("nom_clean", F.coalesce("canonical_nom", "_stripped")).drop(
        "_stripped", "observed_name", "canonical_nom"
    )


def coerce_counts(reports: DataFrame, column: str) -> DataFrame:
    return reports.withColumn(column, to_number(F.col(column)))


def parsed_date(c: Column, strict: bool = True) -> Column:
    """Date of a date text; a text that is no date raises, or gives NULL when not strict.

    A text that is a date as it stands is not repaired first: the repair strips its ends only.
    """
    repaired = clean_date_text(c)
    if strict:
        return date_or_error(c, repaired)
    return F.coalesce(c.try_cast("date"), repaired.try_cast("date"))


def clean_dates(reports: DataFrame, strict: bool = True) -> DataFrame:
    return reports.withColumn("date", parsed_date(F.col("date"), strict))


def clean_cases(reports: DataFrame, aliases: DataFrame, strict: bool = True) -> DataFrame:
    """Attributed rows with a canonical name, a numeric count and a date.

    The pattern test filters the raw rows, in front of the join, and the cast follows on what is left.
    """
    kept = drop_unattributed(reports).where(is_number(F.col(CASES)))
    named = clean_zone_names(kept, aliases)
    return clean_dates(named.withColumn(CASES, strip(F.col(CASES)).try_cast("double")), strict)


def clean_deaths(reports: DataFrame, aliases: DataFrame, strict: bool = True) -> DataFrame:
    """As for cases, but rows with a missing number of deaths stay."""
    named = clean_zone_names(drop_unattributed(reports), aliases)
    return clean_dates(coerce_counts(named, DEATHS), strict)


def with_reason(reports: DataFrame, column: str) -> DataFrame:
    """Raw reports with `reason`: why a row cannot enter the series, or NULL for those that can.

    The first that holds of: no name, no number, no date. Deaths may lack a number, as `clean_deaths` keeps those rows.
    """
    number = is_number(F.col(column)) if column == CASES else F.lit(True)
    date = parsed_date(F.col("date"), strict=False)
    return reports.withColumn(
        "reason",
        F.when(F.col("nom").isNull(), F.lit("no name"))
        .when(~F.coalesce(number, F.lit(False)), F.lit("no number"))
        .when(date.isNull(), F.lit("no date")),
    )


def accepted(reports: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Raw reports that can enter the series, and the rejected ones as they came, with the reason.

    Cleaned with `strict=False`, the accepted rows hold no NULL date, so none reaches a window.
    """
    told = with_reason(reports, column)
    return told.where("reason IS NULL").drop("reason"), told.where("reason IS NOT NULL")


def unmatched_zones(clean: DataFrame, official: DataFrame) -> DataFrame:
    """Reported zones that the official list does not hold."""
    return clean.select("nom_clean").distinct().join(
        official.select(F.col("nom").alias("nom_clean")), "nom_clean", "left_anti"
    )


def duplicate_days(clean: DataFrame) -> DataFrame:
    """Zone-days with more than one row, as an alias may merge two spellings; a quality figure."""
    per_day = clean.groupBy("nom_clean", "date").agg(F.count(F.lit(1)).alias("n_rows"))
    return per_day.where("n_rows > 1")


def _tally(reports: DataFrame, column: str) -> DataFrame:
    """Rows per raw name, with whether the count is a number and whether the date needed repair.

    All counts of the report follow from this small table, so the raw rows are shuffled as partial
    counts only, however many of them share a name or have none.
    """
    dirty = F.coalesce(F.col("date") != clean_date_text(F.col("date")), F.lit(False))
    return reports.groupBy(
        "nom", to_number(F.col(column)).isNotNull().alias("reported"), dirty.alias("dirty_date")
    ).agg(F.count(F.lit(1)).alias("n"))


def _rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def cleaning_report(cases: DataFrame, deaths: DataFrame, aliases: DataFrame, official: DataFrame) -> DataFrame:
    """All counts of the cleaning steps in one row; one pass over each report table.

    The tally of the case reports is small and stored, as two results are read from it.
    """
    attributed, reported = F.col("nom").isNotNull(), F.col("reported")
    case_tally = checkpointed(clean_zone_names(_tally(cases, CASES), aliases))
    case_counts = case_tally.agg(
        _rows_where(F.lit(True)).alias("case_rows"),
        _rows_where(~attributed).alias("case_rows_without_zone"),
        F.countDistinct("nom").alias("zone_names_raw"),
        _rows_where(F.col("nom") != F.col("nom_clean")).alias("names_changed"),
        F.countDistinct("nom_clean").alias("zone_names_clean"),
        _rows_where(attributed & ~reported).alias("case_counts_missing"),
        _rows_where(attributed & reported & F.col("dirty_date")).alias("case_dates_cleaned"),
    )
    death_counts = _tally(deaths, DEATHS).agg(
        _rows_where(F.lit(True)).alias("death_rows"),
        _rows_where(~attributed).alias("death_rows_without_zone"),
        _rows_where(attributed & ~reported).alias("death_counts_missing"),
        _rows_where(attributed & F.col("dirty_date")).alias("death_dates_cleaned"),
    )
    official_count = official.agg(F.countDistinct("nom").alias("n"))
    unmatched = unmatched_zones(case_tally.where(attributed & reported), official).agg(F.count(F.lit(1)).alias("n"))
    deaths_once = death_counts.select(F.struct("*")).scalar()
    return case_counts.select(
        "*",
        *[deaths_once[c].alias(c) for c in death_counts.columns],
        official_count.scalar().alias("official_zones"),
        unmatched.scalar().alias("unmatched_zones"),
    )
