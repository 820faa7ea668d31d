import datetime as dt

import pytest
from pyspark.sql import functions as F

from outbreaklens.functions import text as t
from outbreaklens.operators import cleaning

CASE_SCHEMA = "nom string, date string, cumulative_confirmed_cases string"


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "c string").select(expression(F.col("c"))).first()[0]


@pytest.mark.parametrize("text", ["Bunia", " Bunia ", " Bunia ", "\t\nBunia\x1f", "　 Bu nia \x85", ""])
def test_strip_is_python_strip(spark, text):
    assert one(spark, t.strip, text) == text.strip()


@pytest.mark.parametrize(
    "text, number",
    [
        ("17", 17.0), (" 17 ", 17.0), ("1e3", 1000.0), ("-4.5", -4.5), (".5", 0.5), ("5.", 5.0), ("+3", 3.0),
        ("ND", None), ("17-", None), ("17d", None), ("17f", None), ("", None), ("1,000", None), ("1 7", None), (None, None),
    ],
)
def test_to_number(spark, text, number):
    assert one(spark, t.to_number, text) == number


@pytest.mark.parametrize(
    "text, clean",
    [
        ("2026-06-25]", "2026-06-25"), ("[2026-06-25]", "2026-06-25"), (" 2026-06-25 ] ", "2026-06-25"),
        ("[[2026-06-25]]", "2026-06-25"), ("2026-06-25", "2026-06-25"), ("][2026-06-25", "2026-06-25"),
    ],
)
def test_clean_date_text(spark, text, clean):
    assert one(spark, t.clean_date_text, text) == clean


def test_strict_dates_raise_and_lenient_dates_are_null(spark):
    bad = spark.createDataFrame([("A", "no date", "1")], CASE_SCHEMA)
    with pytest.raises(Exception, match="not a date"):
        cleaning.clean_dates(bad).collect()
    assert cleaning.clean_dates(bad, strict=False).first()["date"] is None


def test_names_aliases_and_missing_counts(spark):
    reports = spark.createDataFrame(
        [
            (None, "2026-06-01", "9"),
            (" Rwmapara ", "2026-06-01", "1"),
            ("Rwampara", "2026-06-02", "ND"),
            ("Bunia", "[2026-06-03]", "17-"),
            ("Bunia", "2026-06-04", "18"),
        ],
        CASE_SCHEMA,
    )
    aliases = spark.createDataFrame(
        [("Rwmapara", "Wrong"), ("Rwmapara", "Rwampara"), (None, "X")], "observed_name string, canonical_nom string"
    ).coalesce(1)
    rows = cleaning.clean_cases(reports, aliases).orderBy("date").collect()
    assert [(r["nom_clean"], r["date"], r["cumulative_confirmed_cases"]) for r in rows] == [
        ("Rwampara", dt.date(2026, 6, 1), 1.0),
        ("Bunia", dt.date(2026, 6, 4), 18.0),
    ]
    deaths = reports.withColumnRenamed("cumulative_confirmed_cases", "cumulative_confirmed_deaths")
    kept = cleaning.clean_deaths(deaths, aliases).collect()
    assert len(kept) == 4 and sum(r["cumulative_confirmed_deaths"] is None for r in kept) == 2


def test_report_counts(spark):
    cases = spark.createDataFrame(
        [(None, "2026-06-01", "9"), (" A", "2026-06-01]", "1"), ("A", "2026-06-02", "ND"), ("B", "2026-06-02", "2")],
        CASE_SCHEMA,
    )
    deaths = spark.createDataFrame(
        [("A", "2026-06-01]", "ND"), (None, "2026-06-01", "1")],
        "nom string, date string, cumulative_confirmed_deaths string",
    )
    aliases = spark.createDataFrame([], "observed_name string, canonical_nom string")
    official = spark.createDataFrame([("A",), ("C",)], "nom string")
    row = cleaning.cleaning_report(cases, deaths, aliases, official).first().asDict()
    assert row == {
        "case_rows": 4, "case_rows_without_zone": 1, "zone_names_raw": 3, "names_changed": 1, "zone_names_clean": 2,
        "case_counts_missing": 1, "case_dates_cleaned": 1, "death_rows": 2, "death_rows_without_zone": 1,
        "death_counts_missing": 1, "death_dates_cleaned": 1, "official_zones": 2, "unmatched_zones": 1,
    }


def test_accepted_and_rejected(spark):
    rows = [("A", "2026-06-01", "3"), (None, "2026-06-01", "3"), ("A", "soon", "3"), ("A", "2026-06-02]", "4"), ("B", None, "1"), ("B", "2026-06-01", "ND"), ("B", "x", "ND")]
    reports = spark.createDataFrame(rows, f"nom string, date string, {cleaning.CASES} string")
    kept, rejected = cleaning.accepted(reports, cleaning.CASES)
    assert sorted(tuple(r) for r in kept.collect()) == [("A", "2026-06-01", "3"), ("A", "2026-06-02]", "4")]
    assert sorted((str(r["nom"]), str(r["date"]), r["reason"]) for r in rejected.collect()) == [
        ("A", "soon", "no date"), ("B", "2026-06-01", "no number"), ("B", "None", "no date"), ("B", "x", "no number"), ("None", "2026-06-01", "no name"),
    ]
    deaths = reports.withColumnRenamed(cleaning.CASES, cleaning.DEATHS)
    assert cleaning.accepted(deaths, cleaning.DEATHS)[0].count() == 3
