import datetime as dt

import pytest

from outbreaklens.operators import star
from outbreaklens.plans import pipeline, serving

D1, D2 = dt.date(2026, 6, 1), dt.date(2026, 6, 2)


@pytest.fixture(scope="module")
def zones(spark):
    rows = [("A", "Nord-Kivu", 1.0, 2.0, 3.0), ("B", "Ituri", None, None, None), ("C", "Sud-Kivu", 4.0, 5.0, 6.0), ("D", None, 7.0, 8.0, 9.0)]
    return spark.createDataFrame(
        rows, "nom string, province string, population_density double, healthsite_density double, gdp_per_capita double"
    )


@pytest.fixture(scope="module")
def scores(spark):
    rows = [("A", D1, 9.0), ("A", D2, 0.5), ("B", D2, 0.5), ("C", D1, 0.70009), ("D", D2, -0.2), ("Unknown", D2, 99.0)]
    return spark.createDataFrame(rows, "nom string, date date, anomaly_score double")


def listed(df):
    return [(r["zone"], r["rank"]) for r in df.orderBy("rank").collect()]


@pytest.mark.parametrize("one_row_per_day", [True, False])
def test_ranking(zones, scores, one_row_per_day):
    got = serving.early_warning(scores, zones, one_row_per_day=one_row_per_day)
    assert listed(got) == [("C", 1), ("A", 2), ("B", 3), ("D", 4)]
    assert [r["anomaly_score"] for r in got.orderBy("rank").collect()] == [0.7001, 0.5, 0.5, -0.2]
    assert {r["zone"]: r["cross_border_watch"] for r in got.collect()} == {"A": True, "B": False, "C": True, "D": False}
    watched = serving.early_warning(scores, zones, limit=1, cross_border_only=True, one_row_per_day=one_row_per_day)
    assert listed(watched) == [("C", 1)]
    header = serving.ranking_header(watched).first()
    assert (header["generated_from_date"], header["zone_count"]) == (D1, 1)


def test_rows_of_one_day_all_stay(spark, zones):
    twice = spark.createDataFrame([("A", D1, 9.0), ("A", D2, 1.0), ("A", D2, 2.0)], "nom string, date date, anomaly_score double")
    assert listed(serving.early_warning(twice, zones)) == [("A", 1), ("A", 2)]


def test_limits_and_empty_ranking(zones, scores):
    for limit in (0, 201):
        with pytest.raises(ValueError):
            serving.early_warning(scores, zones, limit=limit)
    empty = serving.early_warning(scores, zones, cross_border_only=True, provinces=("Nowhere",))
    assert tuple(serving.ranking_header(empty).first()) == (None, 0)
    assert serving.ranking_page(empty).count() == 0 and serving.watchlist_chips(empty).count() == 0


def test_tiers(zones, scores):
    ranking = serving.early_warning(scores, zones)
    page = serving.ranking_page(ranking, rows=3).orderBy("row").collect()
    assert [(r["zone"], r["tier"]) for r in page] == [("C", "hot"), ("A", "hot"), ("B", "hot")]
    assert page[0]["bar_percent"] == 100.0 and page[1]["bar_percent"] == pytest.approx(0.5 / 0.7001 * 100)
    border = serving.ranking_page(ranking, cross_border_only=True).orderBy("row").collect()
    assert [(r["row"], r["zone"]) for r in border] == [(1, "C"), (2, "A")]
    assert {r["zone"] for r in serving.watchlist_chips(ranking).collect()} == {"A", "C"}


def test_zone_state_keeps_silent_zones(spark, zones):
    facts = spark.createDataFrame([("A", D1, 3.0), ("A", D2, 5.0)], "nom string, date date, cumulative_confirmed_cases double")
    got = {r["nom"]: r for r in star.zone_state(zones, facts).collect()}
    assert (got["A"]["has_case_data"], got["A"]["cumulative_confirmed_cases"], got["A"]["days_since_first_case"]) == (True, 5.0, 1)
    assert (got["B"]["has_case_data"], got["B"]["cumulative_confirmed_cases"], got["B"]["days_since_first_case"]) == (False, 0.0, 0)
    assert serving.zone_history(facts, "Nobody").count() == 0


def test_density(spark, zones):
    rows = spark.createDataFrame([("A",), ("A",), ("C",), ("B",), ("X",)], "nom_clean string")
    got = star.with_density(rows, zones).orderBy("nom_clean").collect()
    assert [(r["nom_clean"], r["population_density"], r["population_density_was_missing"]) for r in got] == [
        ("A", 1.0, 0), ("A", 1.0, 0), ("B", 1.0, 1), ("C", 4.0, 0), ("X", 1.0, 1),
    ]
    only_missing = star.with_density(rows.where("nom_clean IN ('B', 'X')"), zones).collect()
    assert {(r["population_density"], r["population_density_was_missing"]) for r in only_missing} == {(0.0, 1)}


def test_deaths_fan_out(spark):
    series = spark.createDataFrame([("A", D1)], "nom_clean string, date date")
    deaths = spark.createDataFrame([("A", D1, 1.0), ("A", D1, None)], "nom_clean string, date date, cumulative_confirmed_deaths double")
    assert star.with_deaths(series, deaths).count() == 2


def test_briefing(spark):
    from outbreaklens.sources.schemas import EXTRACTION

    rows = [
        ("DON1_2026-05-17", ["X"], [], []),
        ("DON2_2026-05-29", ["Goma"], [(5, "cases", "c"), (7, "deaths", "d"), (9, "cases", "c")],
         [("calm", "routine update", 0.9), ("bad", "emergency-level crisis", 0.4)]),
    ]
    brief = serving.briefing(spark.createDataFrame(rows, EXTRACTION)).first()
    assert brief["bulletin"] == "DON2_2026-05-29" and brief["bulletin_count"] == 2
    assert brief["most_severe_paragraph"]["paragraph"] == "bad"


def test_pipeline_without_the_one_row_promise(spark, zones):
    """Two spellings on one day: the general path runs end to end."""
    days = [dt.date(2026, 6, 1) + dt.timedelta(days=i) for i in range(30)]
    cases = [(z, str(d), str(i * k)) for k, z in enumerate(["A", "C"], 1) for i, d in enumerate(days)]
    cases += [("Aa", str(days[3]), "3")]
    raw = spark.createDataFrame(cases, "nom string, date string, cumulative_confirmed_cases string")
    deaths = raw.withColumnRenamed("cumulative_confirmed_cases", "cumulative_confirmed_deaths").where("nom = 'C'")
    aliases = spark.createDataFrame([("Aa", "A")], "observed_name string, canonical_nom string")
    cleaned = pipeline.cleaned(raw, deaths, aliases)
    assert cleaned.count() == 61
    scored = pipeline.scored(cleaned)
    assert scored.count() == 61 and scored.where("anomaly_score IS NULL").count() == 0
    labelled = pipeline.labelled(cleaned, zones)
    assert labelled.where("label_next_7d_onset = 1").count() == labelled.count() == 47
