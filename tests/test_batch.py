"""The whole batch on a small folder of raw files, then the read queries on what it wrote."""

import datetime as dt
import json
import random

import pytest

from outbreaklens.operators import bulletins
from outbreaklens.plans import batch, serving
from outbreaklens.sources import readers

DAYS = [dt.date(2026, 5, 14) + dt.timedelta(days=i) for i in range(60) if i % 11 != 5]
ZONES = ["Bunia", "Goma", "Butembo", "Aru", "Lita", "Nizi"]


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    rng = random.Random(4)
    totals = {z: 1 for z in ZONES}
    cases, deaths, national = [], [], []
    for day in DAYS:
        for z in ZONES:
            totals[z] += rng.choice([0, 0, 0, 1, 4])
            cases.append((" Goma" if z == "Goma" and day.day % 3 else "Bunja" if z == "Bunia" and day.day % 4 == 0 else z, day, totals[z]))
            deaths.append((z, day, "ND" if rng.random() < 0.2 else totals[z] // 3))
        national.append((day, sum(totals.values())))
    cases += [("", DAYS[3], 5), ("Aru", f"{DAYS[-1]}]", "17-")]
    csv = {
        "zone_cases.csv": "nom,date,cumulative_confirmed_cases\n" + "".join(f"{n},{d},{c}\n" for n, d, c in cases),
        "zone_deaths.csv": "nom,date,cumulative_confirmed_deaths\n" + "".join(f"{n},{d},{c}\n" for n, d, c in deaths),
        "national_cases.csv": "nom,date,national_cumulative_confirmed_cases\n" + "".join(f"COD,{d},{c}\n" for d, c in national),
        "national_deaths.csv": "date,national_cumulative_confirmed_deaths\n" + "".join(f"{d},{c // 4}\n" for d, c in national),
        "aliases.csv": "observed_name,canonical_nom\nBunja,Bunia\n",
    }
    for name, content in csv.items():
        (raw / name).write_text(content)
    provinces = ["Ituri", "Nord-Kivu", "Nord-Kivu", "Ituri", "Ituri", None]
    features = [
        {"properties": {"nom": z, "province": p, "worldpop": {"pop_density": {"pop_density": 10.0 + i}}}}
        for i, (z, p) in enumerate(zip(ZONES + ["Silent"], provinces + ["Sud-Kivu"]))
    ]
    (raw / "health_zones.geojson").write_text(json.dumps({"features": features}))
    (raw / "bulletins").mkdir()
    (raw / "bulletins" / "DON1_2026-05-17.txt").write_text("No zone named.")
    (raw / "bulletins" / "DON2_2026-05-29.txt").write_text(
        "As of 29 May, 1,234 confirmed cases and 56 deaths were reported in Bunia and Goma, Nord-Kivu; a public health emergency."
    )
    folder = str(tmp_path_factory.mktemp("out"))
    batch.run(spark, batch.Raw(str(raw)), folder)
    return folder


def test_tables(spark, out):
    report = spark.read.parquet(f"{out}/cleaning_report").first()
    assert (report["case_rows_without_zone"], report["case_counts_missing"], report["zone_names_clean"]) == (1, 1, 6)
    cleaned = spark.read.parquet(f"{out}/zone_cases_cleaned")
    assert cleaned.count() == len(DAYS) * len(ZONES)
    scored = spark.read.parquet(f"{out}/zone_anomaly_scores")
    assert scored.count() == cleaned.count() and scored.where("anomaly_score IS NULL").count() == 0
    labelled = spark.read.parquet(f"{out}/zone_day_features_labelled")
    assert 0 < labelled.count() < cleaned.count()
    assert spark.read.parquet(f"{out}/national_cleaned").where("cfr > 0").count() == len(DAYS)
    for model in ("forest", "network"):
        assert 0 <= spark.read.parquet(f"{out}/evaluation/{model}/average_precision").first()[0] <= 1


def test_read_queries(spark, out):
    star = readers.current_tables(spark, f"{out}/star", ["health_zones", "daily_cases", "anomaly_scores"])
    ranking = serving.early_warning(star["anomaly_scores"], star["health_zones"]).collect()
    assert sorted(r["zone"] for r in ranking) == sorted(ZONES) and {r["date"] for r in ranking} == {DAYS[-1]}
    picture = serving.latest_picture(*star.values()).collect()
    assert len(picture) == 6 and picture[0]["anomaly_score"] == max(r["anomaly_score"] for r in picture)
    history = serving.watchlist_history(*star.values()).collect()
    assert len(history) == 10 and {r["province"] for r in history} == {"Nord-Kivu"}
    predictions = spark.read.parquet(f"{out}/zone_predictions")
    assert predictions.count() == 7
    assert serving.zone_prediction(predictions, "Silent").first()["has_case_data"] is False


def test_briefing(spark, out):
    records = readers.extractions(spark, f"{out}/bulletin_extractions")
    brief = serving.briefing(records).first()
    assert brief["bulletin"] == "DON2_2026-05-29" and brief["bulletin_count"] == 2
    assert brief["locations_mentioned"] == ["Bunia", "Goma", "Nord-Kivu"]
    top = {r["bulletin"]: r for r in bulletins.headline(records).collect()}["DON2_2026-05-29"]
    assert (top["max_cases"], top["max_deaths"], top["locations"], top["severity_class"]) == (1234, 56, 3, "crisis")
