import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from outbreaklens.operators import anomaly, metrics, models

SCHEMA = (
    "nom_clean string, date date, cumulative_confirmed_cases double, days_since_first_case int, "
    "population_density double, label_next_7d_onset int"
)


@pytest.fixture(scope="module")
def train(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        cases = float(rng.randint(0, 100))
        label = int(cases + rng.gauss(0, 10) > 70)
        rows.append((f"Z{i % 9}", dt.date(2026, 5, 1) + dt.timedelta(days=i // 10), cases, rng.randint(0, 60), rng.random(), label))
    return spark.createDataFrame(rows, SCHEMA).cache()


def precision_of(df):
    return metrics.average_precision(df, models.LABEL, "onset_probability").first()[0]


def test_forest_learns_and_reloads(train, tmp_path):
    base = train.agg(F.avg(models.LABEL)).first()[0]
    model = models.train_forest(train, trees=20)
    scored = models.with_probability(model, train)
    assert precision_of(scored) > base + 0.3
    assert set(models.with_class(scored).select("predicted").distinct().toPandas()["predicted"]) == {0, 1}
    names = [name for name, _ in models.importances(model)]
    assert names[-1] == "cumulative_confirmed_cases"
    models.save_model(model, str(tmp_path / "forest"))
    again = models.with_probability(models.load_model(str(tmp_path / "forest")), train)
    key = ["nom_clean", "date", "cumulative_confirmed_cases"]
    assert again.orderBy(key).collect() == scored.orderBy(key).collect()


def test_network_learns(train):
    base = train.agg(F.avg(models.LABEL)).first()[0]
    network = models.train_network(train, segment=20, max_iterations=60)
    stats = anomaly.standardiser(train, models.FEATURES)
    scored = models.with_probability(network, anomaly.standardise(train, stats, models.FEATURES))
    assert precision_of(scored) > base + 0.3


def test_weights(train):
    counts = {r[models.LABEL]: r for r in models.balanced_weights(train).collect()}
    assert sum(r["class_rows"] * r["weight"] for r in counts.values()) == pytest.approx(400)
    assert counts[0]["class_rows"] * counts[0]["weight"] == pytest.approx(200)
    row = models.loss_weight(train).first()
    assert row["positive_weight"] == pytest.approx(row["n_neg"] / row["n_pos"])
    copies = models.replicate_minority(train).groupBy(models.LABEL).count().collect()
    larger = max(counts[0]["class_rows"], counts[1]["class_rows"])
    assert {r[0]: r[1] for r in copies} == {0: larger, 1: larger}


def test_missing_features_stop_training(train):
    broken = train.withColumn("population_density", F.when(F.col("days_since_first_case") > 50, None).otherwise(1.0))
    assert models.missing_features(broken).first()["population_density"] > 0
    with pytest.raises(ValueError, match="population_density"):
        models.train_network(broken)


def test_zone_predictions_for_silent_zones(spark, train):
    forest, network = models.train_forest(train, trees=5), models.train_network(train, segment=10, max_iterations=10)
    state = spark.createDataFrame(
        [("A", "P", None, False, 0.0, 0), ("B", "P", 0.5, True, 90.0, 30)],
        "nom string, province string, population_density double, has_case_data boolean, "
        "cumulative_confirmed_cases double, days_since_first_case long",
    )
    got = models.predict_zones(
        state, network, forest, anomaly.standardiser(train, models.FEATURES), F.lit(0.4)
    ).orderBy("nom").collect()
    assert got[0]["population_density"] is None
    assert got[1]["baseline_rf_probability"] > got[0]["baseline_rf_probability"]
    assert all(0 <= r["next_7d_onset_probability"] <= 1 for r in got)


def sizes_of(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_are_dealt_for_training(spark, train, monkeypatch):
    """The copies of the rarer class came out of a window over dates, at most one part a date."""
    one = train.coalesce(1)
    parts = sizes_of(models.dealt(one, 50))
    assert sum(parts) == 400 and len(parts) == 8 and max(parts) <= 60
    assert models.dealt(one, 50).exceptAll(one).isEmpty() and sizes_of(models.dealt(one, 400)) == [400]
    assert models.dealt(one.limit(0), 50).collect() == []
    rare = train.where(F.col(models.LABEL) == 0).unionByName(train.where(F.col(models.LABEL) == 1).limit(40).withColumn("date", F.lit(dt.date(2026, 5, 1))))
    seen = []
    monkeypatch.setattr(models, "dealt", lambda rows, f=models.dealt: seen.append(f(rows, 40)) or seen[-1])
    assert models.train_network(rare, segment=2, max_iterations=4) is not None
    assert len(seen) == 1 and max(sizes_of(seen[0])) <= 60
