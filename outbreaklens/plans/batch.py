"""The batch job: raw files to cleaned, labelled and scored tables, models, and extraction records.

    spark-submit outbreaklens/plans/batch.py <raw folder> <output folder>

Each step reads what the steps before it wrote, so a failed run resumes at any step.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outbreaklens.operators import anomaly, bulletins, cleaning, forest, metrics, models, network, ordered, series, star
from outbreaklens.plans import pipeline
from outbreaklens.session import build_session, checkpointed
from outbreaklens.sources import readers, writers


@dataclass(frozen=True)
class Raw:
    """Where the raw files lie below one folder."""

    folder: str
    national_cases: str = "national_cases.csv"
    national_deaths: str = "national_deaths.csv"
    zone_cases: str = "zone_cases.csv"
    zone_deaths: str = "zone_deaths.csv"
    aliases: str = "aliases.csv"
    zones: str = "health_zones.geojson"
    bulletins: str = "bulletins"

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{getattr(self, name)}"


def _table(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{out}/{name}")


def _zones(spark: SparkSession, raw: Raw, entry: bool = False) -> DataFrame:
    return star.health_zones(readers.zone_features(spark, raw.path("zones")), entry)


def clean(spark: SparkSession, raw: Raw, out: str) -> None:
    """National table, cleaned zone cases, and the counts of the cleaning steps."""
    national = star.national_table(
        readers.national_cases(spark, raw.path("national_cases")),
        readers.national_deaths(spark, raw.path("national_deaths")),
    )
    writers.write_table(star.with_cfr(national), f"{out}/national_cleaned")
    reports = (
        readers.zone_cases(spark, raw.path("zone_cases")),
        readers.zone_deaths(spark, raw.path("zone_deaths")),
        readers.aliases(spark, raw.path("aliases")),
    )
    writers.write_table(cleaning.cleaning_report(*reports, _zones(spark, raw)), f"{out}/cleaning_report")
    writers.write_table(pipeline.cleaned(*reports), f"{out}/zone_cases_cleaned")


def train(spark: SparkSession, raw: Raw, out: str) -> None:
    """Labelled features, both classifiers, and their evaluation on the test dates."""
    labelled = pipeline.labelled(_table(spark, out, "zone_cases_cleaned"), _zones(spark, raw, entry=True))
    writers.write_table(labelled, f"{out}/zone_day_features_labelled")
    rows = checkpointed(series.split_by_date(_table(spark, out, "zone_day_features_labelled")))
    seen, held = rows.where("is_train"), rows.where(~F.col("is_train"))
    stats = anomaly.standardiser(seen, models.FEATURES)
    writers.write_table(stats, f"{out}/feature_scale")
    trees, fitted = models.train_forest(seen), network.train(seen)
    models.save_model(trees, f"{out}/models/forest")
    nodes = forest.nodes(trees, spark)
    writers.write_table(nodes, f"{out}/models/forest_nodes")
    writers.write_table(forest.importances(nodes, models.FEATURES), f"{out}/evaluation/forest/importances")
    writers.write_table(network.table(fitted, spark), f"{out}/models/network")
    results = {
        "forest": forest.with_probability(held, nodes, models.FEATURES, models.DEPTH),
        "network": held.withColumn("onset_probability", network.probability(fitted)),
    }
    for name, rows in results.items():
        scored = checkpointed(models.with_class(rows))
        evaluation = f"{out}/evaluation/{name}"
        writers.write_table(metrics.confusion_matrix(scored, models.LABEL, "predicted"), f"{evaluation}/confusion")
        writers.write_table(metrics.classification_report(scored, models.LABEL, "predicted"), f"{evaluation}/report")
        writers.write_table(metrics.pr_curve(scored, models.LABEL, "onset_probability"), f"{evaluation}/pr_curve")
        writers.write_table(
            metrics.average_precision(scored, models.LABEL, "onset_probability"), f"{evaluation}/average_precision"
        )


def detect(spark: SparkSession, out: str) -> None:
    """Anomaly scores and their evaluation against surges."""
    writers.write_table(pipeline.scored(_table(spark, out, "zone_cases_cleaned")), f"{out}/zone_anomaly_scores")
    rows = anomaly.evaluation_rows(_table(spark, out, "zone_anomaly_scores"))
    writers.write_table(metrics.pr_curve(rows, "true_surge", "anomaly_score"), f"{out}/evaluation/anomaly/pr_curve")
    writers.write_table(
        metrics.average_precision(rows, "true_surge", "anomaly_score"), f"{out}/evaluation/anomaly/average_precision"
    )


def extract(spark: SparkSession, raw: Raw, out: str) -> None:
    """Extraction record of every bulletin; places come from the zone and province names."""
    zones = _zones(spark, raw)
    names = zones.select(F.col("nom").alias("name")).union(zones.select("province"))
    texts = readers.spread(readers.bulletins(spark, raw.path("bulletins")))
    writers.write_extractions(bulletins.extract(texts, names.where("name IS NOT NULL")), f"{out}/bulletin_extractions")


def load(spark: SparkSession, raw: Raw, out: str) -> None:
    """The three star tables."""
    tables = {
        "health_zones": _zones(spark, raw),
        "daily_cases": star.daily_cases(_table(spark, out, "zone_cases_cleaned")),
        "anomaly_scores": star.anomaly_scores(_table(spark, out, "zone_anomaly_scores")),
    }
    writers.replace_tables(tables, f"{out}/star")


def predict(spark: SparkSession, out: str) -> DataFrame:
    """Both probabilities for every zone at its latest state."""
    tables = readers.current_tables(spark, f"{out}/star", ["health_zones", "daily_cases"])
    state = star.zone_state(tables["health_zones"], tables["daily_cases"])
    known = _table(spark, out, "zone_day_features_labelled")
    return models.score_zones(
        state,
        network.probability(network.from_table(_table(spark, out, "models/network"))),
        _table(spark, out, "models/forest_nodes"),
        ordered.median(known, "population_density").scalar(),
    )


def run(spark: SparkSession, raw: Raw, out: str) -> None:
    out = out.rstrip("/")
    clean(spark, raw, out)
    train(spark, raw, out)
    detect(spark, out)
    extract(spark, raw, out)
    load(spark, raw, out)
    writers.write_table(predict(spark, out), f"{out}/zone_predictions")


if __name__ == "__main__":
    run(build_session("outbreaklens-batch"), Raw(sys.argv[1]), sys.argv[2])
