"""Surveillance tables derived from the generic test tables: zone = user, day = event day,
count = events of one type. Some users report once a week, some under a misspelt name that no alias mends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outbreaklens.operators.cleaning import ENTRY
from outbreaklens.sources import readers

WATCHLIST = ("ASIA", "EUROPE")


# Declared, so that no job reads file footers to find the columns.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _reports(spark: SparkSession, folder: str, event_type: str, column: str) -> DataFrame:
    """One row per user and day with a dirty cumulative count. The events are grouped first, so what
    reaches a user's window is bounded by the number of days."""
    user, k = F.col("user_id"), F.dayofmonth("d")
    day = F.when(user % 17 == 2, F.trunc("ts", "week")).otherwise(F.to_date("ts"))
    days = (
        table(spark, folder, "events")
        .groupBy("user_id", day.alias("d"))
        .agg(F.count_if(F.col("event_type") == event_type).alias("n"))
    )
    running = days.withColumn("running", F.sum("n").over(Window.partitionBy("user_id").orderBy("d")))
    revised = F.when((user + k) % 23 == 0, 1).otherwise(0)
    number = (5 + F.col("running") - revised).cast("string")
    label = user.cast("string")
    return running.select(
        F.when(user % 37 == 36, F.lit(None))
        .when(user % 31 == 9, F.concat(F.lit("Zoen_"), label))
        .when(user % 13 == 5, F.concat(F.lit("Zne_"), label))
        .when(user % 7 == 3, F.concat(F.lit("  Zone_"), label, F.lit(" ")))
        .otherwise(F.concat(F.lit("Zone_"), label))
        .alias("nom"),
        F.when((user + k) % 19 == 0, F.concat(F.col("d").cast("string"), F.lit("]")))
        .otherwise(F.col("d").cast("string"))
        .alias("date"),
        F.when((user * 31 + k) % 17 == 0, "ND")
        .when((user + k) % 41 == 0, F.concat(number, F.lit("-")))
        .otherwise(number)
        .alias(column),
    )


def raw_cases(spark: SparkSession, folder: str) -> DataFrame:
    return _reports(spark, folder, "error", "cumulative_confirmed_cases")


def raw_deaths(spark: SparkSession, folder: str) -> DataFrame:
    return _reports(spark, folder, "signup", "cumulative_confirmed_deaths")


def _twice(reports: DataFrame, column: str) -> DataFrame:
    """Reports under an alias come a second time under the canonical name, with three more."""
    aliased = reports.where(F.col("nom").startswith("Zne_"))
    more = F.coalesce((F.col(column).try_cast("bigint") + 3).cast("string"), F.col(column))
    return reports.unionByName(
        aliased.withColumn("nom", F.replace("nom", F.lit("Zne_"), F.lit("Zone_"))).withColumn(column, more)
    )


def raw_cases_twice(spark: SparkSession, folder: str) -> DataFrame:
    return _twice(raw_cases(spark, folder), "cumulative_confirmed_cases")


def raw_deaths_twice(spark: SparkSession, folder: str) -> DataFrame:
    return _twice(raw_deaths(spark, folder), "cumulative_confirmed_deaths")


def aliases_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Every alias has a wrong entry in front of the right one."""
    rows = aliases(spark, folder)
    wrong = rows.withColumn("canonical_nom", F.lit("Zone_wrong")).withColumn(ENTRY, F.lit(1))
    return rows.withColumn(ENTRY, F.lit(2)).unionByName(wrong)


def aliases(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    return (
        table(spark, folder, "events")
        .where(user % 13 == 5)
        .select(user)
        .distinct()
        .select(
            F.concat(F.lit("Zne_"), user.cast("string")).alias("observed_name"),
            F.concat(F.lit("Zone_"), user.cast("string")).alias("canonical_nom"),
        )
    )


def health_zones(spark: SparkSession, folder: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("n_nationkey")
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == nation)
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("Zone_"), key.cast("string")).alias("nom"),
            F.col("r_name").alias("province"),
            F.when(key % 11 != 4, F.abs("c_acctbal")).alias("population_density"),
            (F.col("c_nationkey").cast("double") / 8).alias("healthsite_density"),
            (300 + 40 * nation).cast("double").alias("gdp_per_capita"),
        )
    )


def bulletins(spark: SparkSession, folder: str) -> DataFrame:
    """Documents closed by one sentence with a case count, a death count and a zone name."""
    doc = F.col("doc_id")
    number = F.lpad((600 + doc).cast("string"), 9, "0")
    day = F.date_add(F.lit("2026-01-01").cast("date"), (doc % 365).cast("int"))
    documents = readers.spread(table(spark, folder, "documents"))
    return documents.select(
        F.concat(F.lit("DON"), number, F.lit("_"), day.cast("string")).alias("bulletin"),
        "lang",
        F.concat(
            F.col("text"),
            F.lit("\nAs of day "),
            doc.cast("string"),
            F.lit(" a total of "),
            F.col("n_chars").cast("string"),
            F.lit(" confirmed cases, including "),
            (F.col("n_chars") % 97).cast("string"),
            F.lit(" deaths, were reported in zone Zone_"),
            (doc % 40).cast("string"),
            F.lit("."),
        ).alias("text"),
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return readers.spread(table(spark, folder, "pages"))


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """Names of zones and provinces."""
    zones = health_zones(spark, folder)
    return zones.select(F.col("nom").alias("name")).union(zones.select("province")).distinct()
