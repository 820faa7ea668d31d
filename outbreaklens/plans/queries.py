"""Registered queries: every operator over the whole test tables. Dates leave as ISO text."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outbreaklens.functions import text as t
from outbreaklens.functions.display import bar_percent, score_tier
from outbreaklens.operators import anomaly, bulletins, cleaning, forest, metrics, models, network, ordered, series, severity, star
from outbreaklens.plans import pipeline, serving
from outbreaklens.session import checkpointed, ensure_checkpoint_dir
from outbreaklens.sources import readers, testviews, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SERIES_COLUMNS = ["nom_clean", "date", "cumulative_confirmed_cases"]
ONE_ROW = True


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _edge(function(spark, folder))

    QUERIES[function.__name__] = run
    return function


def _edge(df: DataFrame) -> DataFrame:
    """Dates as ISO text, integers as one width."""

    def out(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[out(field) for field in df.schema.fields])


def _series(spark: SparkSession, folder: str) -> DataFrame:
    # The derived reports are grouped by user and day, so one row per zone and day holds.
    return pipeline.case_series(testviews.raw_cases(spark, folder), testviews.aliases(spark, folder), ONE_ROW)


def _national(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.national(
        testviews.raw_cases(spark, folder), testviews.raw_deaths(spark, folder), testviews.aliases(spark, folder)
    )


def _shown(df: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """Scores to six decimals, for comparison with another solver; rankings and curves use them as they are."""
    return df.withColumn(score, F.round(score, 6))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.scored(_series(spark, folder), ONE_ROW)


def _star(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Zones, daily cases and anomaly scores; the case rows are stored as both facts read them."""
    inputs = checkpointed(series.anomaly_inputs(_series(spark, folder), ONE_ROW))
    scores = star.anomaly_scores(pipeline.score(inputs))
    return testviews.health_zones(spark, folder), _facts(inputs), scores


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    # Stored, as the median of the density and the features both read it.
    cases = checkpointed(_series(spark, folder))
    return pipeline.labelled(cases, testviews.health_zones(spark, folder), ONE_ROW)


def _split(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled rows with `is_train`; the cutoff needs zones and dates only, so the features are computed once."""
    cases = checkpointed(_series(spark, folder))
    rows = pipeline.labelled(cases, testviews.health_zones(spark, folder), ONE_ROW)
    return rows.withColumn("is_train", F.col("date") < series.full_window_cutoff(cases).scalar())


def _facts(cases: DataFrame) -> DataFrame:
    return cases.withColumnRenamed("nom_clean", "nom_key").drop("nom").withColumnRenamed("nom_key", "nom")


def _latest_scores(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.latest_scores(checkpointed(series.anomaly_inputs(_series(spark, folder), ONE_ROW)), ONE_ROW)


def _latest_rows(rows: DataFrame) -> DataFrame:
    """The latest row of every zone, stored; one row per zone."""
    named = rows.withColumnRenamed("nom_clean", "nom")
    return checkpointed(star.latest_rows(named, ONE_ROW)).withColumnRenamed("nom", "nom_clean")


def _ranking(spark: SparkSession, folder: str, limit: int, cross_border_only: bool = False) -> DataFrame:
    return serving.early_warning(
        _latest_scores(spark, folder),
        testviews.health_zones(spark, folder),
        limit,
        cross_border_only,
        provinces=testviews.WATCHLIST,
        one_row_per_day=True,
    )


def _evaluation(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly.evaluation_rows(_scored(spark, folder))


def _fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


# --- cleaning ---------------------------------------------------------------------------------


@query
def drop_unattributed(spark, folder):
    return cleaning.drop_unattributed(testviews.raw_cases(spark, folder))


@query
def clean_zone_names(spark, folder):
    reports = cleaning.drop_unattributed(testviews.raw_cases(spark, folder))
    return cleaning.clean_zone_names(reports, testviews.aliases(spark, folder)).select("nom", "date", "nom_clean")


@query
def coerce_counts(spark, folder):
    return cleaning.coerce_counts(testviews.raw_cases(spark, folder), "cumulative_confirmed_cases")


def _broken_dates(spark: SparkSession, folder: str) -> DataFrame:
    """The raw case reports, those of the 17th of a month without a readable date."""
    cases = testviews.raw_cases(spark, folder)
    return cases.withColumn("date", F.when(F.col("date").contains("-17"), F.lit("soon")).otherwise(F.col("date")))


@query
def rejected_reports(spark, folder):
    """Rejected case reports by reason, and the accepted ones after cleaning, none of them without a date."""
    kept, rejected = cleaning.accepted(_broken_dates(spark, folder), cleaning.CASES)
    clean = cleaning.clean_cases(kept, testviews.aliases(spark, folder), strict=False)
    reasons = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    dated = clean.where(F.col("date").isNotNull())
    return reasons.unionByName(dated.agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("n_rows"))).unionByName(
        clean.where(F.col("date").isNull()).agg(F.lit("accepted without date").alias("reason"), F.count(F.lit(1)).alias("n_rows"))
    )


@query
def clean_dates(spark, folder):
    reports = testviews.raw_cases(spark, folder).withColumn("date_text", F.col("date"))
    return cleaning.clean_dates(reports).select("nom", "date_text", "date")


@query
def clean_cases(spark, folder):
    return cleaning.clean_cases(testviews.raw_cases(spark, folder), testviews.aliases(spark, folder))


@query
def clean_deaths(spark, folder):
    return cleaning.clean_deaths(testviews.raw_deaths(spark, folder), testviews.aliases(spark, folder))


@query
def cleaning_report(spark, folder):
    return cleaning.cleaning_report(
        testviews.raw_cases(spark, folder),
        testviews.raw_deaths(spark, folder),
        testviews.aliases(spark, folder),
        testviews.health_zones(spark, folder),
    )


@query
def unmatched_zones(spark, folder):
    return cleaning.unmatched_zones(clean_cases(spark, folder), testviews.health_zones(spark, folder))


@query
def unmatched_preview(spark, folder):
    return unmatched_zones(spark, folder).orderBy("nom_clean").limit(10)


@query
def duplicate_reports(spark, folder):
    """Reports of both kinds stacked: zone-days that occur more than once."""
    return cleaning.duplicate_days(clean_cases(spark, folder).select("nom_clean", "date").union(clean_deaths(spark, folder).select("nom_clean", "date")))


@query
def distinct_zones(spark, folder):
    return clean_cases(spark, folder).select("nom_clean").distinct()


# --- series -----------------------------------------------------------------------------------


@query
def new_cases(spark, folder):
    return _series(spark, folder).select(*SERIES_COLUMNS, "new_cases")


@query
def rolling_7_sum(spark, folder):
    return _series(spark, folder).select(*SERIES_COLUMNS, "rolling_7")


@query
def rt_proxy(spark, folder):
    return _series(spark, folder).select(*SERIES_COLUMNS, "new_cases", "rt_proxy")


@query
def reported_growth(spark, folder):
    return _series(spark, folder).where(F.col("rt_proxy").isNotNull()).select("nom_clean", "date", "rt_proxy")


@query
def rolling_3_mean(spark, folder):
    rows = series.anomaly_inputs(_series(spark, folder), one_row_per_day=True)
    return rows.select("nom_clean", "date", "day_idx", "zone_rows", "rolling_3d_new_cases")


@query
def trend_features(spark, folder):
    rows = series.trend_features(_series(spark, folder), one_row_per_day=True)
    return rows.select(
        "nom_clean", "date", "days_since_first_case", "rolling_7d_new_cases", "days_since_last_case"
    )


@query
def label_next_7d(spark, folder):
    rows = series.onset_label(_series(spark, folder), one_row_per_day=True)
    return rows.select("nom_clean", "date", "label_next_7d_onset", "has_full_future_window")


@query
def full_window_rows(spark, folder):
    rows = series.onset_label(_series(spark, folder), one_row_per_day=True)
    kept = F.count_if("has_full_future_window")
    return rows.agg(
        kept.alias("kept"),
        (F.count(F.lit(1)) - kept).alias("dropped"),
        F.avg(F.when(F.col("has_full_future_window"), F.col("label_next_7d_onset"))).alias("positive_share"),
    )


@query
def labelled_features(spark, folder):
    return _labelled(spark, folder).drop("nom", series.DAY, "rolling_7")


@query
def date_cutoff_split(spark, folder):
    return _split(spark, folder).groupBy("is_train").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query
def trending_up(spark, folder):
    return serving.trending_up(_latest_rows(_series(spark, folder).select("nom_clean", "date", "rt_proxy")))


@query
def serving_trend(spark, folder):
    rows = checkpointed(_series(spark, folder).drop("nom"))
    fallback = ordered.upper_median(rows, "rt_proxy").scalar()
    default = F.coalesce(fallback, F.lit(1.0))
    trend = series.latest_trend(rows, default).withColumnRenamed("nom_clean", "nom")
    zones = testviews.health_zones(spark, folder).select("nom")
    return zones.join(trend, "nom", "left").select(
        "nom",
        F.coalesce("rolling_7d_new_cases", F.lit(0.0)).alias("rolling_7d_new_cases"),
        F.coalesce("days_since_last_case", F.lit(0)).alias("days_since_last_case"),
        F.coalesce("rt_proxy", default).alias("rt_proxy"),
    )


# --- joins and star ---------------------------------------------------------------------------


@query
def national_outer_join(spark, folder):
    return _national(spark, folder)


@query
def epidemic_curve(spark, folder):
    return serving.epidemic_curve(_national(spark, folder))


@query
def cfr_trend(spark, folder):
    return serving.cfr_trend(_national(spark, folder))


@query
def cases_deaths_left_join(spark, folder):
    deaths = clean_deaths(spark, folder)
    return star.daily_cases(star.with_deaths(_series(spark, folder), deaths))


@query
def density_impute(spark, folder):
    cases = checkpointed(clean_cases(spark, folder).select("nom_clean", "date"))
    return star.with_density(cases, testviews.health_zones(spark, folder))


@query
def star_latest_top10(spark, folder):
    return _shown(serving.latest_picture(*_star(spark, folder)))


@query
def watchlist_history(spark, folder):
    return _shown(serving.watchlist_history(*_star(spark, folder), provinces=testviews.WATCHLIST))


@query
def usable_zones(spark, folder):
    rows = series.anomaly_inputs(_series(spark, folder), one_row_per_day=True)
    kept = anomaly.usable_zones(rows)
    return kept.select("nom_clean", "date", "day_idx", anomaly.is_baseline().alias("is_baseline"))


@query
def selection_summary(spark, folder):
    rows = series.anomaly_inputs(_series(spark, folder), one_row_per_day=True)
    return anomaly.selection_summary(rows)


@query
def latest_per_zone(spark, folder):
    facts = _facts(_series(spark, folder)).select("nom", "date", "cumulative_confirmed_cases")
    return star.latest_rows(facts, one_row_per_day=True)


@query
def zone_state(spark, folder):
    state = star.zone_state(testviews.health_zones(spark, folder), _facts(_series(spark, folder)))
    return state.withColumn("cross_border_watch", F.col("province").isin(*testviews.WATCHLIST))


@query
def zone_history(spark, folder):
    return serving.zone_history(_facts(_series(spark, folder)), "Zone_7").select(
        "nom", "date", "cumulative_confirmed_cases", "new_cases", "rt_proxy"
    )


@query
def manifest_anti_join(spark, folder):
    """Pages that are listed but not stored; those fetched over plain http count as stored."""
    name = F.concat(F.lit("DON"), F.col("page_id").cast("string"))
    manifest = testviews.table(spark, folder, "pages").select(name.alias("name"), "url")
    return star.only_new(manifest, manifest.where(F.col("url").startswith("http://")))


@query
def report_batches_union(spark, folder):
    """Case and death reports as one long table."""
    tagged = [
        testviews.raw_cases(spark, folder).select("nom", "date", F.col("cumulative_confirmed_cases").alias("number"), F.lit("cases").alias("type")),
        testviews.raw_deaths(spark, folder).select("nom", "date", F.col("cumulative_confirmed_deaths").alias("number"), F.lit("deaths").alias("type")),
    ]
    return tagged[0].unionByName(tagged[1])


# --- two spellings of a zone on one day, an alias given twice, and no promise of one row per day ---------------


def _series_twice(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.case_series(testviews.raw_cases_twice(spark, folder), testviews.aliases_twice(spark, folder))


@query
def twice_series(spark, folder):
    rows = _series_twice(spark, folder)
    return rows.select("nom_clean", "date", "zone_row", "cumulative_confirmed_cases", "new_cases", "rolling_7", "rt_proxy")


@query
def twice_latest_per_zone(spark, folder):
    facts = _facts(_series_twice(spark, folder)).select("nom", "date", "cumulative_confirmed_cases")
    return star.latest_rows(facts)


@query
def twice_zone_state(spark, folder):
    return star.zone_state(testviews.health_zones(spark, folder), _facts(_series_twice(spark, folder)))


@query
def twice_serving_trend(spark, folder):
    return series.latest_trend(_series_twice(spark, folder).drop("nom"), F.lit(1.0))


@query
def twice_cases_deaths(spark, folder):
    """Two case rows and two death rows of one day give four rows."""
    deaths = cleaning.clean_deaths(
        testviews.raw_deaths_twice(spark, folder), testviews.aliases_twice(spark, folder)
    )
    return star.daily_cases(star.with_deaths(_series_twice(spark, folder), deaths))


# --- aggregates and top-k ---------------------------------------------------------------------


@query
def zone_counts(spark, folder):
    return clean_cases(spark, folder).groupBy("nom_clean").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def table_summary(spark, folder):
    return clean_cases(spark, folder).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("nom_clean").alias("zones"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


@query
def class_balance(spark, folder):
    label = F.col("label_next_7d_onset")
    return _split(spark, folder).agg(
        F.avg(label).alias("overall"),
        F.avg(F.when(F.col("is_train"), label)).alias("train"),
        F.avg(F.when(~F.col("is_train"), label)).alias("test"),
        F.count_if("is_train").alias("train_rows"),
        F.count_if(~F.col("is_train")).alias("test_rows"),
    )


@query
def median_density(spark, folder):
    middle = star.median_density(clean_cases(spark, folder), testviews.health_zones(spark, folder))
    return middle.select(F.round("median", 6).alias("median_density"))


@query
def upper_median_rt(spark, folder):
    return ordered.upper_median(_series(spark, folder), "rt_proxy")


@query
def impute_growth(spark, folder):
    """Growth ratio with the median of the training rows in place of missing values."""
    rows = checkpointed(_split(spark, folder))
    middle = ordered.median(rows.where("is_train"), "rt_proxy").scalar()
    return models.impute_ratio(rows, middle).select("nom_clean", "date", "is_train", F.round("rt_proxy", 9).alias("rt_proxy"))


@query
def longest_zone(spark, folder):
    return serving.longest_zone(clean_cases(spark, folder))


@query
def top15_zones(spark, folder):
    rows = clean_cases(spark, folder).select("nom_clean", "date", "cumulative_confirmed_cases")
    return serving.top_zones(_latest_rows(rows))


@query
def early_warning(spark, folder):
    return _ranking(spark, folder, serving.DEFAULT_LIMIT)


@query
def early_warning_cross_border(spark, folder):
    return _ranking(spark, folder, serving.MAX_LIMIT, cross_border_only=True)


@query
def early_warning_header(spark, folder):
    return serving.ranking_header(_ranking(spark, folder, serving.MAX_LIMIT))


@query
def ranking_page(spark, folder):
    return serving.ranking_page(_ranking(spark, folder, serving.MAX_LIMIT))


@query
def ranking_page_cross_border(spark, folder):
    return serving.ranking_page(_ranking(spark, folder, serving.MAX_LIMIT), cross_border_only=True)


@query
def watchlist_chips(spark, folder):
    return serving.watchlist_chips(_ranking(spark, folder, serving.MAX_LIMIT))


@query
def zone_timeline(spark, folder):
    return _shown(serving.zone_timeline(_scored(spark, folder)))


# --- metrics ----------------------------------------------------------------------------------


@query
def evaluation_rows(spark, folder):
    return _shown(_evaluation(spark, folder)).select("nom_clean", "date", "anomaly_score", "true_surge", "flagged")


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_evaluation(spark, folder), "true_surge", "flagged")


@query
def classification_report(spark, folder):
    report = metrics.classification_report(_evaluation(spark, folder), "true_surge", "flagged")
    return report.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query
def pr_curve(spark, folder):
    return _shown(metrics.pr_curve(_evaluation(spark, folder), "true_surge", "anomaly_score"), "threshold")


@query
def average_precision(spark, folder):
    rows = _evaluation(spark, folder)
    return metrics.average_precision(rows, "true_surge", "anomaly_score").select(
        F.round("average_precision", 9).alias("average_precision")
    )


@query
def surge_evaluation(spark, folder):
    rows = _evaluation(spark, folder)
    precision = metrics.average_precision(rows, "true_surge", "anomaly_score").scalar()
    return rows.agg(
        F.count(F.lit(1)).alias("evaluated_rows"),
        F.sum("true_surge").alias("surges"),
        F.round(F.avg("true_surge"), 9).alias("base_rate"),
    ).withColumn("average_precision", F.round(precision, 9))


# --- text and pages ---------------------------------------------------------------------------


@query
def html_article_text(spark, folder):
    return readers.articles(testviews.pages(spark, folder)).select("page_id", "article")


@query
def html_page_forms(spark, folder):
    """The pages rewritten into other forms: a main element, a body alone, a self-closed nav, old references."""
    page, form = F.col("html"), F.col("page_id") % 4
    rewritten = (
        F.when(form == 0, F.replace(F.replace(page, F.lit("<article>"), F.lit("<main>")), F.lit("</article>"), F.lit("</main>")))
        .when(form == 1, F.replace(F.replace(page, F.lit("<article>"), F.lit("<div>")), F.lit("</article>"), F.lit("</div>")))
        .when(form == 2, F.replace(page, F.lit("<article>"), F.lit("<article><nav/>")))
        .otherwise(F.replace(page, F.lit("<article>"), F.lit("<article><p title=it's>&#147;x&#148; &copy 2020</p>")))
    )
    pages = testviews.pages(spark, folder).withColumn("html", rewritten)
    return readers.articles(pages).select("page_id", "article")


@query
def article_lengths(spark, folder):
    return readers.articles(testviews.pages(spark, folder)).select(
        "page_id", F.length("article").alias("n_chars")
    )


@query
def count_mentions(spark, folder):
    return bulletins.mentions(testviews.bulletins(spark, folder)).select("bulletin", "pos", "value", "type")


@query
def mention_context(spark, folder):
    return bulletins.mentions(testviews.bulletins(spark, folder)).select("bulletin", "pos", "context")


@query
def max_counts(spark, folder):
    return bulletins.mentions(testviews.bulletins(spark, folder)).groupBy("type").agg(
        F.max("value").alias("largest"), F.count(F.lit(1)).alias("mentions")
    )


@query
def largest_mention(spark, folder):
    biggest = t.largest_mention(t.count_mentions(F.col("text")))
    return testviews.bulletins(spark, folder).select("bulletin", biggest.alias("m")).select(
        "bulletin", "m.value", "m.type", "m.context"
    )


@query
def paragraphs(spark, folder):
    return bulletins.bulletin_paragraphs(testviews.bulletins(spark, folder))


@query
def truncate_ellipsis(spark, folder):
    rows = bulletins.bulletin_paragraphs(testviews.bulletins(spark, folder))
    return rows.select("bulletin", "pos", t.preview(F.col("paragraph")).alias("preview"))


@query
def severity_labels(spark, folder):
    judged = t.paragraph_severity(F.col("text"))
    rows = testviews.bulletins(spark, folder).select("bulletin", F.posexplode(judged).alias("pos", "s"))
    return rows.select("bulletin", "pos", "s.label", "s.confidence")


@query
def severity_step(spark, folder):
    """Shares of every paragraph after one step from the stems."""
    bulletins = testviews.bulletins(spark, folder)
    paragraphs = severity.seeded(bulletins)
    after = severity.judged(paragraphs, severity.term_shares(paragraphs), severity.repeated_names(bulletins))
    return after.select("bulletin", "pos", *[F.bround(name, 6).alias(name) for name in severity.SHARES])


@query
def severity_refined(spark, folder):
    return severity.refined(testviews.bulletins(spark, folder)).select("bulletin", "pos", "label", "confidence")


@query
def most_severe_paragraph(spark, folder):
    worst = t.most_severe(t.paragraph_severity(F.col("text")))
    return testviews.bulletins(spark, folder).select("bulletin", worst.alias("w")).select("bulletin", "w.*")


@query
def gazetteer_locations(spark, folder):
    found = bulletins.locations(testviews.bulletins(spark, folder), testviews.gazetteer(spark, folder))
    return found.select("bulletin", F.array_join("locations_mentioned", "|").alias("locations"))


@query
def gazetteer_locations_filtered(spark, folder):
    """The same places with a gazetteer that counts as too large to broadcast, behind the filter of its names."""
    found = bulletins.locations(testviews.bulletins(spark, folder), testviews.gazetteer(spark, folder), broadcast_names=10)
    return found.select("bulletin", F.array_join("locations_mentioned", "|").alias("locations"))


@query
def bulletin_headlines(spark, folder):
    records = bulletins.extract(testviews.bulletins(spark, folder), testviews.gazetteer(spark, folder))
    return bulletins.headline(records)


@query
def bulletin_briefing(spark, folder):
    texts = testviews.bulletins(spark, folder)
    names = texts.agg(F.max("bulletin").alias("last"), F.count(F.lit(1)).alias("n")).first()  # reads no text
    last = texts.where(F.col("bulletin") == F.lit(names["last"]))
    brief = serving.briefing(bulletins.extract(last, testviews.gazetteer(spark, folder)), F.lit(names["n"]))
    return brief.select(
        "bulletin",
        F.array_join("locations_mentioned", "|").alias("locations"),
        F.size("case_death_counts").alias("mentions"),
        F.size("paragraph_severity").alias("paragraphs"),
        F.col("most_severe_paragraph.label").alias("label"),
        F.col("most_severe_paragraph.confidence").alias("confidence"),
        F.col("most_severe_paragraph.paragraph").alias("paragraph"),
        "bulletin_count",
    )


@query
def bulletin_id_parts(spark, folder):
    name = F.col("bulletin")
    return testviews.bulletins(spark, folder).select(
        "bulletin", t.bulletin_number(name).alias("number"), t.bulletin_date(name).alias("published")
    )


@query
def json_props(spark, folder):
    props = F.from_json("props", "k BIGINT")
    return testviews.table(spark, folder, "events").select("event_id", props["k"].alias("k"))


@query
def score_tiers(spark, folder):
    latest = _shown(_latest_scores(spark, folder))
    top = F.greatest(latest.agg(F.max("anomaly_score")).scalar(), F.lit(0.0001))
    return latest.select(
        "nom",
        "anomaly_score",
        score_tier(F.col("anomaly_score"), top).alias("tier"),
        F.round(bar_percent(F.col("anomaly_score"), top), 6).alias("bar_percent"),
    )


@query
def log_features(spark, folder):
    rows = models.with_log_features(_series(spark, folder), ("cumulative_confirmed_cases", "rolling_7"))
    return rows.select(
        "nom_clean",
        "date",
        F.round("cumulative_confirmed_cases_log", 9).alias("cumulative_log"),
        F.round("rolling_7_log", 9).alias("rolling_7_log"),
    )


# --- models -----------------------------------------------------------------------------------


@query
def anomaly_scores(spark, folder):
    return _shown(_scored(spark, folder)).select("nom_clean", "date", "anomaly_score")


@query
def anomaly_scores_cascade(spark, folder):
    """The same scores by leaves of 40 points, merged, and by sums over the grid."""
    rows = checkpointed(anomaly.usable_zones(series.anomaly_inputs(_series(spark, folder), ONE_ROW)))
    pairs = anomaly.feature_pairs(rows, anomaly.is_baseline())
    model = anomaly.fit_one_class(pairs, working_set=40)
    return _shown(anomaly.anomaly_score(rows, model, pairs)).select("nom_clean", "date", "anomaly_score")


@query
def standardise_train_stats(spark, folder):
    stats = anomaly.standardiser(_split(spark, folder).where("is_train"), models.FEATURES)
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


@query
def standardised_features(spark, folder):
    rows = checkpointed(_split(spark, folder))
    stats = anomaly.standardiser(rows.where("is_train"), models.FEATURES)
    scaled = anomaly.standardise(rows, stats, models.FEATURES)
    return scaled.select("nom_clean", "date", *[F.round(f"{c}_std", 6).alias(f"{c}_std") for c in models.FEATURES])


@query
def missing_features(spark, folder):
    return models.missing_features(_labelled(spark, folder))


@query
def balanced_weights(spark, folder):
    return models.balanced_weights(_split(spark, folder).where("is_train"))


@query
def network_class_copies(spark, folder):
    """Rows of each class as the network sees them: the rarer one weighs exactly the class ratio."""
    rows = checkpointed(_split(spark, folder).where("is_train").select("date", "nom_clean", models.LABEL))
    return models.replicate_minority(rows).groupBy(models.LABEL).agg(F.count(F.lit(1)).alias("copies"))


@query
def loss_weight(spark, folder):
    return models.loss_weight(_split(spark, folder).where("is_train"))


def _train_and_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = models.dealt(
        _split(spark, folder).select("nom_clean", "date", *models.FEATURES, models.LABEL, "is_train")
    )
    return rows.where("is_train"), rows.where(~F.col("is_train"))


@query
def rf_predictions(spark, folder):
    train, test = _train_and_test(spark, folder)
    scored = models.with_probability(models.train_forest(train), test)
    return models.with_class(scored).drop("is_train")


@query
def feature_importances(spark, folder):
    train, _ = _train_and_test(spark, folder)
    return spark.createDataFrame(models.importances(models.train_forest(train)), "feature string, importance double")


@query
def forest_walk(spark, folder):
    """Test rows, and those where walking the node table and the library's own scoring differ: none."""
    train, test = _train_and_test(spark, folder)
    fitted = models.train_forest(train)
    scored = models.with_probability(fitted, test, "library")
    walked = forest.with_probability(scored, forest.nodes(fitted, spark), models.FEATURES, models.DEPTH, "walked")
    return walked.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~(F.abs(F.col("walked") - F.col("library")) < 1e-12)).alias("differing")
    )


@query
def forest_importances(spark, folder):
    """Importance of every feature from the node table: whether it is the library's, and whether they add up to 1."""
    train, _ = _train_and_test(spark, folder)
    fitted = models.train_forest(train)
    own = checkpointed(forest.importances(forest.nodes(fitted, spark), models.FEATURES))
    library = spark.createDataFrame(models.importances(fitted), "feature string, library double")
    same = F.abs(F.col("importance") - F.col("library")) < 1e-9
    all_of_it = F.abs(own.agg(F.sum("importance")).scalar() - 1) < 1e-9
    return own.join(library, "feature").select("feature", same.alias("same"), all_of_it.alias("adds_up"))


@query
def mlp_predictions(spark, folder):
    train, test = _train_and_test(spark, folder)
    scored = test.withColumn("onset_probability", network.probability(network.train(train)))
    return models.with_class(scored).drop("is_train")


@query
def network_training(spark, folder):
    """What holds for a training: its loss fell, it ended by patience or by its limit, a rerun and a stored copy agree."""
    train, test = _train_and_test(spark, folder)
    fitted = network.train(train, iterations=30)
    again = network.train(train, iterations=30)
    path = _fresh_folder(spark, "network")
    writers.write_table(network.table(fitted, spark), path)
    stored = network.from_table(spark.read.parquet(path))
    scored = test.select(
        *[network.probability(one).alias(name) for name, one in (("first", fitted), ("again", again), ("stored", stored))]
    )
    losses = fitted.losses
    ended = len(losses) == 31 or len(losses) - 1 - losses.index(min(losses)) == network.PATIENCE
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("first") != F.col("again")).alias("changed_by_rerun"),
        F.count_if(F.col("first") != F.col("stored")).alias("changed_by_storing"),
        F.count_if(~F.col("first").between(0, 1)).alias("out_of_range"),
        F.lit(fitted.own_losses[-1] < fitted.own_losses[0]).alias("loss_fell"),
        F.lit(ended).alias("ended_by_rule"),
    )


def _by_joins(rows: DataFrame, fitted: network.Network, part_rows: int = 20_000) -> DataFrame:
    """`rows` with `plain`: the forward pass of a network as joins with its table of weights and sums by unit.

    The rows are dealt by number into parts of about `part_rows`, which all joins and sums keep: the table of weights has
    some fifty rows, which go to every part, and a task holds the units of its own part only, however many rows there are.
    """
    weights = checkpointed(network.table(fitted, rows.sparkSession))
    kept = checkpointed(rows.withColumn("_row", F.monotonically_increasing_id()))
    parts = max(1, -(-kept.count() // part_rows))
    inputs = F.array(*[F.col(c).cast("double") for c in models.FEATURES])
    scale = weights.where("layer = -1").select(F.col("unit").alias("at"), F.col("weights")[0].alias("mean"), F.col("weights")[1].alias("sd"))
    values = kept.select("_row", inputs.alias("inputs")).repartition(parts, "_row")
    values = values.select("_row", F.posexplode("inputs").alias("at", "value")).join(F.broadcast(scale), "at")
    values = values.select("_row", "at", ((F.col("value") - F.col("mean")) / F.col("sd")).alias("value"))
    for layer in range(len(fitted.layers)):
        own = weights.where(F.col("layer") == layer).select("unit", "bias", F.posexplode("weights").alias("at", "weight"))
        reached = values.join(F.broadcast(own), "at").groupBy("_row", "unit").agg((F.sum(F.col("value") * F.col("weight")) + F.max("bias")).alias("value"))
        last = layer == len(fitted.layers) - 1
        value = 1 / (1 + F.exp(-F.col("value"))) if last else F.greatest("value", F.lit(0.0))
        values = reached.select("_row", F.col("unit").alias("at"), value.alias("value"))
    return kept.join(values.select("_row", F.col("value").alias("plain")), "_row").drop("_row")


@query
def network_agreement(spark, folder):
    """Rows where the native expression and a forward pass by joins with the table of weights differ: none."""
    train, test = _train_and_test(spark, folder)
    fitted = network.train(train, iterations=10)
    rows = _by_joins(test.withColumn("native", network.probability(fitted)), fitted)
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~(F.abs(F.col("native") - F.col("plain")) < 1e-12)).alias("differing")
    )


@query
def model_comparison(spark, folder):
    """Average precision of both classifiers on the test dates, next to the share of positives."""
    train, test = _train_and_test(spark, folder)
    scored = {
        "forest": models.with_probability(models.train_forest(train), test),
        "network": test.withColumn("onset_probability", network.probability(network.train(train))),
    }
    base = test.agg(F.avg(models.LABEL)).scalar()
    results = [
        metrics.average_precision(rows, models.LABEL, "onset_probability").select(
            F.lit(name).alias("model"), "average_precision", base.alias("positive_share")
        )
        for name, rows in scored.items()
    ]
    return results[0].unionByName(results[1])


def _zone_predictions(spark: SparkSession, folder: str, iterations: int = network.ITERATIONS) -> DataFrame:
    train, _ = _train_and_test(spark, folder)
    fitted, trees = network.train(train, iterations=iterations), forest.nodes(models.train_forest(train), spark)
    state = star.zone_state(testviews.health_zones(spark, folder), _facts(_series(spark, folder)))
    density = ordered.median(train, "population_density").scalar()
    scored = models.score_zones(state, network.probability(fitted), trees, density)
    return scored.withColumn("cross_border_watch", F.col("province").isin(*testviews.WATCHLIST))


@query
def zone_predictions(spark, folder):
    return _zone_predictions(spark, folder)


@query
def zone_prediction_records(spark, folder):
    """The records with what can be told without a model: probabilities are there, within 0 and 1, to four places."""
    records = _zone_predictions(spark, folder, iterations=5)
    out = {"network_valid": "next_7d_onset_probability", "forest_valid": "baseline_rf_probability"}
    valid = [(F.col(c).between(0, 1) & (F.abs(F.round(c, 4) - F.col(c)) < 1e-12)).alias(name) for name, c in out.items()]
    return records.select(*[c for c in records.columns if c not in out.values()], *valid)


@query
def zone_probability_agreement(spark, folder):
    """Zones, and those where the one native expression and the models' own scoring differ in a probability: none."""
    train, _ = _train_and_test(spark, folder)
    fitted = models.train_forest(train)
    net = network.train(train, iterations=5)
    state = star.zone_state(testviews.health_zones(spark, folder), _facts(_series(spark, folder)))
    density = ordered.median(train, "population_density").scalar()
    native = models.score_zones(state, network.probability(net), forest.nodes(fitted, spark), density)
    inputs = state.withColumn("population_density", F.coalesce("population_density", density, F.lit(0.0)))
    own = _by_joins(models.with_probability(fitted, inputs, "by_forest"), net).select("nom", "by_forest", F.col("plain").alias("by_network"))
    both = native.join(own, "nom")
    # Rounding to four places may part values that differ in the last bit.
    apart = lambda a, b: ~(F.abs(F.col(a) - F.col(b)) <= 5.1e-5)
    return both.agg(
        F.count(F.lit(1)).alias("zones"),
        F.count_if(apart("next_7d_onset_probability", "by_network")).alias("network_differs"),
        F.count_if(apart("baseline_rf_probability", "by_forest")).alias("forest_differs"),
    )


# --- sinks ------------------------------------------------------------------------------------


@query
def roundtrip_parquet(spark, folder):
    path = _fresh_folder(spark, "cases")
    writers.write_table(_series(spark, folder).drop("nom", series.DAY), path)
    return spark.read.parquet(path)


@query
def roundtrip_partitioned(spark, folder):
    path = _fresh_folder(spark, "labelled")
    writers.write_table(labelled_features(spark, folder).repartition("date"), path, partition_by=["date"])
    return spark.read.parquet(path).withColumn("date", F.col("date").cast("date"))


@query
def roundtrip_csv(spark, folder):
    path = _fresh_folder(spark, "national")
    writers.write_csv(_national(spark, folder), path)
    national = readers.csv_table(spark, path)
    return national.select("date", *[F.col(c).cast("double") for c in national.columns if c != "date"])


@query
def csv_national(spark, folder):
    """Both national series written as CSV, read back and joined."""
    paths = {name: _fresh_folder(spark, name) for name in ("cases", "deaths")}
    national = checkpointed(_national(spark, folder))
    for name, path in paths.items():
        column = f"national_cumulative_confirmed_{name}"
        writers.write_csv(national.select("date", column).where(F.col(column).isNotNull()), path)
    joined = star.national_table(
        readers.national_cases(spark, paths["cases"]), readers.national_deaths(spark, paths["deaths"])
    )
    return star.with_cfr(joined)


@query
def csv_reports(spark, folder):
    """Raw reports and aliases written as CSV, read back as text and cleaned."""
    paths = {name: _fresh_folder(spark, name) for name in ("cases", "aliases")}
    writers.write_csv(testviews.raw_cases(spark, folder), paths["cases"])
    writers.write_csv(testviews.aliases(spark, folder), paths["aliases"])
    return cleaning.clean_cases(readers.zone_cases(spark, paths["cases"]), readers.aliases(spark, paths["aliases"]))


@query
def csv_death_reports(spark, folder):
    """Raw death reports and aliases written as CSV, read back as text and cleaned."""
    paths = {name: _fresh_folder(spark, name) for name in ("deaths", "aliases")}
    writers.write_csv(testviews.raw_deaths(spark, folder), paths["deaths"])
    writers.write_csv(testviews.aliases(spark, folder), paths["aliases"])
    return cleaning.clean_deaths(readers.zone_deaths(spark, paths["deaths"]), readers.aliases(spark, paths["aliases"]))


@query
def geojson_zones(spark, folder):
    """The zones written as feature collections of some hundred features, and read back."""
    path = _fresh_folder(spark, "geojson")
    measure = lambda column, *names: F.struct(F.struct(F.col(column).alias(names[1])).alias(names[1])).alias(names[0])
    properties = F.struct(
        "nom",
        "province",
        measure("population_density", "worldpop", "pop_density"),
        measure("healthsite_density", "grid3_healthsites", "healthsite_density"),
        measure("gdp_per_capita", "gdp_pc", "gdp_pc"),
    )
    zones = testviews.health_zones(spark, folder)
    files = max(1, zones.count() // 500)
    feature = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"))
    collections = zones.groupBy(F.pmod(F.xxhash64("nom"), F.lit(files)).alias("part")).agg(F.collect_list(feature).alias("features"))
    collections.withColumn("type", F.lit("FeatureCollection")).write.partitionBy("part").json(path)
    return star.health_zones(readers.zone_features(spark, f"{path}/*/*.json"))


@query
def appended_articles(spark, folder):
    """Articles of the pages fetched over plain http are stored; the others are appended."""
    path = _fresh_folder(spark, "articles")
    pages = readers.articles(testviews.pages(spark, folder))
    named = pages.select(F.concat(F.lit("DON"), F.col("page_id").cast("string")).alias("name"), "url", "article")
    first = named.where(F.col("url").startswith("http://")).withColumn("n_chars", F.length("article"))
    writers.write_table(first, path)
    writers.append_articles(named, checkpointed(spark.read.parquet(path).select("name")), path)
    return spark.read.parquet(path).select("name", "n_chars")


@query
def bulletin_file_stems(spark, folder):
    path = F.concat(F.lit("file:/raw/who.reports/"), F.col("bulletin"), F.lit(".txt"))
    return testviews.bulletins(spark, folder).select("bulletin", t.file_stem(path).alias("stem"))


def _stored_probabilities(spark: SparkSession, folder: str) -> DataFrame:
    """Stand-in probabilities from the age of a zone, written and read back, with the class at one half."""
    path = _fresh_folder(spark, "probabilities")
    probability = (F.col("days_since_first_case") * 7919 % 1000 / 1000).alias("onset_probability")
    writers.write_table(_labelled(spark, folder).select("nom_clean", "date", models.LABEL, probability), path)
    return models.with_class(spark.read.parquet(path))


@query
def stored_probabilities(spark, folder):
    rows = _stored_probabilities(spark, folder)
    return rows.withColumn("shown", F.bround("onset_probability", 2)).select("nom_clean", "date", "shown", "predicted")


@query
def stored_probabilities_confusion(spark, folder):
    return metrics.confusion_matrix(_stored_probabilities(spark, folder), models.LABEL, "predicted")


@query
def reloaded_models(spark, folder):
    """Rows whose prediction changes when a model is saved and loaded: none."""
    train, test = _train_and_test(spark, folder)
    stats = anomaly.standardiser(train, models.FEATURES)
    inputs = {"forest": test, "network": anomaly.standardise(test, stats, models.FEATURES)}
    fitted = {"forest": models.train_forest(train), "network": models.train_network(train)}
    parts = []
    for name, model in fitted.items():
        path = _fresh_folder(spark, name)
        models.save_model(model, path)
        before = models.with_probability(model, inputs[name])
        both = models.with_probability(models.load_model(path), before, "again")
        parts.append(
            both.agg(
                F.lit(name).alias("model"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(~F.col("again").eqNullSafe(F.col("onset_probability"))).alias("changed"),
            )
        )
    return parts[0].unionByName(parts[1])


@query
def roundtrip_json(spark, folder):
    path = _fresh_folder(spark, "extractions")
    views = testviews.bulletins(spark, folder), testviews.gazetteer(spark, folder)
    writers.write_extractions(bulletins.extract(*views), path)
    stored = readers.extractions(spark, path)

    def part(name: str, field: str, *columns) -> DataFrame:
        rows = stored.select("bulletin", F.lit(name).alias("part"), F.posexplode(field).alias("pos", "m"))
        return rows.select("bulletin", "part", "pos", *[c.alias(n) for n, c in zip(("name", "number", "body"), columns)])

    m, nothing = F.col("m"), F.lit(None)
    return (
        part("count", "case_death_counts", m["type"], m["value"].cast("double"), m["context"])
        .unionByName(part("place", "locations_mentioned", m, nothing.cast("double"), nothing.cast("string")))
        .unionByName(part("paragraph", "paragraph_severity", m["label"], m["confidence"], m["paragraph"]))
    )


@query
def star_tables_sql(spark, folder):
    """Three written tables, joined by SQL on their registered names."""
    names = ("health_zones", "daily_cases", "anomaly_scores")
    writers.replace_tables(dict(zip(names, _star(spark, folder))), _fresh_folder(spark, "star"))
    return spark.sql(
        """
        SELECT province, COUNT(*) AS zone_days, COUNT(DISTINCT nom) AS zones, ROUND(MAX(anomaly_score), 6) AS max_score
        FROM anomaly_scores JOIN daily_cases USING (nom, date) JOIN health_zones USING (nom)
        GROUP BY province
        """
    )


@query
def star_versions(spark, folder):
    """Rows of the three tables after a replacement that fails at the last of them: those of the version before."""
    path = _fresh_folder(spark, "star")
    tables = dict(zip(("health_zones", "daily_cases", "anomaly_scores"), _star(spark, folder)))
    writers.replace_tables(tables, path)
    broken = {name: df.limit(0) for name, df in tables.items()}
    broken["anomaly_scores"] = tables["anomaly_scores"].withColumn("nom", F.raise_error(F.lit("lost")).cast("string"))
    try:
        writers.replace_tables(broken, path)
        failed = False
    except PySparkException:
        failed = True
    current = readers.current_tables(spark, path, list(tables))
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.lit(failed).alias("replacement_failed"))
        for name, df in current.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def bulletin_files(spark, folder):
    """Bulletins written as one text file each and read back whole: name, length and paragraphs of every file."""
    path = _fresh_folder(spark, "bulletins")
    texts = testviews.bulletins(spark, folder)
    writers.write_bulletins(texts, path)
    read = readers.bulletins(spark, path, partitioned=True)
    return read.select("bulletin", F.length("text").alias("n_chars"), F.size(t.paragraphs(F.col("text"))).alias("n_paragraphs"))


@query
def manifest_entries(spark, folder):
    """A manifest of all pages: number and date out of every name, and whether the page is stored already."""
    pages = testviews.pages(spark, folder)
    date = F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 300).cast("int")), "yyyy-MM-dd")
    name = F.concat(F.lit("DON"), F.col("page_id").cast("string"), F.lit("_"), date)
    entries = readers.manifest(pages.select(name.alias("name"), "url"))
    stored = pages.where(F.col("url").startswith("http://")).select(name.alias("name"))
    fresh = star.only_new(entries, stored).select("name", F.lit(True).alias("is_new"))
    return entries.join(fresh, "name", "left").select("name", "number", "published", F.coalesce("is_new", F.lit(False)).alias("is_new"))


@query
def file_integrity(spark, folder):
    files = readers.file_integrity(spark, f"{folder.rstrip('/')}/*.parquet")
    return files.select(t.file_stem(F.col("path")).alias("table_name"), "length", "looks_broken")
