"""Bulletin extraction: places, counts, severity, and the nested record per bulletin."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outbreaklens.functions import text as t
from outbreaklens.functions.display import severity_class
from outbreaklens.session import checkpointed
from outbreaklens.sources.schemas import EXTRACTION

RECORD = T.StructType([field for field in EXTRACTION.fields if field.name in ("case_death_counts", "paragraph_severity")])
BROADCAST_NAMES = 200_000
FILTER_BITS = 1 << 26
FILTER_HASHES = 2
FIRST_WORDS = 1_000  # up to so many, word runs are built only where a longer name can begin


def mentions(bulletins: DataFrame) -> DataFrame:
    """One row per count mention, in order."""
    return bulletins.select("bulletin", F.posexplode(t.count_mentions(F.col("text"))).alias("pos", "m")).select(
        "bulletin", "pos", "m.*"
    )


def bulletin_paragraphs(bulletins: DataFrame) -> DataFrame:
    """One row per paragraph that is long enough to judge."""
    return bulletins.select("bulletin", F.posexplode(t.paragraphs(F.col("text"))).alias("pos", "paragraph"))


def _bits_of(gram: Column, bits: int) -> list[Column]:
    """The places of a word run in a filter of so many bits."""
    return [F.pmod(F.xxhash64(F.lit(seed), gram), F.lit(bits)) for seed in range(FILTER_HASHES)]


def _name_filter(names: DataFrame, bits: int) -> Column:
    """A filter of the names' word runs as a scalar: an array of `bits` / 64 numbers."""
    spark = names.sparkSession
    places = names.select(F.explode(F.array(*_bits_of(F.col("gram"), bits))).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))
    set_bits = places.groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(one).alias("held"))
    every = spark.range(bits // 64).join(set_bits, F.col("id") == F.col("word"), "left")
    packed = every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("held", F.lit(0).cast("long")).alias("held")))).alias("words"))
    return packed.select(F.transform("words", lambda w: w["held"])).scalar()


def _names_and_runs(bulletins: DataFrame, gazetteer: DataFrame, broadcast_names: int) -> tuple[DataFrame, DataFrame, Column]:
    """The bulletins, gazetteer names by word run, and the distinct word runs of a text that can name one.

    Runs jobs on the gazetteer. Of a gazetteer that is too large to broadcast, a filter of its names goes along, of at
    most `FILTER_BITS` bits however many names there are; it drops the word runs that name nothing inside the row.
    """
    gram = F.array_join(t.word_tokens(F.col("name")), " ")
    names = checkpointed(gazetteer.select(gram.alias("gram"), "name").where(F.col("gram") != "").distinct())
    words = F.split("gram", " ")
    size = names.agg(F.count(F.lit(1)).alias("names"), F.max(F.size(words)).alias("words")).first()
    first_words = None
    if (size["words"] or 1) > 1:
        starts = names.where(F.size(words) > 1).select(words[0]).distinct().limit(FIRST_WORDS + 1).collect()
        first_words = [r[0] for r in starts] if len(starts) <= FIRST_WORDS else None
    runs = t.word_grams(F.col("text"), size["words"] or 1, first_words)
    if size["names"] <= broadcast_names:
        return bulletins, F.broadcast(names), runs
    bits = min(FILTER_BITS, 1 << max(6, (size["names"] * 16).bit_length()))
    told = bulletins.withColumn("_filter", _name_filter(names, bits))

    def held(place: Column) -> Column:
        word = F.get(F.col("_filter"), F.call_function("div", place, F.lit(64)))
        return F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1

    # The filter is named once, so the projections fold into one and no row carries it.
    return told, names, F.filter(runs, lambda run: F.forall(F.array(*_bits_of(run, bits)), held))


def locations(bulletins: DataFrame, gazetteer: DataFrame, broadcast_names: int = BROADCAST_NAMES) -> DataFrame:
    """Sorted distinct place names per bulletin; bulletins without one are absent.

    Word runs become distinct within their text before they meet the gazetteer, so a frequent word
    counts once per bulletin. A gazetteer of at most `broadcast_names` names is broadcast; a larger one takes part in a
    shuffle join with the runs that pass a filter of its names. Either way, runs which name no place are
    dropped where they arise, the second time but for a few in a hundred.
    """
    bulletins, names, runs = _names_and_runs(bulletins, gazetteer, broadcast_names)
    grams = bulletins.select("bulletin", F.explode(runs).alias("gram"))
    return grams.join(names, "gram").groupBy("bulletin").agg(
        F.array_sort(F.collect_set("name")).alias("locations_mentioned")
    )


def extract(bulletins: DataFrame, gazetteer: DataFrame, broadcast_names: int = BROADCAST_NAMES) -> DataFrame:
    """The stored record of every bulletin.

    One scan of the texts: each gives a row with its counts and paragraphs, and a row for every word run, of which
    only place names are left. One aggregation brings them together.
    """
    bulletins, names, runs = _names_and_runs(bulletins, gazetteer, broadcast_names)
    record = F.struct(
        t.count_mentions(F.col("text")).alias("case_death_counts"),
        t.paragraph_severity(F.col("text")).alias("paragraph_severity"),
    )
    no_record = F.lit(None).cast(RECORD)
    rows = F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("gram"), record.cast(RECORD).alias("record"))),
        F.transform(runs, lambda run: F.struct(run.alias("gram"), no_record.alias("record"))),
    )
    told = bulletins.select("bulletin", F.explode(rows).alias("row")).select("bulletin", "row.gram", "row.record")
    placed = told.join(names, "gram", "left").where(F.col("record").isNotNull() | F.col("name").isNotNull())
    return (
        placed.groupBy("bulletin")
        .agg(F.array_sort(F.collect_set("name")).alias("locations_mentioned"), F.first("record", ignorenulls=True).alias("record"))
        .select("bulletin", "locations_mentioned", "record.case_death_counts", "record.paragraph_severity")
    )


def severity_by_model(
    paragraphs: DataFrame, make_predict: Callable, labels: list[str], batch_size: int = 64
) -> DataFrame:
    """Severity from a caller's model: `make_predict()` loads it once per Python worker and returns a
    function from a batch of texts to an array of one score per label."""
    scorer = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    scored = paragraphs.withColumn("_scores", scorer(F.col("paragraph")))
    best = F.array_max("_scores")
    names = F.array(*[F.lit(name) for name in labels])
    return scored.select(
        *paragraphs.columns,
        F.element_at(names, F.array_position("_scores", best).cast("int")).alias("label"),
        F.round(best, 3).alias("confidence"),
    )


def entities_by_model(bulletins: DataFrame, recognise: Callable[[str], list[tuple[str, str]]]) -> DataFrame:
    """Sorted distinct LOC and ORG entities per bulletin from a caller's recogniser.

    `recognise` maps a text to (word, entity group) pairs; texts reach it in Arrow batches.
    """
    @F.pandas_udf("array<struct<word:string,entity_group:string>>")
    def tagged(texts: pd.Series) -> pd.Series:
        return texts.map(lambda one: [{"word": w, "entity_group": g} for w, g in recognise(one)])

    kept = F.filter(tagged(F.col("text")), lambda e: e["entity_group"].isin("LOC", "ORG"))
    words = F.array_sort(F.array_distinct(F.transform(kept, lambda e: e["word"])))
    return bulletins.select("bulletin", words.alias("locations_mentioned"))


def headline(records: DataFrame) -> DataFrame:
    """Per record: largest counts, number of places, and the most severe paragraph with its class."""
    worst = F.col("worst")
    return records.withColumn("worst", t.most_severe(F.col("paragraph_severity"))).select(
        "bulletin",
        t.largest(F.col("case_death_counts"), "cases").alias("max_cases"),
        t.largest(F.col("case_death_counts"), "deaths").alias("max_deaths"),
        F.size("locations_mentioned").cast("bigint").alias("locations"),
        worst["paragraph"].alias("paragraph"),
        worst["label"].alias("label"),
        worst["confidence"].alias("confidence"),
        F.when(worst.isNotNull(), severity_class(worst["label"])).alias("severity_class"),
    )


def latest(records: DataFrame) -> DataFrame:
    """The last bulletin by name."""
    return records.orderBy(F.desc("bulletin")).limit(1)
