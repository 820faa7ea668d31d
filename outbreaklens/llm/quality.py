"""Quality rules: a threshold table compiled into one projection of native columns.

Words are runs of characters other than the six ASCII white-space characters. A document fails the base rules
with fewer than ten words or when repeated five-word windows cover more than a fifth of them. The rest of the
verdict comes from `THRESHOLDS`: length, symbol, stop-word and line ratios, each with a lower and an upper bound.

A null or empty text has no words and fails. Every row is judged by itself, so repeated rows get equal verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of the languages the tables hold.
STOP_WORDS = (
    "the of and to in is that with as for on by from it be this are was an at "
    "le la les de des du un une et en que qui dans pour au pas sur est "
    "der die das den dem ein eine und zu mit von für auf im ist nicht "
    "el los las del y por con para se una como más su al lo no"
).split()


@dataclass(frozen=True)
class Threshold:
    """`low <= numerator / denominator <= high`; a bound of None does not bind."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


THRESHOLDS = (
    Threshold("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    Threshold("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Threshold("stop_words", "n_stop_words", "n_words", 0.01, None),
    Threshold("duplicate_lines", "n_dup_lines", "n_lines", None, 0.3),
    Threshold("words_with_letter", "n_letter_words", "n_words", 0.8, None),
    Threshold("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.3),
    Threshold("bullet_lines", "n_bullet_lines", "n_lines", None, 0.9),
)


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _count(items: Column, test) -> Column:
    return F.size(F.filter(items, test)).cast("long")


def words(text: str) -> Column:
    # A single plain character splits without a regular expression.
    spaced = F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, " " * len(SPACES))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def lines_with_word(text: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda one: F.trim(one, F.lit(SPACES)) != "")


def repeat_words(tokens: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of `window` words that the text holds twice or more.

    Most texts repeat no window, which the number of distinct hashes shows. For the others windows are sorted
    together with their place, so equal ones stand side by side; the places of the repeated ones, in order, then
    cover `min(window, distance to the next)` words each. n log n for any text.
    """

    def of(found: Column) -> Column:
        def part(i: Column) -> list[Column]:
            return [F.get(found, i + k) for k in range(window)]

        # Two windows count as equal when two independent hashes, 96 bits in all, agree.
        def placed(hashes: Column) -> Column:
            return F.sort_array(
                F.transform(
                    hashes, lambda a, i: F.struct(a.alias("a"), F.hash(*reversed(part(i))).alias("b"), i.alias("at"))
                )
            )

        def repeated(order: Column) -> Column:
            def same(one: Column, other: Column) -> Column:
                return F.coalesce((one["a"] == other["a"]) & (one["b"] == other["b"]), F.lit(False))

            twice = F.filter(
                order, lambda one, j: same(one, F.get(order, j - 1)) | same(one, F.get(order, j + 1))
            )
            return F.sort_array(F.transform(twice, lambda one: one["at"]))

        def covered(places: Column) -> Column:
            steps = F.transform(
                places,
                lambda at, j: F.least(F.lit(window), F.coalesce(F.get(places, j + 1) - at, F.lit(window))),
            )
            return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

        def counted(hashes: Column) -> Column:
            return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
                _bound(placed(hashes), lambda order: _bound(repeated(order), covered))
            )

        starts = F.sequence(F.lit(0), F.size(found) - window)
        return F.when(F.size(found) <= window, F.lit(0).cast("long")).otherwise(
            _bound(F.transform(starts, lambda i: F.xxhash64(*part(i))), counted)
        )

    return _bound(tokens, of)


def verdict(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """All bounds of a threshold table as one condition over the counts."""
    kept = F.lit(True)
    for rule in thresholds:
        ratio = F.col(rule.numerator) / F.greatest(F.col(rule.denominator), F.lit(1))
        if rule.low is not None:
            kept = kept & (ratio >= rule.low)
        if rule.high is not None:
            kept = kept & (ratio <= rule.high)
    return kept


def quality(
    df: DataFrame, key: str = "doc_id", text: str = "text", thresholds: tuple[Threshold, ...] = THRESHOLDS
) -> DataFrame:
    """Counts and verdict of every row of `df`; other columns are not read."""
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    cut = source.select("key", "text", words("text").alias("words"), lines_with_word("text").alias("lines"))
    stop = sorted(set(STOP_WORDS))
    plain = F.coalesce(F.col("text"), F.lit(""))
    counted = cut.select(
        "key",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(plain, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(plain) - F.length(F.translate(plain, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _count(F.col("words"), lambda w: F.lower(w).isin(stop)).alias("n_stop_words"),
        _count(F.col("words"), lambda w: w.rlike(r"\p{L}")).alias("n_letter_words"),
        _count(F.col("lines"), lambda one: one.rlike(r"(\.\.\.|…)\s*$")).alias("n_ellipsis_lines"),
        _count(F.col("lines"), lambda one: one.rlike(r"^\s*[-•*]\s")).alias("n_bullet_lines"),
    )
    judged = counted.withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    )
    return judged.select(
        F.col("key").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & verdict(thresholds)).alias("kept"),
        "n_lines",
        "n_stop_words",
        "n_letter_words",
        "n_ellipsis_lines",
        "n_bullet_lines",
    )
