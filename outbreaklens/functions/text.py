"""Text columns: stripping, number and date repair, count mentions, paragraphs, severity."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and \s treat as white space, as a class and as a text.
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Texts that a default pandas CSV read takes for a missing cell.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"

# The two mention patterns of the bulletins; a digit is any decimal digit.
CASE_MENTION = rf"(?i)(\p{{Nd}}[\p{{Nd}},]*){SPACE}+(?:confirmed{SPACE}+|suspected{SPACE}+)?cases?"
DEATH_MENTION = rf"(?i)(\p{{Nd}}[\p{{Nd}},]*){SPACE}+deaths?"
# Decimal digits of other scripts, and the ASCII digit of each.
OTHER_DIGITS = "".join(c for c in map(chr, range(0x80, 0x10000)) if c.isdecimal())
ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in OTHER_DIGITS)
CONTEXT_BEFORE = 60
CONTEXT_AFTER = 20

PARAGRAPH_MIN_CHARS = 60
PREVIEW_CHARS = 150

# The three severity labels, mildest first.
ROUTINE = "routine update"
ESCALATION = "concerning escalation"
EMERGENCY = "emergency-level crisis"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once, however often `use` mentions it."""
    return F.transform(F.array(value), use)[0]


def strip(c: Column) -> Column:
    """Drop leading and trailing Unicode white space (`trim` drops plain blanks only)."""
    return F.btrim(c, F.lit(SPACES))


def null_if_missing(c: Column) -> Column:
    return F.when(~c.isin(NULL_TOKENS), c)


def is_number(c: Column) -> Column:
    return strip(c).rlike(NUMBER)


def to_number(c: Column) -> Column:
    """Number or NULL. The pattern keeps out what Spark's cast takes but a CSV number is not ("17d")."""
    return F.when(is_number(c), strip(c).try_cast("double"))


def clean_date_text(c: Column) -> Column:
    """Strip blanks, then `]`, then `[`, then blanks again."""
    return strip(F.btrim(F.btrim(strip(c), F.lit("]")), F.lit("[")))


def date_or_error(c: Column, *repaired: Column) -> Column:
    """Date of a text, or of the first repaired form that is one; a text that is no date raises."""
    wrong = F.raise_error(F.concat(F.lit("not a date: "), c)).cast("date")
    return F.coalesce(*[form.try_cast("date") for form in (c, *repaired)], F.when(c.isNotNull(), wrong))


def _digits(number: Column) -> Column:
    """A number without commas, in ASCII digits."""
    # Characters without a partner are dropped, hence the comma at the end.
    converted = F.translate(number, OTHER_DIGITS + ",", ASCII_DIGITS)
    return F.when(number.rlike("[^0-9,]"), converted).otherwise(F.translate(number, ",", ""))


def _joined(parts: list[Column]) -> Column:
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])


def _mentions(text: Column, pattern: str, kind: str) -> Column:
    """Array of (value, type, context) for every match of `pattern`, in text order.

    The context is cut from the pieces next to a match, the texts between matches shortened to what a context can
    hold, so a text of many mentions takes time in proportion to its length.
    """
    # A match has six characters at least ("1 case"): so many of them can lie inside a context.
    back, ahead = CONTEXT_BEFORE // 6, CONTEXT_AFTER // 6 + 1

    def records(whole: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            def with_ends(tails: Column) -> Column:
                def with_heads(heads: Column) -> Column:
                    def record(match: Column, i: Column) -> Column:
                        before = [part for k in range(back, 0, -1) for part in (F.get(tails, i - k), F.get(whole, i - k))]
                        after = [part for k in range(1, ahead + 1) for part in (F.get(heads, i + k), F.get(whole, i + k))]
                        context = F.concat(
                            F.right(_joined([*before, F.get(tails, i)]), F.lit(CONTEXT_BEFORE)),
                            match,
                            F.left(_joined(after), F.lit(CONTEXT_AFTER)),
                        )
                        return F.struct(
                            _digits(F.regexp_extract(match, r"^[\p{Nd},]+", 0)).try_cast("bigint").alias("value"),
                            F.lit(kind).alias("type"),
                            F.concat(F.lit("..."), strip(F.translate(context, "\n", " ")), F.lit("...")).alias("context"),
                        )

                    return F.transform(whole, record)

                return bind(F.transform(gaps, lambda gap: F.left(gap, F.lit(CONTEXT_AFTER))), with_heads)

            return bind(F.transform(gaps, lambda gap: F.right(gap, F.lit(CONTEXT_BEFORE))), with_ends)

        return bind(F.split(text, pattern, -1), with_gaps)

    return bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), records)


def count_mentions(text: Column) -> Column:
    """Every "N cases" mention, then every "N deaths" mention."""
    return F.concat(_mentions(text, CASE_MENTION, "cases"), _mentions(text, DEATH_MENTION, "deaths"))


def paragraphs(text: Column, min_chars: int = PARAGRAPH_MIN_CHARS) -> Column:
    """Stripped lines longer than `min_chars`."""
    lines = F.transform(F.split(text, "\n", -1), strip)
    return F.filter(lines, lambda line: F.length(line) > min_chars)


def preview(c: Column, chars: int = PREVIEW_CHARS) -> Column:
    return F.when(F.length(c) > chars, F.concat(F.substring(c, 1, chars), F.lit("..."))).otherwise(c)


def file_stem(name: Column) -> Column:
    return F.regexp_extract(name, r"([^/]+)\.[^./]+$", 1)


def bulletin_number(name: Column) -> Column:
    return F.regexp_extract(name, r"^([A-Z]+[0-9]+)_", 1)


def bulletin_date(name: Column) -> Column:
    return F.to_date(F.regexp_extract(name, r"_([0-9]{4}-[0-9]{2}-[0-9]{2})", 1))


# Word stems that speak for each label, and the weight a label has before any stem is seen.
SEVERITY_TERMS = {
    ROUTINE: "update|routine|recover|follow-up|monitor|discharged",
    ESCALATION: "increas|escalat|spread|rising|expand|surge|intensif|additional",
    EMERGENCY: "emergenc|crisis|death|fatal|mortality|international concern",
}
# The same stems behind a look at the first letter, which spares most places of a text the tries of every stem.
SEVERITY_PATTERNS = {
    name: f"(?i)(?=[{''.join(sorted({stem[0] for stem in stems.split('|')}))}])(?:{stems})" for name, stems in SEVERITY_TERMS.items()
}
SEVERITY_PRIOR = {ROUTINE: 1.0, ESCALATION: 0.5, EMERGENCY: 0.5}


def paragraph_severity(text: Column, shorten: bool = True) -> Column:
    """Array of (paragraph, label, confidence), in text order.

    The label is the one with the largest share of prior weight plus stem hits. Every stage is its
    own `transform`, so each regular expression runs once per paragraph.
    """
    names = (ROUTINE, ESCALATION, EMERGENCY)

    def hits(paragraph: Column, name: str) -> Column:
        return F.lit(SEVERITY_PRIOR[name]) + F.regexp_count(paragraph, F.lit(SEVERITY_PATTERNS[name]))

    weighed = F.transform(
        paragraphs(text),
        lambda p: F.struct(
            (preview(p) if shorten else p).alias("paragraph"),
            *[hits(p, name).alias(f"w{i}") for i, name in enumerate(names)],
        ),
    )

    def judged(p: Column) -> Column:
        weights = [p[f"w{i}"] for i in range(len(names))]
        best = F.greatest(*weights)
        label = F.lit(names[0])
        for name, weight in zip(names[1:], weights[1:]):
            label = F.when(weight == best, F.lit(name)).otherwise(label)
        return F.struct(
            p["paragraph"].alias("paragraph"),
            label.alias("label"),
            F.round(best / sum(weights[1:], weights[0]), 3).alias("confidence"),
        )

    return F.transform(weighed, judged)


def most_severe(judged: Column) -> Column:
    """The emergency paragraph with the highest confidence; the first paragraph when there is none."""
    keyed = F.transform(
        judged,
        lambda p, i: F.struct(
            F.when(p["label"] == EMERGENCY, p["confidence"]).otherwise(F.lit(0.0)).alias("key"),
            (-i).alias("order"),
            p.alias("entry"),
        ),
    )
    return F.array_max(keyed)["entry"]


def largest(mentions: Column, kind: str) -> Column:
    """Largest value among the mentions of one type, NULL when there is none."""
    return F.array_max(F.transform(F.filter(mentions, lambda m: m["type"] == kind), lambda m: m["value"]))


def largest_mention(mentions: Column) -> Column:
    """The mention with the largest value, the first of equals; NULL when there is none."""
    keyed = F.transform(mentions, lambda m, i: F.struct(m["value"].alias("key"), (-i).alias("order"), m.alias("entry")))
    return F.array_max(keyed)["entry"]


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}\p{N}_'’-]+"), F.lit(0))


def word_grams(text: Column, max_words: int, first_words: list[str] | None = None) -> Column:
    """Distinct words, and runs of 2..max_words words joined by one blank.

    With `first_words`, only runs that begin with one of them.
    """

    def runs(tokens: Column) -> Column:
        grams, longer = tokens, tokens
        if first_words is not None:
            longer = F.transform(tokens, lambda word: F.when(word.isin(first_words), word))
        for n in range(2, max_words + 1):
            # The shorter side is padded with NULL, so a run that would pass the end becomes NULL.
            following = F.slice(tokens, F.lit(n), F.size(tokens))
            longer = F.zip_with(longer, following, lambda run, word: F.concat(run, F.lit(" "), word))
            grams = F.concat(grams, longer)
        return F.array_compact(F.array_distinct(grams))

    return bind(word_tokens(text), runs)
