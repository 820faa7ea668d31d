"""Language identification by compression: the language whose sample text helps zstandard most wins.

Every learned language has a raw-content dictionary, cut from sampled texts of that language. A text, in lower case
and in pieces of `PIECE_BYTES`, is compressed with each dictionary; the smallest sum names the language, ties go to
the smaller name. Pieces keep a long text from being its own dictionary; whole texts are read, however long. Sizes are
whole bytes, too coarse for a few words: a text of at most `SHORT_BYTES` is measured from each of its bytes on, and
the sizes are added. The score is the margin to the second best, between 0 and 1. Where the margin is narrow the
prediction is marked as rejected.

The fit is bounded: at most `SAMPLE_TEXTS` different texts a language, those with the smallest hash of the text, so
that neither an id nor a text that fills a third of the rows fills the sample, and `DICTIONARY_BYTES` of them. Beyond
`LANGUAGES` languages both shrink with their number, so that a model stays under `LANGUAGES` * `DICTIONARY_BYTES`
(a language keeps 1 KiB at least). A sampled text is cut to the size of a dictionary, and sampling of a language ends
once `SPARE` dictionaries are full, both in Spark: the driver gets no more than (`SPARE` + 1) dictionaries a language.
Wrong labels would bring whole foreign texts into a dictionary. So lines that the sample holds under several languages
go; then the sample is cut in halves, and texts go that the other half's dictionaries assign to another language.
Prediction reads texts only.

A text that is null or has no letter is `und` with score 0 and rejected, and so is every text when nothing
could be learned, from an empty table for one. Rows without text or language teach nothing. Repeated rows are each
predicted, and teach once. Columns but id, text and language are not read, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from outbreaklens.session import checkpointed

UNKNOWN = "und"
SAMPLE_TEXTS = 300
DICTIONARY_BYTES = 192 * 1024
LANGUAGES = 256  # with full samples and dictionaries; more share what these may hold, 48 MiB
LEAST_BYTES = 1024  # of a dictionary, however many languages there are
SPARE = 4  # dictionaries that a sample fills, before lines and texts are taken out
PIECE_BYTES = 2048
SHORT_BYTES = 128
LAST_BYTES = 4  # shorter ends of a short text are not measured
LEVEL = 6
MARGIN = 0.003  # of the second smallest size; a narrower lead is rejected
PREDICTION = "struct<lang_pred:string,score:double,rejected:boolean>"
HAS_LETTER = r"\p{L}"

Model = tuple[tuple[str, bytes], ...]


def sample(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    sample_texts: int = SAMPLE_TEXTS,
    dictionary_bytes: int = DICTIONARY_BYTES,
    languages: int = LANGUAGES,
) -> tuple[dict[str, list[str]], int]:
    """Texts by language, in the order of their hashes, and the bytes a dictionary may have."""
    known = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(text).alias("draw"), F.col(text).alias("text")
    )
    lowest = Window.partitionBy("lang").orderBy("draw")
    # Hashes first, one of each: texts are read in a second scan that keeps the sampled ones only.
    chosen = checkpointed(
        known.select("lang", "draw").distinct().withColumn("place", F.row_number().over(lowest)).where(F.col("place") <= sample_texts)
    )
    n = chosen.agg(F.count_distinct("lang")).first()[0]
    if n > languages:
        sample_texts = max(8, sample_texts * languages // n)
        dictionary_bytes = max(LEAST_BYTES, dictionary_bytes * languages // n)
    before = lowest.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        # The side is bounded: `sample_texts` rows of some 30 bytes a language.
        known.join(F.broadcast(chosen.where(F.col("place") <= sample_texts).select("lang", "draw")), ["lang", "draw"])
        # A long text fills a dictionary alone: no more of it is needed.
        .select("lang", "draw", F.substring("text", 1, dictionary_bytes).alias("text"))
        .groupBy("lang", "draw")
        .agg(F.min("text").alias("text"))
        .withColumn("filled", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)))
        .where(F.col("filled") < SPARE * dictionary_bytes)
        .select("lang", "draw", "text")
        .collect()
    )
    found: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda row: (row["lang"], row["draw"])):
        found.setdefault(row["lang"], []).append(row["text"])
    return found, dictionary_bytes


def fit(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    sample_texts: int = SAMPLE_TEXTS,
    dictionary_bytes: int = DICTIONARY_BYTES,
    languages: int = LANGUAGES,
) -> Model:
    """Dictionaries of the languages in `df`, from a bounded sample; stores the hashes of the sampled texts."""
    texts, dictionary_bytes = sample(df, text, lang, sample_texts, dictionary_bytes, languages)
    return cleaned(texts, dictionary_bytes)


def cleaned(sample: dict[str, list[str]], dictionary_bytes: int) -> Model:
    """Dictionaries without lines of several languages and without texts that look mislabelled."""
    under: dict[str, set[str]] = {}
    for name, own in sample.items():
        for line in {line for text in own for line in text.split("\n")}:
            under.setdefault(line, set()).add(name)
    sample = {
        name: ["\n".join(line for line in text.split("\n") if len(under[line]) == 1) for text in own]
        for name, own in sample.items()
    }
    halves = [_model({name: own[half::2] for name, own in sample.items()}, dictionary_bytes) for half in (0, 1)]
    agreed = {
        name: [text for i, text in enumerate(own) if predict_text(halves[1 - i % 2], text)[0] == name]
        for name, own in sample.items()
    }
    return _model({name: agreed[name] or own for name, own in sample.items()}, dictionary_bytes)


def _model(sample: dict[str, list[str]], dictionary_bytes: int) -> Model:
    joined = {name: "\n".join(texts).lower().encode()[:dictionary_bytes] for name, texts in sample.items()}
    return tuple((name, joined[name]) for name in sorted(joined) if joined[name])


@lru_cache(maxsize=2)
def _compressors(model: Model, level: int) -> list[tuple[str, zstandard.ZstdCompressor]]:
    found = []
    for name, content in model:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=level)
        found.append(
            (
                name,
                zstandard.ZstdCompressor(
                    level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
                ),
            )
        )
    return found


def _parts(text: str) -> list[bytes]:
    """What is compressed of a text: its pieces, or every end of a short one, with a space on both sides."""
    data = text.lower().encode()
    if len(data) > SHORT_BYTES:
        return [data[at : at + PIECE_BYTES] for at in range(0, len(data), PIECE_BYTES)]
    data = b" " + data + b" "
    return [data[at:] for at in range(max(1, len(data) - LAST_BYTES + 1))]


def predict_text(model: Model, text: str, margin: float = MARGIN, level: int = LEVEL) -> tuple[str, float, bool]:
    if not model:
        return UNKNOWN, 0.0, True
    parts = _parts(text)
    sizes = sorted((sum(len(one.compress(part)) for part in parts), name) for name, one in _compressors(model, level))
    best, name = sizes[0]
    lead = (sizes[1][0] - best) / max(sizes[1][0], 1) if len(sizes) > 1 else 1.0
    return name, lead, lead < margin


def predict(text: Column | str, model: Model, margin: float = MARGIN, level: int = LEVEL) -> Column:
    """Language, score and rejection of a text column."""
    text = F.col(text) if isinstance(text, str) else text

    @F.arrow_udf(PREDICTION)
    def run(texts: pa.Array, lettered: pa.Array) -> pa.Array:
        found = [
            predict_text(model, one, margin, level) if judged else (UNKNOWN, 0.0, True)
            for one, judged in zip(texts.to_pylist(), lettered.to_pylist())
        ]
        return pa.StructArray.from_arrays(
            [
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([x[2] for x in found], pa.bool_()),
            ],
            ["lang_pred", "score", "rejected"],
        )

    return run(text, F.coalesce(text.rlike(HAS_LETTER), F.lit(False)))


def held_out(key: str = "doc_id") -> Column:
    """True for the rows the fit must not see; a null id belongs to them."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Prediction for every row of `df`; other columns are not read."""
    judged = df.select(F.col(key), held_out(key).alias("held_out"), predict(text, model).alias("found"))
    return judged.select(key, "held_out", "found.lang_pred", "found.score", "found.rejected")
