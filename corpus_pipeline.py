"""Documents to token ids in five stages: language, near-duplicates, repeated passages, mixture, tokens.

Each stage takes documents and returns documents, the last one with their token ids. `run` writes what a stage
returns as Parquet to the shared folder of `spark.checkpoint.dir`, reads it again for the next one, and removes it
when the next one is written.

Rows are told apart by a SHA-256 of all their columns: different rows may share an id or have none, and all of them stay
that no stage has a reason to drop. Columns beyond those of the stage's operator are joined back by that key, so they stay
as they are, whatever their types and names.

Null, empty and letterless texts are no language, so the first stage drops them; where a later stage is used alone,
null and empty texts are one group of near-duplicates, lose no passage, are not mixed in and have no tokens. Empty tables
go through every stage. A single text has to fit into one task. Names that begin with two underscores are taken.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outbreaklens.llm import bpe, langid, mixing, simhash, substrings, warc
from outbreaklens.llm.batches import bound_batches
from outbreaklens.llm.quality import words
from outbreaklens.session import checkpointed

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
ROW_KEY = "__row_key"
ADDED = "__added"
REMOVED = "__removed"


def _spelled(column: Column, kind: T.DataType) -> Column:
    """A value as text that no other value of its type has: lengths in front, so that parts cannot run together."""
    if isinstance(kind, T.StructType):
        parts = [_spelled(column.getField(field.name), field.dataType) for field in kind.fields]
        text = F.concat(F.lit("{"), *parts, F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(column, lambda x: _spelled(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return _spelled(F.map_entries(column), T.ArrayType(entry))
    else:
        plain = F.hex(column) if isinstance(kind, T.BinaryType) else column.cast("string")
        text = F.concat(F.length(plain).cast("string"), F.lit(":"), plain)
    return F.when(column.isNull(), F.lit("n")).otherwise(text)


def _row_key(docs: DataFrame) -> Column:
    """SHA-256 of the whole row: rows of one key are the same row."""
    columns = [_spelled(F.col(f"`{field.name}`"), field.dataType) for field in docs.schema.fields]
    return F.unhex(F.sha2(F.concat(*columns), 256))


def _once(keyed: DataFrame) -> DataFrame:
    """Keyed rows with each key once. Rows that stand there again are rare, and only then anything is aggregated."""
    names = [name for name in keyed.columns if name != ROW_KEY]
    repeated = keyed.select(ROW_KEY).groupBy(ROW_KEY).count().where("count > 1")
    if repeated.isEmpty():
        return keyed
    rows = keyed.groupBy(ROW_KEY).agg(F.first(F.struct(*[F.col(f"`{name}`") for name in names])).alias(ADDED))
    # Stored, so that no aggregation stands between a join and its exchange: AQE then splits a frequent key.
    return checkpointed(rows).select(*[F.col(f"{ADDED}.`{name}`") for name in names], ROW_KEY)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a clear margin; the others go."""
    bound_batches(spark)
    model = langid.fit(docs.where(~langid.held_out()))
    judged = docs.withColumn(ADDED, langid.predict("text", model))
    return judged.where(~F.col(f"{ADDED}.rejected")).drop(ADDED)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group linked by SimHash fingerprints: that of the smallest id, then of the least row hash."""
    bound_batches(spark)
    keyed = docs.withColumn(ROW_KEY, _row_key(docs))
    order = F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"), F.col(ROW_KEY).alias("row"))
    prints = checkpointed(keyed.select(order.alias("least"), simhash.fingerprints("text").alias("fp")))
    classes = checkpointed(prints.groupBy("fp").agg(F.min("least").alias("least")))
    stay = checkpointed(
        simhash.with_components(classes).groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.row").alias(ADDED))
    )
    # A kept row that stands there again is a copy of itself.
    return _once(keyed.join(stay, F.col(ROW_KEY) == F.col(ADDED), "left_semi")).drop(ROW_KEY)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of a smaller id holds; those left empty by that go."""
    bound_batches(spark)
    keyed = docs.withColumn(ROW_KEY, _row_key(docs))
    found = substrings.remove_repeats(keyed, carry=F.hex(ROW_KEY)).where("n_removed = 0 or n_removed < n_words")
    left = found.select(F.unhex("carried").alias(ROW_KEY), F.col("kept_text").alias(ADDED), F.col("n_removed").alias(REMOVED))
    others = _once(keyed.drop("text"))
    made = {
        "text": F.col(ADDED),
        "n_chars": F.when(F.col(REMOVED) == 0, F.col("n_chars")).otherwise(F.length(ADDED)).cast(docs.schema["n_chars"].dataType),
    }
    return left.join(others, ROW_KEY).select(*[made.get(name, F.col(f"`{name}`")).alias(name) for name in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix holds them: the words of their drawn blocks, a row for every pass over their source.

    In a whole pass a document stands there as it is. In the last pass of a source it holds the words whose blocks were
    drawn for some shard, joined by one space; if that is none, it is not there.
    """
    keyed = docs.withColumn(ROW_KEY, _row_key(docs))
    taken = mixing.copies(keyed, ROW_KEY).select(F.col(ROW_KEY).alias(ADDED), "size", "spans")
    mixed = _once(keyed).alias("d").join(taken.alias("t"), F.col(f"d.{ROW_KEY}") == F.col(f"t.{ADDED}"))
    whole = F.aggregate("t.spans", F.lit(0).cast("long"), lambda n, span: n + span["n_words"]) == F.col("t.size")
    # The words are an argument of the function, so a text is cut into words once and not once a span.
    spans_of = lambda tokens: F.flatten(
        F.transform("t.spans", lambda span: F.slice(tokens, (span["first"] + 1).cast("int"), span["n_words"].cast("int")))
    )
    drawn = F.element_at(F.transform(F.array(words("d.text")), spans_of), 1)
    text = F.when(whole, F.col("d.text")).otherwise(F.array_join(drawn, " "))
    made = {
        "text": text,
        "n_chars": F.when(whole, F.col("d.n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType),
    }
    return mixed.select(*[made.get(name, F.col(f"d.`{name}`")).alias(name) for name in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and the digest of the bytes decoded from them."""
    bound_batches(spark)
    coded = docs.withColumn(ADDED, bpe.round_trip("text", RANK_FILE, public_tokenizers.PATTERN))
    return coded.select(
        *[F.col(f"`{name}`") for name in docs.columns],
        F.col(f"{ADDED}.ids").alias("token_ids"),
        F.size(f"{ADDED}.ids").cast("long").alias("n_tokens"),
        F.sha2(F.col(f"{ADDED}.decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", remove_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("source_mixing", mix_sources),
    ("bpe_encoding", encode_tokens),
]

# Compression, SimHash and BPE have no SQL form; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        folder = warc.scratch_folder(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            _removed(spark, before)
        before = folder
    return docs


def _removed(spark: SparkSession, folder: str) -> None:
    """Take away a folder that `run` wrote and nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
