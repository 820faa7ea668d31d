import zlib

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from outbreaklens.llm import langid


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return langid.fit(documents.where(~langid.held_out()))


def test_held_out_accuracy(documents, model):
    found = langid.identify(documents, model).join(documents.select("doc_id", "lang"), "doc_id").where("held_out")
    right, rejected, n = found.agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int")), F.count("*")
    ).first()
    assert n > 150 and right > 0.97 and rejected < 0.02
    assert found.where("score < 0 or score > 1").count() == 0


def test_fit_is_bounded_and_ignores_unlabelled(spark, documents):
    model = langid.fit(documents.withColumn("source", F.lit("x")), sample_texts=3, dictionary_bytes=2000)
    assert [name for name, _ in model] == ["de", "en", "es", "fr"]
    assert all(len(content) <= 2000 for _, content in model)
    assert langid.fit(documents.withColumn("lang", F.lit(None).cast("string"))) == ()


def test_edge_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "123 ... 456"), (4, "the one of them and that is the other of the two"), (5, "la " * 300_000), (None, "and this is"), (4, "the one of them and that is the other of the two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    found = sorted(langid.identify(df, model).collect(), key=str)
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 and by_id[i]["rejected"] for i in (1, 2, 3))
    assert by_id[4]["lang_pred"] == "en" and by_id[5]["lang_pred"] in dict(model) and by_id[None]["held_out"]
    assert langid.identify(df.limit(0), model).collect() == []
    assert {r["lang_pred"] for r in langid.identify(df, ()).collect()} == {"und"}


def test_narrow_margins_are_rejected(model):
    text = model[0][1][:300].decode(errors="ignore") + model[1][1][:300].decode(errors="ignore")
    _, score, rejected = langid.predict_text(model, text, margin=0.9)
    assert rejected and score < 0.9
    assert not langid.predict_text(model, model[1][1][:2000].decode(errors="ignore"))[2]


def plain_sizes(dictionaries, text):
    """Compressed size of a text by language, written out anew."""
    data, sizes = text.lower().encode(), {}
    if len(data) <= 128:
        padded = b" " + data + b" "
        parts = [padded[at:] for at in range(len(padded)) if at == 0 or len(padded) - at >= 4]
    else:
        parts = [data[at : at + 2048] for at in range(0, len(data), 2048)]
    for name, content in dictionaries.items():
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=6)
        one = zstandard.ZstdCompressor(
            level=6, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        sizes[name] = sum(len(one.compress(part)) for part in parts)
    return sizes


def plain_choice(sizes):
    best = min(sizes, key=lambda name: (sizes[name], name))
    second = min(size for name, size in sizes.items() if name != best)
    return best, (second - sizes[best]) / second


def plain_fit(rows, texts=300, size=192 * 1024):
    """Dictionaries from (lang, text) rows, written out anew."""

    def joined(sample):
        return {name: "\n".join(own).lower().encode()[:size] for name, own in sample.items()}

    def signed(text):
        return (xxhash.xxh64_intdigest(text.encode(), 42) + 2**63) % 2**64

    sample = {}
    for name in {lang for lang, _ in rows}:
        lowest = sorted({text for lang, text in rows if lang == name}, key=signed)[:texts]
        taken, filled = [], 0
        for text in lowest:
            if filled < 4 * size:
                taken.append(text[:size])
            filled += len(text[:size].encode())
        sample[name] = taken
    lines = {name: {line for text in own for line in text.split("\n")} for name, own in sample.items()}
    for name, own in sample.items():
        foreign = set().union(*(held for other, held in lines.items() if other != name))
        sample[name] = ["\n".join(line for line in text.split("\n") if line not in foreign) for text in own]
    even, odd = (joined({name: own[half::2] for name, own in sample.items()}) for half in (0, 1))
    agreed = {
        name: [text for i, text in enumerate(own) if plain_choice(plain_sizes(even if i % 2 else odd, text))[0] == name]
        for name, own in sample.items()
    }
    return joined({name: agreed[name] or own for name, own in sample.items()})


def test_equals_a_plain_version(documents, model):
    rows = documents.select("doc_id", "text", "lang").collect()
    learned = [(r["lang"], r["text"]) for r in rows if r["text"] is not None and r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    dictionaries = plain_fit(learned, 20, 8192)
    small = langid.fit(documents.where(~langid.held_out()), sample_texts=20, dictionary_bytes=8192)
    assert dict(small) == dictionaries
    found = {r["doc_id"]: r for r in langid.identify(documents, small).collect()}
    judged = 0
    for row in rows:
        if row["text"] and any(c.isalpha() for c in row["text"]):
            name, lead = plain_choice(plain_sizes(dictionaries, row["text"])) if judged < 300 else (None, None)
            if name:
                assert (name, lead, lead < 0.003) == tuple(found[row["doc_id"]])[2:]
            judged += 1
    assert judged > 300


def test_repeats_of_a_text_or_an_id_fill_no_sample(documents):
    learned = documents.where(~langid.held_out())
    hot = learned.limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("copy")
    other = learned.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, 7).otherwise(F.col("doc_id")))
    assert langid.fit(learned.unionByName(hot)) == langid.fit(learned) == langid.fit(other)


def test_many_languages_share_the_bound(spark):
    rows = [(i, f"word{i % 90} " * 400 + str(i), f"l{i % 90:02}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, size = langid.sample(df, sample_texts=40, dictionary_bytes=4096, languages=30)
    assert len(texts) == 90 and size == 4096 * 30 // 90
    assert all(sum(len(text.encode()) for text in own) <= (langid.SPARE + 1) * size for own in texts.values())
    model = langid.cleaned(texts, size)
    assert len(model) == 90 and sum(len(content) for _, content in model) <= 30 * 4096
    assert langid.predict_text(model, "word17 " * 50)[0] == "l17"


def test_short_texts(documents, model):
    """Few words are told apart by more than whole bytes: hardly one is wrong, and most are not rejected."""
    assert len(langid._parts("This.")) == 4 and len(langid._parts("")) == 1
    at_words = documents.where(F.size(F.split("text", " ")) >= 12).select("doc_id", "lang", F.array_join(F.slice(F.split("text", " "), 4, 7), " ").alias("text"))
    found = langid.identify(at_words.where(F.octet_length("text") <= 128), model).join(at_words.select("doc_id", "lang"), "doc_id")
    right, rejected, n = found.where("held_out and lang_pred <> 'und'").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int")), F.count("*")
    ).first()
    assert n > 150 and right > 0.95 and rejected < 0.05
