"""The pipeline against a plain version of its stages on a small table."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from test_simhash import plain_components, plain_fingerprint

import corpus_pipeline
from outbreaklens.llm import bpe, langid

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra array<int>"
FOLDER = "/root/testdata/sf0.01"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def documents(spark):
    """Real texts with near copies, shared passages, an extra column and rows that are odd."""
    draw = random.Random(7)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(150).collect()]
    passage = " ".join(f"p{i}" for i in range(60))
    for n, (i, text, lang, source) in enumerate(rows[:20]):
        rows.append((1000 + n, text.replace(" ", "  ", 3), lang, source))
        rows.append((1100 + n, f"{text}\n{passage}", lang, source))
    rows += [(2000, None, "en", "s"), (2001, "", "en", None), (2002, "123 456", None, "s"), (None, rows[3][1] + " and on", "en", None), rows[5], (rows[6][0], "the other " + rows[7][1], None, "s")]
    draw.shuffle(rows)
    return spark.createDataFrame([(i, t, la, s, len(t or ""), [1]) for i, t, la, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def staged(spark, documents, tmp_path_factory):
    """Input and output of every stage."""
    folder, docs, found = tmp_path_factory.mktemp("stages"), documents, {}
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        found[name] = (docs.collect(), out.collect())
        if name != "bpe_encoding":
            assert out.columns == documents.columns and out.dtypes == documents.dtypes
        docs = out
    return found


def test_language(spark, documents, staged):
    before, after = staged["language_id"]
    model = langid.fit(documents.where(~langid.held_out()))
    stay = [r for r in before if r["text"] and re.search(r"[^\W\d_]", r["text"]) and not langid.predict_text(model, r["text"])[2]]
    assert Counter(map(str, after)) == Counter(map(str, stay))
    assert not {2000, 2001, 2002} & {r["doc_id"] for r in after}
    assert len(after) > 0.97 * (len(before) - 3)


def test_near_duplicates(staged):
    before, after = staged["simhash_near_dedup"]
    prints = {n: (plain_fingerprint(r["text"]), r) for n, r in enumerate(before)}
    groups = plain_components({n: p for n, (p, _) in prints.items()})
    order = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    group_of = {str(r): groups[n] for n, (_, r) in prints.items()}
    # One row a group, and no other has a smaller id; rows that share an id stay when their texts differ.
    assert Counter(group_of[str(r)] for r in after) == Counter(set(groups.values()))
    for r in after:
        assert order(r) == min(order(o) for n, (_, o) in prints.items() if groups[n] == group_of[str(r)])
    assert len(after) < len(before) - 15
    assert len({r["doc_id"] for r in after}) < len(after)


def test_passages(staged):
    before, after = staged["substring_dedup"]
    first = {}
    for r in before:
        w = WORD.findall(r["text"])
        for a in range(len(w) - 12):
            first[tuple(w[a : a + 13])] = min(first.get(tuple(w[a : a + 13]), 1 << 62), r["doc_id"] if r["doc_id"] is not None else 1 << 62)
    found = {(r["doc_id"], tuple(WORD.findall(r["text"]))): r for r in after}
    removed = 0
    for r in before:
        w, gone = WORD.findall(r["text"]), set()
        for a in range(len(w) - 12):
            if first[tuple(w[a : a + 13])] < (r["doc_id"] if r["doc_id"] is not None else 1 << 62):
                gone.update(range(a, a + 13))
        removed += len(gone)
        stay = (r["doc_id"], tuple(x for k, x in enumerate(w) if k not in gone))
        if w and not stay[1]:
            assert stay not in found
            continue
        out = found[stay]
        assert gone or out["text"] == r["text"]
        assert out["n_chars"] == len(out["text"])
        assert (out["lang"], out["source"], out["extra"]) == (r["lang"], r["source"], r["extra"])
    assert removed > 60


def test_mixture(spark, documents, staged):
    """Every row of the mix is a document as it is, or the words of its drawn blocks; the words add up to the targets."""
    from outbreaklens.llm import mixing

    before, after = staged["source_mixing"]
    known = {(r["doc_id"], r["lang"], r["source"]): [] for r in before}
    for r in before:
        known[r["doc_id"], r["lang"], r["source"]].append(WORD.findall(r["text"]))
    whole, parts, taken = {str(r) for r in before}, 0, Counter()
    for r in after:
        own = WORD.findall(r["text"])
        taken[r["source"]] += len(own)
        if str(r) not in whole:
            parts += 1
            assert r["n_chars"] == len(r["text"]) and r["extra"] == [1]
            spans = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
            assert any(Counter(own) <= Counter(w) and len(own) < len(w) for w in known[r["doc_id"], r["lang"], r["source"]]) and spans
    assert parts > 0 and max(Counter(str(r) for r in after).values()) <= 2
    table = spark.createDataFrame([tuple(r) for r in before], SCHEMA)
    for r in mixing.mix(table).groupBy("source_size", "target").agg({"taken": "sum"}).collect():
        source = [s for s in taken if sum(len(WORD.findall(x["text"])) for x in before if x["source"] == s) == r["source_size"]]
        assert any(abs(taken[s] - r["target"]) <= 2 * mixing.BLOCK for s in source)


def test_tokens(staged):
    before, after = staged["bpe_encoding"]
    encoding = bpe.tokenizer(corpus_pipeline.RANK_FILE, public_tokenizers.PATTERN)
    assert len(before) == len(after)
    for r in after:
        assert r["token_ids"] == encoding.encode_ordinary(r["text"]) and r["n_tokens"] == len(r["token_ids"])
        assert r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_run_and_empty_table(spark, documents, tmp_path):
    documents.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").collect() == []
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language_id" and corpus_pipeline.ORACLE_SQL is None


def test_rows_that_share_an_id_or_have_none(spark):
    draw = random.Random(3)
    text = lambda: " ".join(draw.choice(["red", "green", "blue", "one", "two", "three"]) + str(draw.randrange(900)) for _ in range(200))
    base = text()
    rows = [(3, base), (5, base.replace(" ", "  ", 2)), (5, text()), (5, text())] + [(None, text()) for _ in range(20)]
    rows += [(5, rows[3][1]), (None, rows[4][1]), (4, rows[5][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), [1]) for i, t in rows], SCHEMA)
    seen = set()
    for parts in (1, 5):
        after = corpus_pipeline.remove_near_duplicates(spark, docs.coalesce(1) if parts == 1 else docs.repartition(parts), FOLDER).collect()
        found = Counter((r["doc_id"], r["text"]) for r in after)
        # The copy of document 3 goes; different texts of one id stay, each once.
        assert found == Counter([rows[0], rows[2], rows[3], rows[4], rows[-1], *rows[6:24]])
        seen.add(str(sorted(found, key=str)))
    assert len(seen) == 1


def test_rows_without_an_id_have_a_wide_key(spark):
    docs = spark.createDataFrame([(None, "a", "en", "s", 1, [1]), (None, "a", None, "s", 1, [1])], SCHEMA)
    keys = [r[0] for r in docs.select(corpus_pipeline._row_key(docs)).collect()]
    assert keys[0] != keys[1] and all(len(key) == 32 for key in keys)


ODD = (
    "doc_id long, text string, lang string, source string, n_chars long, at timestamp, local timestamp_ntz, raw binary, "
    "counts map<int,array<double>>, nested struct<a:string,b:struct<c:date>>, __x string, carried string, size int, spans string"
)


def odd_rows():
    import datetime as dt

    at = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    words = [" ".join(f"w{i}x{k}" for k in range(150)) for i in range(12)]
    rows = [
        (i, words[i], "en", f"s{i % 2}", len(words[i]), at + dt.timedelta(microseconds=i), at, bytes([i, 255]), {i: [0.1, None]},
         ("a, b", (dt.date(1970, 1, i + 1),)), None, "[", i, "")
        for i in range(12)
    ]
    return rows + [(3, words[3], "en", "s1", 5, at, None, None, None, None, "y", None, None, None)]


@pytest.mark.parametrize("name", ["simhash_near_dedup", "substring_dedup", "source_mixing"])
def test_columns_stay_bit_for_bit(spark, name):
    docs = spark.createDataFrame(odd_rows(), ODD)
    after = stage(name)(spark, docs, FOLDER)
    assert after.dtypes == docs.dtypes
    before = {str(r) for r in docs.collect()}
    rows = after.collect()
    kept = [str(r) for r in rows]
    if name == "source_mixing":
        assert sum(r in before for r in kept) > 3
        assert {str(r.asDict() | {"text": None, "n_chars": None}) for r in rows} <= {
            str(r.asDict() | {"text": None, "n_chars": None}) for r in docs.collect()
        }
    else:
        assert set(kept) <= before and len(kept) >= 12


def test_repeated_rows(spark):
    """The same row many times: one stays as a near-duplicate; the other stages keep every copy."""
    docs = spark.createDataFrame(odd_rows()[:3] + [odd_rows()[0]] * 30, ODD)
    assert stage("simhash_near_dedup")(spark, docs, FOLDER).count() == 3
    assert stage("substring_dedup")(spark, docs, FOLDER).count() == 33
    mixed = stage("source_mixing")(spark, docs, FOLDER).collect()
    assert 33 <= len(mixed) <= 66


@pytest.mark.parametrize("name", ["simhash_near_dedup", "substring_dedup", "source_mixing", "bpe_encoding"])
def test_null_and_empty_texts_alone(spark, name):
    docs = spark.createDataFrame([(1, None, "en", "s", 0, [1]), (2, "", None, None, 0, None), (3, " ", "en", "s", 1, [])], SCHEMA)
    after = stage(name)(spark, docs, FOLDER).collect()
    assert len(after) == {"simhash_near_dedup": 1, "substring_dedup": 3, "source_mixing": 0, "bpe_encoding": 3}[name]


def test_values_are_spelled_apart(spark):
    from pyspark.sql import functions as F

    rows = [(["a,1:b"], None), (["a", "b"], None), ([None], None), ([], None), (None, None), ([], (None,)), ([], ("n",)), (["1:a"], None)]
    df = spark.createDataFrame(rows, "a array<string>, b struct<c:string>")
    assert df.select(F.hex(corpus_pipeline._row_key(df)).alias("k")).distinct().count() == len(rows)


def test_run_leaves_one_folder(spark, documents, tmp_path):
    from outbreaklens.llm import warc

    documents.limit(60).write.parquet(f"{tmp_path}/documents.parquet")
    made, plain = [], warc.scratch_folder
    corpus_pipeline.warc.scratch_folder = lambda *of: made.append(plain(*of)) or made[-1]
    try:
        assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() > 0
    finally:
        corpus_pipeline.warc.scratch_folder = plain
    system = spark._jvm.org.apache.hadoop.fs.Path(made[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    assert [system.exists(spark._jvm.org.apache.hadoop.fs.Path(folder)) for folder in made] == [False] * 4 + [True]


def test_mixing_broadcasts_no_slots(spark):
    """The slots of all sources stood in the driver when a plan took a run of them for one row."""
    from test_mixing import broadcast_rows

    rows = [(i, " ".join(f"w{i}-{k}" for k in range(3200)), f"s{i % 10}", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    assert mixed.select("doc_id").distinct().count() > 100
    assert mixed.collect() and max(broadcast_rows(mixed._jdf.queryExecution().executedPlan())) <= 5000
