import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from outbreaklens.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    wins = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(wins), set()
    for i, win in enumerate(wins):
        if times[win] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def rows(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    return {r["doc_id"]: r for r in quality.quality(df).collect()}


TEXTS = [
    None,
    "",
    " \t\n",
    "a b c d e",
    "a b c d e a b c d e",
    "a b c d e f a b c d e a b c d",
    "x " * 40,
    "one\ntwo\none\n\n \none\r\none",
    "#tag *x* $5 50% a&b <p>|</p>",
    "é中 😀 na me  x",
    "the of and " + " ".join(f"w{i}" for i in range(40_000)),
]


def test_counts(spark):
    found = rows(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        assert tuple(found[i][1:7]) == plain(text), text and text[:40]
    assert not found[0]["kept"] and not found[10]["base_failed"]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n#."), max_size=60), min_size=1, max_size=30))
def test_random_texts(spark, texts):
    found = rows(spark, texts)
    assert all(tuple(found[i][1:7]) == plain(text) for i, text in enumerate(texts))


def test_verdicts(spark):
    good = "The report of the day is in and it was for the town that we know."
    junk = "ab#$%& cd#$%& ef#$%& gh#$%& ij#$%& kl#$%& mn#$%& op#$%& qr#$%& the of"
    found = rows(spark, [good, junk, good + "\n" + "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17"])
    assert found[0]["kept"] and not found[1]["kept"] and not found[2]["kept"]


def test_clean_documents_stay(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.quality(documents).join(labels, "doc_id")
    assert found.where("quality = 1 and not base_failed and not kept").count() == 0
    assert found.where("quality = 0 and kept").count() <= 0.05 * found.where("quality = 0").count()


def test_one_native_projection(spark):
    df = quality.quality(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert quality.quality(spark.createDataFrame([], "doc_id long, text string")).collect() == []
