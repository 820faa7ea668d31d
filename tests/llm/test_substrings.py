import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from outbreaklens.llm import substrings
from outbreaklens.llm.wordhash import grams, sliding_min, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    """(id, words, removed words, words left) of rows (id, text); a null id is larger than any other."""
    top = 1 << 63
    split = [(top if i is None else i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for a in range(len(w) - 12):
            key = tuple(w[a : a + 13])
            first[key] = min(first.get(key, i), i)
    found = []
    for (i, w), (shown, _) in zip(split, rows):
        gone = set()
        for a in range(len(w) - 12):
            if first[tuple(w[a : a + 13])] < i:
                gone.update(range(a, a + 13))
        found.append((shown, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(found, key=str)


def run(df, **sizes):
    rows = substrings.remove_repeats(df, **sizes).collect()
    for r in rows:
        assert sum(s["last"] - s["first"] + 1 for s in r["removed"]) == r["n_removed"]
    return sorted(((r["id"], r["n_words"], r["n_removed"], " ".join(WORD.findall(r["kept_text"]))) for r in rows), key=str)


def test_words():
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab é\n\t") for _ in range(draw.randrange(30))) for _ in range(200)]
    found = words([t.encode() for t in texts])
    want = [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t)]
    assert found.text.tolist() == [i for i, _ in want]
    joined = b" ".join(t.encode() for t in texts)
    assert [joined[a:b].decode() for a, b in zip(found.start, found.end)] == [w for _, w in want]
    same = {}
    for h, (_, w) in zip(found.hashes.tolist(), want):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)
    values = found.hashes
    assert sliding_min(values, 9).tolist() == [min(values[i : i + 9]) for i in range(len(values) - 8)]
    assert len(grams(values, 13)) == len(values) - 12


def test_subtree():
    codes = np.array([[1, 1, 2, 1], [5, 5, 5, 6], [7, 8, 7, 7]], np.uint32)
    tree = substrings.Subtree(codes, np.arange(4, dtype=np.uint64))
    assert tree.order.tolist() == [0, 1, 3, 2] and tree.shared.tolist() == [0, 2, 1, 0]
    assert tree.nodes(2).tolist() == [0, 2, 3]


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 20_000, "group_rows": 40}])
def test_documents(spark, sizes):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert run(df, **sizes) == plain([(r["doc_id"], r["text"]) for r in df.collect()])


def made(seed):
    """Texts over few words with shared passages, copies and one very frequent line."""
    draw = random.Random(seed)
    passage = [" ".join(draw.choice("abcdefgh") for _ in range(draw.choice([12, 13, 14, 60]))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(draw.randrange(5)):
            parts.append(draw.choice(passage) if draw.random() < 0.5 else " ".join(f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(20))))
        rows.append((draw.randrange(100) if draw.random() < 0.9 else None, draw.choice([" ", "\n", "\t  "]).join(parts)))
    rows += [(200 + i, "the same line again and again it goes on and on and on " * 2) for i in range(60)]
    return rows + [(300, "a " * 400), (301, "a " * 20), (302, None), (303, ""), (304, "short"), rows[0], rows[0], (None, rows[1][1])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_made_texts(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, block int, payload string")
    assert run(df, block_bytes=800, group_rows=16) == plain(rows)
    assert run(df) == plain(rows)


def test_carried_text_and_spaces(spark):
    shared = " ".join(f"s{i}" for i in range(15))
    df = spark.createDataFrame([(1, f"x\n{shared}\ny"), (2, f"p  q\n{shared}\tr\n\ns ")], "doc_id long, text string")
    rows = {r["id"]: r for r in substrings.remove_repeats(df, carry=F.concat(F.lit("é"), F.col("doc_id"))).collect()}
    assert rows[1]["kept_text"] == f"x\n{shared}\ny" and rows[1]["carried"] == "é1"
    assert rows[2]["kept_text"] == "p  q\nr\n\ns " and [tuple(s) for s in rows[2]["removed"]] == [(2, 16)]


def test_frequent_prefixes(spark):
    texts = spark.createDataFrame([("a b c d " * 50 + f"x{i}",) for i in range(100)], "text string").repartition(7)
    heavy = substrings.frequent_prefixes(texts, 3000, 20_100)
    a = grams(words([b"a b c d e f g"]).hashes, 1)[0]
    abcd = grams(words([b"a b c d e f g"]).hashes, 4)[0]
    assert a in heavy and abcd in heavy and len(heavy) <= 12


def test_long_text_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(400_000))
    df = spark.createDataFrame([(1, text), (2, text[: len(text) // 2])], "doc_id long, text string")
    rows = {r["id"]: r for r in substrings.remove_repeats(df).collect()}
    assert rows[1]["n_removed"] == 0 and rows[1]["n_words"] == 400_000
    assert rows[2]["n_removed"] >= rows[2]["n_words"] - 1
    assert substrings.remove_repeats(df.limit(0)).collect() == []
