import math
import re
from collections import Counter

import numpy as np
import pytest

from outbreaklens.llm import lmscore
from outbreaklens.llm.wordhash import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def plain(rows, good, known):
    """Scores with dictionaries; pairs share a count when they share a cell."""
    coder = lmscore.Coder(known)
    size = coder.size
    word_id = {}

    def ids(text):
        found = WORD.findall(text or "")
        for w in found:
            if w not in word_id:
                word_id[w] = int(coder.numbers(words([w.encode()]).hashes)[0])
        return [word_id[w] for w in found]

    def cell(before, word):
        pair = np.array([before], np.uint64) * lmscore._PAIR + np.array([word], np.uint64)
        return int(lmscore.mixed(pair)[0] % np.uint64(lmscore.CELLS))

    def model(texts):
        single, pairs, starts = Counter(), Counter(), 0
        for text in texts:
            own = ids(text)
            single.update(own)
            pairs.update(cell(a, b) for a, b in zip([size - 1, *own], own))
            starts += bool(own)
        total = sum(single.values())

        def loss(before, word):
            n = starts if before == size - 1 else single[before]
            p1 = (single[word] + 1) / (total + size - 1)
            return -math.log((min(pairs[cell(before, word)], n) + lmscore.PRIOR * p1) / (n + lmscore.PRIOR))

        return loss

    models = [model([t for i, t in rows if i in good]), model([t for _, t in rows])]
    for i, text in rows:
        own = ids(text)
        losses = [sum(m(a, b) for a, b in zip([size - 1, *own], own)) / max(len(own), 1) for m in models]
        yield i, len(own), *losses, losses[0] - losses[1]


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not r["toxic"]}
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = {r[0]: r[1:] for r in plain(rows, good, lmscore.vocabulary(df))}
    found = lmscore.score(df.repartition(5), labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[1:]) == pytest.approx(want[r["doc_id"]], rel=1e-9, abs=1e-9)


def test_target_like_texts_score_lower(spark):
    rows = [(i, "red green blue " * 20 if i % 2 else "one two three " * 20) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 20)], LABELS)
    found = {r["doc_id"]: r["score"] for r in lmscore.score(df, labels).collect()}
    assert max(v for i, v in found.items() if i % 2) < min(v for i, v in found.items() if not i % 2)


def test_vocabulary(spark):
    texts = spark.createDataFrame([("a a a a b b b c c d",), (None,), ("a b",)], "text string")
    hashes = {w: int(words([w.encode()]).hashes[0]) for w in "abcd"}
    assert set(lmscore.vocabulary(texts).tolist()) == set(hashes.values())
    assert set(lmscore.vocabulary(texts, most=2).tolist()) == {hashes["a"], hashes["b"]}
    assert len(lmscore.vocabulary(texts, most=0)) == 0


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c"), (4, "a b c"), (4, "a b c"), (5, "w " * 100_000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, None), (5, 1, 1), (None, 1, 0), (1, None, None)], LABELS)
    assert [r[0] for r in lmscore.targets(labels).collect()] == [4]
    found = lmscore.score(df, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert all(map(math.isfinite, r[2:])) and (r["n_tokens"] or r["score"] == 0)
    assert lmscore.score(df.limit(0), labels).collect() == []
    assert lmscore.score(df, labels.limit(0)).count() == len(rows)


def exact(rows, good):
    """Scores over all words and pairs themselves, with nothing hashed or left out."""
    texts = [(i, WORD.findall(text or "")) for i, text in rows]
    known = {w for _, own in texts for w in own}

    def model(chosen):
        single, pairs = Counter(), Counter()
        for own in chosen:
            single.update(own + [None] * bool(own))
            pairs.update(zip([None, *own], own))
        total = sum(n for w, n in single.items() if w is not None)

        def loss(before, word):
            p1 = (single[word] + 1) / (total + len(known) + 1)
            return -math.log((pairs[before, word] + lmscore.PRIOR * p1) / (single[before] + lmscore.PRIOR))

        return loss

    models = [model([own for i, own in texts if i in good]), model([own for _, own in texts])]
    for i, own in texts:
        losses = [sum(m(a, b) for a, b in zip([None, *own], own)) / max(len(own), 1) for m in models]
        yield i, len(own), *losses, losses[0] - losses[1]


def check_exact(spark, rows, good):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in good] or [(None, 1, 0)], LABELS)
    order = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[4], 6))
    want, found = sorted(exact(rows, good), key=order), sorted(lmscore.score(df.repartition(5), labels).collect(), key=order)
    assert len(found) == len(want)
    for r, w in zip(found, want):
        assert r[0] == w[0] and tuple(r[1:]) == pytest.approx(w[1:], rel=1e-9, abs=1e-9)


def test_more_words_than_are_held(spark):
    rows = [(i, " ".join(f"w{(i * 300 + j) % 70_000} the of" for j in range(300))) for i in range(280)]
    rows += [(None, "the of w1 w2"), (3, "w5 w5 w5"), (3, "w5 w5 w5"), (900, None), (901, "")]
    check_exact(spark, rows, {i for i in range(280) if i % 3 == 0})


@pytest.mark.parametrize("held_words, held_pairs", [(0, 0), (50, 0), (50, 20), (1 << 16, 1 << 18)])
def test_what_is_held_does_not_change_scores(spark, monkeypatch, held_words, held_pairs):
    monkeypatch.setattr(lmscore, "VOCABULARY", held_words)
    monkeypatch.setattr(lmscore, "HELD_PAIRS", held_pairs)
    monkeypatch.setattr(lmscore, "MEETING_ROWS", 100)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    check_exact(spark, rows + rows[:2], {i for i, _ in rows[::3]})
