import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from outbreaklens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(documents, items, k=10):
    docs = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in documents]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(term for _, c, _ in docs for term in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    found = []
    for item, terms in asked.items():
        scored = []
        for i, c, n in docs:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms & c.keys()
            )
            if score > 0:
                scored.append((-score, i is None, i))
        found += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(found, key=str)


def searched(spark, documents, items, blocks={}, **sizes):
    df = spark.createDataFrame([(i, t, "x", "x") for i, t in documents], "doc_id long, text string, score string, rank string")
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = lexical.search(lexical.index(df, **blocks), asked, **sizes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed, n, words=60):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    return [(i, " ".join(draw.choices(vocabulary, [1 / (j + 1) for j in range(words)], k=draw.randrange(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("blocks", [{}, {"block_docs": 37}, {"block_text": 500}])
def test_against_all_scores(spark, blocks):
    documents = corpus(1, 400)
    items = [(i, " ".join(f"w{j}" for j in random.Random(i).sample(range(60), 12))) for i in range(25)]
    want = plain(documents, items)
    assert searched(spark, documents, items, blocks, pair_terms=20) == want
    assert searched(spark, documents, items, blocks, pair_terms=0) == want
    assert searched(spark, documents, items, blocks, query_terms=30) == want


def test_ties_nulls_repeats_and_scripts(spark):
    documents = [(i, "same text here") for i in range(30)] + [(3, "same text here"), (None, "same text here")] * 3
    documents += [(100, None), (101, ""), (102, "... !!"), (103, "ÄÖ Äö ÉCOLE école_x9 中文 İ"), (104, "Same\x00TEXT x"), (105, "long " * 200_000)]
    items = [(1, "same"), (1, "TEXT"), (2, None), (3, "..."), (None, "same"), (4, "école École ÉCOLE x9 中文"), (5, "nowhere"), (6, "long here"), (1, "same")]
    assert searched(spark, documents, items) == plain(documents, items)
    assert searched(spark, documents, items, {"block_docs": 4}, k=40) == plain(documents, items, 40)


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None)], [(1, "a")]) == []


def block_of(documents, wanted, pair_words):
    block = lexical._block([i for i, _ in documents], [t for _, t in documents])
    at = {int(w): int(n) for w, n in zip(block.words, np.diff(block.starts))}
    weights = np.array([lexical.weight(len(documents), at[int(w)]) for w in wanted], np.int64)
    return lexical.Searcher(block, lexical.Corpus(len(documents), int(block.lengths.sum()), wanted, weights, pair_words))


def test_pair_bounds_hold_and_close_more(spark):
    """The bound of a set is never below what a document holds of it, never above the sum of maxima, and closes postings."""
    documents = corpus(5, 3000, 40)
    words = np.array(sorted({int(w) for w in lexical.terms(["w%d" % j for j in range(40)]).hashes}), np.uint64)
    joint, alone = block_of(documents, words, words), block_of(documents, words, words[:0])
    draw = random.Random(3)
    tighter = 0
    for _ in range(40):
        asked = draw.sample([int(w) for w in words], 8)
        ordered = sorted(asked, key=lambda w: joint.lists[w][2])
        bounds, sums = joint.bounds(ordered), alone.bounds(ordered)
        for n in range(len(ordered) + 1):
            held = np.zeros(len(documents), np.int64)
            for word in ordered[:n]:
                docs, impacts, _ = joint.lists[word]
                held[docs] += impacts
            assert held.max(initial=0) <= bounds[n] <= sums[n]
            tighter += bounds[n] < sums[n]
        best = [sorted(-s for s in searcher.search(asked)[1])[:10] for searcher in (joint, alone)]
        assert best[0] == best[1]
    assert tighter > 40 and joint.closed > alone.closed


def test_blocks_are_skipped_whole():
    documents = corpus(6, 200, 10)
    words = np.array(sorted({int(w) for w in lexical.terms(["w%d" % j for j in range(10)]).hashes}), np.uint64)
    searcher = block_of(documents, words, words)
    assert len(searcher.search([int(w) for w in words], 1 << 60)[0]) == 0 and searcher.opened == 0 and searcher.closed > 0
