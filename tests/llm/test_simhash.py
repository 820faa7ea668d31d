import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from outbreaklens.llm import simhash
from outbreaklens.llm.components import components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=3):
    """Smallest id reachable for {id: fingerprint}."""
    top = {i: i for i in prints}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return {i: find(i) for i in prints}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "É a B c\x0bd e a b", "x y z " * 30_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = df.collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    want = plain_components(prints)
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {
        i: (f"{p:016x}", want[i]) for i, p in prints.items()
    }
    assert len(set(want.values())) < len(want)


def vertices(spark, prints):
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    return spark.createDataFrame([(p,) for p in signed], "fp long"), dict(zip(signed, prints))


@pytest.mark.parametrize("bits, segments, block_rows", [(3, 2, 1000), (3, 2, 7), (3, 4, 1000), (4, 2, 1000), (2, 1, 50)])
def test_links_connect_what_is_near(spark, bits, segments, block_rows):
    draw = random.Random(bits * 10 + segments)
    prints = set()
    for _ in range(6):
        center = draw.getrandbits(64)
        for _ in range(40):  # a dense cluster and a chain
            prints.add(center ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(4))))
            prints.add(center)
            center ^= 1 << draw.randrange(64)
    prints |= {0, 1, (1 << 64) - 1, 1 << 63} | {draw.getrandbits(64) for _ in range(200)}
    prints = sorted(prints)
    df, unsigned = vertices(spark, prints)
    links = simhash.links(df, bits, segments, block_rows).collect()
    assert all((unsigned[r["a"]] ^ unsigned[r["b"]]).bit_count() <= bits for r in links)
    named = {r["vertex"]: r["component"] for r in components(simhash.links(df, bits, segments, block_rows)).collect()}
    want = plain_components({p: p for p in prints}, bits)
    groups = {}
    for signed, p in unsigned.items():
        groups.setdefault(named.get(signed, signed), set()).add(p)
    plain = {}
    for p, top in want.items():
        plain.setdefault(top, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_dense_group_sends_few_links(spark):
    """All points within one bit of a center: linked in pairs, but few links leave the tasks."""
    prints = [0] + [1 << b for b in range(64)] + [3 << b for b in range(63)]
    df, _ = vertices(spark, prints)
    n = simhash.links(df).count()
    assert n < 40 * len(prints) < len(prints) * (len(prints) - 1) / 2 * 0.7


def test_components(spark):
    draw = random.Random(3)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(50)] + [(7, 7)]
    pairs += [(900, 900 + i) for i in range(60)]
    found = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    top = {v: v for pair in pairs for v in pair}
    for _ in top:
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
    assert found == {v: t for v, t in top.items() if v in found}
    assert all(top[v] == v for v in top if v not in found)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_edges(spark):
    text = "the first of many words in a rather plain text that is repeated here"
    rows = [(5, text), (5, text), (3, text.upper()), (None, text), (9, None), (8, ""), (None, "only one"), (7, "alone it stands, this line")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS fp", "1 AS component_id")
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    got = sorted(((r["doc_id"], r["component_id"]) for r in found), key=str)
    assert got == sorted([(5, 3), (5, 3), (3, 3), (None, 3), (9, 8), (8, 8), (None, None), (7, 7)], key=str)
    assert {r["fingerprint"] for r in found if r["doc_id"] in (8, 9)} == {"0" * 16}
    assert simhash.near_duplicates(df.limit(0)).collect() == []
