import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from outbreaklens.llm import prefixtrie
from outbreaklens.llm.listrank import prefix_sums

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {c: [turn for _, turn in sorted(rows)] for c, rows in own.items()}
    found = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = turns.get(int(c - (abs(c) % 100) * (1 if c >= 0 else -1)), [])[:h] + turns[c][h:]
    return found


def plain(conversations):
    """Every node by its sequence, subtree totals by walking all pairs of a node and a node below."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    total, leaves, kids = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, convs in members.items():
        saved = (len(convs) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            total[node[:d]] += saved
            leaves[node[:d]] += kids[node] == 0
    return sorted(
        (
            min(convs), len(node), min(members[node[:-1]]) if node else -1, len(convs), kids[node], leaves[node], total[node],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(node)).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def found(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert df.columns == list(names)
    return sorted(tuple(-1 if v is None else v for v in row) for row in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "x") for row in rows], SCHEMA)


def test_shared_prefixes(spark):
    draw = random.Random(8)
    rows = [
        (c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bb", "ccc é"]))
        for c in [*range(0, 40), *range(100, 140), *range(300, 330)]
        for t in range(draw.randrange(0, 8))
    ]
    want = plain(rebuilt(rows))
    small = {"chunk": 3, "siblings": 2, "pack": 3, "alone": 20}
    placed = prefixtrie.turns(frame(spark, rows))
    assert found(prefixtrie.trie(*prefixtrie.rebuilt(placed), **small)) == want
    assert found(prefixtrie.conversation_trie(frame(spark, rows))) == want


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [
        (0, 1, "user", "x"), (0, None, "user", "first"), (0, None, None, None), (0, 1, "user", "x"), (0, 1, "bot", "x"),
        (None, 1, "user", "x"), (7, 1, "", ""), (7, 2, "user", None), (-5, 1, "user", "x"), (-5, 2, "", "y"), (50, 1, "user", "x"),
        *[(c, 1, "user", "only") for c in range(401, 420)],  # no conversation 400: some lose all their turns
    ]
    want = plain(rebuilt(rows))
    assert any(depth == 0 and n == len({r[0] for r in rows if r[0] is not None}) for _, depth, _, n, *_ in want)
    assert found(prefixtrie.conversation_trie(frame(spark, rows))) == want
    assert found(prefixtrie.conversation_trie(frame(spark, [(401, 1, "user", "x")]))) == plain(rebuilt([(401, 1, "user", "x")]))


def test_empty_table(spark):
    assert prefixtrie.conversation_trie(frame(spark, [])).collect() == []
    assert prefixtrie.conversation_trie(frame(spark, [(None, 1, "user", "x")])).collect() == []


def test_one_long_conversation(spark):
    """A third of all turns under one id, deeper than many chunks; its copies share its nodes."""
    rows = [(c, t, "user", str(t % 7)) for c in (5, 105) for t in range(400)]
    rows += [(c, t, "user", str(t % 7)) for c in range(200, 260) for t in range(5)]
    placed = prefixtrie.turns(frame(spark, rows))
    got = prefixtrie.trie(*prefixtrie.rebuilt(placed), chunk=16, siblings=8, pack=10, alone=50)
    assert found(got) == plain(rebuilt(rows))


def test_numbers_run_through_partitions(spark):
    rows = [(1, 3)] * 500 + [(1, 2)] * 300 + [(2, 1)] * 10 + [(0, None)] * 5
    df = spark.createDataFrame(rows, "k long, o long")
    got = sorted((r["k"], r["place"], r["o"]) for r in prefixtrie.numbered(df, "k", F.col("o").asc_nulls_first()).collect())
    assert got == [(0, i, None) for i in range(1, 6)] + [(1, i, 2 if i <= 300 else 3) for i in range(1, 801)] + [(2, i, 1) for i in range(1, 11)]


def test_list_ranks(spark):
    """Several lists in one table, in rounds and alone."""
    draw = random.Random(2)
    rows, want = [], {}
    for one in range(3):
        order = draw.sample(range(one * 1000, one * 1000 + 300), 300)
        before = 0
        for at, number in enumerate(order):
            weight = draw.randrange(-3, 9)
            rows.append((number, order[at + 1] if at + 1 < len(order) else None, weight))
            want[number], before = before, before + weight
    df = spark.createDataFrame(rows, "id long, after long, w long")
    for alone in (10, 10_000):
        assert {r["id"]: r["w"] for r in prefix_sums(df, ["id"], ["after"], ["w"], alone).collect()} == want
    assert prefix_sums(df.limit(0), ["id"], ["after"], ["w"]).collect() == []
