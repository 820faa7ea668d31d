from collections import defaultdict

import pytest

from outbreaklens.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / total for s in free}
        for s in over:
            fixed[s] = cap * sizes[s]
        left = share * sum(sizes.values()) - sum(fixed.values())


def documents(spark, rows):
    return spark.createDataFrame(
        [(i, " \n".join(["w"] * n) if n is not None else None, s, "x") for i, (n, s) in enumerate(rows)],
        "doc_id long, text string, source string, taken string",
    )


ROWS = (
    [(50 + i % 90, "hot") for i in range(400)]
    + [(30 + i % 40, "a") for i in range(100)]
    + [(20, None) for _ in range(100)]
    + [(11, "é") for _ in range(60)]
    + [(700, "")]
    + [(None, "empty"), (0, "empty"), (0, "hot"), (5000, "a")]
)


@pytest.fixture(scope="module")
def mixed(spark):
    return mixing.mix(documents(spark, ROWS)).collect()


def test_targets(mixed):
    sizes = defaultdict(int)
    for n, s in ROWS:
        sizes[s] += n or 0
    want = plain_targets(sizes)
    assert len(mixed) == len(ROWS)
    for r in mixed:
        n, s = ROWS[r["doc_id"]]
        assert r["size"] == (n or 0) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s], rel=1e-9)


def test_taken(mixed):
    taken = defaultdict(int)
    for r in mixed:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[ROWS[r["doc_id"]][1]] += r["taken"]
    for r in mixed:
        assert abs(taken[ROWS[r["doc_id"]][1]] - r["target"]) <= max(2 * mixing.BLOCK, 0.03 * r["target"])


def test_reruns_agree(spark, mixed):
    again = mixing.mix(documents(spark, ROWS).repartition(3)).collect()
    assert sorted(again) == sorted(mixed)


def test_shard_counts_vary_and_totals_hold(spark):
    sources = spark.createDataFrame([(0, 9000), (1, 3000), (2, 0), (3, 500)], "sid int, wanted long")
    rows = mixing.slots(sources, 12_500).collect()
    seen, shards = defaultdict(set), defaultdict(lambda: defaultdict(int))
    for r in rows:
        seen[r["sid"]].add(r["index"])
        shards[r["shard"]][r["sid"]] += 1
    assert len(rows) == 12_500 and {s: len(v) for s, v in seen.items()} == {0: 9000, 1: 3000, 3: 500}
    assert all(v == set(range(len(v))) for v in seen.values())
    assert all(sum(c.values()) <= mixing.SHARD_SLOTS for c in shards.values())
    assert len({c[1] for c in shards.values()}) > 1


def test_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 97, 1000):
        df = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5), F.lit(1)).alias("b"))
        assert sorted(r["b"] for r in df.collect()) == list(range(n))


def test_edges(spark):
    assert mixing.mix(documents(spark, [(5, "a")]).limit(0)).collect() == []
    nothing = mixing.mix(documents(spark, [(0, "a"), (None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2
    many = spark.createDataFrame([(1, "a b c", "s")] * 5 + [(None, "a b", "s")] * 2, "doc_id long, text string, source string")
    assert len(mixing.mix(many).collect()) == 7


def test_no_python(spark):
    plan = mixing.mix(documents(spark, ROWS[:50]))._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if word in plan]


def test_shards_hold_the_words_of_the_mix(spark):
    rows = [(i, " \n".join(f"{s}{i}-{k}" for k in range(n or 0)) if n is not None else None, s) for i, (n, s) in enumerate(ROWS)]
    rows += [(0, "x y z", "hot"), (0, "u v w", "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts, sizes = defaultdict(list), defaultdict(int)
    for i, text, s in rows:
        texts[i, s].append((text or "").split())
        sizes[s] += len((text or "").split())
    found, slots, taken = mixing.shards(df).collect(), defaultdict(list), defaultdict(int)
    for r in found:
        own = r["words"].split(" ")
        assert len(own) == r["n_words"]
        assert any(t[r["first"] : r["first"] + r["n_words"]] == own for t in texts[r["doc_id"], r["source"]])
        slots[r["shard"], r["slot"]].append((r["place"], r["n_words"], r["source"]))
        taken[r["doc_id"]] += r["n_words"]
    blocks = defaultdict(int)
    for held in slots.values():
        held.sort()
        assert len({s for *_, s in held}) == 1 and [p for p, *_ in held] == [sum(n for _, n, _ in held[:k]) for k in range(len(held))]
        size = sum(n for _, n, _ in held)
        assert size in (mixing.BLOCK, sizes[held[0][2]] % mixing.BLOCK)
        blocks[held[0][2]] += 1
    for s, target in plain_targets(sizes).items():
        assert blocks[s] == round(target * -(-sizes[s] // mixing.BLOCK) / sizes[s]) if sizes[s] else s not in blocks
    for shard in {shard for shard, _ in slots}:
        numbers = sorted(slot for k, slot in slots if k == shard)
        assert numbers == list(range(len(numbers))) and len(numbers) <= mixing.SHARD_SLOTS
    by_row = defaultdict(int)
    for r in mixing.mix(df).collect():
        by_row[r["doc_id"]] += r["taken"]
    assert {i: n for i, n in by_row.items() if n} == dict(taken)


def broadcast_rows(plan) -> list[int]:
    """Rows of every broadcast in a plan that has run."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return broadcast_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return broadcast_rows(plan.plan())
    own = [plan.metrics().apply("numOutputRows").value()] if kind == "BroadcastExchangeExec" else []
    return own + [n for i in range(plan.children().size()) for n in broadcast_rows(plan.children().apply(i))]


def test_neither_slots_nor_pieces_are_broadcast(spark):
    """Plans take what a row is spread out to for one row; broadcast, all slots of the mix stood in the driver."""
    rows = [(i, (6400, f"s{i % 20}")) for i in range(200)]
    for made in (mixing.mix, mixing.copies):
        mixed = made(documents(spark, [row for _, row in rows]))
        assert len(mixed.collect()) >= len(rows)
        found = broadcast_rows(mixed._jdf.queryExecution().executedPlan())
        assert found and max(found) <= mixing.CELLS + 100
    sources = spark.createDataFrame([(i, 5000) for i in range(20)], "sid int, wanted long")
    dealt = mixing.slots(sources, 100_000)
    assert len(dealt.collect()) == 100_000
    assert max(broadcast_rows(dealt._jdf.queryExecution().executedPlan())) <= mixing.CELLS + 100
