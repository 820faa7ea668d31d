"""Zone series against plain Python loops, and long zones cut into chunks against whole zones."""

import datetime as dt
import random

import pytest

from outbreaklens.operators import series

SCHEMA = "nom string, nom_clean string, date date, cumulative_confirmed_cases double"
START = dt.date(2026, 5, 1)


def reports(seed: int, zones: int = 6, longest: int = 40) -> list[tuple]:
    """Gappy series with revisions, duplicate days from a second spelling, and one single-row zone."""
    rng = random.Random(seed)
    rows = [("Solo", "Solo", START, 4.0)]
    for z in range(zones):
        day, total = START, float(rng.randint(0, 9))
        for _ in range(rng.randint(2, longest)):
            rows.append((f"Z{z}", f"Z{z}", day, total))
            if rng.random() < 0.1:
                rows.append((f"z{z}", f"Z{z}", day, total + rng.randint(-1, 2)))
            day += dt.timedelta(days=rng.choice([1, 1, 1, 2, 3, 9]))
            total += rng.choice([0, 0, 1, 3, -2])
    rng.shuffle(rows)
    return rows


def expected(rows: list[tuple]) -> dict:
    """One dictionary per row, keyed by zone and position."""
    out = {}
    for zone in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == zone), key=lambda r: (r[2], r[0], r[3]))
        fresh = []
        for i, r in enumerate(own):
            fresh.append(max(r[3] - own[i - 1][3], 0.0) if i else 0.0)
        week = [sum(fresh[max(0, i - 6) : i + 1]) for i in range(len(own))]
        for i, r in enumerate(own):
            before = week[i - 7] if i >= 7 else 0
            last3 = fresh[max(0, i - 2) : i + 1]
            earlier = [own[j][2] for j in range(i) if fresh[j] > 0]
            age = (r[2] - own[0][2]).days
            ahead = sum(f for o, f in zip(own, fresh) if 0 < (o[2] - r[2]).days <= 7)
            out[zone, i] = {
                "nom": r[0],
                "date": r[2],
                "new_cases": fresh[i],
                "rolling_7": week[i],
                "rt_proxy": week[i] / before if before > 0 else None,
                "rolling_3d_new_cases": sum(last3) / len(last3),
                "days_since_first_case": age,
                "days_since_last_case": (r[2] - earlier[-1]).days if earlier else age,
                "label_next_7d_onset": int(ahead > 0),
                "has_full_future_window": (own[-1][2] - r[2]).days >= 7,
                "zone_rows": len(own),
            }
    return out


def computed(df, **limits) -> dict:
    rows = series.case_series(df, **limits)
    rows = series.anomaly_inputs(rows, **limits)
    rows = series.onset_label(series.trend_features(rows, **limits), **limits)
    got = {}
    for r in rows.collect():
        d = r.asDict()
        got[d["nom_clean"], d["day_idx"]] = d
    return got


def check(got: dict, want: dict) -> None:
    assert set(got) == set(want)
    for key, row in want.items():
        for name, value in row.items():
            assert got[key][name] == pytest.approx(value), (key, name)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_whole_zones(spark, seed):
    rows = reports(seed)
    check(computed(spark.createDataFrame(rows, SCHEMA)), expected(rows))


@pytest.mark.parametrize("chunk_rows", [16, 37, 100])
def test_chunks_of_a_long_zone(spark, chunk_rows):
    """One zone holds most rows, a third of them copies of one row."""
    rows = reports(7, zones=4, longest=30)
    day = START
    for i in range(220):
        rows.append(("Hot", "Hot", day, float(i // 3)))
        day += dt.timedelta(days=1 if i % 4 else 2)
    rows += [("Hot", "Hot", START + dt.timedelta(days=50), 11.0)] * 150
    df = spark.createDataFrame(rows, SCHEMA)
    check(computed(df, max_zone_rows=60, chunk_rows=chunk_rows), expected(rows))


def test_one_row_per_day_needs_no_count(spark):
    rows = [("A", "A", START + dt.timedelta(days=i), float(i)) for i in range(20)]
    got = series.case_series(spark.createDataFrame(rows, SCHEMA), one_row_per_day=True).orderBy("date").collect()
    # Defined from the ninth row on: the eighth divides by the first row's 0.
    assert [r["rt_proxy"] is not None for r in got] == [False] * 8 + [True] * 12


def test_feature_chain_sorts_once(spark):
    rows = [("A", "A", START + dt.timedelta(days=i), float(i)) for i in range(20)]
    chain = series.case_series(spark.createDataFrame(rows, SCHEMA), one_row_per_day=True)
    chain = series.onset_label(series.trend_features(chain, True), True)
    plan = chain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_serving_trend_counts_the_current_row(spark):
    from pyspark.sql import functions as F

    rows = [("A", "A", START + dt.timedelta(days=2 * i), float(c)) for i, c in enumerate([3, 3, 5, 5, 9])]
    got = series.latest_trend(series.case_series(spark.createDataFrame(rows, SCHEMA), True), F.lit(1.5)).first()
    assert (got["rolling_7d_new_cases"], got["days_since_last_case"], got["rt_proxy"]) == (6.0, 0, 1.5)
    flat = [("A", "A", START + dt.timedelta(days=2 * i), 3.0) for i in range(4)]
    got = series.latest_trend(series.case_series(spark.createDataFrame(flat, SCHEMA), True), F.lit(1.0)).first()
    assert (got["rolling_7d_new_cases"], got["days_since_last_case"]) == (0.0, 6)
