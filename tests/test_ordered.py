import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from outbreaklens.operators import ordered


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


@pytest.mark.parametrize("values", [[1.0], [2.0, 1.0], [3.0, 1.0, 2.0], [4.0, 1.0, 1.0, 9.0], [5.0] * 7 + [None, 1.0]])
def test_medians(spark, values):
    known = sorted(v for v in values if v is not None)
    assert ordered.median(frame(spark, values), "v").first()[0] == statistics.median(known)
    assert ordered.upper_median(frame(spark, values), "v").first()[0] == known[len(known) // 2]


def test_median_of_nothing(spark):
    assert ordered.median(frame(spark, [None, None]), "v").first()[0] is None
    assert ordered.upper_median(frame(spark, [None]), "v").first()[0] is None


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_range_partitions(spark, descending):
    """Beyond the single window the totals come from range partitions; the result is the same."""
    rng = random.Random(3)
    rows = [(float(k), rng.randint(1, 5)) for k in rng.sample(range(10_000), 2_000)]
    df = spark.createDataFrame(rows, "k double, n long")
    order = [F.col("k").desc() if descending else F.col("k")]
    got, totals = ordered.running_totals(df, order, ["n"], single_window_rows=100)
    want, running = {}, 0
    for k, n in sorted(rows, reverse=descending):
        running += n
        want[k] = running
    assert {r["k"]: r["cum_n"] for r in got.collect()} == want
    assert totals == {"n": running}


@pytest.mark.parametrize("n", [1, 10, 30, 90, 100, 101])
def test_cutoff_uses_binary_fraction(spark, n):
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    assert ordered.date_at_fraction(df, "date", 0.70).first()[0] == days[int(n * 0.70)]
