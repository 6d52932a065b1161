"""Cases too long for one task: the same results as the operators that see a whole case, and as plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrift.operators import anchors, hot

SCHEMA = "caseid long, track string, time_sec double, value double, ord long"


def walk(seed, n, cases=(1,), step=20.0, tracks=("x",), missing=0.3):
    r = random.Random(seed)
    out, t = [], 0.0
    for k in range(n):
        t += r.choice([0.0, 0.1, 1.0, step, 5 * step]) * r.random() if r.random() < 0.98 else 3000.0
        value = None if r.random() < missing else r.choice([0.0, 1.0, 2.5, round(r.uniform(-50, 50), 2)])
        out.append((r.choice(cases), r.choice(tracks), round(t, 1), value, k))
    return out


@pytest.mark.parametrize("values", [
    [1.0] * 1000 + [2.0] * 1000,
    [-math.inf, math.inf] * 300 + [2.0 ** (k % 700 - 350) for k in range(1500)],
])
def test_quantiles_of_a_key_that_no_task_holds(spark, values):
    rows = [("hot", v) for v in values] + [("few", v) for v in values[:7]] + [(None, v) for v in values] + [("none", None)]
    got = hot.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", (0.0, 0.25, 0.5, 0.9, 1.0), [F.count(F.lit(1)).alias("n")], most=64, bins=32)
    got = {r.k: (r.quantiles, r.n) for r in got.collect()}
    assert set(got) == {"hot", "few", None}
    for key, some in (("hot", values), (None, values), ("few", values[:7])):
        s, (found, n) = sorted(some), got[key]
        assert n == len(s)
        for q, v in zip((0.0, 0.25, 0.5, 0.9, 1.0), found):
            p = q * (len(s) - 1)
            low, high = math.floor(p), math.ceil(p)
            want = s[low] if low == high else (high - p) * s[low] + (p - low) * s[high]
            assert v == want or np.isclose(v, want, rtol=1e-12, atol=0), (key, q)


def test_quantiles_of_nothing(spark):
    assert hot.quantiles(spark.createDataFrame([], "k string, v double"), ["k"], "v", (0.5,)).collect() == []
    nan = hot.quantiles(spark.createDataFrame([("a", float("nan"))] * 5 + [("a", 1.0)] * 6, "k string, v double"), ["k"], "v", (0.0, 1.0), most=2, bins=2).collect()[0]
    assert nan.quantiles[0] == 1.0 and math.isnan(nan.quantiles[1])


@pytest.mark.parametrize("width", [4.0, 4096.0])
def test_neighbours_by_ranges(spark, width):
    rows = walk(1, 700, cases=(1, 1, 1, 2, None))
    got = {r.ord: r for r in hot.neighbours(spark.createDataFrame(rows, SCHEMA), ["caseid"], width).collect()}
    assert len(got) == len(rows)
    for row in rows:
        same = sorted((r for r in rows if r[0] == row[0]), key=lambda r: (r[2], r[4]))
        at = same.index(row)
        a = next(((r[2], r[3]) for r in reversed(same[: at + 1]) if r[3] is not None), None)
        b = next(((r[2], r[3]) for r in same[at:] if r[3] is not None), None)
        found = got[row[4]]
        assert (found["__a"] and tuple(found["__a"]), found["__b"] and tuple(found["__b"])) == (a, b)


@pytest.mark.parametrize("lookback", [60.0, 5000.0])
def test_rates_by_ranges(spark, lookback):
    rows = [r for r in walk(2, 600, cases=(1, 1, 2), tracks=("x", "y")) if r[2] >= 0]
    seen, distinct = set(), []
    for r in rows:  # equal times have no order here
        if (r[0], r[1], r[2]) not in seen:
            seen.add((r[0], r[1], r[2]))
            distinct.append(r)
    df = spark.createDataFrame(distinct, SCHEMA)
    got = {r.ord: r for r in anchors.smoothed_rates(df, lookback).collect()}
    assert len(got) == len(distinct)
    for c, k, t, v, o in distinct:
        past = sorted((r for r in distinct if r[:2] == (c, k) and r[3] is not None and r[2] <= t), key=lambda r: r[2])
        old = [r for r in past if r[2] <= t - lookback]
        want = old[-1][2] if old else past[0][2] if past else None
        assert got[o].ref_time_sec == want


@pytest.mark.parametrize("label", [None, "track"])
@pytest.mark.parametrize("gap,width", [(0.3, 0.5), (30.0, 32.0), (700.0, None)])
def test_thinning_by_ranges(spark, label, gap, width):
    rows = walk(3, 900, cases=(1, 1, 1, 1, 2, None), tracks=("a", "b", None))
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(r.ord for r in anchors.thin(df, gap, label).collect())
    assert sorted(r.ord for r in hot.thin_long(df, gap, label, width).collect()) == want
    kept, last = [], {}
    for r in sorted(rows, key=lambda r: (r[2], r[4])):
        if r[0] not in last or r[2] - last[r[0]][0] >= gap or (label and r[1] != last[r[0]][1]):
            last[r[0]] = (r[2], r[1])
            kept.append(r[4])
    assert sorted(kept) == want


def test_thinning_without_events_times_or_gap(spark):
    assert hot.thin_long(spark.createDataFrame([], SCHEMA), 30.0).collect() == []
    rows = [(1, "a", None, 1.0, 0), (1, "a", 1.0, 1.0, 1), (1, "a", 1.0, 1.0, 2)]
    assert [r.ord for r in hot.thin_long(spark.createDataFrame(rows, SCHEMA), 30.0).collect()] == [1]
    assert sorted(r.ord for r in hot.thin_long(spark.createDataFrame(rows, SCHEMA), 0.0).collect()) == [1, 2]
    with pytest.raises(ValueError):
        hot.thin_long(spark.createDataFrame(rows, SCHEMA), 30.0, width=16.0)
