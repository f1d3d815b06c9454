"""AGG5-AGG7, SCL1-SCL4 on hand-made series."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.operators.scaling import clip_symmetric, minmax, ward_clusters, zscore
from blotter.operators.temporal import daily_pivot, hourly_pivot, monthly_resample, seasonal_profile


def test_monthly_resample_fills_empty_months(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2020, 1, 5), "x"), (d(2020, 1, 6), "y"), (d(2020, 4, 1), "x")],
                               "Date date, c string")
    wide = daily_pivot(df, "Date", "c", ["x", "y"])
    got = [(str(r.month_end), r.x, r.y) for r in monthly_resample(wide, "Date", ["x", "y"]).orderBy("month_end").collect()]
    assert got == [("2020-01-31", 1, 1), ("2020-02-29", 0, 0), ("2020-03-31", 0, 0), ("2020-04-30", 1, 0)]


def test_seasonal_profile_keeps_first_28_days(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2020, 1, 29), "x"), (d(2020, 1, 3), "x")], "Date date, c string")
    wide = daily_pivot(df, "Date", "c", ["x"])
    assert [r.day for r in seasonal_profile(wide, "Date", ["x"], "day", 28).collect()] == [3]


def test_hourly_pivot_drops_null_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 30), "x"), (None, "x"),
                                (dt.datetime(2020, 1, 1, 5, 0), "y")], "ts timestamp, c string")
    got = {r.hour: (r.x, r.y) for r in hourly_pivot(df, "ts", "c", ["x", "y"]).collect()}
    assert got == {0: (1, 0), 5: (0, 1)}


def test_zscore_minmax_constant_series_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 5.0), ("b", 5.0)], "k string, v double")
    z = {(r.k, r.v): r.z for r in zscore(df, "v", "k").collect()}
    assert z[("a", 1.0)] == -1.0 and z[("a", 3.0)] == 1.0      # sample std = 1
    assert z[("b", 5.0)] is None                              # 0/0 -> NULL, no ANSI error
    zp = {(r.k, r.v): r.z for r in zscore(df, "v", "k", ddof=0).collect()}
    assert math.isclose(zp[("a", 3.0)], 1.0 / math.sqrt(2.0 / 3.0))
    s = {(r.k, r.v): r.scaled for r in minmax(df, "v", "k").collect()}
    assert s[("a", 2.0)] == 0.5 and s[("b", 5.0)] is None


def test_clip_symmetric(spark):
    df = spark.createDataFrame([(-3.0,), (1.0,), (2.0,)], "z double")
    got = sorted(r.z for r in clip_symmetric(df, "z").collect())
    assert got == [-2.0, 1.0, 2.0]
    assert clip_symmetric(df, "z").agg(F.max("z")).first()[0] == 2.0


def _ward(rows, k):
    """Greedy Ward on (key, vector): sorted key lists of the k clusters."""
    live = {key: (1.0, np.array(v, float), [key]) for key, v in rows}
    while len(live) > k:
        cost = lambda a, b: live[a][0] * live[b][0] / (live[a][0] + live[b][0]) * ((live[a][1] - live[b][1]) ** 2).sum()
        _, a, b = min((cost(a, b), a, b) for a in live for b in live if a < b)
        (na, ca, ia), (nb, cb, ib) = live[a], live.pop(b)
        live[a] = (na + nb, (na * ca + nb * cb) / (na + nb), ia + ib)
    return sorted(sorted(v[2]) for v in live.values())


@pytest.mark.parametrize("n,k,last,block", [(30, 4, 4, 12), (30, 3, 16, 1024), (3, 4, 48, 1024), (0, 4, 48, 1024)])
def test_ward_equals_brute_force(spark, n, k, last, block):
    rng = np.random.default_rng(n + k)
    rows = [(i, (rng.normal(size=3) + 4 * (i % 5)).tolist()) for i in range(n)]
    if n == 30:
        rows[22:] = [(22 + i, [100.0 * i] * 3) for i in range(8)]      # far pairs that are each other's nearest early
    long = [(i, "xyz"[j], x) for i, v in rows for j, x in enumerate(v)] + [(None, "x", 1.0)]
    got = {}
    for r in ward_clusters(spark.createDataFrame(long, "r int, c string, v double"), "r", "c", "v", list("xyz"), k,
                           last=last, block_rows=block).collect():
        got.setdefault(r.cluster, []).append(r.r)
    want = _ward(rows, k)
    assert sorted(sorted(v) for v in got.values()) == want
    assert [min(got[c]) for c in sorted(got)] == sorted(w[0] for w in want) and sorted(got) == list(range(len(want)))


def test_ward_ties_and_missing_cells(spark):
    """Equal distances go by the smallest rows; a missing cell is 0."""
    long = [(i, "x", float(i)) for i in range(1, 8)] + [(8, "y", 0.0)]
    df = spark.createDataFrame(long, "r int, c string, v double")
    want = _ward([(i, [float(i), 0.0]) for i in range(1, 8)] + [(8, [0.0, 0.0])], 3)
    for last in (3, 48):
        got = {}
        for r in ward_clusters(df, "r", "c", "v", ["x", "y"], 3, last=last).collect():
            got.setdefault(r.cluster, []).append(r.r)
        assert sorted(sorted(v) for v in got.values()) == want
