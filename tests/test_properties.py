
import math

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from blotter.functions.keys import region_year_key, wkt_point
from blotter.operators.crosstab import crosstab_wide, wide_to_long
from blotter.operators.regression import correlations, ols_tests
from blotter.operators.scaling import minmax, zscore

SETTINGS = settings(max_examples=8, deadline=None)
cells = st.lists(st.tuples(st.sampled_from(["r1", "r2", "r3", None]), st.sampled_from(["a", "b", "c"])),
                 min_size=1, max_size=40)


@SETTINGS
@given(cells)
def test_pivot_then_unpivot_is_identity(spark, rows):
    df = spark.createDataFrame(rows, "r string, c string")
    long = wide_to_long(crosstab_wide(df, "r", "c", ["a", "b", "c"]), ["r"], ["a", "b", "c"], "c", "n")
    got = {(r.r, r.c): r.n for r in long.collect() if r.n}
    expected = {}
    for r, c in rows:
        expected[(r, c)] = expected.get((r, c), 0) + 1
    assert got == expected


@SETTINGS
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=3, max_size=30))
def test_zscore_mean0_std1_and_minmax_unit_interval(spark, xs):
    df = spark.createDataFrame([("k", float(x)) for x in xs], "g string, v double")
    z = zscore(df, "v", "g").agg(F.avg("z").alias("m"), F.stddev_samp("z").alias("s")).first()
    s = minmax(df, "v", "g").agg(F.min("scaled").alias("lo"), F.max("scaled").alias("hi")).first()
    if np.std(xs) > 1e-6 * max(1.0, max(abs(x) for x in xs)):
        assert abs(z.m) < 1e-9 and abs(z.s - 1.0) < 1e-9
        assert abs(s.lo) < 1e-12 and abs(s.hi - 1.0) < 1e-12
    elif max(xs) == min(xs):
        assert z.m is None and s.lo is None


@SETTINGS
@given(st.integers(0, 10_000))
def test_single_predictor_beta_is_pearson_r(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=20)
    y = rng.normal(size=20) + rng.uniform(-2, 2) * x
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    beta = ols_tests(df, "y", [("t", "x", None)]).first().beta
    r = {row.column: row.corr for row in correlations(df, "y", ["x"]).collect()}["x"]
    assert math.isclose(beta, r, rel_tol=1e-12, abs_tol=1e-15)
    assert math.isclose(r, float(np.corrcoef(x, y)[0, 1]), rel_tol=1e-9, abs_tol=1e-12)


def test_keys_and_point_text(spark):
    df = spark.createDataFrame([("Queens", 2019, 1.5, -2.0), ("x", None, 0.0, 0.0)], "b string, y int, lon double, lat double")
    got = df.select(region_year_key("b", "y").alias("k"), wkt_point("lon", "lat").alias("p")).collect()
    assert (got[0].k, got[0].p) == ("QUEENS2019", "POINT(1.5 -2.0)")
    assert got[1].k is None


def _brute_intersects(px, py, rings):
    """Plain-Python reference: even-odd over all rings, or on any edge."""
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and \
                    min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return True
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def _wkt(polys):
    body = ", ".join("(" + ", ".join("(" + ", ".join(f"{x} {y}" for x, y in r) + ")" for r in rings) + ")"
                     for rings in polys)
    return f"MULTIPOLYGON ({body})" if len(polys) > 1 else f"POLYGON {body}"


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10_000))
def test_tag_points_matches_brute_force(spark, seed):
    from blotter.operators.spatial import tag_points
    rng = np.random.default_rng(seed)
    regions, shapes = [], {}
    for k in range(12):
        x0, y0 = int(rng.integers(0, 16)), int(rng.integers(0, 16))
        w, h = int(rng.integers(2, 7)), int(rng.integers(2, 7))
        kind = k % 4
        sq = [(x0, y0), (x0 + w, y0), (x0 + w, y0 + h), (x0, y0 + h), (x0, y0)]
        if kind == 0:
            polys = [[sq]]
        elif kind == 1:
            hole = [(x0 + 1, y0 + 1), (x0 + w - 1, y0 + 1), (x0 + w - 1, y0 + h - 1), (x0 + 1, y0 + h - 1),
                    (x0 + 1, y0 + 1)]
            polys = [[sq, hole]]
        elif kind == 2:
            polys = [[[(x0, y0), (x0 + w, y0), (x0, y0 + h), (x0, y0)]]]
        else:
            polys = [[sq], [[(x0 + w + 1, y0), (x0 + w + 3, y0), (x0 + w + 3, y0 + 2), (x0 + w + 1, y0)]]]
        regions.append((str(k), f"R{k}", _wkt(polys)))
        shapes[str(k)] = [r for rings in polys for r in rings]
    pts = [(f"p{i}", float(rng.integers(0, 26)), float(rng.integers(0, 26))) for i in range(150)]
    pts += [(f"q{i}", float(rng.uniform(0, 25)), float(rng.uniform(0, 25))) for i in range(150)]
    rdf = spark.createDataFrame(regions, "bor_subb string, name string, geometry string")
    pdf = spark.createDataFrame(pts, "pid string, x double, y double")
    expected = sorted((p, k) for p, x, y in pts for k, rings in shapes.items() if _brute_intersects(x, y, rings))
    for cell, limit in ((1.0, 2_000_000), (3.0, 0)):
        got = sorted((r.pid, r.bor_subb) for r in
                     tag_points(pdf, rdf, "x", "y", cell=cell, max_broadcast_rows=limit, salt=3).collect())
        assert got == expected
