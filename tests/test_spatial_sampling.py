"""GEO1/GEO2/JN3 edge cases, density, sampling."""

import json
import math

import numpy as np
from pyspark.sql import functions as F

from blotter.operators.sampling import stratified_sample, stratified_sample_hash
from blotter.operators.spatial import (explode_edges, grid_counts, kernel_density, region_edges,
                                       region_year_counts, tag_points)
from blotter.sources.readers import read_regions

REGIONS = [
    ("1", "WEST", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"),
    ("2", "EAST", "POLYGON ((10 0, 20 0, 20 10, 10 10, 10 0))"),
    ("3", "ISLES", "MULTIPOLYGON (((30 0, 32 0, 32 2, 30 2, 30 0)), ((40 0, 42 0, 42 2, 40 2, 40 0)))"),
    ("4", "GONE", "None"),
    ("5", "BAD", "POLYGON ((a b, 1 1, 0 0))"),
    (None, "NOID", "POLYGON ((0 0, 1 0, 1 1, 0 0))"),
]
POINTS = [
    ("inside", 2.0, 2.0), ("outside", 25.0, 5.0), ("hole", 5.0, 5.0), ("part2", 41.0, 1.0),
    ("outer_edge", 0.0, 5.0), ("shared_edge", 10.0, 5.0), ("vertex", 20.0, 10.0),
    ("hole_edge", 4.0, 5.0), ("null", None, 1.0), ("nan", float("nan"), 1.0), ("far", -100.0, -100.0),
]


def _tag(spark, cell, limit=2_000_000):
    regions = spark.createDataFrame(REGIONS, "bor_subb string, name string, geometry string")
    pts = spark.createDataFrame(POINTS, "pid string, x double, y double")
    got = tag_points(pts, regions, x="x", y="y", cell=cell, max_broadcast_rows=limit, salt=4)
    return sorted((r.pid, r.name) for r in got.collect())


def test_point_in_polygon_cases(spark):
    expected = sorted([("inside", "WEST"), ("part2", "ISLES"), ("outer_edge", "WEST"),
                       ("shared_edge", "WEST"), ("shared_edge", "EAST"), ("vertex", "EAST"),
                       ("hole_edge", "WEST")])
    for cell in (1.0, 3.0, 100.0):          # the grid size never changes the answer
        assert _tag(spark, cell) == expected
    assert _tag(spark, 3.0, limit=0) == expected     # salted shuffle path, same answer


def test_salted_path_on_driver_tables(spark, sf_dir):
    from blotter.plans import catalog as C, roles
    pts = C._complaint_points(spark, sf_dir)
    reg = roles.regions(spark, sf_dir)
    key = lambda df: sorted((r.CMPLNT_NUM, r.bor_subb) for r in df.collect())
    fast = tag_points(pts, reg)
    salted = tag_points(pts, reg, max_broadcast_rows=0, salt=8)
    assert key(fast) == key(salted) and len(key(fast)) > 0


def test_cover_adapts_and_decides_most_hits(spark, sf_dir):
    """Service areas differ in size; the cells of each follow its own extent, and most hits need no edges."""
    from blotter.plans import roles
    from blotter.operators.spatial import region_cells
    areas = roles.service_areas(spark, sf_dir)
    cover = region_cells(region_edges(areas)).withColumn("area", F.pow(F.lit(4.0), F.col("_level"))).toPandas()
    assert cover.edges.dropna().map(len).max() <= 16
    share = cover[cover._interior].area.sum() / cover.area.sum()
    assert share > 0.5


def test_cover_of_many_edges_splits_further(spark):
    """A polygon of 4,000 edges: cells stay small in edges, and their number is of the order of the boundary."""
    from blotter.operators.spatial import region_cells
    a = np.linspace(0, 2 * np.pi, 4000, endpoint=False)
    ring = [(float(1e5 + 7 * np.cos(t)), float(-3 + 7 * np.sin(t))) for t in a]
    wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring + ring[:1]) + "))"
    cells = region_cells(region_edges(spark.createDataFrame([("1", "R", wkt)], "bor_subb string, name string, geometry string")))
    sizes = [len(r.edges) if r.edges is not None else 0 for r in cells.collect()]
    assert max(sizes) <= 16 and sum(sizes) < 3 * 4000 and len(sizes) < 4000


def test_tagged_counts(spark):
    regions = spark.createDataFrame(REGIONS, "bor_subb string, name string, geometry string")
    pts = spark.createDataFrame([(p, x, y, g) for p, x, y in POINTS for g in (1, 1, 2)], "pid string, x double, y double, g int")
    from blotter.operators.spatial import tagged_counts
    got = {(r.g, r.name): r.n for r in tagged_counts(pts, regions, by=["g"], x="x", y="y").collect()}
    assert got == {(1, "WEST"): 8, (2, "WEST"): 4, (1, "EAST"): 4, (2, "EAST"): 2, (1, "ISLES"): 2, (2, "ISLES"): 1}
    assert tagged_counts(pts, regions.limit(0), x="x", y="y").count() == 0


def test_region_edges_drop_bad_geometry(spark):
    regions = spark.createDataFrame(REGIONS, "bor_subb string, name string, geometry string")
    names = {r.name for r in region_edges(regions).collect()}
    assert names == {"WEST", "EAST", "ISLES"}
    e = explode_edges(regions).filter("name = 'WEST'").orderBy("edge_no").collect()
    assert len(e) == 8 and (e[4].x1, e[4].y1, e[4].x2, e[4].y2) == (4.0, 4.0, 6.0, 4.0)


def test_region_year_counts_key(spark):
    df = spark.createDataFrame([("c1", "west", 2019), ("c2", "West", 2019), ("c3", "WEST", None)],
                               "CMPLNT_NUM string, name string, Year int")
    got = {r.Key: r.crime_count for r in region_year_counts(df).collect()}
    assert got == {"WEST2019": 2, None: 1}


def test_read_geojson_regions(spark, tmp_path):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"bor_subb": 1, "name": "SQ"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}},
        {"type": "Feature", "properties": {"bor_subb": 2, "name": "MP"},
         "geometry": {"type": "MultiPolygon",
                      "coordinates": [[[[5, 5], [6, 5], [6, 6], [5, 5]]], [[[8, 8], [9, 8], [9, 9], [8, 8]]]]}}]}
    p = tmp_path / "r.geojson"
    p.write_text(json.dumps(fc))
    regions = read_regions(spark, str(p), fmt="geojson")
    pts = spark.createDataFrame([("a", 1.0, 1.0), ("b", 8.5, 8.2), ("c", 3.0, 3.0)], "pid string, x double, y double")
    got = sorted((r.pid, r.name) for r in tag_points(pts, regions, "x", "y", cell=1.0).collect())
    assert got == [("a", "SQ"), ("b", "MP")]


def test_kernel_density_normalisation(spark):
    pts = spark.createDataFrame([("k", 0.5, 0.5)] * 4 + [("k", 3.5, 0.5)], "g string, x double, y double")
    counts = grid_counts(pts, "x", "y", 1.0, by=["g"])
    assert {(r.gx, r.gy): r.n for r in counts.collect()} == {(0, 0): 4, (3, 0): 1}
    dens = {(r.gx, r.gy): r for r in kernel_density(counts, 1.0, 1.0, by=["g"]).collect()}
    assert math.isclose(dens[(0, 0)].weight, 4 + math.exp(-4.5))
    assert math.isclose(dens[(1, 0)].weight, 4 * math.exp(-0.5) + math.exp(-2.0))
    assert math.isclose(dens[(0, 0)].density, dens[(0, 0)].weight / (2 * math.pi * 5))


def test_kernel_keeps_the_whole_weight(spark):
    counts = spark.createDataFrame([("k", 0, 0, 1000)], "g string, gx long, gy long, n long")
    total = kernel_density(counts, 2.0, 2.0, by=["g"], least=0.0).agg(F.sum("weight")).first()[0]
    whole = 1000 * sum(math.exp(-d * d / 2) for d in range(-60, 61)) ** 2
    assert math.isclose(total, whole, rel_tol=1e-14)


def test_stratified_samples(spark):
    rows = [(f"k{i}", s) for i in range(4000) for s in ["A", "B", "C", None]][:8000]
    df = spark.createDataFrame(rows, "key string, s string")
    fr = {"A": 0.5, "B": 0.0}
    got = stratified_sample(df, "s", fr).groupBy("s").count().collect()
    counts = {r.s: r["count"] for r in got}
    assert set(counts) == {"A"} and 800 < counts["A"] < 1200
    h1 = stratified_sample_hash(df, "s", fr, "key")
    h2 = stratified_sample_hash(df.repartition(7), "s", fr, "key")
    assert sorted(r.key for r in h1.collect()) == sorted(r.key for r in h2.collect())
    assert {r.s for r in h1.collect()} == {"A"}
    assert h1.count() == h1.filter(F.col("s") == "A").count()


def test_read_regions_csv_by_header_name(spark, tmp_path):
    p = tmp_path / "regions.csv"
    p.write_text('name,geometry,bor_subb\nSQ,"POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))",7\n')
    r = read_regions(spark, str(p)).first()
    assert (r.bor_subb, r.name, r.geometry.startswith("POLYGON")) == ("7", "SQ", True)


def test_large_polygon_with_a_hole(spark):
    """3,000 edges, a hole, points on edges and vertices; both join paths against a plain even-odd test."""
    rng = np.random.default_rng(4)

    def ring(n, r0, r1, cx=1000.0, cy=-500.0):
        a = np.linspace(0, 2 * np.pi, n, endpoint=False)
        r = rng.uniform(r0, r1, n)
        p = [(float(cx + q * np.cos(t)), float(cy + q * np.sin(t))) for q, t in zip(r, a)]
        return p + p[:1]

    rings = [ring(2400, 8, 10), ring(600, 2, 3)]
    wkt = "POLYGON (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in rings) + ")"
    pts = [(float(x), float(y)) for x, y in rng.uniform(-11, 11, (400, 2)) + [1000, -500]]
    pts += rings[0][:50] + rings[1][:50]
    edges = [(a, b) for r in rings for a, b in zip(r, r[1:])]

    def hit(x, y):
        inside = False
        for (x1, y1), (x2, y2) in edges:
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) \
                    and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
        return inside

    want = sorted(i for i, p in enumerate(pts) if hit(*p))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "i long, x double, y double")
    regions = spark.createDataFrame([("1", "R", wkt)], "bor_subb string, name string, geometry string")
    for cell in (0.37, 5.0, 1000.0):
        for limit in ({}, {"max_broadcast_rows": 0}, {"max_broadcast_bytes": 0}):
            got = tag_points(df, regions, "x", "y", cell=cell, salt=3, **limit)
            assert sorted(r.i for r in got.collect()) == want


def test_only_hot_cells_are_replicated(spark):
    """Beyond the broadcast bounds the cover is shuffled once; a cell with many points alone is dealt over replicas."""
    regions = spark.createDataFrame([(str(k), f"R{k}", f"POLYGON (({k} 0, {k + 3} 0, {k + 3} 3, {k} 3, {k} 0))")
                                     for k in range(20)], "bor_subb string, name string, geometry string")
    places = [(k, 0.5 + k, 1.5) for k in range(20)] + [(100 + k, 7.25, 1.25) for k in range(400)] + [(None, 7.25, 1.25)] * 2
    points = spark.createDataFrame(places, "id long, x double, y double")
    key = lambda df: sorted(tuple(r) for r in df.select(F.coalesce("id", F.lit(-1)), "bor_subb").collect())
    want = sorted((-1 if i is None else i, str(k)) for i, x, _ in places for k in range(20) if k <= x <= k + 3)
    for hot in (100, 1 << 17):
        tagged = tag_points(points, regions, "x", "y", max_broadcast_rows=0, salt=32, hot=hot)
        assert key(tagged) == want
    # with no hot cell the join reads each cell once: 32 replicas of every cell before
    once, salted = (_rows_joined(tag_points(points, regions, "x", "y", max_broadcast_rows=0, salt=n)) for n in (1, 32))
    assert once == salted and sum(once) > 0


def _rows_joined(df):
    """Rows of the cover that a shuffle join of ``df`` exchanges."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []
    plan = plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange" and "_parity" in node.output().mkString(","):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return tuple(found)
