"""Spatial operators: region tagging and density surfaces (JN3, SPA1-SPA5, AGG10).

Point-in-polygon join
---------------------
There is no geometry engine: polygons are edge arrays (``functions.geometry``)
and the join is an equi-join on the cells of a *quad-tree cover* of each
region:

1. a region is covered by square cells of power-of-two sizes that adapt to
   its edges.  Cells no edge touches are whole: inside (kept without edges)
   or outside (dropped).  Cells an edge touches are split down to a share of
   the region's extent, and further while they hold many edges;
2. a boundary cell keeps the edges that touch it and one bit, the parity of
   its reference corner; the bit stands for all other edges of the region;
3. a point asks for its ancestor cell on every level that the cover uses and
   joins on ``(level, cx, cy)`` -- a hash equi-join instead of a points x
   regions nested loop;
4. points of inside cells are hits; points of boundary cells get the exact
   even-odd / on-edge test on the few edges of their cell.

The cells of one region do not overlap, so a pair is produced at most once and
no de-duplication is needed.  No join carries whole shapes.  The cover is
broadcast only after its rows and bytes have been checked against bounds;
beyond them the join shuffles, and only cells with very many points are
salted, so that a hot cell is split over many tasks.  Where only counts per region are wanted, points are counted per
coordinate first (:func:`tagged_counts`): geocoded feeds repeat coordinates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.geometry import edges_bbox, edges_valid, point_on_edge, wkt_edges
from blotter.session import materialize

# Broadcast bounds for the region side: rows (cells or regions) and bytes of edges.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20
HOT_POINTS = 1 << 17                         # points of a cell that one task of a shuffle join tests
_ROUNDING = 2.0 ** -45                       # relative slack of the touch test, far above a double's rounding


def region_edges(regions: DataFrame, id_col: str = "bor_subb", name_col: str = "name",
                 geometry_col: str = "geometry") -> DataFrame:
    """GEO1: ``(id, name, geometry WKT)`` -> ``(id, name, edges, bbox...)``.

    Rows with a missing id/name/geometry, or geometry text that does not
    parse (e.g. the string ``'None'``), are dropped.
    """
    r = regions.dropna(subset=[id_col, name_col, geometry_col])
    r = r.withColumn("edges", wkt_edges(geometry_col)).filter(edges_valid("edges"))
    return r.select(id_col, name_col, "edges", *[v.alias(k) for k, v in edges_bbox("edges").items()])


def explode_edges(regions: DataFrame, id_col: str = "bor_subb", name_col: str = "name",
                  geometry_col: str = "geometry") -> DataFrame:
    """One row per polygon edge: ``(id, name, edge_no, x1, y1, x2, y2)``."""
    e = region_edges(regions, id_col, name_col, geometry_col)
    return e.select(id_col, name_col, F.posexplode("edges").alias("edge_no", "e")) \
        .select(id_col, name_col, "edge_no", "e.x1", "e.y1", "e.x2", "e.y2")


def _near(e, x, y, half):
    """Whether an edge may touch the closed square around (x, y); errs on the side of yes."""
    dx, dy = e.x2 - e.x1, e.y2 - e.y1
    slack_x, slack_y = (F.abs(v) + half for v in (x, y))
    wide_x, wide_y = half + slack_x * _ROUNDING, half + slack_y * _ROUNDING
    aside = F.abs(dx * (y - e.y1) - dy * (x - e.x1))
    reach = (F.abs(dx) * (wide_y + (F.abs(y) + F.abs(e.y1)) * _ROUNDING)
             + F.abs(dy) * (wide_x + (F.abs(x) + F.abs(e.x1)) * _ROUNDING))
    return ((F.greatest(e.x1, e.x2) >= x - wide_x) & (F.least(e.x1, e.x2) <= x + wide_x)
            & (F.greatest(e.y1, e.y2) >= y - wide_y) & (F.least(e.y1, e.y2) <= y + wide_y) & (aside <= reach))


def _toggles(x, y, right):
    """Whether an edge of a cell lies between (x, y) and the cell's reference corner.

    The way goes right along y to the cell's ``right`` side, then down it.
    An edge that crosses the line of that side is met either on the first leg
    or on the second; only the comparison of x with the edge at height y is
    computed, as in :func:`point_in_polygon`, so rounding cannot count an edge
    on both legs.
    """
    def of(e):
        spans = (e.y1 > y) != (e.y2 > y)
        before = F.when(spans, x < (e.x2 - e.x1) * (y - e.y1) / (e.y2 - e.y1) + e.x1)
        rising = (e.x2 > e.x1) == (e.y2 > e.y1)
        return (F.when((e.x1 > right) != (e.x2 > right),
                       F.when(spans, before == rising).otherwise(F.greatest(e.y1, e.y2) <= y))
                .when(F.least(e.x1, e.x2) > right, F.lit(False)).otherwise(F.coalesce(before, F.lit(False))))

    return of


def point_in_cell(x, y, right, parity, edges) -> Column:
    """:func:`point_in_polygon` for a point of a cover cell, from the cell's edges and parity alone."""
    toggles = _toggles(x, y, right)
    inside = F.aggregate(edges, parity, lambda acc, e: acc != toggles(e))
    return point_on_edge(x, y, edges) | inside


def _split(cells: DataFrame, halvings: int) -> DataFrame:
    """The cells ``halvings`` levels below each cell, without those outside the region.

    One row an edge and new cell, then one aggregate a new cell, so no cell
    copies edges that do not touch it.  ``_parity`` of a new cell is fixed at
    its corner of lowest coordinates: the old cell's edges say whether that
    corner is inside, the new cell's edges how often they are crossed on the
    way from it.
    """
    parts = lambda c: F.sequence(F.shiftleft(c, halvings), F.shiftleft(c, halvings) + (1 << halvings) - 1)
    xs, ys = (F.coalesce(first, parts(c)) for first, c in (("_xs", F.col("_cx")), ("_ys", F.col("_cy"))))
    at = (cells.select("_region", (F.col("_level") - halvings).alias("_level"), F.col("_right").alias("_up"), "_parity",
                       xs.alias("_xs"), ys.alias("_ys"), F.explode("edges").alias("e"))
          .withColumn("_cx", F.explode("_xs")).withColumn("_cy", F.explode("_ys")))
    size = F.pow(F.lit(2.0), F.col("_level"))
    at = at.withColumns({"_x": F.col("_cx") * size, "_y": F.col("_cy") * size,
                         "_right": (F.col("_cx") + 1) * size, "_half": size / 2})
    x, y, half = F.col("_x"), F.col("_y"), F.col("_half")
    at = at.withColumns({"_near": _near(F.col("e"), x + half, y + half, half),
                         "_above": _toggles(x, y, F.col("_up"))(F.col("e")),
                         "_below": _toggles(x, y, F.col("_right"))(F.col("e"))})
    new = at.groupBy("_region", "_level", "_cx", "_cy", "_right", "_parity").agg(
        F.collect_list(F.when(F.col("_near"), F.col("e"))).alias("edges"),
        F.count_if("_above").alias("_a"), F.count_if(F.col("_near") & F.col("_below")).alias("_b"))
    inside = F.col("_parity") != (F.col("_a") % 2 == 1)
    none = F.lit(None).cast("array<bigint>")
    return (new.withColumn("_in", inside).filter((F.size("edges") > 0) | F.col("_in"))
            .select("_region", "_level", "_cx", "_cy", "_right", (F.col("_in") != (F.col("_b") % 2 == 1)).alias("_parity"),
                    "edges", none.alias("_xs"), none.alias("_ys")))


def region_cells(edges: DataFrame, cell: float | None = None, id_col: str = "bor_subb", name_col: str = "name",
                 leaf_edges: int = 16, max_splits: int = 8) -> DataFrame:
    """Quad-tree cover of each region: ``(id, name, _level, _cx, _cy, _interior, _right, _parity, edges)``.

    A cell is ``[_cx, _cx + 1) x [_cy, _cy + 1)`` times ``2 ** _level``, so
    cell numbers of points are exact.  The first cells are a quarter of the
    region's extent (rounded up to a power of two); those an edge touches are
    split into 16 once, and again while they hold more than ``leaf_edges``
    edges, at most ``max_splits`` times (where many edges share a vertex no
    splitting parts them).  ``cell`` keeps cells from being split below that
    size unless they hold more than ``leaf_edges`` edges.  Edges go down to
    the cells they touch, so the work grows with the edges and the boundary's
    length, not with their product.  ``edges`` is null in inside cells.
    """
    extent = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"),
                        *[F.abs(c) * 2.0 ** -30 for c in ("min_x", "max_x", "min_y", "max_y")], F.lit(2.0 ** -500))
    regions = materialize(edges.withColumn("_region", F.monotonically_increasing_id()))
    first = regions.withColumn("_level", F.ceil(F.log2(extent)).cast("int"))
    size = F.pow(F.lit(2.0), F.col("_level") - 2)
    span = lambda low, high: F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size))
    nowhere = F.lit(None).cast("bigint")
    whole = first.select("_region", "_level", nowhere.alias("_cx"), nowhere.alias("_cy"), F.lit(float("inf")).alias("_right"),
                         F.lit(False).alias("_parity"), "edges", span("min_x", "max_x").alias("_xs"),
                         span("min_y", "max_y").alias("_ys"))
    cells = materialize(_split(whole, 2))
    small = F.lit(False) if cell is None else F.pow(F.lit(2.0), F.col("_level")) <= cell
    open_, leaves = (F.size("edges") > 0) & (~small | (F.size("edges") > leaf_edges)), []
    for _ in range(max_splits):
        leaves.append(cells.filter(~open_))
        cells = materialize(_split(cells.filter(open_), 2))
        open_ = F.size("edges") > leaf_edges
        if cells.filter(open_).isEmpty():
            break
    touched = F.size("edges") > 0
    cover = reduce(DataFrame.unionByName, leaves, cells).select(
        "_region", "_level", "_cx", "_cy", (~touched).alias("_interior"), "_right", "_parity",
        F.when(touched, F.col("edges")).alias("edges"))
    return cover.join(regions.select("_region", id_col, name_col), "_region").drop("_region")


def valid_points(points: DataFrame, x: str, y: str) -> DataFrame:
    """Drop points with a NULL or NaN coordinate."""
    return points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()
                         & ~F.isnan(F.col(x)) & ~F.isnan(F.col(y)))


def tag_points(points: DataFrame, regions: DataFrame, x: str = "Longitude", y: str = "Latitude",
               cell: float | None = None, id_col: str = "bor_subb", name_col: str = "name",
               geometry_col: str = "geometry", max_broadcast_rows: int = MAX_BROADCAST_ROWS,
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES, salt: int = 32, hot: int = HOT_POINTS) -> DataFrame:
    """JN3/GEO2: every (point, region) pair where the point intersects the
    region (inside or on the boundary).  Output: point columns + id + name.

    The cover (:func:`region_cells`) is computed once and written.  Within
    ``max_broadcast_rows`` rows and ``max_broadcast_bytes`` of edges (32 bytes
    each): a broadcast hash join, the points are never shuffled.  Beyond it: a
    shuffle join.  Only a cell with more than ``hot`` points is replicated,
    once a ``hot`` points and at most ``salt`` times, with each point sent to
    one replica chosen by a hash of the point; so a cell holding a third of
    all points is split over ``salt`` tasks, and the cover is shuffled once.
    """
    cover = materialize(region_cells(region_edges(regions, id_col, name_col, geometry_col), cell, id_col, name_col))
    size = cover.agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.size("edges"), F.lit(0))).alias("e"),
                     F.collect_set("_level").alias("levels")).first()
    fits = (size["n"] or 0) <= max_broadcast_rows and 32 * (size["e"] or 0) <= max_broadcast_bytes
    # one key a level in use: a double has at most some hundred, a layer of similar regions a handful
    keys = [F.struct(F.lit(lv).alias("_level"), F.floor(F.col(x) * F.lit(2.0 ** -lv)).alias("_cx"),
                     F.floor(F.col(y) * F.lit(2.0 ** -lv)).alias("_cy")) for lv in sorted(size["levels"])]
    at = F.array(*keys) if keys else F.array().cast("array<struct<_level:int,_cx:bigint,_cy:bigint>>")
    pts = valid_points(points, x, y)
    on = ["_level", "_cx", "_cy"]
    if fits:
        cand = pts.select(*points.columns, F.inline(at)).join(F.broadcast(cover), on)
    else:
        full = F.broadcast(materialize(pts.select(F.inline(at)).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
                                       .filter(F.col("_n") > hot)
                                       .select(*on, F.least(F.ceil(F.col("_n") / hot), F.lit(salt)).alias("_salts"))))
        salts = F.coalesce("_salts", F.lit(1))
        replicas = F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("_salt")
        dealt = F.pmod(F.xxhash64(*[F.col(c) for c in points.columns]), salts).alias("_salt")
        cand = (pts.select("*", F.inline(at)).join(full, on, "left").select(*points.columns, *on, dealt)
                .join(cover.join(full, on, "left").select(*cover.columns, replicas), [*on, "_salt"]))
    hit = cand.filter(F.col("_interior") | point_in_cell(F.col(x), F.col(y), F.col("_right"), F.col("_parity"), F.col("edges")))
    return hit.select(*points.columns, id_col, name_col)


def tagged_counts(points: DataFrame, regions: DataFrame, by: Sequence[str] = (), x: str = "Longitude",
                  y: str = "Latitude", id_col: str = "bor_subb", name_col: str = "name",
                  count: Column | None = None, **options) -> DataFrame:
    """Points per region (and per group of ``by``): ``(*by, id, name, n)``.

    Points are counted per coordinate and group before the join, map-side, so
    the spatial join sees every coordinate once a group.  ``count`` replaces
    the count of rows (e.g. ``count(id)``, which leaves out null ids).
    """
    n = F.count(F.lit(1)) if count is None else count
    once = valid_points(points, x, y).groupBy(*by, x, y).agg(n.alias("_n"))
    tagged = tag_points(once, regions, x=x, y=y, id_col=id_col, name_col=name_col, **options)
    return tagged.groupBy(*by, id_col, name_col).agg(F.sum("_n").cast("long").alias("n"))


def region_year_counts(tagged: DataFrame, name_col: str = "name", year_col: str = "Year",
                       id_col: str = "CMPLNT_NUM", key: str = "Key", weight: str | None = None) -> DataFrame:
    """SPA5: records per region-year, keyed ``upper(name) || year``; ``weight`` sums counts made before."""
    k = F.concat(F.upper(F.col(name_col)), F.col(year_col).cast("string"))
    n = F.sum(weight).cast("long") if weight else F.count(F.col(id_col))
    return tagged.groupBy(k.alias(key)).agg(n.alias("crime_count"))


def grid_counts(points: DataFrame, x: str, y: str, cell: float, by: Sequence[str] = ()) -> DataFrame:
    """SPA1/SPA2 step 1: points binned to grid cells: ``(by, gx, gy, n)``.

    A partial aggregate per task, so only occupied-cell counts shuffle.
    """
    p = valid_points(points, x, y)
    return p.groupBy(*by, F.floor(F.col(x) / F.lit(cell)).alias("gx"),
                     F.floor(F.col(y) / F.lit(cell)).alias("gy")).agg(F.count(F.lit(1)).alias("n"))


def kernel_radius(cell: float, bandwidth: float, tail: float = 2.0 ** -53) -> int:
    """Cells from a point beyond which the Gaussian weight is below ``tail``
    (by default below what a double sum of the group can resolve)."""
    return math.ceil(bandwidth * math.sqrt(-2.0 * math.log(tail)) / cell)


def kernel_density(counts: DataFrame, cell: float, bandwidth: float, by: Sequence[str] = (),
                   least: float = 1e-6) -> DataFrame:
    """SPA1/SPA2 step 2: Gaussian kernel surface on the grid.

    Each occupied cell spreads its count with weight ``exp(-d^2 / 2 bw^2)``
    (d between cell corners) over every cell of the plane; the surface is the
    sum, listed wherever its weight is at least ``least``, and ``density``
    normalises by ``2 pi bw^2 N`` of the group.  Weights below
    :func:`kernel_radius`'s tail are not computed: what they add to a cell is
    below the rounding of the group's total.  The Gaussian is separable, so
    the spread is one pass along x and one along y: 2 (2r + 1) rows per
    occupied cell instead of (2r + 1)^2.  Work grows with occupied cells, not
    with points.
    """
    r = kernel_radius(cell, bandwidth)
    off = F.sequence(F.lit(-r), F.lit(r))

    def along(df: DataFrame, axis: str, value: str) -> DataFrame:
        other = "gy" if axis == "gx" else "gx"
        d = F.col("_d") * F.lit(float(cell))
        w = F.col(value) * F.exp(-(d * d) / F.lit(2.0 * bandwidth * bandwidth))
        spread = df.select(*by, "gx", "gy", value, F.explode(off).alias("_d"))
        return spread.groupBy(*by, (F.col(axis) + F.col("_d")).alias(axis), other).agg(F.sum(w).alias("weight"))

    surf = along(along(counts, "gx", "n"), "gy", "weight").filter(F.col("weight") >= least)
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_N"))
    joined = surf.join(totals, list(by)) if by else surf.withColumn("_N", counts.agg(F.sum("n")).scalar())
    return joined.select(*by, "gx", "gy", "weight", (
        F.col("weight") / (F.lit(2.0 * math.pi * bandwidth * bandwidth) * F.col("_N"))).alias("density"))


def heat_layer(points: DataFrame, x: str, y: str, by: Sequence[str] = (),
               digits: int | None = None, weight: str | None = None) -> DataFrame:
    """SPA3: valid points of a layer, weighted by how many share a location
    (optionally rounded to ``digits``); ``weight`` sums pre-aggregated counts."""
    p = valid_points(points, x, y)
    gx = F.round(F.col(x), digits) if digits is not None else F.col(x)
    gy = F.round(F.col(y), digits) if digits is not None else F.col(y)
    n = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
    return p.groupBy(*by, gy.alias(y), gx.alias(x)).agg(n.alias("weight"))


def group_extent(points: DataFrame, x: str, y: str, by: Sequence[str], total: str | None = None) -> DataFrame:
    """AGG10: coordinate extent and count of the valid points per group (groups without one have no row).

    ``total`` names a column that counts all records of the group, valid or
    not, in the same aggregate; then every group has a row.
    """
    ok = ~(F.isnull(x) | F.isnull(y) | F.isnan(x) | F.isnan(y))
    lat, lon = F.when(ok, F.col(y)), F.when(ok, F.col(x))
    every = [F.count(F.lit(1)).alias(total)] if total else []
    out = points.groupBy(*by).agg(F.min(lat).alias(f"min_{y}"), F.max(lat).alias(f"max_{y}"),
                                  F.min(lon).alias(f"min_{x}"), F.max(lon).alias(f"max_{x}"),
                                  F.count_if(ok).alias("n"), *every)
    return out if total else out.filter("n > 0")
