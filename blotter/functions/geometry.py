"""Planar geometry as native Spark expressions (GEO1, GEO2).

A polygon is kept as an ``ARRAY<STRUCT<x1,y1,x2,y2>>`` of its edges, taken
from every ring of a POLYGON or MULTIPOLYGON WKT text.  With all rings in one
edge list the even-odd rule handles holes and multi-part shapes at once.
Everything is a higher-order SQL function: JVM-side, with no Python worker,
though Spark evaluates the lambda bodies outside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One ring = the text between an innermost pair of parentheses.
_RING = r"\(([^()]+)\)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ring_edges(ring: Column) -> Column:
    pts = F.transform(
        F.split(F.trim(ring), r"\s*,\s*"),
        lambda p: F.struct(
            F.split(F.trim(p), r"\s+")[0].try_cast("double").alias("x"),
            F.split(F.trim(p), r"\s+")[1].try_cast("double").alias("y"),
        ),
    )
    n = F.size(pts)
    pairs = F.arrays_zip(F.slice(pts, 1, n - 1).alias("a"), F.slice(pts, 2, n - 1).alias("b"))
    return F.transform(pairs, lambda e: F.struct(
        e["a"]["x"].alias("x1"), e["a"]["y"].alias("y1"),
        e["b"]["x"].alias("x2"), e["b"]["y"].alias("y2")))


def wkt_edges(wkt) -> Column:
    """WKT (MULTI)POLYGON text -> array of edges; junk or ``'None'`` -> empty array."""
    rings = F.regexp_extract_all(_col(wkt), F.lit(_RING), 1)
    return F.flatten(F.transform(rings, _ring_edges))


def edges_valid(edges) -> Column:
    """True when the edge list is non-empty and every coordinate parsed."""
    e = _col(edges)
    return (F.size(e) > 0) & ~F.exists(
        e, lambda s: s.x1.isNull() | s.y1.isNull() | s.x2.isNull() | s.y2.isNull())


def edges_bbox(edges) -> dict[str, Column]:
    """Bounding box of an edge list as four DOUBLE columns."""
    e = _col(edges)
    return {
        "min_x": F.array_min(F.transform(e, lambda s: F.least(s.x1, s.x2))),
        "max_x": F.array_max(F.transform(e, lambda s: F.greatest(s.x1, s.x2))),
        "min_y": F.array_min(F.transform(e, lambda s: F.least(s.y1, s.y2))),
        "max_y": F.array_max(F.transform(e, lambda s: F.greatest(s.y1, s.y2))),
    }


def point_in_polygon(px, py, edges) -> Column:
    """Point intersects polygon: strictly inside (even-odd) or on its boundary.

    Boundary points count, as with an ``intersects`` predicate: a point on
    an edge shared by two regions belongs to both.
    """
    x, y, e = _col(px), _col(py), _col(edges)

    def crosses(s):
        # Division only where the edge straddles the ray (y1 != y2).
        return F.when((s.y1 > y) != (s.y2 > y),
                      x < (s.x2 - s.x1) * (y - s.y1) / (s.y2 - s.y1) + s.x1
                      ).otherwise(F.lit(False))

    inside = F.aggregate(e, F.lit(False), lambda acc, s: acc != crosses(s))
    return point_on_edge(x, y, e) | inside


def point_on_edge(px, py, edges) -> Column:
    """Point lies on one of the edges, ends included."""
    x, y = _col(px), _col(py)
    return F.exists(_col(edges), lambda s: (
        ((s.x2 - s.x1) * (y - s.y1) == (s.y2 - s.y1) * (x - s.x1))
        & (x >= F.least(s.x1, s.x2)) & (x <= F.greatest(s.x1, s.x2))
        & (y >= F.least(s.y1, s.y2)) & (y <= F.greatest(s.y1, s.y2))))
