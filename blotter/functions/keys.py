"""Surrogate keys and text encodings (STR1-STR3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def region_year_key(region, year) -> Column:
    """``upper(region) || year``; NULL when either part is NULL (never joins)."""
    r = F.col(region) if isinstance(region, str) else region
    y = F.col(year) if isinstance(year, str) else year
    return F.concat(F.upper(r), y.cast("string"))


def wkt_point(x, y) -> Column:
    """WKT ``POINT(x y)`` text (x = longitude first)."""
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    return F.concat(F.lit("POINT("), xc.cast("string"), F.lit(" "), yc.cast("string"), F.lit(")"))
