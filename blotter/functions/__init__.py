"""Column-expression building blocks (all JVM-side, codegen friendly)."""

from blotter.functions.dates import civil_date, clock_hour, date_parts
from blotter.functions.keys import region_year_key, wkt_point
from blotter.functions.geometry import wkt_edges, point_in_polygon, edges_bbox
from blotter.functions.tdist import t_sf, t_two_sided

__all__ = ["civil_date", "clock_hour", "date_parts", "region_year_key", "wkt_point",
           "wkt_edges", "point_in_polygon", "edges_bbox", "t_sf", "t_two_sided"]
