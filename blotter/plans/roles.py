"""Role mapping: driver tables -> raw incident feeds, regions, demographics.

The driver ships TPC-H-style tables, not incident feeds, so each feed is a
projection of real rows:

* complaints = orders x customer x nation x region (offence = order
  priority, premises = market segment, borough = region name, date = order
  date as ``MM/dd/yyyy`` text, point = (totalprice, account balance) plane);
* arrests = lineitem x part (offence = brand, race = part type, date = ship
  date, point = (quantity, discount) plane, borough = a one-letter code);
* region boundaries = one WKT polygon per nation (squares tiling the point
  plane, some with holes, some multi-part, one triangle, one missing);
* demographics = five yearly measures per region, derived from orders.

Derived fields assign coded values (age group, sex, junk dates, NULLs) by
the remainder of a record key, so every feed carries the legal, illegal and
NULL values the operators must treat correctly; no row is ever removed.

Every field is one SQL expression string that Spark SQL and DuckDB both
evaluate identically, so the DuckDB oracle reads exactly the same feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.session import materialize

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _civil_text(d: str, key: str) -> str:
    """Date as ``MM/dd/yyyy`` text; some one-digit, some junk, some NULL."""
    y = f"CAST(year({d}) AS STRING)"
    m = f"CAST(month({d}) AS STRING)"
    dd = f"CAST(dayofmonth({d}) AS STRING)"
    padded = f"lpad({m}, 2, '0') || '/' || lpad({dd}, 2, '0') || '/' || {y}"
    short = f"{m} || '/' || {dd} || '/' || {y}"
    return (f"CASE WHEN {key} % 211 = 0 THEN NULL "
            f"WHEN {key} % 197 = 0 THEN '13/45/2019' "
            f"WHEN {key} % 193 = 0 THEN 'n/a' "
            f"WHEN {key} % 2 = 0 THEN {short} ELSE {padded} END")


def _coded(key: str, modulus: int, values: list) -> str:
    whens = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'")
                     for i, v in enumerate(values))
    return f"CASE {key} % {modulus} {whens} ELSE NULL END"


_AGES = ["<18", "18-24", "25-44", "45-64", "65+", "UNKNOWN"]
_C_LAT = "CAST(floor((c_acctbal + 1000) * 0.4) AS DOUBLE) / 100"
_C_LON = "CAST(floor(o_totalprice / 100) AS DOUBLE) / 100"
_A_KEY = "(l_orderkey * 8 + l_linenumber)"

COMPLAINT_EXPRS: dict[str, str] = {
    "CMPLNT_NUM": "CAST(o_orderkey AS STRING)",
    "CMPLNT_FR_DT": _civil_text("o_orderdate", "o_orderkey"),
    "CMPLNT_FR_TM": ("CASE WHEN o_orderkey % 199 = 0 THEN '24:00:00' "
                     "WHEN o_orderkey % 191 = 0 THEN NULL "
                     "ELSE lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 24 AS STRING), 2, '0') || ':' "
                     "|| lpad(CAST(CAST(floor(o_totalprice * 7) AS BIGINT) % 60 AS STRING), 2, '0') || ':00' END"),
    "RPT_DT": "CAST(year(o_orderdate) AS STRING)",
    "KY_CD": "CAST(c_custkey % 1000 AS STRING)",
    "PD_CD": "CAST(o_custkey AS STRING)",
    "ADDR_PCT_CD": "CAST(c_nationkey AS STRING)",
    "OFNS_DESC": "o_orderpriority",
    "CRM_ATPT_CPTD_CD": "CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE 'ATTEMPTED' END",
    "LAW_CAT_CD": "CASE o_orderstatus WHEN 'F' THEN 'FELONY' WHEN 'O' THEN 'MISDEMEANOR' ELSE 'VIOLATION' END",
    "BORO_NM": "r_name",
    "PREM_TYP_DESC": "c_mktsegment",
    "JURIS_DESC": "'POLICE DEPT'",
    "SUSP_AGE_GROUP": _coded("o_custkey", 8, _AGES + ["-942", None]),
    "SUSP_RACE": "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END",
    "SUSP_SEX": ("CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE "
                 + _coded("o_orderkey", 4, ["U", None, "X", "M"]) + " END"),
    "Latitude": f"CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE {_C_LAT} END",
    "Longitude": f"CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE {_C_LON} END",
    "Lat_Lon": ("CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE '(' "
                "|| CAST(CAST(floor((c_acctbal + 1000) * 0.4) AS BIGINT) AS STRING) || ', ' "
                "|| CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS STRING) || ')' END"),
    "VIC_AGE_GROUP": _coded("o_orderkey", 7, _AGES + [None]),
    "VIC_RACE": "CASE o_orderstatus WHEN 'F' THEN 'WHITE' WHEN 'O' THEN 'BLACK' ELSE 'UNKNOWN' END",
    "VIC_SEX": ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'M' WHEN 'BUILDING' THEN 'F' "
                "WHEN 'FURNITURE' THEN 'D' "
                "WHEN 'HOUSEHOLD' THEN CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'E' END "
                "ELSE CASE WHEN o_orderkey % 5 = 0 THEN 'Z' ELSE 'U' END END"),
}

ARREST_EXPRS: dict[str, str] = {
    "ARREST_KEY": f"CAST({_A_KEY} AS STRING)",
    "ARREST_DATE": _civil_text("l_shipdate", _A_KEY),
    "PD_CD": "CAST(l_partkey % 1000 AS STRING)",
    "KY_CD": "CAST(l_suppkey % 100 AS STRING)",
    "OFNS_DESC": "p_brand",
    "LAW_CODE": "'PL ' || CAST(p_size AS STRING)",
    "LAW_CAT_CD": "CASE l_returnflag WHEN 'R' THEN 'F' WHEN 'A' THEN 'M' ELSE 'V' END",
    "ARREST_BORO": _coded("l_suppkey", 7, ["B", "S", "K", "M", "Q", "X", None]),
    "ARREST_PRECINCT": "CAST(l_suppkey % 77 AS STRING)",
    "JURISDICTION_CODE": "'0'",
    "AGE_GROUP": _coded("l_partkey", 7, _AGES + [None]),
    "PERP_SEX": "CASE l_linestatus WHEN 'O' THEN 'M' ELSE 'F' END",
    "PERP_RACE": "p_type",
    "X_COORD_CD": "CAST(l_linenumber AS STRING)",
    "Y_COORD_CD": "CAST(l_linenumber AS STRING)",
    "Latitude": "CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE CAST(floor(l_discount * 400 + 0.5) AS DOUBLE) END",
    "Longitude": "CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE l_quantity END",
}


def _ring(x0: str, y0: str, x1: str, y1: str) -> str:
    p = lambda x, y: f"CAST({x} AS STRING) || ' ' || CAST({y} AS STRING)"
    return " || ', ' || ".join([p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0)])


REGION_CELL_EXPRS: dict[str, str] = {
    "k": "n_nationkey",
    "name": "n_name",
    "x0": "(n_nationkey % 5) * 10",
    "y0": "CAST(floor(n_nationkey / 5) AS INT) * 8",
}
_tri = " || ', ' || ".join(
    f"CAST({x} AS STRING) || ' ' || CAST({y} AS STRING)"
    for x, y in [("x0", "y0"), ("x0 + 10", "y0"), ("x0", "y0 + 8"), ("x0", "y0")])
REGION_EXPRS: dict[str, str] = {
    "bor_subb": "CAST(k AS STRING)",
    "name": "name",
    "geometry": (
        "CASE WHEN k = 24 THEN 'None' "
        "WHEN k % 4 = 1 THEN 'POLYGON ((' || " + _ring("x0", "y0", "x0 + 10", "y0 + 8")
        + " || '), (' || " + _ring("x0 + 3", "y0 + 2", "x0 + 7", "y0 + 6") + " || '))' "
        "WHEN k % 4 = 2 THEN 'MULTIPOLYGON (((' || " + _ring("x0", "y0", "x0 + 4", "y0 + 8")
        + " || ')), ((' || " + _ring("x0 + 6", "y0", "x0 + 10", "y0 + 8") + " || ')))' "
        "WHEN k % 4 = 3 THEN 'POLYGON ((' || " + _tri + " || '))' "
        "ELSE 'POLYGON ((' || " + _ring("x0", "y0", "x0 + 10", "y0 + 8") + " || '))' END"),
}

# Service areas: one polygon per supplier (their number grows with the data),
# 4 x 4 squares scattered over the plane and overlapping; some with a hole,
# some in two parts, some triangles, some missing or unparsable.
AREA_CELL_EXPRS: dict[str, str] = {
    "k": "s_suppkey",
    "name": "s_name",
    "x0": "(s_suppkey * 7) % 47",
    "y0": "(s_suppkey * 11) % 41",
}
_atri = " || ', ' || ".join(
    f"CAST({x} AS STRING) || ' ' || CAST({y} AS STRING)"
    for x, y in [("x0", "y0"), ("x0 + 4", "y0"), ("x0", "y0 + 4"), ("x0", "y0")])
AREA_EXPRS: dict[str, str] = {
    "bor_subb": "CAST(k AS STRING)",
    "name": "name",
    "geometry": (
        "CASE WHEN k % 97 = 5 THEN 'None' "
        "WHEN k % 89 = 7 THEN 'POLYGON ((a b, 1 1, 0 0))' "
        "WHEN k % 4 = 1 THEN 'POLYGON ((' || " + _ring("x0", "y0", "x0 + 4", "y0 + 4")
        + " || '), (' || " + _ring("x0 + 1", "y0 + 1", "x0 + 3", "y0 + 3") + " || '))' "
        "WHEN k % 4 = 2 THEN 'MULTIPOLYGON (((' || " + _ring("x0", "y0", "x0 + 1", "y0 + 4")
        + " || ')), ((' || " + _ring("x0 + 3", "y0", "x0 + 4", "y0 + 4") + " || ')))' "
        "WHEN k % 4 = 3 THEN 'POLYGON ((' || " + _atri + " || '))' "
        "ELSE 'POLYGON ((' || " + _ring("x0", "y0", "x0 + 4", "y0 + 4") + " || '))' END"),
}

# Five yearly measures per region, from orders of that region's customers.
DEMO_YEARS = ["1995", "1996", "1997", "1998", "1999", "2000", "2001"]
DEMO_GROUP_EXPRS = {"Borough": "r_name", "Year": "CAST(year(o_orderdate) AS STRING)"}
SUB_DEMO_GROUP_EXPRS = {"Borough": "n_name", "Year": "CAST(year(o_orderdate) AS STRING)"}
DEMO_MEASURE_EXPRS: dict[str, str] = {
    "proverty_rate": ("CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS DOUBLE) * 100 "
                      "/ CAST(count(*) AS DOUBLE)"),
    "income_diversity": "max(o_totalprice) / min(o_totalprice)",
    "racial_diversity": "CAST(count(DISTINCT o_custkey) AS DOUBLE) / CAST(count(*) AS DOUBLE)",
    "unemployment_rate": ("CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS DOUBLE) * 100 "
                          "/ CAST(count(*) AS DOUBLE)"),
    "population": "CAST(count(DISTINCT o_custkey) AS DOUBLE)",
}
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

# Plane coordinates of the point feeds: grid cell of the density surfaces
# (the plane spans [0, 50] x [0, 44]).
DENSITY_CELL = 2.0
DENSITY_BANDWIDTH = 2.0
SINCE = "1996-01-01"
SPATIAL_SINCE = "1999-01-01"   # the last three years of the feed
HEAT_LAYERS = 3
# Per-stratum sampling fractions over the arrest "race" values of the role
# feed: sampled strata, a zero-fraction stratum and one stratum left out.
STRATUM_FRACTIONS = {"ECONOMY": 0.01, "LARGE": 0.01, "MEDIUM": 0.01, "PROMO": 0.0, "SMALL": 0.01}


def _select(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {k}" for k, e in exprs.items()])


def complaints_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    return _select(j, COMPLAINT_EXPRS)


def arrests_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return _select(li.join(p, li.l_partkey == p.p_partkey), ARREST_EXPRS)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return _select(_select(n, REGION_CELL_EXPRS), REGION_EXPRS)


def _orders_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey))


def service_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return _select(_select(s, AREA_CELL_EXPRS), AREA_EXPRS)


def demographics_measures(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """Long ``(Borough, Year, measure...)`` yearly facts per region (or nation)."""
    groups = DEMO_GROUP_EXPRS if level == "region" else SUB_DEMO_GROUP_EXPRS
    g = [F.expr(e).alias(k) for k, e in groups.items()]
    return _orders_by_place(spark, sf_dir).groupBy(*g).agg(
        *[F.expr(e).alias(k) for k, e in DEMO_MEASURE_EXPRS.items()])


def demographics_wide(spark: SparkSession, sf_dir: str, level: str = "region") -> dict[str, DataFrame]:
    """One wide table per measure: entity, short/long name, one column per year.

    At nation level the entity column is called ``Sub-Borough Area``, as in
    the finer-grained demographic files.
    """
    m = demographics_measures(spark, sf_dir, level)
    entity = "Borough" if level == "region" else "Sub-Borough Area"
    # One pivot for all measures (columns "<year>_<measure>"), split per measure.
    # It is small (entities x years) and written once: a lazy frame would be planned, and the big
    # source scanned, once per measure.
    wide = materialize(m.groupBy("Borough").pivot("Year", DEMO_YEARS).agg(
        *[F.first(measure).alias(measure) for measure in DEMO_MEASURE_EXPRS]))
    out = {}
    for measure in DEMO_MEASURE_EXPRS:
        out[measure] = wide.select(
            F.col("Borough").alias(entity),
            F.lower(F.substring("Borough", 1, 3)).alias("short_name"),
            F.initcap("Borough").alias("long_name"),
            *[F.col(f"`{y}_{measure}`").alias(y) for y in DEMO_YEARS])
    return out


# ---- the same feeds as SQL common table expressions, for the oracle ----

def _sql_select(exprs: dict[str, str]) -> str:
    return ",\n    ".join(f"{e} AS {k}" for k, e in exprs.items())


COMPLAINTS_CTE = (
    "complaints_raw AS (SELECT " + _sql_select(COMPLAINT_EXPRS)
    + " FROM orders JOIN customer ON o_custkey = c_custkey"
    " JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)")
ARRESTS_CTE = (
    "arrests_raw AS (SELECT " + _sql_select(ARREST_EXPRS)
    + " FROM lineitem JOIN part ON l_partkey = p_partkey)")
REGIONS_CTE = (
    "regions_raw AS (SELECT " + _sql_select(REGION_EXPRS)
    + " FROM (SELECT " + _sql_select(REGION_CELL_EXPRS) + " FROM nation) AS cells)")
AREAS_CTE = (
    "areas_raw AS (SELECT " + _sql_select(AREA_EXPRS)
    + " FROM (SELECT " + _sql_select(AREA_CELL_EXPRS) + " FROM supplier) AS cells)")
DEMO_CTE = (
    "demo_measures AS (SELECT " + _sql_select(DEMO_GROUP_EXPRS) + ", "
    + _sql_select(DEMO_MEASURE_EXPRS)
    + " FROM orders JOIN customer ON o_custkey = c_custkey"
    " JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
    " GROUP BY 1, 2)")
SUB_DEMO_CTE = (
    "sub_demo_measures AS (SELECT " + _sql_select(SUB_DEMO_GROUP_EXPRS) + ", "
    + _sql_select(DEMO_MEASURE_EXPRS)
    + " FROM orders JOIN customer ON o_custkey = c_custkey"
    " JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
    " GROUP BY 1, 2)")
