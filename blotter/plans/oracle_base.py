"""SQL building blocks for the DuckDB oracle (independent of the Spark code).

The oracle re-states every operator in plain SQL over the same role feeds
(``blotter.plans.roles``); only the feeds are shared.
"""

from __future__ import annotations

from blotter.plans.roles import (AREAS_CTE, ARRESTS_CTE, COMPLAINTS_CTE, DEMO_CTE, REGIONS_CTE,
                                 SUB_DEMO_CTE)

_N = "CAST(NULL AS VARCHAR)"


def _date(col: str) -> str:
    return f"CAST(try_strptime({col}, '%m/%d/%Y') AS DATE)"


INCIDENTS_CTE = f"""incidents AS (
  SELECT ARREST_KEY AS CMPLNT_NUM, 'A' AS RECORD_TYPE,
    CASE ARREST_BORO WHEN 'B' THEN 'BRONX' WHEN 'S' THEN 'STATEN ISLAND' WHEN 'K' THEN 'BROOKLYN'
      WHEN 'M' THEN 'MANHATTAN' WHEN 'Q' THEN 'QUEENS' ELSE ARREST_BORO END AS BORO_NM,
    ARREST_PRECINCT AS ADDR_PCT_CD, ARREST_DATE, {_N} AS CMPLNT_FR_DT, {_N} AS CMPLNT_FR_TM,
    OFNS_DESC, {_N} AS PREM_TYP_DESC, {_N} AS CRM_ATPT_CPTD_CD, {_N} AS LAW_CAT_CD,
    AGE_GROUP AS SUSP_AGE_GROUP, PERP_RACE AS SUSP_RACE, PERP_SEX AS SUSP_SEX,
    {_N} AS VIC_AGE_GROUP, {_N} AS VIC_RACE, {_N} AS VIC_SEX, {_N} AS Lat_Lon,
    TRY_CAST(Latitude AS DOUBLE) AS Latitude, TRY_CAST(Longitude AS DOUBLE) AS Longitude,
    CAST(year({_date('ARREST_DATE')}) AS INTEGER) AS Year,
    CAST(month({_date('ARREST_DATE')}) AS INTEGER) AS Month,
    {_date('ARREST_DATE')} AS Date
  FROM arrests_raw
  WHERE AGE_GROUP IN ('<18', '18-24', '25-44', '45-64', '65+')
  UNION ALL
  SELECT CMPLNT_NUM, 'C', BORO_NM, ADDR_PCT_CD, {_N}, CMPLNT_FR_DT, CMPLNT_FR_TM,
    OFNS_DESC, PREM_TYP_DESC, CRM_ATPT_CPTD_CD, LAW_CAT_CD,
    SUSP_AGE_GROUP, SUSP_RACE, SUSP_SEX, VIC_AGE_GROUP, VIC_RACE, VIC_SEX, Lat_Lon,
    TRY_CAST(Latitude AS DOUBLE), TRY_CAST(Longitude AS DOUBLE),
    CAST(year({_date('CMPLNT_FR_DT')}) AS INTEGER), CAST(month({_date('CMPLNT_FR_DT')}) AS INTEGER),
    {_date('CMPLNT_FR_DT')}
  FROM complaints_raw
  WHERE (SUSP_AGE_GROUP IN ('<18', '18-24', '25-44', '45-64', '65+', 'UNKNOWN') OR SUSP_AGE_GROUP IS NULL)
    AND (SUSP_SEX IN ('M', 'F', 'U') OR SUSP_SEX IS NULL)
    AND (VIC_SEX IN ('M', 'F', 'U', 'D', 'E') OR VIC_SEX IS NULL)
)"""

BASE = "WITH " + ",\n".join([ARRESTS_CTE, COMPLAINTS_CTE, INCIDENTS_CTE, REGIONS_CTE, DEMO_CTE,
                                  SUB_DEMO_CTE, AREAS_CTE])


def with_base(*ctes_and_body: str, recursive: bool = False) -> str:
    """``WITH <feeds>, <extra ctes...> <final select>``."""
    *ctes, body = ctes_and_body
    base = BASE.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else BASE
    head = base + "".join(",\n" + c for c in ctes)
    return head + "\n" + body


def quoted(v: str) -> str:
    return '"' + v.replace('"', '""') + '"'


def lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"
