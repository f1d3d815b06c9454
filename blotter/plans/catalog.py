"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.dates import civil_date, clock_hour
from blotter.operators.crosstab import crosstab_long, crosstab_wide, pair_counts
from blotter.operators.correspondence import ca_biplot, ca_inertia, ca_residuals, correspondence
from blotter.operators.sampling import stratified_sample, stratified_sample_hash
from blotter.operators.spatial import (explode_edges, grid_counts, group_extent, heat_layer,
                                       kernel_density, region_year_counts, tag_points, tagged_counts)
from blotter.operators.demographics import assemble_demographics, unpivot_years
from blotter.operators.regression import (attach_demographics, correlations, elastic_net, ols_general,
                                         ols_tests, region_year_facts)
from blotter.operators.harmonize import harmonize, record_type, since
from blotter.operators.scaling import cluster_rows, minmax, row_zscore_clip, zscore
from blotter.operators.temporal import (daily_pivot, hourly_pivot, monthly_resample, pivot_to_long,
                                        seasonal_profile)
from blotter.operators.ranking import top_categories_by_field, top_values
from blotter.plans import roles
from blotter.plans.oracle_base import lit, quoted, with_base
from blotter.schema import ELASTIC_NET, TOP_K
from blotter.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified incident table built from the role feeds (NRM1)."""
    return harmonize(roles.arrests_raw(spark, sf_dir), roles.complaints_raw(spark, sf_dir))


# Data domains of the driver tables, used where the oracle needs a static
# column list (the Spark side always derives its lists from the data).
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _in(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


# ---------------------------------------------------------------- relational

@register("harmonize_union", with_base("SELECT * FROM incidents"))
def q_harmonize_union(spark, sf_dir):
    return incidents(spark, sf_dir)


@register("parse_civil_dates", with_base("""
SELECT CMPLNT_NUM, CMPLNT_FR_DT, CMPLNT_FR_TM,
       CAST(try_strptime(CMPLNT_FR_DT, '%m/%d/%Y') AS DATE) AS cmplnt_date,
       CAST(hour(try_strptime(CMPLNT_FR_TM, '%H:%M:%S')) AS INTEGER) AS cmplnt_hour
FROM complaints_raw"""))
def q_parse_civil_dates(spark, sf_dir):
    c = roles.complaints_raw(spark, sf_dir)
    return c.select("CMPLNT_NUM", "CMPLNT_FR_DT", "CMPLNT_FR_TM",
                    civil_date("CMPLNT_FR_DT").alias("cmplnt_date"),
                    clock_hour("CMPLNT_FR_TM").alias("cmplnt_hour"))


@register("domain_filter_nulls", with_base("""
SELECT RECORD_TYPE, SUSP_AGE_GROUP, SUSP_SEX, VIC_SEX, count(*) AS n
FROM incidents WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL
GROUP BY ALL"""))
def q_domain_filter_nulls(spark, sf_dir):
    inc = incidents(spark, sf_dir).dropna(subset=["Latitude", "Longitude"])
    return (inc.groupBy("RECORD_TYPE", "SUSP_AGE_GROUP", "SUSP_SEX", "VIC_SEX")
            .agg(F.count(F.lit(1)).alias("n")))


_TOPK_K = 10


@register("topk_categories", with_base(f"""
ranked AS (
  SELECT RECORD_TYPE, field, category, n,
         CAST(row_number() OVER (PARTITION BY RECORD_TYPE, field
                                 ORDER BY n DESC, category ASC NULLS LAST) AS INTEGER) AS rank
  FROM (SELECT RECORD_TYPE, field, category, count(*) AS n
        FROM (SELECT RECORD_TYPE, 'OFNS_DESC' AS field, OFNS_DESC AS category FROM incidents
              UNION ALL SELECT RECORD_TYPE, 'PREM_TYP_DESC', PREM_TYP_DESC FROM incidents
              UNION ALL SELECT RECORD_TYPE, 'SUSP_RACE', SUSP_RACE FROM incidents) AS s
        GROUP BY ALL) AS c)""", f"""
SELECT * FROM ranked WHERE rank <= {_TOPK_K} AND category IS NOT NULL"""))
def q_topk_categories(spark, sf_dir):
    return top_categories_by_field(incidents(spark, sf_dir),
                                   ["OFNS_DESC", "PREM_TYP_DESC", "SUSP_RACE"],
                                   k=_TOPK_K, by=["RECORD_TYPE"])


def _complaint_counts(spark, sf_dir, row: str) -> tuple[DataFrame, list]:
    """Complaint counts per (row, offence), pre-aggregated once and
    checkpointed; the top offence list and the crosstab both come from it."""
    c = record_type(incidents(spark, sf_dir), "C")
    counts = materialize(pair_counts(c, row, "OFNS_DESC"))
    return counts, top_values(counts, "OFNS_DESC", TOP_K, weight="n")


_wide_cols = ", ".join(f"count(*) FILTER (WHERE OFNS_DESC = {lit(v)}) AS {quoted(v)}" for v in PRIORITIES)


@register("crosstab_wide", with_base(f"""
SELECT SUSP_RACE, {_wide_cols}
FROM incidents WHERE RECORD_TYPE = 'C' GROUP BY SUSP_RACE"""))
def q_crosstab_wide(spark, sf_dir):
    counts, offences = _complaint_counts(spark, sf_dir, "SUSP_RACE")
    return crosstab_wide(counts, "SUSP_RACE", "OFNS_DESC", offences, weight="n")


@register("crosstab_long", with_base(f"""
SELECT PREM_TYP_DESC, OFNS_DESC, n FROM (
  SELECT PREM_TYP_DESC, {_wide_cols}
  FROM incidents WHERE RECORD_TYPE = 'C' AND PREM_TYP_DESC IN {_in(SEGMENTS)}
  GROUP BY PREM_TYP_DESC) UNPIVOT (n FOR OFNS_DESC IN ({", ".join(quoted(v) for v in PRIORITIES)}))"""))
def q_crosstab_long(spark, sf_dir):
    return _location_cells(spark, sf_dir)


# ------------------------------------------------------------------ temporal

def _arrest_days(spark, sf_dir) -> tuple[DataFrame, list]:
    """Daily pivot of arrests since ``roles.SINCE`` over the top arrest offences."""
    a = record_type(incidents(spark, sf_dir), "A")
    counts = materialize(pair_counts(a, "Date", "OFNS_DESC"))
    offences = top_values(counts, "OFNS_DESC", TOP_K, weight="n")
    return daily_pivot(since(counts, roles.SINCE), "Date", "OFNS_DESC", offences, weight="n"), offences


_A_SINCE = f"incidents WHERE RECORD_TYPE = 'A' AND Date >= DATE {lit(roles.SINCE)}"
_A_CATS = ("cats AS (SELECT DISTINCT OFNS_DESC FROM incidents "
           "WHERE RECORD_TYPE = 'A' AND OFNS_DESC IS NOT NULL)")
BRANDS = [f"Brand#{i}" for i in range(1, 26)]
_brand_cols = ", ".join(f"count(*) FILTER (WHERE OFNS_DESC = {lit(v)}) AS {quoted(v)}" for v in BRANDS)


@register("daily_pivot", with_base(f"SELECT Date, {_brand_cols} FROM {_A_SINCE} GROUP BY Date"))
def q_daily_pivot(spark, sf_dir):
    return _arrest_days(spark, sf_dir)[0]


@register("monthly_resample", with_base(
    f"daily AS (SELECT Date, OFNS_DESC, count(*) AS n FROM {_A_SINCE} GROUP BY ALL)",
    "months AS (SELECT CAST(unnest(generate_series(min(date_trunc('month', Date)), "
    "max(date_trunc('month', Date)), INTERVAL 1 MONTH)) AS DATE) AS m FROM daily)",
    _A_CATS, """
SELECT last_day(m) AS month_end, c.OFNS_DESC, CAST(coalesce(sum(d.n), 0) AS BIGINT) AS n
FROM months CROSS JOIN cats c
LEFT JOIN daily d ON CAST(date_trunc('month', d.Date) AS DATE) = m AND d.OFNS_DESC = c.OFNS_DESC
GROUP BY ALL"""))
def q_monthly_resample(spark, sf_dir):
    wide, offences = _arrest_days(spark, sf_dir)
    return pivot_to_long(monthly_resample(wide, "Date", offences), "month_end", offences, "OFNS_DESC")


def _seasonal_oracle(part: str, fn: str, max_key: int | None) -> str:
    cond = f"WHERE {fn}(Date) <= {max_key}" if max_key else ""
    return with_base(
        f"a AS (SELECT Date, OFNS_DESC FROM {_A_SINCE})",
        f"keys AS (SELECT DISTINCT CAST({fn}(Date) AS INTEGER) AS {part} FROM a {cond})",
        _A_CATS,
        f"cnt AS (SELECT CAST({fn}(Date) AS INTEGER) AS {part}, OFNS_DESC, count(*) AS n FROM a GROUP BY ALL)",
        f"""grid AS (SELECT k.{part}, c.OFNS_DESC, CAST(coalesce(x.n, 0) AS BIGINT) AS n
          FROM keys k CROSS JOIN cats c LEFT JOIN cnt x ON x.{part} = k.{part} AND x.OFNS_DESC = c.OFNS_DESC)""",
        f"""SELECT {part}, OFNS_DESC, n,
       round((n - avg(n) OVER w) / NULLIF(stddev_samp(n) OVER w, 0), 6) AS z
FROM grid WINDOW w AS (PARTITION BY OFNS_DESC)""")


def _seasonal(spark, sf_dir, part: str, max_key: int | None) -> DataFrame:
    wide, offences = _arrest_days(spark, sf_dir)
    prof = pivot_to_long(seasonal_profile(wide, "Date", offences, part, max_key), part, offences,
                         "OFNS_DESC")
    return zscore(prof, "n", "OFNS_DESC", ddof=1).withColumn("z", F.round("z", 6))


@register("day_of_month_z", _seasonal_oracle("day", "dayofmonth", 28))
def q_day_of_month_z(spark, sf_dir):
    return _seasonal(spark, sf_dir, "day", 28)


@register("month_of_year_z", _seasonal_oracle("month", "month", None))
def q_month_of_year_z(spark, sf_dir):
    return _seasonal(spark, sf_dir, "month", None)


def _hours(spark, sf_dir) -> tuple[DataFrame, list]:
    ev = roles.table(spark, sf_dir, "events")
    counts = materialize(pair_counts(ev, F.hour("ts").alias("hour"), "event_type"))
    types = top_values(counts, "event_type", TOP_K, weight="n")
    return hourly_pivot(counts, "hour", "event_type", types, "hour", weight="n"), types


_ev_cols = ", ".join(f"count(*) FILTER (WHERE event_type = {lit(v)}) AS {quoted(v)}" for v in EVENT_TYPES)
_HOUR_GRID = (f"""grid AS (SELECT hour, event_type, n FROM (
  SELECT CAST(hour(ts) AS INTEGER) AS hour, {_ev_cols} FROM events WHERE ts IS NOT NULL GROUP BY 1)
  UNPIVOT (n FOR event_type IN ({", ".join(quoted(v) for v in EVENT_TYPES)})))""")


@register("hourly_pivot", with_base(
    f"SELECT CAST(hour(ts) AS INTEGER) AS hour, {_ev_cols} FROM events WHERE ts IS NOT NULL GROUP BY 1"))
def q_hourly_pivot(spark, sf_dir):
    return _hours(spark, sf_dir)[0]


@register("hour_minmax", with_base(_HOUR_GRID, """
SELECT hour, event_type, n,
       round((n - min(n) OVER w) / NULLIF(max(n) OVER w - min(n) OVER w, 0), 6) AS scaled
FROM grid WINDOW w AS (PARTITION BY event_type)"""))
def q_hour_minmax(spark, sf_dir):
    wide, types = _hours(spark, sf_dir)
    return minmax(pivot_to_long(wide, "hour", types, "event_type"), "n", "event_type") \
        .withColumn("scaled", F.round("scaled", 6))


@register("row_z_clip", with_base(_HOUR_GRID, """
z AS (SELECT hour, event_type, n,
             (n - avg(n) OVER w) / NULLIF(stddev_samp(n) OVER w, 0) AS z
      FROM grid WINDOW w AS (PARTITION BY hour))""", """
cap AS (SELECT least(max(z), abs(min(z))) AS cap FROM z)""", """
SELECT hour, event_type, n, round(greatest(least(z, cap), -cap), 6) AS z FROM z, cap"""))
def q_row_z_clip(spark, sf_dir):
    wide, types = _hours(spark, sf_dir)
    return row_zscore_clip(pivot_to_long(wide, "hour", types, "event_type"), "hour", "n") \
        .withColumn("z", F.round("z", 6))


@register("complaint_hour_pivot", with_base(f"""
SELECT CAST(hour(try_strptime(CMPLNT_FR_TM, '%H:%M:%S')) AS INTEGER) AS hour, {_wide_cols}
FROM incidents WHERE RECORD_TYPE = 'C' AND hour(try_strptime(CMPLNT_FR_TM, '%H:%M:%S')) IS NOT NULL
GROUP BY 1"""))
def q_complaint_hour_pivot(spark, sf_dir):
    """AGG5 + DT2 on the clock-time text of complaints: junk and ``24:00:00``
    give no hour and are dropped (not merged into midnight)."""
    c = record_type(incidents(spark, sf_dir), "C")
    counts = materialize(pair_counts(c, clock_hour("CMPLNT_FR_TM").alias("hour"), "OFNS_DESC"))
    offences = top_values(counts, "OFNS_DESC", TOP_K, weight="n")
    return hourly_pivot(counts, "hour", "OFNS_DESC", offences, "hour", weight="n")


# Greedy Ward merging of the hours, one merge an iteration: every iteration lists all clusters that are left.
_HOUR_CLUSTERS = f"""z AS (SELECT hour, event_type, coalesce((n - avg(n) OVER w) / NULLIF(stddev_samp(n) OVER w, 0), 0) AS z
      FROM grid WINDOW w AS (PARTITION BY hour)),
v AS (SELECT hour, list(z ORDER BY list_position({[*EVENT_TYPES]}, event_type)) AS c FROM z WHERE hour IS NOT NULL GROUP BY hour),
st AS (SELECT 0 AS step, hour AS id, 1.0::DOUBLE AS n, c, [hour] AS ids FROM v
  UNION ALL
  (WITH best AS (SELECT a.id AS a, b.id AS b FROM st a JOIN st b ON a.id < b.id
                 ORDER BY a.n * b.n / (a.n + b.n) * list_sum(list_transform(range(1, len(a.c) + 1),
                          lambda j: (a.c[j] - b.c[j]) * (a.c[j] - b.c[j]))), a.id, b.id LIMIT 1),
        many AS (SELECT count(*) AS live FROM st)
   SELECT step + 1, id, n, c, ids FROM st, best, many WHERE live > 4 AND id <> a AND id <> b
   UNION ALL
   SELECT x.step + 1, x.id, x.n + y.n, list_transform(range(1, len(x.c) + 1), lambda j: (x.n * x.c[j] + y.n * y.c[j]) / (x.n + y.n)),
          x.ids || y.ids FROM best JOIN st x ON x.id = a JOIN st y ON y.id = b, many WHERE live > 4)),
labels AS (SELECT unnest(ids) AS hour, CAST(dense_rank() OVER (ORDER BY id) - 1 AS INTEGER) AS cluster
           FROM st WHERE step = (SELECT max(step) FROM st))"""


@register("cluster_order", with_base(_HOUR_GRID, _HOUR_CLUSTERS, "SELECT hour, cluster FROM labels", recursive=True))
def q_cluster_order(spark, sf_dir):
    wide, types = _hours(spark, sf_dir)
    z = zscore(pivot_to_long(wide, "hour", types, "event_type"), "n", "hour", ddof=1)
    return cluster_rows(z, "hour", "event_type", "z", types, k=4)


# ------------------------------------------------------------ demographics

def demographics(spark, sf_dir) -> DataFrame:
    wides = roles.demographics_wide(spark, sf_dir)
    parts = {m: unpivot_years(w, m, roles.DEMO_YEARS) for m, w in wides.items()}
    return assemble_demographics(parts)


_MEASURES = list(roles.DEMO_MEASURE_EXPRS)
def _demo_sql(source: str) -> str:
    """Long demographics: every entity x listed year (a melt keeps NULL cells)."""
    years = "[" + ", ".join(lit(y) for y in roles.DEMO_YEARS) + "]"
    return ("demo AS (SELECT upper(b.Borough) AS Borough, y.Year, "
            + ", ".join(f"m.{c}" for c in _MEASURES)
            + ", upper(b.Borough) || y.Year AS Demo_Key"
            f" FROM (SELECT DISTINCT Borough FROM {source}) AS b"
            f" CROSS JOIN (SELECT unnest({years}) AS Year) AS y"
            f" LEFT JOIN {source} AS m ON m.Borough = b.Borough AND m.Year = y.Year)")


_DEMO_SQL = _demo_sql("demo_measures")
_FACTS_SQL = ("facts AS (SELECT Key, crime_count, Borough, Year, " + ", ".join(_MEASURES) + """
  FROM (SELECT upper(BORO_NM) || CAST(Year AS VARCHAR) AS Key, count(CMPLNT_NUM) AS crime_count
        FROM incidents WHERE RECORD_TYPE = 'C' AND Year IN (""" + ", ".join(roles.DEMO_YEARS) + """)
          AND BORO_NM IN """ + _in(roles.REGION_NAMES) + """ GROUP BY 1) AS c
  JOIN demo ON c.Key = demo.Demo_Key)""")


@register("demographics_long", with_base(_DEMO_SQL, "SELECT * FROM demo"))
def q_demographics_long(spark, sf_dir):
    return demographics(spark, sf_dir)


def facts(spark, sf_dir) -> DataFrame:
    return region_year_facts(incidents(spark, sf_dir), demographics(spark, sf_dir),
                             roles.DEMO_YEARS, roles.REGION_NAMES)


@register("region_year_facts", with_base(_DEMO_SQL, _FACTS_SQL, "SELECT * FROM facts"))
def q_region_year_facts(spark, sf_dir):
    return facts(spark, sf_dir)


_CORR_COLS = ["crime_count", *_MEASURES]


@register("correlations", with_base(_DEMO_SQL, _FACTS_SQL, " UNION ALL ".join(
    f"SELECT {lit(c)} AS factor, round(CASE WHEN isnan(corr(crime_count, {c})) THEN NULL "
    f"ELSE corr(crime_count, {c}) END, 6) AS r FROM facts" for c in _CORR_COLS)))
def q_correlations(spark, sf_dir):
    out = correlations(facts(spark, sf_dir), "crime_count")
    return out.select(F.col("column").alias("factor"), F.round("corr", 6).alias("r"))


SIMPLE_TESTS = [(f"crime_count~{m}", m, None) for m in _MEASURES[:4]]
CONTROLLED_TESTS = [(f"crime_count~{m}+population", m, "population") for m in _MEASURES[:4]]
_ROUNDED = ["beta", "r_squared", "t_marginal", "t_ols",
            "p_marginal_one_sided", "p_marginal_two_sided", "p_ols_one_sided", "p_ols_two_sided"]


def _ols(spark, sf_dir, tests) -> DataFrame:
    out = ols_tests(facts(spark, sf_dir), "crime_count", tests)
    return out.withColumns({c: F.round(c, 6) for c in _ROUNDED})


def _ols_oracle(tests, facts_ctes=None) -> str:
    parts = []
    for name, x1, x2 in tests:
        cond = f"crime_count IS NOT NULL AND {x1} IS NOT NULL" + (f" AND {x2} IS NOT NULL" if x2 else "")
        r2 = f"corr(crime_count, {x2})" if x2 else "CAST(0 AS DOUBLE)"
        r12 = f"corr({x1}, {x2})" if x2 else "CAST(0 AS DOUBLE)"
        parts.append(f"SELECT {lit(name)} AS test, {lit(x1)} AS predictor, "
                     f"{lit(x2) if x2 else 'CAST(NULL AS VARCHAR)'} AS control, {2 if x2 else 1} AS M, "
                     f"count(*) AS n, corr(crime_count, {x1}) AS r1, {r2} AS r2, {r12} AS r12 "
                     f"FROM facts WHERE {cond}")
    return with_base(
        *(facts_ctes or [_DEMO_SQL, _FACTS_SQL]),
        "m AS (" + " UNION ALL ".join(parts) + ")",
        """c AS (SELECT *, n - (M + 1) AS dof,
  CASE WHEN M = 1 THEN r1 WHEN 1 - r12 * r12 < 1e-12 THEN r1 / 2 ELSE (r1 - r2 * r12) / (1 - r12 * r12) END AS beta,
  CASE WHEN M = 1 THEN 0 WHEN 1 - r12 * r12 < 1e-12 THEN r2 / 2 ELSE (r2 - r1 * r12) / (1 - r12 * r12) END AS beta2
  FROM m)""",
        """d AS (SELECT *, CASE WHEN M = 1 OR 1 - r12 * r12 < 1e-12 THEN r1 * r1 ELSE beta * r1 + beta2 * r2 END AS r_squared FROM c)""",
        """t AS (SELECT *, beta * sqrt(dof / (1 - r_squared)) AS t_marginal,
  beta * sqrt(dof * (1 - r12 * r12) / (1 - r_squared)) AS t_ols FROM d)""",
        """tv AS (SELECT test, 'm' AS which, abs(t_marginal) AS tv, dof FROM t
        UNION ALL SELECT test, 'o', abs(t_ols), dof FROM t)""",
        """sp AS (SELECT test, which, dof, atan(tv / sqrt(dof)) AS th,
  CASE WHEN dof % 2 = 0 THEN dof // 2 ELSE (dof - 1) // 2 END AS nt FROM tv)""",
        """ser(test, which, k, term, total) AS (
  SELECT test, which, 0, CASE WHEN dof % 2 = 0 THEN CAST(1 AS DOUBLE) ELSE cos(th) END, CAST(0 AS DOUBLE) FROM sp
  UNION ALL
  SELECT s.test, s.which, s.k + 1,
         s.term * pow(cos(p.th), 2) * CASE WHEN p.dof % 2 = 0 THEN (2 * s.k + 1) / (2 * s.k + 2)
                                           ELSE (2 * s.k + 2) / (2 * s.k + 3) END,
         s.total + s.term
  FROM ser s JOIN sp p ON s.test = p.test AND s.which = p.which WHERE s.k < p.nt)""",
        """pv AS (SELECT p.test, p.which, greatest(CASE WHEN p.dof % 2 = 0 THEN (1 - sin(p.th) * s.total) / 2
  ELSE (1 - 2 / pi() * (p.th + sin(p.th) * s.total)) / 2 END, 0) AS p
  FROM sp p JOIN ser s ON s.test = p.test AND s.which = p.which AND s.k = p.nt)""",
        """SELECT t.test, predictor, control, CAST(n AS BIGINT) AS n, CAST(dof AS BIGINT) AS dof,
  round(beta, 6) AS beta, round(r_squared, 6) AS r_squared, round(t_marginal, 6) AS t_marginal,
  round(t_ols, 6) AS t_ols, round(pm.p, 6) AS p_marginal_one_sided,
  round(least(2 * pm.p, 1), 6) AS p_marginal_two_sided, round(po.p, 6) AS p_ols_one_sided,
  round(least(2 * po.p, 1), 6) AS p_ols_two_sided,
  CASE WHEN pm.p < 0.05 THEN 'reject' ELSE 'retain' END AS decision,
  CASE WHEN least(2 * po.p, 1) < 0.05 THEN 'reject' ELSE 'retain' END AS decision_ols,
  'ok' AS status
FROM t JOIN pv pm ON pm.test = t.test AND pm.which = 'm' JOIN pv po ON po.test = t.test AND po.which = 'o'""",
        recursive=True)


@register("ols_simple", _ols_oracle(SIMPLE_TESTS))
def q_ols_simple(spark, sf_dir):
    return _ols(spark, sf_dir, SIMPLE_TESTS)


@register("ols_controlled", _ols_oracle(CONTROLLED_TESTS))
def q_ols_controlled(spark, sf_dir):
    return _ols(spark, sf_dir, CONTROLLED_TESTS)


MULTI_PREDICTORS = ["proverty_rate", "income_diversity", "population"]
_pa, _pb, _pc = MULTI_PREDICTORS
_OLS_MULTI_SQL = with_base(_DEMO_SQL, _FACTS_SQL, f"""
m AS (SELECT count(*) AS n, corr(crime_count, {_pa}) AS ya, corr(crime_count, {_pb}) AS yb,
             corr(crime_count, {_pc}) AS yc, corr({_pa}, {_pb}) AS ab, corr({_pa}, {_pc}) AS ac,
             corr({_pb}, {_pc}) AS bc
      FROM facts WHERE crime_count IS NOT NULL AND {_pa} IS NOT NULL AND {_pb} IS NOT NULL
        AND {_pc} IS NOT NULL)""", """
d AS (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM m)""", """
b AS (SELECT n, n - 4 AS dof, ya, yb, yc,
  ((1 - bc * bc) * ya + (ac * bc - ab) * yb + (ab * bc - ac) * yc) / det AS b1,
  ((ac * bc - ab) * ya + (1 - ac * ac) * yb + (ab * ac - bc) * yc) / det AS b2,
  ((ab * bc - ac) * ya + (ab * ac - bc) * yb + (1 - ab * ab) * yc) / det AS b3 FROM d)""", """
r AS (SELECT *, b1 * ya + b2 * yb + b3 * yc AS r2 FROM b)""", f"""
SELECT {lit(_pa)} AS predictor, round(b1, 6) AS beta, CAST(n AS BIGINT) AS n, CAST(dof AS BIGINT) AS dof,
       round(r2, 6) AS r_squared, round(b1 * sqrt(dof / (1 - r2)), 6) AS t_marginal FROM r
UNION ALL SELECT {lit(_pb)}, round(b2, 6), CAST(n AS BIGINT), CAST(dof AS BIGINT), round(r2, 6),
       CAST(NULL AS DOUBLE) FROM r
UNION ALL SELECT {lit(_pc)}, round(b3, 6), CAST(n AS BIGINT), CAST(dof AS BIGINT), round(r2, 6),
       CAST(NULL AS DOUBLE) FROM r""")


@register("ols_multi", _OLS_MULTI_SQL)
def q_ols_multi(spark, sf_dir):
    """REG1 with three predictors: one aggregate of pairwise correlations,
    the 3 x 3 solve on the driver; one row per predictor."""
    g = ols_general(facts(spark, sf_dir), "crime_count", MULTI_PREDICTORS)
    r = lambda v: None if v is None else round(v, 6)
    rows = [(p, r(b), g["n"], g["dof"], r(g["r_squared"]), r(g["t_marginal"]) if i == 0 else None)
            for i, (p, b) in enumerate(zip(MULTI_PREDICTORS, g["beta"]))]
    return spark.createDataFrame(rows, "predictor string, beta double, n long, dof long, "
                                       "r_squared double, t_marginal double")


# With one predictor the elastic net is a soft threshold of the correlation.
_ELASTIC_SQL = f"""e AS (SELECT count(*) AS n, avg(crime_count) AS my, avg(unemployment_rate) AS mx,
  stddev_pop(crime_count) AS sy, stddev_pop(unemployment_rate) AS sx, corr(unemployment_rate, crime_count) AS r
  FROM facts WHERE crime_count IS NOT NULL AND unemployment_rate IS NOT NULL),
b AS (SELECT *, sign(r) * greatest(abs(r) - {ELASTIC_NET["regParam"] * ELASTIC_NET["elasticNetParam"]} / sy, 0)
             / (1 + {ELASTIC_NET["regParam"] * (1 - ELASTIC_NET["elasticNetParam"])} / sy) AS beta FROM e)"""
_ELASTIC_OUT = """SELECT round(2 * beta * r - beta * beta, 6) AS r2, round(my - beta * sy / sx * mx, 6) AS intercept,
       round(beta * sy / sx, 6) AS coefficient, n FROM b"""


def _elastic_row(df: DataFrame) -> DataFrame:
    fit = elastic_net(df, "crime_count", ["unemployment_rate"])
    return fit.select(F.round("r2", 6).alias("r2"), F.round("intercept", 6).alias("intercept"),
                      F.round(F.get("coefficients", F.lit(0)), 6).alias("coefficient"), "n")


@register("elastic_net_r2", with_base(_DEMO_SQL, _FACTS_SQL, _ELASTIC_SQL, _ELASTIC_OUT))
def q_elastic_net_r2(spark, sf_dir):
    return _elastic_row(facts(spark, sf_dir))


# ------------------------------------------------------ correspondence analysis

CA_FIELDS = ["PREM_TYP_DESC", "SUSP_AGE_GROUP", "SUSP_SEX", "BORO_NM", "SUSP_RACE"]


def _location_cells(spark, sf_dir) -> DataFrame:
    counts, offences = _complaint_counts(spark, sf_dir, "PREM_TYP_DESC")
    premises = top_values(counts, "PREM_TYP_DESC", TOP_K, weight="n")
    return crosstab_long(counts, "PREM_TYP_DESC", "OFNS_DESC", offences, row_filter=premises, weight="n")


_LOC_GRID = f"""grid AS (SELECT PREM_TYP_DESC, OFNS_DESC, n FROM (
  SELECT PREM_TYP_DESC, {_wide_cols}
  FROM incidents WHERE RECORD_TYPE = 'C' AND PREM_TYP_DESC IN {_in(SEGMENTS)}
  GROUP BY PREM_TYP_DESC) UNPIVOT (n FOR OFNS_DESC IN ({", ".join(quoted(v) for v in PRIORITIES)})))"""


@register("ca_residuals", with_base(_LOC_GRID, """
t AS (SELECT PREM_TYP_DESC, OFNS_DESC, CAST(n AS DOUBLE) AS n,
             sum(n) OVER (PARTITION BY PREM_TYP_DESC) AS rn, sum(n) OVER (PARTITION BY OFNS_DESC) AS cn,
             sum(n) OVER () AS tot FROM grid)""", """
SELECT PREM_TYP_DESC, OFNS_DESC, CAST(n AS BIGINT) AS n, round(n / tot, 6) AS p,
       round(rn / tot, 6) AS mass_row, round(cn / tot, 6) AS mass_col,
       round((n / tot - (rn / tot) * (cn / tot)) / sqrt((rn / tot) * (cn / tot)), 6) AS residual
FROM t WHERE rn > 0 AND cn > 0"""))
def q_ca_residuals(spark, sf_dir):
    res = ca_residuals(_location_cells(spark, sf_dir), "PREM_TYP_DESC", "OFNS_DESC")
    return res.withColumns({c: F.round(c, 6) for c in ["p", "mass_row", "mass_col", "residual"]})


_ca_stack = " UNION ALL ".join(
    f"SELECT {lit(f)} AS row_field, {f} AS key, OFNS_DESC FROM incidents WHERE RECORD_TYPE = 'C'"
    + (f" AND PREM_TYP_DESC IN {_in(SEGMENTS)}" if f == "PREM_TYP_DESC" else "")
    for f in CA_FIELDS)


@register("ca_inertia", with_base(
    f"s AS ({_ca_stack})",
    "keys AS (SELECT DISTINCT row_field, key FROM s)",
    "cats AS (SELECT unnest([" + ", ".join(lit(v) for v in PRIORITIES) + "]) AS OFNS_DESC)",
    "cnt AS (SELECT row_field, key, OFNS_DESC, count(*) AS n FROM s GROUP BY ALL)",
    """grid AS (SELECT k.row_field, k.key, c.OFNS_DESC, CAST(coalesce(x.n, 0) AS DOUBLE) AS n
  FROM keys k CROSS JOIN cats c LEFT JOIN cnt x
  ON x.row_field = k.row_field AND x.key IS NOT DISTINCT FROM k.key AND x.OFNS_DESC = c.OFNS_DESC)""",
    """t AS (SELECT *, sum(n) OVER (PARTITION BY row_field, key) AS rn,
  sum(n) OVER (PARTITION BY row_field, OFNS_DESC) AS cn, sum(n) OVER (PARTITION BY row_field) AS tot FROM grid)""",
    """r AS (SELECT row_field, key, OFNS_DESC, n,
  (n / tot - (rn / tot) * (cn / tot)) / sqrt((rn / tot) * (cn / tot)) AS s FROM t WHERE rn > 0 AND cn > 0)""", """
SELECT row_field, CAST(sum(n) AS BIGINT) AS n_total, round(sum(s * s), 6) AS inertia,
       round(sum(s * s) * sum(n), 6) AS chi2,
       count(DISTINCT key) + max(CASE WHEN key IS NULL THEN 1 ELSE 0 END) AS n_rows,
       count(DISTINCT OFNS_DESC) AS n_cols
FROM r GROUP BY row_field"""))
def q_ca_inertia(spark, sf_dir):
    c = record_type(incidents(spark, sf_dir), "C")
    stacked = c.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("row_field"), F.col(f).cast("string").alias("key"),
                 F.col("OFNS_DESC").alias("OFNS_DESC")) for f in CA_FIELDS])))
    # One scan: counts per (field, key, offence); lists and tables come from it.
    counts = materialize(stacked.groupBy("row_field", "key", "OFNS_DESC").agg(F.count(F.lit(1)).alias("n")))
    prem = counts.filter(F.col("row_field") == "PREM_TYP_DESC")
    offences = top_values(prem, "OFNS_DESC", TOP_K, weight="n")
    premises = top_values(prem, "key", TOP_K, weight="n")
    kept = counts.filter((F.col("row_field") != "PREM_TYP_DESC") | F.col("key").isin(premises))
    wide = crosstab_wide(kept, F.struct("row_field", "key"), "OFNS_DESC", offences, row_alias="rk", weight="n")
    wide = wide.select("rk.row_field", "rk.key", *[F.col(f"`{v}`") for v in offences])
    cells = wide.unpivot(["row_field", "key"], [F.col(f"`{v}`") for v in offences], "OFNS_DESC", "n")
    res = ca_residuals(cells, "key", "OFNS_DESC", by=["row_field"])
    out = ca_inertia(res, "key", "OFNS_DESC", by=["row_field"])
    return out.select("row_field", "n_total", F.round("inertia", 6).alias("inertia"),
                      F.round("chi2", 6).alias("chi2"), "n_rows", "n_cols")


@register("ca_scree")
def q_ca_scree(spark, sf_dir):
    return correspondence(_location_cells(spark, sf_dir), "PREM_TYP_DESC", "OFNS_DESC").scree


@register("ca_coordinates")
def q_ca_coordinates(spark, sf_dir):
    ca = correspondence(_location_cells(spark, sf_dir), "PREM_TYP_DESC", "OFNS_DESC")
    return ca.coordinates


@register("ca_biplot")
def q_ca_biplot(spark, sf_dir):
    counts, offences = _complaint_counts(spark, sf_dir, "SUSP_RACE")
    cells = crosstab_long(counts, "SUSP_RACE", "OFNS_DESC", offences, weight="n")
    return ca_biplot(correspondence(cells, "SUSP_RACE", "OFNS_DESC").coordinates)


# ------------------------------------------------------------------ spatial

_VALID_XY = "Latitude IS NOT NULL AND Longitude IS NOT NULL AND NOT isnan(Latitude) AND NOT isnan(Longitude)"


def _wkt_edges_sql(src: str, out: str = "edges") -> str:
    """WKT -> edges in plain SQL: rings by regex, points by split, edges by lead()."""
    p = out + "_"
    return rf"""{p}1 AS (SELECT bor_subb, name, regexp_extract_all(geometry, '\(([^()]+)\)', 1) AS rings
  FROM {src} WHERE bor_subb IS NOT NULL AND name IS NOT NULL AND geometry IS NOT NULL),
{p}2 AS (SELECT bor_subb, name, unnest(rings) AS ring, unnest(range(len(rings))) AS ring_no FROM {p}1),
{p}3 AS (SELECT bor_subb, name, ring_no, unnest(string_split(ring, ',')) AS pt,
              unnest(range(len(string_split(ring, ',')))) AS idx FROM {p}2),
{p}4 AS (SELECT bor_subb, name, ring_no, idx, TRY_CAST(string_split(trim(pt), ' ')[1] AS DOUBLE) AS x,
              TRY_CAST(string_split(trim(pt), ' ')[2] AS DOUBLE) AS y FROM {p}3),
{p}5 AS (SELECT bor_subb, name, ring_no, idx, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2
       FROM {p}4 WINDOW w AS (PARTITION BY bor_subb, ring_no ORDER BY idx)),
{p}bad AS (SELECT DISTINCT bor_subb FROM {p}4 WHERE x IS NULL OR y IS NULL),
{out} AS (SELECT bor_subb, name,
                 CAST(row_number() OVER (PARTITION BY bor_subb ORDER BY ring_no, idx) - 1 AS INTEGER) AS edge_no,
                 x1, y1, x2, y2 FROM {p}5
          WHERE x2 IS NOT NULL AND bor_subb NOT IN (SELECT bor_subb FROM {p}bad))"""


_WKT_EDGES = _wkt_edges_sql("regions_raw", "edges")


@register("wkt_edges", with_base(_WKT_EDGES, _wkt_edges_sql("areas_raw", "area_edges"), """
SELECT 'region' AS layer, * FROM edges UNION ALL SELECT 'service_area', * FROM area_edges"""))
def q_wkt_edges(spark, sf_dir):
    """GEO1 over both boundary layers: nation regions and supplier service areas."""
    regions = explode_edges(roles.regions(spark, sf_dir)).select(F.lit("region").alias("layer"), "*")
    areas = explode_edges(roles.service_areas(spark, sf_dir)).select(F.lit("service_area").alias("layer"), "*")
    return regions.unionByName(areas)


@register("service_area_counts", with_base(_wkt_edges_sql("areas_raw", "area_edges"), f"""
apts AS (SELECT CMPLNT_NUM, Latitude, Longitude, count(*) AS mult
         FROM incidents WHERE RECORD_TYPE = 'A' AND {_VALID_XY} GROUP BY ALL)""", """
hits AS (SELECT p.CMPLNT_NUM, p.Latitude, p.Longitude, p.mult, e.bor_subb, e.name
  FROM apts p CROSS JOIN area_edges e
  GROUP BY ALL
  HAVING sum(CASE WHEN (e.y1 > p.Latitude) != (e.y2 > p.Latitude)
                   AND p.Longitude < (e.x2 - e.x1) * (p.Latitude - e.y1) / (e.y2 - e.y1) + e.x1
              THEN 1 ELSE 0 END) % 2 = 1
      OR bool_or((e.x2 - e.x1) * (p.Latitude - e.y1) = (e.y2 - e.y1) * (p.Longitude - e.x1)
                 AND p.Longitude >= least(e.x1, e.x2) AND p.Longitude <= greatest(e.x1, e.x2)
                 AND p.Latitude >= least(e.y1, e.y2) AND p.Latitude <= greatest(e.y1, e.y2)))""",
    "SELECT bor_subb, name, CAST(sum(mult) AS BIGINT) AS n FROM hits GROUP BY ALL"))
def q_service_area_counts(spark, sf_dir):
    """JN3 with many overlapping regions: arrests per supplier service area."""
    a = record_type(incidents(spark, sf_dir), "A").select("CMPLNT_NUM", "Latitude", "Longitude")
    return tagged_counts(a, roles.service_areas(spark, sf_dir))


def _complaint_points(spark, sf_dir) -> DataFrame:
    c = record_type(incidents(spark, sf_dir), "C").filter(F.col("Lat_Lon").isNotNull())
    return c.select("CMPLNT_NUM", "Year", "Latitude", "Longitude")


def tagged_complaints(spark, sf_dir) -> DataFrame:
    return tag_points(_complaint_points(spark, sf_dir), roles.regions(spark, sf_dir))


def complaint_counts(spark, sf_dir) -> DataFrame:
    """SPA5: complaints per region-year of the demographic years, counted per coordinate first."""
    points = _complaint_points(spark, sf_dir).filter(F.col("Year").isin([int(y) for y in roles.DEMO_YEARS]))
    n = tagged_counts(points, roles.regions(spark, sf_dir), by=["Year"], count=F.count("CMPLNT_NUM"))
    return region_year_counts(n, weight="n")


_PIP = _WKT_EDGES + """,
pts AS (SELECT CMPLNT_NUM, Year, Latitude, Longitude FROM incidents
        WHERE RECORD_TYPE = 'C' AND Lat_Lon IS NOT NULL AND Latitude IS NOT NULL AND Longitude IS NOT NULL
          AND NOT isnan(Latitude) AND NOT isnan(Longitude)),
tagged AS (SELECT p.CMPLNT_NUM, p.Year, p.Latitude, p.Longitude, e.bor_subb, e.name
  FROM pts p CROSS JOIN edges e
  GROUP BY ALL
  HAVING sum(CASE WHEN (e.y1 > p.Latitude) != (e.y2 > p.Latitude)
                   AND p.Longitude < (e.x2 - e.x1) * (p.Latitude - e.y1) / (e.y2 - e.y1) + e.x1
              THEN 1 ELSE 0 END) % 2 = 1
      OR bool_or((e.x2 - e.x1) * (p.Latitude - e.y1) = (e.y2 - e.y1) * (p.Longitude - e.x1)
                 AND p.Longitude >= least(e.x1, e.x2) AND p.Longitude <= greatest(e.x1, e.x2)
                 AND p.Latitude >= least(e.y1, e.y2) AND p.Latitude <= greatest(e.y1, e.y2)))"""


@register("point_in_region", with_base(_PIP, "SELECT * FROM tagged"))
def q_point_in_region(spark, sf_dir):
    return tagged_complaints(spark, sf_dir)


@register("region_counts", with_base(_PIP, f"""
SELECT upper(name) || CAST(Year AS VARCHAR) AS Key, count(CMPLNT_NUM) AS crime_count
FROM tagged WHERE Year IN ({", ".join(roles.DEMO_YEARS)}) GROUP BY 1"""))
def q_region_counts(spark, sf_dir):
    return complaint_counts(spark, sf_dir)


def _recent() -> Column:
    return F.coalesce(F.col("Date") >= F.lit(roles.SPATIAL_SINCE).cast("date"), F.lit(False)).alias("recent")


def _arrest_cells(spark, sf_dir, key: str) -> DataFrame:
    """One scan: arrests per (key, recent, cell); the top list and the surfaces both come from it.

    Records without a valid point count for the list and have no cell.
    """
    a = record_type(incidents(spark, sf_dir), "A")
    ok = ~(F.isnan("Longitude") | F.isnan("Latitude"))
    at = [F.when(ok, F.floor(F.col(c) / F.lit(roles.DENSITY_CELL))).alias(g)
          for c, g in (("Longitude", "gx"), ("Latitude", "gy"))]
    return materialize(a.groupBy(key, _recent(), *at).agg(F.count(F.lit(1)).alias("n")))


def _recent_cells(cells: DataFrame, key: str) -> DataFrame:
    return (cells.filter("recent and gx is not null and gy is not null").filter(F.col(key).isNotNull())
            .select(key, "gx", "gy", "n"))


_A_RECENT = f"incidents WHERE RECORD_TYPE = 'A' AND Date >= DATE {lit(roles.SPATIAL_SINCE)}"


def _top_arrest_sql(k: int) -> str:
    return (f"top AS (SELECT OFNS_DESC FROM (SELECT OFNS_DESC, count(*) AS n FROM incidents "
            f"WHERE RECORD_TYPE = 'A' GROUP BY 1) ORDER BY n DESC, OFNS_DESC ASC NULLS LAST LIMIT {k})")


@register("grid_density", with_base(_top_arrest_sql(10), f"""
SELECT OFNS_DESC, CAST(floor(Longitude / {roles.DENSITY_CELL}) AS BIGINT) AS gx,
       CAST(floor(Latitude / {roles.DENSITY_CELL}) AS BIGINT) AS gy, count(*) AS n
FROM {_A_RECENT} AND {_VALID_XY} AND OFNS_DESC IN (SELECT OFNS_DESC FROM top WHERE OFNS_DESC IS NOT NULL)
GROUP BY ALL"""))
def q_grid_density(spark, sf_dir):
    cells = _arrest_cells(spark, sf_dir, "OFNS_DESC")
    top10 = top_values(cells, "OFNS_DESC", 10, weight="n")
    return _recent_cells(cells, "OFNS_DESC").filter(F.col("OFNS_DESC").isin(top10))


_cell, _bw = roles.DENSITY_CELL, roles.DENSITY_BANDWIDTH


def _kernel_oracle(group: str, where: str, *pre: str) -> str:
    """Every occupied cell against every cell of a plane 16 bandwidths wider than the group; no radius."""
    wide = int(16 * _bw / _cell)
    return with_base(
        *pre,
        f"""c AS (SELECT {group}, CAST(floor(Longitude / {_cell}) AS BIGINT) AS gx,
                CAST(floor(Latitude / {_cell}) AS BIGINT) AS gy, count(*) AS n
         FROM {_A_RECENT} AND {_VALID_XY} AND {where} GROUP BY ALL)""",
        f"""box AS (SELECT {group}, min(gx) - {wide} AS x0, max(gx) + {wide} AS x1, min(gy) - {wide} AS y0,
                max(gy) + {wide} AS y1, sum(n) AS total FROM c GROUP BY 1)""",
        f"""plane AS (SELECT {group}, total, gx, unnest(range(y0, y1 + 1)) AS gy
            FROM (SELECT *, unnest(range(x0, x1 + 1)) AS gx FROM box))""",
        f"""s AS (SELECT p.{group}, p.gx, p.gy, any_value(total) AS total,
                sum(n * exp(-(((c.gx - p.gx) * {_cell}) * ((c.gx - p.gx) * {_cell})
                              + ((c.gy - p.gy) * {_cell}) * ((c.gy - p.gy) * {_cell})) / {2.0 * _bw * _bw})) AS w
         FROM plane p JOIN c ON c.{group} = p.{group} GROUP BY p.{group}, p.gx, p.gy)""", f"""
SELECT {group}, CAST(gx AS BIGINT) AS gx, CAST(gy AS BIGINT) AS gy, round(w, 6) AS weight,
       round(w / ({2.0 * 3.141592653589793 * _bw * _bw} * total), 10) AS density
FROM s WHERE w >= 1e-6""")


def _kernel(counts: DataFrame, group: str) -> DataFrame:
    k = kernel_density(counts, _cell, _bw, by=[group])
    return k.select(group, "gx", "gy", F.round("weight", 6).alias("weight"),
                    F.round("density", 10).alias("density"))


@register("offence_kernel", _kernel_oracle(
    "OFNS_DESC", "OFNS_DESC IN (SELECT OFNS_DESC FROM top WHERE OFNS_DESC IS NOT NULL)", _top_arrest_sql(10)))
def q_offence_kernel(spark, sf_dir):
    """SPA1: kernel density surface of each of the top-10 arrest offences (last three years)."""
    cells = _arrest_cells(spark, sf_dir, "OFNS_DESC")
    top10 = top_values(cells, "OFNS_DESC", 10, weight="n")
    return _kernel(_recent_cells(cells, "OFNS_DESC").filter(F.col("OFNS_DESC").isin(top10)), "OFNS_DESC")


@register("grid_kernel", _kernel_oracle("SUSP_RACE", "SUSP_RACE IS NOT NULL"))
def q_grid_kernel(spark, sf_dir):
    """SPA2: kernel density surface per suspect race (NULL race selects nothing)."""
    return _kernel(_recent_cells(_arrest_cells(spark, sf_dir, "SUSP_RACE"), "SUSP_RACE"), "SUSP_RACE")


@register("heat_points", with_base(_top_arrest_sql(roles.HEAT_LAYERS), f"""
SELECT OFNS_DESC, Latitude, Longitude, count(*) AS weight
FROM {_A_RECENT} AND {_VALID_XY} AND OFNS_DESC IN (SELECT OFNS_DESC FROM top) GROUP BY ALL"""))
def q_heat_points(spark, sf_dir):
    """SPA3: one scan; arrests per (offence, recent, location) give the list and the layers."""
    a = record_type(incidents(spark, sf_dir), "A")
    spots = materialize(a.groupBy("OFNS_DESC", _recent(), "Latitude", "Longitude")
                        .agg(F.count(F.lit(1)).alias("n")))
    layers = top_values(spots, "OFNS_DESC", roles.HEAT_LAYERS, weight="n")
    return heat_layer(spots.filter(F.col("recent") & F.col("OFNS_DESC").isin(layers)), "Longitude", "Latitude",
                      by=["OFNS_DESC"], weight="n")


@register("group_extent", with_base(_top_arrest_sql(10), f"""
SELECT OFNS_DESC, min(Latitude) AS min_Latitude, max(Latitude) AS max_Latitude,
       min(Longitude) AS min_Longitude, max(Longitude) AS max_Longitude, count(*) AS n
FROM {_A_RECENT} AND {_VALID_XY} AND OFNS_DESC IN (SELECT OFNS_DESC FROM top) GROUP BY ALL"""))
def q_group_extent(spark, sf_dir):
    """AGG10: one scan; extents of the recent valid points of every offence, the list from their counts."""
    a = record_type(incidents(spark, sf_dir), "A").withColumn("recent", _recent())
    shown = a.withColumns({c: F.when(F.col("recent"), F.col(c)) for c in ("Latitude", "Longitude")})
    extents = materialize(group_extent(shown, "Longitude", "Latitude", ["OFNS_DESC"], total="records"))
    top10 = top_values(extents, "OFNS_DESC", 10, weight="records")
    return extents.filter(F.col("OFNS_DESC").isin(top10)).filter("n > 0").drop("records")


@register("stratified_sample")
def q_stratified_sample(spark, sf_dir):
    a = record_type(incidents(spark, sf_dir), "A")
    s = stratified_sample(a, "SUSP_RACE", roles.STRATUM_FRACTIONS)
    return s.select("CMPLNT_NUM", "SUSP_RACE", "Latitude", "Longitude")


_frac_case = "CASE SUSP_RACE " + " ".join(
    f"WHEN {lit(k)} THEN {float(v)}" for k, v in roles.STRATUM_FRACTIONS.items()) + " ELSE 0.0 END"


@register("stratified_sample_md5", with_base(f"""
SELECT CMPLNT_NUM, SUSP_RACE, Latitude, Longitude FROM incidents
WHERE RECORD_TYPE = 'A' AND SUSP_RACE IS NOT NULL
  AND CAST(('0x' || substr(md5(CMPLNT_NUM), 1, 8)) AS BIGINT) / 4294967296.0 < {_frac_case}"""))
def q_stratified_sample_md5(spark, sf_dir):
    a = record_type(incidents(spark, sf_dir), "A")
    s = stratified_sample_hash(a, "SUSP_RACE", roles.STRATUM_FRACTIONS, "CMPLNT_NUM")
    return s.select("CMPLNT_NUM", "SUSP_RACE", "Latitude", "Longitude")


# ------------------------------------------- sub-region (spatially tagged) tests

def subregion_demographics(spark, sf_dir) -> DataFrame:
    wides = roles.demographics_wide(spark, sf_dir, level="nation")
    parts = {m: unpivot_years(w.withColumnRenamed("Sub-Borough Area", "Borough"), m, roles.DEMO_YEARS)
             for m, w in wides.items()}
    return assemble_demographics(parts)


def subregion_facts(spark, sf_dir) -> DataFrame:
    return attach_demographics(complaint_counts(spark, sf_dir), subregion_demographics(spark, sf_dir))


_SUB_DEMO_SQL = _demo_sql("sub_demo_measures")
_SUB_FACTS = [_PIP, _SUB_DEMO_SQL, "facts AS (SELECT Key, crime_count, Borough, Year, " + ", ".join(_MEASURES)
              + " FROM (SELECT upper(name) || CAST(Year AS VARCHAR) AS Key, count(CMPLNT_NUM) AS crime_count"
              " FROM tagged WHERE Year IN (" + ", ".join(roles.DEMO_YEARS) + ") GROUP BY 1) AS c"
              " JOIN demo ON c.Key = demo.Demo_Key)"]


@register("subregion_facts", with_base(*_SUB_FACTS, "SELECT * FROM facts"))
def q_subregion_facts(spark, sf_dir):
    return subregion_facts(spark, sf_dir)


@register("ols_subregion", _ols_oracle(SIMPLE_TESTS + CONTROLLED_TESTS, _SUB_FACTS))
def q_ols_subregion(spark, sf_dir):
    out = ols_tests(subregion_facts(spark, sf_dir), "crime_count", SIMPLE_TESTS + CONTROLLED_TESTS)
    return out.withColumns({c: F.round(c, 6) for c in _ROUNDED})


_TWO_COL_GRID = f"""grid AS (SELECT PREM_TYP_DESC, CRM_ATPT_CPTD_CD, n FROM (
  SELECT PREM_TYP_DESC, count(*) FILTER (WHERE CRM_ATPT_CPTD_CD = 'ATTEMPTED') AS "ATTEMPTED",
         count(*) FILTER (WHERE CRM_ATPT_CPTD_CD = 'COMPLETED') AS "COMPLETED"
  FROM incidents WHERE RECORD_TYPE = 'C' GROUP BY PREM_TYP_DESC)
  UNPIVOT (n FOR CRM_ATPT_CPTD_CD IN ("ATTEMPTED", "COMPLETED")))"""


def _two_column_cells(spark, sf_dir) -> DataFrame:
    c = record_type(incidents(spark, sf_dir), "C")
    counts = materialize(pair_counts(c, "PREM_TYP_DESC", "CRM_ATPT_CPTD_CD"))
    outcomes = top_values(counts, "CRM_ATPT_CPTD_CD", TOP_K, weight="n")
    return crosstab_long(counts, "PREM_TYP_DESC", "CRM_ATPT_CPTD_CD", outcomes, weight="n")


@register("ca_coordinates_two_columns", with_base(
    _TWO_COL_GRID,
    "t AS (SELECT PREM_TYP_DESC, CRM_ATPT_CPTD_CD, CAST(n AS DOUBLE) AS n FROM grid)",
    "tot AS (SELECT sum(n) AS total FROM t)",
    """rm AS (SELECT PREM_TYP_DESC, sum(n) AS rn,
                  sum(CASE WHEN CRM_ATPT_CPTD_CD = 'ATTEMPTED' THEN n ELSE 0 END) AS n1
           FROM t GROUP BY 1 HAVING sum(n) > 0)""",
    """m AS (SELECT sum(CASE WHEN CRM_ATPT_CPTD_CD = 'ATTEMPTED' THEN n ELSE 0 END) / any_value(total) AS c1,
                 sum(CASE WHEN CRM_ATPT_CPTD_CD = 'COMPLETED' THEN n ELSE 0 END) / any_value(total) AS c2
          FROM t CROSS JOIN tot)""",
    """i AS (SELECT sqrt(sum(pow((t.n / tot.total - (r.rn / tot.total) * (m.c1 * (t.CRM_ATPT_CPTD_CD = 'ATTEMPTED')::INT
                                 + m.c2 * (t.CRM_ATPT_CPTD_CD = 'COMPLETED')::INT))
                             / sqrt((r.rn / tot.total) * (m.c1 * (t.CRM_ATPT_CPTD_CD = 'ATTEMPTED')::INT
                                 + m.c2 * (t.CRM_ATPT_CPTD_CD = 'COMPLETED')::INT)), 2))) AS sigma
          FROM t JOIN rm AS r ON r.PREM_TYP_DESC = t.PREM_TYP_DESC CROSS JOIN tot CROSS JOIN m)""",
    "g AS (SELECT CASE WHEN c2 >= c1 THEN 1.0 ELSE -1.0 END AS sg, c1, c2, sigma FROM m CROSS JOIN i)", """
SELECT 'row' AS kind, PREM_TYP_DESC AS label, CAST(1 AS INTEGER) AS dimension,
       round(sg * (n1 / rn - c1) / sqrt(c1 * c2), 6) AS principal,
       round(sg * (n1 / rn - c1) / sqrt(c1 * c2) / sigma, 6) AS standard
FROM rm CROSS JOIN g
UNION ALL SELECT 'col', 'ATTEMPTED', CAST(1 AS INTEGER), round(sg * sqrt(c2) * sigma / sqrt(c1), 6),
       round(sg * sqrt(c2) / sqrt(c1), 6) FROM g
UNION ALL SELECT 'col', 'COMPLETED', CAST(1 AS INTEGER), round(-sg * sqrt(c1) * sigma / sqrt(c2), 6),
       round(-sg * sqrt(c1) / sqrt(c2), 6) FROM g"""))
def q_ca_coordinates_two_columns(spark, sf_dir):
    """CA4/CA5 where a closed form exists: with two columns the one axis has
    eigenvector (sqrt c2, -sqrt c1) up to the sign convention."""
    ca = correspondence(_two_column_cells(spark, sf_dir), "PREM_TYP_DESC", "CRM_ATPT_CPTD_CD")
    return ca.coordinates.select("kind", "label", "dimension", F.round("principal", 6).alias("principal"),
                                 F.round("standard", 6).alias("standard"))


@register("ca_scree_two_columns", with_base(
    _TWO_COL_GRID,
    """t AS (SELECT CAST(n AS DOUBLE) AS n, sum(n) OVER (PARTITION BY PREM_TYP_DESC) AS rn,
  sum(n) OVER (PARTITION BY CRM_ATPT_CPTD_CD) AS cn, sum(n) OVER () AS tot FROM grid)""",
    "i AS (SELECT sum(pow((n / tot - (rn / tot) * (cn / tot)) / sqrt((rn / tot) * (cn / tot)), 2)) AS inertia FROM t)",
    """SELECT CAST(1 AS INTEGER) AS dimension, round(inertia, 6) AS eigenvalue, CAST(100 AS DOUBLE) AS percent
FROM i UNION ALL SELECT CAST(2 AS INTEGER), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)"""))
def q_ca_scree_two_columns(spark, sf_dir):
    """For a table with two columns the only non-trivial eigenvalue is the inertia."""
    scree = correspondence(_two_column_cells(spark, sf_dir), "PREM_TYP_DESC", "CRM_ATPT_CPTD_CD").scree
    return scree.select("dimension", F.round("eigenvalue", 6).alias("eigenvalue"),
                        F.round("percent", 6).alias("percent"))


# --------------------------------- lists shorter than the domain, exclusions, off-list keys

def _top_sql(name: str, source: str, column: str, k: int) -> str:
    """The top-k list from the data; a NULL category may take a slot and is removed after the cut."""
    return (f"{name} AS (SELECT {column} FROM (SELECT {column}, count(*) AS n FROM {source} GROUP BY 1 "
            f"ORDER BY n DESC, {column} ASC NULLS LAST LIMIT {k}) WHERE {column} IS NOT NULL)")


_COMPLAINTS = "incidents WHERE RECORD_TYPE = 'C'"


@register("crosstab_top3", with_base(_top_sql("top", _COMPLAINTS, "OFNS_DESC", 3), f"""
k AS (SELECT DISTINCT SUSP_RACE FROM {_COMPLAINTS})""", f"""
c AS (SELECT SUSP_RACE, OFNS_DESC, count(*) AS n FROM {_COMPLAINTS} GROUP BY ALL)""", """
SELECT k.SUSP_RACE, top.OFNS_DESC, coalesce(c.n, 0) AS n FROM k CROSS JOIN top
LEFT JOIN c ON c.SUSP_RACE IS NOT DISTINCT FROM k.SUSP_RACE AND c.OFNS_DESC = top.OFNS_DESC"""))
def q_crosstab_top3(spark, sf_dir):
    """AGG3 where the cut bites: two offences of five are off the list; keys keep their rows."""
    c = record_type(incidents(spark, sf_dir), "C")
    counts = materialize(pair_counts(c, "SUSP_RACE", "OFNS_DESC"))
    return crosstab_long(counts, "SUSP_RACE", "OFNS_DESC", top_values(counts, "OFNS_DESC", 3, weight="n"), weight="n")


@register("daily_pivot_top7", with_base(_top_sql("top", "incidents WHERE RECORD_TYPE = 'A'", "OFNS_DESC", 7), f"""
k AS (SELECT DISTINCT Date FROM {_A_SINCE})""", f"""
c AS (SELECT Date, OFNS_DESC, count(*) AS n FROM {_A_SINCE} GROUP BY ALL)""", """
SELECT k.Date, top.OFNS_DESC, coalesce(c.n, 0) AS n FROM k CROSS JOIN top
LEFT JOIN c ON c.Date = k.Date AND c.OFNS_DESC = top.OFNS_DESC"""))
def q_daily_pivot_top7(spark, sf_dir):
    """AGG4 with 7 of 25 offences: days without a listed offence are rows of zeros."""
    a = record_type(incidents(spark, sf_dir), "A")
    counts = materialize(pair_counts(a, "Date", "OFNS_DESC"))
    offences = top_values(counts, "OFNS_DESC", 7, weight="n")
    wide = daily_pivot(since(counts, roles.SINCE), "Date", "OFNS_DESC", offences, weight="n")
    return pivot_to_long(wide, "Date", offences, "OFNS_DESC")


@register("hourly_pivot_excluding", with_base(_top_sql("top", "events", "event_type", 3), """
k AS (SELECT DISTINCT CAST(hour(ts) AS INTEGER) AS hour FROM events WHERE ts IS NOT NULL)""", """
c AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL)""", f"""
SELECT k.hour, top.event_type, coalesce(c.n, 0) AS n FROM k CROSS JOIN (SELECT * FROM top WHERE event_type <> {lit(EVENT_TYPES[0])}) AS top
LEFT JOIN c ON c.hour = k.hour AND c.event_type = top.event_type"""))
def q_hourly_pivot_excluding(spark, sf_dir):
    """AGG5 + PRJ2: the top three event types without one that is left out by name."""
    ev = roles.table(spark, sf_dir, "events")
    counts = materialize(pair_counts(ev, F.hour("ts").alias("hour"), "event_type"))
    types = top_values(counts, "event_type", 3, weight="n")
    gone = [EVENT_TYPES[0]]
    wide = hourly_pivot(counts, "hour", "event_type", types, "hour", exclude=gone, weight="n")
    return pivot_to_long(wide, "hour", [t for t in types if t not in gone], "event_type")


# ------------------------------------- correspondence analysis of all tables, by sign-free facts

_CA_TABLES = [("C", f) for f in CA_FIELDS] + [("A", "SUSP_RACE")]


def _ca_all(spark, sf_dir) -> list:
    """CA8: the full analysis of the five complaint tables and of arrests by 25 offences."""
    out = []
    inc = incidents(spark, sf_dir)
    for kind, field in _CA_TABLES:
        counts = materialize(pair_counts(record_type(inc, kind), field, "OFNS_DESC"))
        offences = top_values(counts, "OFNS_DESC", TOP_K, weight="n")
        rows = top_values(counts, field, TOP_K, weight="n")
        cells = crosstab_long(counts, field, "OFNS_DESC", offences, row_filter=rows, weight="n")
        out.append((f"{kind}:{field}", correspondence(cells, field, "OFNS_DESC")))
    return out


def _ca_union(frames: list) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn("analysis", F.lit(name)) for name, df in frames])


_CA_CELLS = [
    "s AS (" + " UNION ALL ".join(
        f"SELECT {lit(k + ':' + f)} AS analysis, {f} AS row_label, OFNS_DESC AS col_label FROM incidents "
        f"WHERE RECORD_TYPE = {lit(k)} AND {f} IS NOT NULL" for k, f in _CA_TABLES) + ")",
    """o AS (SELECT DISTINCT analysis, col_label FROM s WHERE col_label IS NOT NULL)""",
    """k AS (SELECT DISTINCT analysis, row_label FROM s)""",
    """c AS (SELECT analysis, row_label, col_label, count(*) AS n FROM s GROUP BY ALL)""",
    """g AS (SELECT k.analysis, k.row_label, o.col_label, CAST(coalesce(c.n, 0) AS DOUBLE) AS n
       FROM k JOIN o USING (analysis) LEFT JOIN c USING (analysis, row_label, col_label))""",
    """t AS (SELECT *, sum(n) OVER (PARTITION BY analysis) AS tot, sum(n) OVER (PARTITION BY analysis, row_label) AS rn,
       sum(n) OVER (PARTITION BY analysis, col_label) AS cn FROM g)""",
]


@register("ca_reconstruction", with_base(*_CA_CELLS, """
SELECT analysis, row_label, col_label, round(n * tot / (rn * cn) - 1, 6) + 0.0 AS association
FROM t WHERE rn > 0 AND cn > 0"""))
def q_ca_reconstruction(spark, sf_dir):
    """CA4 + CA5: over all axes, row principal x column standard rebuilds each cell's p / (r c) - 1,
    whatever the signs of the axes."""
    parts = []
    for name, ca in _ca_all(spark, sf_dir):
        rows, cols = (ca.coordinates.filter(F.col("kind") == k) for k in ("row", "col"))
        both = (rows.select(F.col("label").alias("row_label"), "dimension", "principal")
                .join(cols.select(F.col("label").alias("col_label"), "dimension", "standard"), "dimension"))
        parts.append((name, both.groupBy("row_label", "col_label").agg(
            (F.round(F.sum(F.col("principal") * F.col("standard")), 6) + F.lit(0.0)).alias("association"))))
    return _ca_union(parts).select("analysis", "row_label", "col_label", "association")


@register("ca_axes", with_base(*_CA_CELLS, """
i AS (SELECT analysis, sum(power(n / tot - rn * cn / (tot * tot), 2) / (rn * cn / (tot * tot))) AS inertia
      FROM t WHERE rn > 0 AND cn > 0 GROUP BY analysis)""", """
SELECT analysis, round(inertia, 6) AS inertia, round(inertia, 6) AS sum_of_eigenvalues,
       round(inertia, 6) AS mass_weighted_squares, CAST(100 AS DOUBLE) AS percent FROM i"""))
def q_ca_axes(spark, sf_dir):
    """CA2 + CA3 + CA6: eigenvalues add up to the inertia, percents to 100, and the mass-weighted
    squares of the row coordinates to the inertia again."""
    parts = []
    for name, ca in _ca_all(spark, sf_dir):
        mass = ca.residuals.groupBy(F.col(ca.residuals.columns[0]).cast("string").alias("label")) \
            .agg(F.first("mass_row").alias("mass"))
        squares = (ca.coordinates.filter("kind = 'row'").join(mass, "label")
                   .agg(F.sum(F.col("mass") * F.col("principal") * F.col("principal")).alias("q")))
        parts.append((name, ca.inertia.select(F.round("inertia", 6).alias("inertia")).withColumns({
            "sum_of_eigenvalues": F.round(ca.scree.agg(F.sum("eigenvalue")).scalar(), 6),
            "mass_weighted_squares": F.round(squares.select("q").scalar(), 6),
            "percent": F.round(ca.scree.agg(F.sum("percent")).scalar(), 6)})))
    return _ca_union(parts).select("analysis", "inertia", "sum_of_eigenvalues", "mass_weighted_squares", "percent")


@register("cluster_summary", with_base(_HOUR_GRID, """
SELECT count(DISTINCT hour) AS rows, CAST(0 AS INTEGER) AS first_label, CAST(3 AS INTEGER) AS last_label FROM grid"""))
def q_cluster_summary(spark, sf_dir):
    """SCL4: what does not depend on the labels: every row has one label of the k clusters."""
    return q_cluster_order(spark, sf_dir).agg(
        F.count_distinct("hour").alias("rows"), F.min("cluster").alias("first_label"), F.max("cluster").alias("last_label"))


@register("correlations_subregion", with_base(*_SUB_FACTS, " UNION ALL ".join(
    f"SELECT {lit(c)} AS factor, round(CASE WHEN isnan(corr(crime_count, {c})) THEN NULL "
    f"ELSE corr(crime_count, {c}) END, 6) AS r FROM facts" for c in _CORR_COLS)))
def q_correlations_subregion(spark, sf_dir):
    """COR1 over the spatially tagged sub-region facts."""
    out = correlations(subregion_facts(spark, sf_dir), "crime_count")
    return out.select(F.col("column").alias("factor"), F.round("corr", 6).alias("r"))


@register("elastic_net_subregion", with_base(*_SUB_FACTS, _ELASTIC_SQL, _ELASTIC_OUT))
def q_elastic_net_subregion(spark, sf_dir):
    """REG6 over the spatially tagged sub-region facts."""
    return _elastic_row(subregion_facts(spark, sf_dir))
