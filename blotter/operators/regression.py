"""Region-year facts, correlation and regression tests (REG1-REG7, COR1).

All statistics reduce to one aggregate of pairwise moments over the fact
table (which is one row per region-year); the closed forms are column
expressions on the aggregated row.  Nothing is collected except in
``ols_general`` for more than two predictors (an M x M solve).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions.keys import region_year_key
from blotter.functions.tdist import t_sf, t_sf_value, t_two_sided
from blotter.schema import DEMOGRAPHIC_MEASURES, ELASTIC_NET, SIGNIFICANCE_LEVEL

_COLLINEAR = 1e-12


def region_year_facts(incidents: DataFrame, demographics: DataFrame, years: Sequence,
                      regions: Sequence[str], region_col: str = "BORO_NM", year_col: str = "Year",
                      id_col: str = "CMPLNT_NUM", kind: str = "C",
                      measures: Sequence[str] = DEMOGRAPHIC_MEASURES) -> DataFrame:
    """REG7: count records per region-year and attach that region-year's measures.

    Output ``Key, crime_count, <demographic columns without Demo_Key>``.
    ``count(id)`` ignores NULL ids; a NULL region or year gives a NULL key,
    which joins nothing.
    """
    years_int = [int(y) for y in years]
    facts = (incidents.filter(F.col("RECORD_TYPE") == kind)
             .filter(F.col(year_col).isin(years_int))
             .filter(F.col(region_col).isin(list(regions))))
    counts = (facts.groupBy(region_year_key(region_col, year_col).alias("Key"))
              .agg(F.count(F.col(id_col)).alias("crime_count")))
    return attach_demographics(counts, demographics, measures=measures)


def attach_demographics(counts: DataFrame, demographics: DataFrame, key: str = "Key",
                        measures: Sequence[str] = DEMOGRAPHIC_MEASURES) -> DataFrame:
    """JN2 + PRJ9: join region-year counts to the measures of that region-year.

    Both sides are one row per region-year (small); the planner picks the
    join strategy from their measured sizes.
    """
    demo = demographics.withColumns({m: F.col(m).try_cast("double") for m in measures
                                     if m in demographics.columns})
    return counts.join(demo, counts[key] == demo.Demo_Key, "inner").drop("Demo_Key")


def _pearson(y: Column, x: Column) -> Column:
    """Pairwise-complete Pearson r; NULL (not an error) on zero variance."""
    ym = F.when(x.isNotNull(), y)
    xm = F.when(y.isNotNull(), x)
    return F.try_divide(F.covar_pop(ym, xm), F.stddev_pop(ym) * F.stddev_pop(xm))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def correlations(df: DataFrame, target: str = "crime_count", columns: Sequence[str] | None = None,
                 null_as_zero: bool = False) -> DataFrame:
    """COR1: Pearson r of ``target`` with every numeric column, in one pass.

    Returns ``(column, corr)``.  ``null_as_zero=True`` reproduces the
    behaviour of ``DataFrame.stat.corr`` on NULL cells (treated as 0).
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    val = (lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))) if null_as_zero else \
        (lambda c: F.col(c).cast("double"))
    row = df.agg(*[_pearson(val(target), val(c)).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "corr")


def ols_tests(df: DataFrame, target: str, tests: Sequence[tuple[str, str, str | None]],
              alpha: float = SIGNIFICANCE_LEVEL) -> DataFrame:
    """REG1-REG5: standardised OLS of ``target`` on one predictor (plus an
    optional control), with the significance of the predictor.

    ``tests`` is ``[(name, predictor, control or None), ...]``.  Per test:
    rows with a NULL predictor/control/target are dropped (listwise), X and
    y are z-scored (population std), and the slope of the predictor is

    * one predictor: ``beta = r``
    * with a control: ``beta = (r1 - r2 r12) / (1 - r12^2)``
      (minimum-norm ``r1 / 2`` when the two are collinear)

    ``dof = n - (1 + M)``.  ``t_marginal`` is the statistic of the original
    analysis (``beta / sqrt(s^2 / sum x1^2)``, which ignores the control's
    collinearity) and ``t_ols`` the textbook one; each has a one- and a
    two-sided p-value from the exact t series.  ``decision`` compares the
    marginal one-sided p with ``alpha`` like the original, ``decision_ols``
    the textbook two-sided p.
    """
    y = F.col(target).cast("double")
    aggs = []
    for i, (_, x1n, x2n) in enumerate(tests):
        x1 = F.col(x1n).cast("double")
        x2 = F.col(x2n).cast("double") if x2n else None
        mask = y.isNotNull() & x1.isNotNull() & (x2.isNotNull() if x2 is not None else F.lit(True))
        m = lambda c: F.when(mask, c)
        r12 = _pearson(m(x1), m(x2)) if x2 is not None else F.lit(0.0)
        r2 = _pearson(m(y), m(x2)) if x2 is not None else F.lit(0.0)
        aggs.append(F.struct(
            F.count_if(mask).alias("n"),
            _pearson(m(y), m(x1)).alias("r1"),
            r2.cast("double").alias("r2"),
            r12.cast("double").alias("r12")).alias(f"t{i}"))
    moments = df.agg(*aggs)
    meta = F.array(*[F.struct(F.lit(name).alias("test"), F.lit(x1n).alias("predictor"),
                              F.lit(x2n).cast("string").alias("control"),
                              F.lit(2 if x2n else 1).alias("M"), F.col(f"t{i}").alias("s"))
                     for i, (name, x1n, x2n) in enumerate(tests)])
    rows = moments.select(F.inline(meta))
    n, r1, r2, r12, M = (F.col("s.n"), F.col("s.r1"), F.col("s.r2"), F.col("s.r12"), F.col("M"))
    det = 1 - r12 * r12
    collinear = (M == 2) & (det < _COLLINEAR)
    beta = (F.when(M == 1, r1).when(collinear, r1 / 2)
            .otherwise((r1 - r2 * r12) / det))
    beta2 = F.when(M == 1, F.lit(0.0)).when(collinear, r2 / 2).otherwise((r2 - r1 * r12) / det)
    r_sq = F.when(M == 1, r1 * r1).when(collinear, r1 * r1).otherwise(beta * r1 + beta2 * r2)
    dof = (n - (M + 1)).cast("long")
    out = rows.select("test", "predictor", "control", n.cast("long").alias("n"),
                      dof.alias("dof"), beta.alias("beta"), r_sq.alias("r_squared"), r12.alias("r12"))
    ok = (F.col("dof") > 0) & F.col("beta").isNotNull()
    resid = 1 - F.col("r_squared")
    t_marg = F.when(ok, F.col("beta") * F.sqrt(F.try_divide(F.col("dof").cast("double"), resid)))
    t_ols = F.when(ok & ~((F.col("control").isNotNull()) & (1 - F.col("r12") * F.col("r12") < _COLLINEAR)),
                   F.col("beta") * F.sqrt(F.try_divide(F.col("dof") * (1 - F.col("r12") * F.col("r12")), resid)))
    out = out.withColumns({"t_marginal": t_marg, "t_ols": t_ols})
    out = out.withColumns({f"p_{t}_{side}": p(f"t_{t}", "dof") for t in ("marginal", "ols")
                           for side, p in (("one_sided", t_sf), ("two_sided", t_two_sided))})
    status = (F.when(F.col("dof") <= 0, "insufficient_df")
              .when(F.col("beta").isNull(), "zero_variance")
              .when(F.col("t_marginal").isNull(), "perfect_fit")
              .when(F.col("control").isNotNull() & (1 - F.col("r12") * F.col("r12") < _COLLINEAR),
                    "collinear")
              .otherwise("ok"))
    decide = lambda p: F.when(p.isNull(), F.lit(None).cast("string")) \
        .when(p < alpha, "reject").otherwise("retain")
    return out.withColumns({
        "decision": decide(F.col("p_marginal_one_sided")),
        "decision_ols": decide(F.col("p_ols_two_sided")),
        "status": status,
    }).drop("r12")


def ols_general(df: DataFrame, target: str, predictors: Sequence[str]) -> dict:
    """REG1 for any number of predictors: the M x M correlation system.

    One aggregate gives the pairwise correlations over listwise-complete
    rows; the (M+1)^2 numbers are the only thing collected, and the
    pseudo-inverse solve runs on the driver.  Returns beta of every
    predictor, dof, and for the first predictor the marginal and the textbook
    t with their one- and two-sided p-values.  ``status`` is ``ok``,
    ``collinear``, ``perfect_fit``, ``zero_variance`` (a constant column) or
    ``insufficient_df``; what a status leaves undefined is None.
    """
    import numpy as np

    cols = [target, *predictors]
    clean = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = clean.agg(F.count(F.lit(1)).alias("n"),
                    *[_pearson(F.col(a), F.col(b)).alias(f"r{cols.index(a)}_{cols.index(b)}") for a, b in pairs]).first()
    n, m = row["n"], len(predictors)
    dof = n - (1 + m)
    out = {"n": n, "dof": dof, "beta": [None] * m, "r_squared": None, "t_marginal": None, "t_ols": None}
    corr = np.eye(m + 1)
    for a, b in pairs:
        i, j = cols.index(a), cols.index(b)
        r = row[f"r{i}_{j}"]
        corr[i, j] = corr[j, i] = np.nan if r is None else r
    if dof > 0 and np.isnan(corr).any():
        status = "zero_variance"
    elif dof <= 0:
        status = "insufficient_df"
    else:
        rxx, rxy = corr[1:, 1:], corr[1:, 0]
        beta = np.linalg.pinv(rxx) @ rxy
        r_sq = float(beta @ rxy)
        collinear = bool(np.linalg.eigvalsh(rxx)[0] < _COLLINEAR)
        status = "perfect_fit" if r_sq >= 1 else "collinear" if collinear else "ok"
        out |= {"beta": [float(b) for b in beta], "r_squared": r_sq}
        if r_sq < 1:
            out["t_marginal"] = float(beta[0] * np.sqrt(dof / (1 - r_sq)))
            if not collinear:
                out["t_ols"] = float(beta[0] * np.sqrt(dof / ((1 - r_sq) * np.linalg.inv(rxx)[0, 0])))
    for name in ("marginal", "ols"):
        p = t_sf_value(out[f"t_{name}"], dof)
        out |= {f"p_{name}_one_sided": p, f"p_{name}_two_sided": None if p is None else min(1.0, 2 * p)}
    return out | {"status": status}


def elastic_net(df: DataFrame, target: str, features: Sequence[str], regParam: float = ELASTIC_NET["regParam"],
                elasticNetParam: float = ELASTIC_NET["elasticNetParam"], sweeps: int = 1000,
                tolerance: float = 1e-12) -> DataFrame:
    """REG6: linear regression with elastic-net penalty: one row ``(r2, intercept, coefficients, iterations, n)``.

    One aggregate gives the means and covariances of the rows without a NULL;
    the rest are expressions on that row.  With target and features scaled to
    unit variance, the penalty is ``regParam / std(target)``, split into L1 and
    L2 by ``elasticNetParam``, and cyclic coordinate descent updates each
    coefficient from the correlations alone (soft threshold of the residual
    correlation, over 1 + L2).  It ends with the sweep that changes no
    coefficient by more than ``tolerance``; ``iterations`` counts the sweeps,
    at most ``sweeps``.  A constant feature has coefficient 0; a constant
    target gives zeros, its mean as intercept and a NULL r2; no rows give NULLs.
    """
    cols = [target, *features]
    m = len(features)
    clean = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)]).dropna()
    cov = {(i, j): F.covar_pop(f"_{i}", f"_{j}") for i in range(m + 1) for j in range(i, m + 1)}
    row = clean.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(f"_{i}") for i in range(m + 1)]).alias("mean"),
                    F.array(*[F.array(*[cov[min(i, j), max(i, j)] for j in range(m + 1)]) for i in range(m + 1)]).alias("cov"))
    row = row.withColumn("std", F.transform("cov", lambda c, i: F.sqrt(F.get(c, i))))
    corr = F.transform("cov", lambda c, i: F.transform(c, lambda v, j: F.when(i == j, 1.0).otherwise(
        F.coalesce(F.try_divide(v, F.get("std", i) * F.get("std", j)), F.lit(0.0)))))
    row = row.withColumn("corr", corr)
    row = row.select("n", "mean", "std", F.slice(F.get("corr", F.lit(0)), 2, m).alias("b"),
                     F.transform(F.slice("corr", 2, m), lambda c: F.slice(c, 2, m)).alias("a"))
    penalty = F.try_divide(F.lit(float(regParam)), F.get("std", F.lit(0)))
    row = row.withColumns({"l1": penalty * elasticNetParam, "l2": penalty * (1 - elasticNetParam)})
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)

    def update(s, j):
        old = F.get(s["beta"], j)
        gap = F.get("b", j) - dot(F.get("a", j), s["beta"]) + old
        new = F.sign(gap) * F.greatest(F.abs(gap) - F.col("l1"), F.lit(0.0)) / (1 + F.col("l2"))
        return F.struct(F.transform(s["beta"], lambda v, i: F.when(i == j, new).otherwise(v)).alias("beta"),
                        F.greatest(s["change"], F.abs(new - old)).alias("change"), s["sweeps"].alias("sweeps"))

    def sweep(s, _):
        fresh = F.struct(s["beta"].alias("beta"), F.lit(0.0).alias("change"), (s["sweeps"] + 1).alias("sweeps"))
        return F.when(s["change"] <= tolerance, s).otherwise(
            F.aggregate(F.sequence(F.lit(0), F.lit(m - 1)), fresh, update))

    start = F.struct(F.array_repeat(F.lit(0.0), m).alias("beta"), F.lit(float("inf")).alias("change"), F.lit(0).alias("sweeps"))
    varied = F.get("std", F.lit(0)) > 0
    row = row.withColumn("fit", F.when(varied, F.aggregate(F.sequence(F.lit(1), F.lit(sweeps)), start, sweep))
                         .otherwise(start))
    beta = F.col("fit.beta")
    weights = F.transform(beta, lambda v, i: F.coalesce(F.try_divide(v * F.get("std", F.lit(0)), F.get("std", i + 1)), F.lit(0.0)))
    row = row.withColumn("coefficients", F.when(F.col("n") > 0, weights))
    return row.select(
        F.when(varied, 2 * dot(beta, F.col("b")) - dot(beta, F.transform("a", lambda c: dot(c, beta)))).alias("r2"),
        (F.get("mean", F.lit(0)) - dot(F.col("coefficients"), F.slice("mean", 2, m))).alias("intercept"),
        "coefficients", F.col("fit.sweeps").alias("iterations"), "n")
