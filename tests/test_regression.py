"""REG1-REG5, REG2, COR1, REG6 against independent NumPy computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.functions.tdist import t_sf, t_sf_value, t_two_sided
from blotter.operators.regression import correlations, elastic_net, ols_general, ols_tests


def _t_sf_numeric(t, df):
    """P(T > t) by integrating the t density (Simpson) from |t| to a far bound."""
    c = math.gamma((df + 1) / 2) / (math.sqrt(df * math.pi) * math.gamma(df / 2))
    x = np.linspace(abs(t), abs(t) + 400.0, 400001)
    y = c * (1 + x * x / df) ** (-(df + 1) / 2)
    h = x[1] - x[0]
    body = h / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())
    # tail beyond the bound B: density ~ c df^((df+1)/2) x^-(df+1)
    b = x[-1]
    tail = c * df ** ((df + 1) / 2) * b ** (-df) / df
    return float(body + tail)


def _t_series(t, df):
    """The finite series of integer degrees of freedom (Abramowitz & Stegun 26.7.3-4)."""
    theta = math.atan(abs(t) / math.sqrt(df))
    sin, cos2, even = math.sin(theta), math.cos(theta) ** 2, df % 2 == 0
    term, total = (1.0 if even else math.cos(theta)), 0.0
    for k in range(df // 2):
        total += term
        term *= cos2 * ((2 * k + 1) / (2 * k + 2) if even else (2 * k + 2) / (2 * k + 3))
    return (1 - sin * total) / 2 if even else (1 - (2 / math.pi) * (theta + sin * total)) / 2


def test_t_sf_equals_the_series_and_the_normal_tail(spark):
    cases = [(t, df) for df in [*range(1, 41), 100, 199, 200, 1999] for t in (0.0, 1e-9, 0.3, 1.73, 1.74, 2.5, 6.0, 40.0)]
    frame = spark.createDataFrame([(float(t), float(df)) for t, df in cases], "t double, df double")
    for r in frame.select("t", "df", t_sf("t", "df").alias("p")).collect():
        assert abs(r.p - _t_series(r.t, int(r.df))) < 1e-13
        assert abs(r.p - t_sf_value(r.t, r.df)) <= 1e-15 + 1e-13 * r.p
    for t in (0.5, 1.96, 4.0, 20.0):                     # 10^9 degrees: the normal tail, small values to their digits
        assert math.isclose(t_sf_value(t, 1e9), 0.5 * math.erfc(t / math.sqrt(2)), rel_tol=1e-4)
        assert t_sf_value(t, 10 ** 12) == t_sf_value(t, 1e9)
    assert math.isclose(t_sf_value(3.0, 2.5), (_t_sf_numeric(3.0, 2.5)), rel_tol=1e-6)
    assert t_sf_value(1.0, 0) is None and t_sf_value(None, 3) is None and t_sf_value(float("inf"), 5) < 1e-300
    edge = spark.createDataFrame([(None, 3.0), (1.0, None), (1.0, 0.0), (float("nan"), 2.0)], "t double, df double")
    assert all(r.p is None for r in edge.select(t_sf("t", "df").alias("p")).collect())


@pytest.mark.parametrize("t,df,expected", [(1, 1, 0.25), (2, 10, 0.0366940), (2, 11, 0.0354020),
                                           (2, 63, 0.0249079), (0, 5, 0.5), (-2, 10, 0.0366940)])
def test_t_sf_known_values(spark, t, df, expected):
    got = spark.range(1).select(t_sf(F.lit(float(t)), F.lit(df)).alias("p")).first().p
    assert abs(got - expected) < 5e-7


@pytest.mark.parametrize("df", [1, 2, 3, 7, 30, 33, 64])
def test_t_sf_matches_integral(spark, df):
    for t in [0.3, 1.7, 4.2]:
        got = spark.range(1).select(t_sf(F.lit(t), F.lit(df)).alias("p"),
                                    t_two_sided(F.lit(t), F.lit(df)).alias("p2")).first()
        ref = _t_sf_numeric(t, df)
        assert abs(got.p - ref) < 1e-6
        assert abs(got.p2 - 2 * ref) < 2e-6


def _reference_ols(x, y):
    """The original procedure, re-stated: z-score (population std), intercept,
    pinv normal equations, t of the first slope from rss / df and sum x1^2."""
    n, m = x.shape
    dof = n - (1 + m)
    xs = (x - x.mean(axis=0)) / x.std(axis=0)
    ys = (y - y.mean()) / y.std()
    xx = np.hstack([xs, np.ones((n, 1))])
    w = np.linalg.pinv(xx.T @ xx) @ xx.T @ ys
    rss = float(((ys - xx @ w) ** 2).sum())
    t = w[0] / math.sqrt(rss / dof / float((xx[:, 0] ** 2).sum()))
    return float(w[0]), float(t), dof


def test_ols_matches_reference_procedure(spark):
    rng = np.random.default_rng(7)
    n = 40
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    x2 = 0.6 * x1 + 0.8 * x2
    y = 3 * x1 - 2 * x2 + rng.normal(size=n)
    rows = [(float(a), float(b), float(c)) for a, b, c in zip(x1, x2, y)]
    rows += [(None, 1.0, 5.0)]                     # listwise: dropped by both tests
    df = spark.createDataFrame(rows, "x1 double, x2 double, y double")
    out = {r.test: r for r in ols_tests(df, "y", [("s", "x1", None), ("c", "x1", "x2")]).collect()}
    b1, t1, d1 = _reference_ols(np.c_[x1], y)
    b2, t2, d2 = _reference_ols(np.c_[x1, x2], y)
    assert out["s"].n == n and out["s"].dof == d1 and out["c"].dof == d2
    assert math.isclose(out["s"].beta, b1, rel_tol=1e-9) and math.isclose(out["s"].t_marginal, t1, rel_tol=1e-9)
    assert math.isclose(out["c"].beta, b2, rel_tol=1e-9) and math.isclose(out["c"].t_marginal, t2, rel_tol=1e-9)
    # textbook t for the controlled model (statsmodels-style se from (X'X)^-1)
    xs = np.c_[x1, x2]
    xs = (xs - xs.mean(0)) / xs.std(0)
    ys = (y - y.mean()) / y.std()
    xx = np.hstack([xs, np.ones((n, 1))])
    w = np.linalg.solve(xx.T @ xx, xx.T @ ys)
    s2 = ((ys - xx @ w) ** 2).sum() / d2
    t_ols = w[0] / math.sqrt(s2 * np.linalg.inv(xx.T @ xx)[0, 0])
    assert math.isclose(out["c"].t_ols, t_ols, rel_tol=1e-9)
    assert math.isclose(out["c"].p_marginal_one_sided, _t_sf_numeric(t2, d2), abs_tol=1e-6)
    assert out["s"].decision in ("reject", "retain") and out["s"].status == "ok"
    g = ols_general(df, "y", ["x1", "x2"])
    assert math.isclose(g["beta"][0], b2, rel_tol=1e-9) and math.isclose(g["t_marginal"], t2, rel_tol=1e-9)


def test_ols_edge_cases(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0, 3.0), (2.0, 2.0, 2.0, 1.0), (3.0, 3.0, 2.0, 4.0),
                                (4.0, 4.0, 2.0, 2.0)], "x double, xdup double, const double, y double")
    out = {r.test: r for r in ols_tests(df, "y", [
        ("tiny", "x", "xdup"), ("const", "const", None), ("ok", "x", None)]).collect()}
    assert out["tiny"].dof == 1 and out["tiny"].status == "collinear"
    assert math.isclose(out["tiny"].beta, out["ok"].beta / 2)          # minimum-norm split
    assert out["const"].beta is None and out["const"].status == "zero_variance"
    few = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "x double, y double")
    r = ols_tests(few, "y", [("t", "x", None)]).first()
    assert r.dof == 0 and r.status == "insufficient_df" and r.t_marginal is None


def test_correlations_pairwise_and_null_as_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, "a"), (2, 2.0, 5.0, "b"), (3, None, 5.0, "c"), (4, 4.5, 5.0, "d")],
                               "y long, x double, k double, s string")
    got = {r.column: r.corr for r in correlations(df, "y").collect()}
    assert set(got) == {"y", "x", "k"}                  # string column skipped
    assert math.isclose(got["y"], 1.0) and got["k"] is None
    xs, ys = np.array([1.0, 2.0, 4.5]), np.array([1.0, 2.0, 4.0])
    assert math.isclose(got["x"], float(np.corrcoef(xs, ys)[0, 1]), rel_tol=1e-12)
    z = {r.column: r.corr for r in correlations(df, "y", null_as_zero=True).collect()}
    assert math.isclose(z["x"], float(np.corrcoef([1.0, 2.0, 0.0, 4.5], [1, 2, 3, 4])[0, 1]), rel_tol=1e-12)


def test_elastic_net_skips_null_features(spark):
    rng = np.random.default_rng(1)
    rows = [(float(x), float(2 * x + rng.normal())) for x in rng.normal(size=50)] + [(None, 1.0)]
    r = elastic_net(spark.createDataFrame(rows, "x double, crime_count double"), "crime_count", ["x"]).first()
    assert r.n == 50 and 0.0 < r.r2 <= 1.0


@pytest.mark.parametrize("reg,mix", [(0.3, 0.8), (2.0, 1.0), (0.5, 0.0), (0.0, 0.5), (50.0, 0.8)])
def test_elastic_net_equals_spark_ml_at_convergence(spark, reg, mix):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rng = np.random.default_rng(8)
    x = rng.normal(size=(80, 3)) * [1, 10, 0.1]
    x[:, 1] += 6 * x[:, 0]
    y = x @ np.array([2.0, -0.5, 4.0]) + rng.normal(size=80) * 2 + 7
    df = spark.createDataFrame([tuple(map(float, r)) + (float(v),) for r, v in zip(x, y)], "a double, b double, c double, y double")
    got = elastic_net(df, "y", ["a", "b", "c"], regParam=reg, elasticNetParam=mix).first()
    model = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=mix, maxIter=2000, tol=1e-14).fit(
        VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df))
    assert np.allclose(got.coefficients, model.coefficients.toArray(), rtol=1e-5, atol=1e-6)
    assert math.isclose(got.intercept, model.intercept, rel_tol=1e-5) and got.n == 80
    assert math.isclose(got.r2, model.summary.r2, rel_tol=1e-6, abs_tol=1e-9) and 1 <= got.iterations < 1000


def test_elastic_net_constant_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (4.0, 5.0, 9.0)], "a double, k double, y double")
    r = elastic_net(df, "y", ["k", "a"], regParam=0.0).first()
    assert r.coefficients[0] == 0.0 and math.isclose(r.coefficients[1], np.polyfit([1, 2, 4], [2, 4, 9], 1)[0])
    r = elastic_net(df, "k", ["a", "y"]).first()
    assert r.r2 is None and r.coefficients == [0.0, 0.0] and r.intercept == 5.0
    r = elastic_net(df.limit(0), "y", ["a"]).first()
    assert r.n == 0 and r.r2 is None and r.coefficients is None and r.intercept is None


def test_ols_general_three_predictors(spark):
    rng = np.random.default_rng(3)
    n = 50
    x = rng.normal(size=(n, 3))
    x[:, 2] = 0.5 * x[:, 0] + 0.5 * x[:, 2]
    y = x @ np.array([1.0, -2.0, 0.5]) + rng.normal(size=n)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(v),) for r, v in zip(x, y)],
                               "a double, b double, c double, y double")
    g = ols_general(df, "y", ["a", "b", "c"])
    b, t, dof = _reference_ols(x, y)
    assert g["dof"] == dof and math.isclose(g["beta"][0], b, rel_tol=1e-9)
    assert math.isclose(g["t_marginal"], t, rel_tol=1e-9)


def test_ols_general_statistics_and_statuses(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 2))
    y = x @ np.array([0.3, 1.0]) + rng.normal(size=40)
    df = spark.createDataFrame([(*map(float, r), float(v), 2.0) for r, v in zip(x, y)],
                               "a double, b double, y double, k double")
    g = ols_general(df, "y", ["a", "b"])
    one = ols_tests(df, "y", [("t", "a", "b")]).first()
    assert g["status"] == "ok" and math.isclose(g["t_ols"], one.t_ols, rel_tol=1e-9)
    assert math.isclose(g["p_marginal_one_sided"], one.p_marginal_one_sided, rel_tol=1e-9)
    assert math.isclose(g["p_ols_two_sided"], one.p_ols_two_sided, rel_tol=1e-9)
    const = ols_general(df, "y", ["a", "k"])
    assert const["status"] == "zero_variance" and const["t_ols"] is None and const["beta"] == [None, None]
    assert ols_general(df.limit(3), "y", ["a", "b"])["status"] == "insufficient_df"
    assert ols_general(df.withColumn("c", 2 * df.a), "y", ["a", "c"])["status"] == "collinear"
