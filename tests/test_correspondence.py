"""CA1-CA7 against a NumPy SVD correspondence analysis."""

import numpy as np
import pytest

from blotter.operators.correspondence import ca_biplot, correspondence


def _numpy_ca(n):
    p = n / n.sum()
    r, c = p.sum(1), p.sum(0)
    s = (p - np.outer(r, c)) / np.sqrt(np.outer(r, c))
    u, d, vt = np.linalg.svd(s, full_matrices=False)
    f = (u * d) / np.sqrt(r)[:, None]
    g = (vt.T * d) / np.sqrt(c)[:, None]
    return (s ** 2).sum(), d ** 2, f, g


@pytest.mark.parametrize("shape", [(6, 4), (3, 5), (8, 2)])
def test_ca_matches_svd(spark, shape):
    rng = np.random.default_rng(sum(shape))
    n = rng.integers(1, 60, size=shape).astype(float)
    rows = [f"r{i}" for i in range(shape[0])]
    cols = [f"c{j}" for j in range(shape[1])]
    cells = spark.createDataFrame([(rows[i], cols[j], int(n[i, j])) for i in range(shape[0])
                                   for j in range(shape[1])], "row string, col string, n long")
    ca = correspondence(cells, "row", "col")
    inertia, ev, f, g = _numpy_ca(n)
    got_inertia = ca.inertia.first().inertia
    assert np.isclose(got_inertia, inertia, rtol=1e-10)
    k = min(shape)
    assert np.allclose(ca.eigenvalues, ev[:k], atol=1e-12)
    assert np.isclose(sum(ca.eigenvalues), inertia, rtol=1e-9)          # sum of eigenvalues = inertia
    coords = ca.coordinates.collect()
    dims = sorted({r.dimension for r in coords})
    assert dims == list(range(1, k))          # the trivial axis is omitted
    for d in dims:
        fr = np.array([next(x.principal for x in coords if x.kind == "row" and x.label == lab and x.dimension == d)
                       for lab in rows])
        gc = np.array([next(x.principal for x in coords if x.kind == "col" and x.label == lab and x.dimension == d)
                       for lab in cols])
        sign = 1.0 if np.dot(fr, f[:, d - 1]) >= 0 else -1.0
        assert np.allclose(fr, sign * f[:, d - 1], atol=1e-9)
        assert np.allclose(gc, sign * g[:, d - 1], atol=1e-9)
        # row masses weight principal coordinates to zero mean
        assert abs(float(np.dot(n.sum(1) / n.sum(), fr))) < 1e-9
    scree = ca.scree.orderBy("dimension").collect()
    assert np.isclose(sum(r.percent for r in scree), 100.0)
    b = ca_biplot(ca.coordinates).collect()
    assert len(b) == shape[0] + shape[1] and all(x.xmin <= x.dim1 <= x.xmax for x in b)


def test_ca_two_columns_first_eigenvalue_is_inertia(spark):
    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 3), ("b", "x", 2), ("b", "y", 9), ("c", "x", 4),
                                   ("c", "y", 4)], "row string, col string, n long")
    ca = correspondence(cells, "row", "col")
    assert np.isclose(ca.eigenvalues[0], ca.inertia.first().inertia)


def test_ca_drops_zero_mass_rows(spark):
    cells = spark.createDataFrame([("a", "x", 5), ("a", "y", 1), ("z", "x", 0), ("z", "y", 0), ("b", "x", 1),
                                   ("b", "y", 6), (None, "x", 2), (None, "y", 2)],
                                  "row string, col string, n long")
    ca = correspondence(cells, "row", "col")
    labels = {r.label for r in ca.coordinates.collect() if r.kind == "row"}
    assert labels == {"a", "b", None}


@pytest.mark.parametrize("row,col,value", [("n", "c", "v"), ("r", "p", "n"), ("_r", "n", "mass_col"), ("kind", "residual", "p")])
def test_field_names_do_not_clash(spark, row, col, value):
    n = np.array([[5, 9, 2], [7, 1, 8], [3, 3, 30]], float)
    data = [(str(i), str(j), int(n[i, j])) for i in range(3) for j in range(3)]
    plain = correspondence(spark.createDataFrame(data, "row string, col string, count long"), "row", "col", "count")
    odd = correspondence(spark.createDataFrame(data, f"`{row}` string, `{col}` string, `{value}` long"), row, col, value)
    key = lambda r: (r.kind, r.label, r.dimension)
    a, b = (sorted(x.coordinates.collect(), key=key) for x in (plain, odd))
    assert np.allclose([x.principal for x in a], [x.principal for x in b])
    assert np.allclose([x.standard for x in a], [x.standard for x in b])


def test_many_columns(spark):
    rng = np.random.default_rng(2)
    n = rng.integers(1, 60, size=(40, 30)).astype(float)
    cells = spark.createDataFrame([(f"r{i}", f"c{j}", int(n[i, j])) for i in range(40) for j in range(30)],
                                  "row string, col string, n long")
    assert np.allclose(correspondence(cells, "row", "col").eigenvalues, _numpy_ca(n)[1], atol=1e-12)


def test_leading_axes_beyond_the_bound(spark):
    """2,000 columns: three strong axes by subspace iteration, against the SVD; a null row label is a row."""
    rng = np.random.default_rng(3)
    rows, cols = 24, 2000
    mean = 8 + 6 * np.sign(rng.normal(size=(rows, 3))) * [1.0, 0.6, 0.35] @ np.sign(rng.normal(size=(3, cols))) / 2
    n = rng.poisson(np.clip(mean, 0.2, None)).astype(float)
    n[:, 0] += 1
    cells = spark.createDataFrame([(None if i == 5 else f"r{i}", f"c{j}", int(n[i, j])) for i in range(rows) for j in range(cols)],
                                  "row string, col string, n long")
    ca = correspondence(cells, "row", "col", max_columns=500, axes=3)
    inertia, ev, f, g = _numpy_ca(n)
    assert ca.columns is None and np.allclose(ca.eigenvalues, ev[:3], rtol=1e-8)
    assert np.allclose([r.percent for r in ca.scree.orderBy("dimension").collect()], 100 * ev[:3] / inertia, rtol=1e-8)
    got = {(r.kind, r.label, r.dimension): r.principal for r in ca.coordinates.collect()}
    assert len(got) == 3 * (rows + cols)
    for d in range(3):
        fr = np.array([got["row", None if i == 5 else f"r{i}", d + 1] for i in range(rows)])
        gc = np.array([got["col", f"c{j}", d + 1] for j in range(cols)])
        sign = 1.0 if fr @ f[:, d] >= 0 else -1.0
        assert np.allclose(fr, sign * f[:, d], atol=1e-6) and np.allclose(gc, sign * g[:, d], atol=1e-6)


def test_leading_axes_of_independent_table(spark):
    cells = spark.createDataFrame([(f"r{i}", f"c{j}", (i + 1) * (j + 1)) for i in range(4) for j in range(6)],
                                  "row string, col string, n long")
    ca = correspondence(cells, "row", "col", max_columns=5)
    assert all(v < 1e-12 for v in ca.eigenvalues)
