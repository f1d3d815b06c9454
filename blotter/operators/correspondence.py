"""Correspondence analysis of a contingency table (CA1-CA8).

Input is a long, complete ``(row, col, n)`` grid (zero cells present), as
produced by ``crosstab_long``.  The distributed part:

* masses: row sums by a window over each row's cells, column sums by an
  aggregate joined back (at most K columns), the grand total as a scalar
  subquery;
* standardized residuals ``s = (p - r c) / sqrt(r c)`` and the total
  inertia ``sum s^2`` as column expressions and one aggregate;
* up to ``max_columns`` columns, the K x K Gram matrix ``S'S`` by MLlib's
  ``RowMatrix`` (each task adds its rows' products into one packed triangle,
  the triangles meet in a tree), then a symmetric eigen-solve of it.  Row
  coordinates are plain projections of the residual rows with the
  eigenvectors inlined as literals: no shuffle, distributed over rows;
* beyond, the leading ``axes`` by block subspace iteration: the loadings are a
  table of one row a column, a step is two joins with the residuals, and only
  numbers per pair of axes reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.session import materialize

_TRIVIAL = 1e-12


@dataclass
class CAResult:
    residuals: DataFrame      # row, col, n, p, mass_row, mass_col, residual
    inertia: DataFrame        # n_total, inertia, chi2, n_rows, n_cols
    scree: DataFrame          # dimension, eigenvalue, percent
    coordinates: DataFrame    # kind, label, dimension, principal, standard
    eigenvalues: list
    columns: list | None      # None beyond max_columns


def ca_residuals(cells: DataFrame, row: str, col: str, value: str = "n",
                 by: Sequence[str] = ()) -> DataFrame:
    """CA1: masses and standardized residuals; zero-mass rows/columns removed.

    ``by`` analyses several tables at once (one per group), in one plan.
    """
    by = list(by)
    c = cells.select(*by, row, col, F.col(value).cast("double").alias("_ca_n"))
    c = c.withColumn("_ca_rn", F.sum("_ca_n").over(Window.partitionBy(*by, row)))
    col_tot = c.groupBy(*by, col).agg(F.sum("_ca_n").alias("_ca_cn"))
    c = c.join(col_tot, [*by, col]).filter((F.col("_ca_rn") > 0) & (F.col("_ca_cn") > 0))
    if by:
        tot = c.groupBy(*by).agg(F.sum("_ca_n").alias("_ca_tot"))
        c = c.join(tot, by)
        total = F.col("_ca_tot")
    else:
        total = c.agg(F.sum("_ca_n")).scalar()
    p, r, k = F.col("_ca_n") / total, F.col("_ca_rn") / total, F.col("_ca_cn") / total
    return c.select(*by, row, col, F.col("_ca_n").cast("long").alias("n"), p.alias("p"),
                    r.alias("mass_row"), k.alias("mass_col"),
                    ((p - r * k) / F.sqrt(r * k)).alias("residual"))


def ca_inertia(residuals: DataFrame, row: str, col: str, by: Sequence[str] = ()) -> DataFrame:
    """CA2: total inertia (= chi-square / n) in one aggregate (per group of ``by``)."""
    return residuals.groupBy(*by).agg(
        F.sum("n").alias("n_total"),
        F.sum(F.col("residual") * F.col("residual")).alias("inertia"),
        F.count_distinct(F.coalesce(F.col(row).cast("string"), F.lit("\u0000NULL"))).alias("n_rows"),
        F.count_distinct(col).alias("n_cols"),
    ).withColumn("chi2", F.col("inertia") * F.col("n_total"))


def correspondence(cells: DataFrame, row: str, col: str, value: str = "n",
                   max_columns: int = 1000, axes: int = 10) -> CAResult:
    """CA1-CA5: full correspondence analysis of a table; the leading ``axes`` beyond ``max_columns`` columns.

    Eigenvectors are sign-normalised (largest absolute loading positive);
    trivial axes (eigenvalue below 1e-12 of the first) are omitted from the
    coordinates and kept in the scree table up to ``min(rows, cols)``.
    """
    res = materialize(ca_residuals(
        cells.select(F.col(row).alias("_ca_row"), F.col(col).alias("_ca_col"), F.col(value).alias("_ca_value")),
        "_ca_row", "_ca_col", "_ca_value"))
    inertia = ca_inertia(res, "_ca_row", "_ca_col")
    named = res.select(F.col("_ca_row").alias(row), F.col("_ca_col").alias(col),
                       *[c for c in res.columns if not c.startswith("_ca_")])
    cols_info = (res.groupBy("_ca_col").agg(F.first("mass_col").alias("_ca_mass"))
                 .orderBy("_ca_col").limit(max_columns + 1).collect())
    if len(cols_info) > max_columns:
        return _leading_axes(res, named, inertia, axes)
    return _all_axes(res, named, inertia, [r["_ca_col"] for r in cols_info],
                     np.array([r["_ca_mass"] for r in cols_info], dtype=float))


def _all_axes(res: DataFrame, named: DataFrame, inertia: DataFrame, columns: list, masses: np.ndarray) -> CAResult:
    from pyspark.ml.functions import array_to_vector
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    spark, k = res.sparkSession, len(columns)
    # One array of the K residuals per row, in column order (a removed cell is 0); the numbers are at most max_columns rows.
    number = F.broadcast(spark.createDataFrame([(c, i) for i, c in enumerate(columns)],
                                               f"_ca_col {res.schema['_ca_col'].dataType.simpleString()}, _ca_i int"))
    listed = (res.join(number, "_ca_col").groupBy("_ca_row")
              .agg(F.first("mass_row").alias("_ca_r"), F.sort_array(F.collect_list(F.struct("_ca_i", "residual"))).alias("l")))
    lookup = F.map_from_entries("l")
    filled = F.when(F.size("l") == k, F.transform("l", lambda x: x["residual"])).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.element_at(lookup, i), F.lit(0.0))))
    wide = materialize(listed.select("_ca_row", "_ca_r", filled.alias("_ca_s")))
    n_rows = wide.count()
    vectors = MLUtils.convertVectorColumnsFromML(wide.select(array_to_vector("_ca_s").alias("v")), "v")
    gram = RowMatrix(vectors).computeGramianMatrix().toArray() if n_rows else np.zeros((k, k))
    evals, evecs = np.linalg.eigh(gram) if k else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(evals)[::-1]
    evals = np.clip(evals[order], 0.0, None)
    evecs = evecs[:, order]
    for d in range(k):
        j = int(np.argmax(np.abs(evecs[:, d])))
        if evecs[j, d] < 0:
            evecs[:, d] = -evecs[:, d]
    n_dims = min(n_rows, k)
    scree_vals = evals[:n_dims]
    scree = _scree(spark, scree_vals, float(scree_vals.sum()))
    keep = [d for d in range(n_dims) if evals[0] > 0 and evals[d] > _TRIVIAL * evals[0]]

    # Column coordinates: K x dims numbers, computed where they already are.
    col_rows = []
    for j, v in enumerate(columns):
        for d in keep:
            std = evecs[j, d] / np.sqrt(masses[j])
            col_rows.append(("col", str(v), d + 1, float(std * np.sqrt(evals[d])), float(std)))
    col_coords = spark.createDataFrame(
        col_rows, "kind string, label string, dimension int, principal double, standard double")

    # Row coordinates: F = S V / sqrt(r), a projection of each row's residuals.
    def proj(d):
        axis = F.array(*[F.lit(float(v)) for v in evecs[:, d]])
        return F.aggregate(F.zip_with("_ca_s", axis, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return CAResult(named, inertia, scree,
                    _row_coordinates(wide, [proj(d) for d in keep], evals[keep]).unionByName(col_coords),
                    [float(v) for v in scree_vals], columns)


def _scree(spark, values: np.ndarray, total: float) -> DataFrame:
    return spark.createDataFrame([(d + 1, float(v), float(100.0 * v / total) if total > 0 else None)
                                  for d, v in enumerate(values)], "dimension int, eigenvalue double, percent double")


def _row_coordinates(rows: DataFrame, projections: list, evals: np.ndarray) -> DataFrame:
    """Principal and standard coordinates from the projections of each row's residuals on the axes."""
    if not projections:
        return rows.sparkSession.createDataFrame([], "kind string, label string, dimension int, principal double, standard double")
    return rows.select(
        F.lit("row").alias("kind"), F.col("_ca_row").cast("string").alias("label"),
        F.inline(F.array(*[F.struct(F.lit(d + 1).alias("dimension"), (p / F.sqrt("_ca_r")).alias("principal"),
                                    (p / F.sqrt("_ca_r") / F.lit(float(np.sqrt(evals[d])))).alias("standard"))
                           for d, p in enumerate(projections)])))


def _times(res: DataFrame, vectors: DataFrame, over: str, to: str, mass: str, p: int) -> DataFrame:
    """The residuals, or their transpose, times a table of ``p`` numbers a row: (to, its mass, _ca_v)."""
    sums = [F.sum(F.col("residual") * F.get("_ca_v", F.lit(i))) for i in range(p)]
    known = vectors.select(F.col(over).alias("_ca_over"), "_ca_v")
    return (res.join(known, F.col(over).eqNullSafe(F.col("_ca_over"))).groupBy(to)
            .agg(F.first(mass).alias("_ca_r"), F.array(*sums).alias("_ca_v")))


def _inner(vectors: DataFrame, p: int) -> np.ndarray:
    """The p x p inner products of the columns of a table of vectors."""
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    got = vectors.agg(F.array(*[F.sum(F.get("_ca_v", F.lit(i)) * F.get("_ca_v", F.lit(j))) for i, j in pairs])).first()[0]
    out = np.zeros((p, p))
    for (i, j), v in zip(pairs, got):
        out[i, j] = out[j, i] = v
    return out


def _turn(vectors: DataFrame, by: np.ndarray) -> DataFrame:
    """Each row's vector times a small matrix."""
    turned = [sum((F.get("_ca_v", F.lit(i)) * float(by[i, j]) for i in range(by.shape[0])), F.lit(0.0)) for j in range(by.shape[1])]
    return vectors.withColumn("_ca_v", F.array(*turned))


def _leading_axes(res: DataFrame, named: DataFrame, inertia: DataFrame, axes: int, extra: int = 4,
                  most: int = 60, tolerance: float = 1e-12) -> CAResult:
    """Block subspace iteration: ``axes + extra`` vectors, until the wanted eigenvalues stand still."""
    spark = res.sparkSession
    rows, cols = res.agg(F.approx_count_distinct("_ca_row"), F.approx_count_distinct("_ca_col")).first()
    p = max(1, min(axes + extra, rows, cols))
    unit = lambda i: F.pmod(F.xxhash64(F.col("_ca_col"), F.lit(i)), F.lit(2000001)) / 1e6 - 1
    v = res.select("_ca_col").distinct().withColumn("_ca_v", F.array(*[unit(i) for i in range(p)]))
    last = np.zeros(p)
    for _ in range(most):
        y = _times(res, v, "_ca_col", "_ca_row", "mass_row", p)
        z = materialize(_times(res, y, "_ca_row", "_ca_col", "mass_col", p))
        squares, turn = np.linalg.eigh(_inner(z, p))
        squares, turn = squares[::-1], turn[:, ::-1]
        keep = squares > squares[0] * _TRIVIAL ** 2 if squares[0] > 0 else np.zeros(p, bool)
        p = int(keep.sum())
        if not p:
            break
        v = _turn(z, turn[:, keep] / np.sqrt(squares[keep]))
        now = np.sqrt(squares[keep])                # of S'S, once the vectors are orthonormal
        if len(now) == len(last) and np.abs(now - last)[:axes].max() <= tolerance * now[0]:
            break
        last = now
    total = inertia.first()["inertia"] or 0.0
    if not p:
        empty = spark.createDataFrame([], "kind string, label string, dimension int, principal double, standard double")
        return CAResult(named, inertia, _scree(spark, np.zeros(0), total), empty, [], None)
    v = materialize(_turn(v, _orthonormal(_inner(v, p))))
    y = materialize(_times(res, v, "_ca_col", "_ca_row", "mass_row", p))
    evals, turn = np.linalg.eigh(_inner(y, p))      # Rayleigh-Ritz in the space found
    evals, turn = np.clip(evals[::-1], 0.0, None)[:axes], turn[:, ::-1][:, :axes]
    kept = [d for d in range(len(evals)) if evals[d] > _TRIVIAL * evals[0]]
    loadings = materialize(_turn(v, turn[:, kept]))
    largest = loadings.agg(F.array(*[F.max_by(F.get("_ca_v", F.lit(d)), F.abs(F.get("_ca_v", F.lit(d))))
                                     for d in range(len(kept))])).first()[0]
    sign = np.diag([-1.0 if x < 0 else 1.0 for x in largest])
    loadings, y = _turn(loadings, sign), _turn(y, turn[:, kept] @ sign)
    cols = loadings.select(F.lit("col").alias("kind"), F.col("_ca_col").cast("string").alias("label"), F.inline(F.array(*[
        F.struct(F.lit(d + 1).alias("dimension"), (x / F.sqrt("_ca_r") * float(np.sqrt(evals[d]))).alias("principal"),
                 (x / F.sqrt("_ca_r")).alias("standard")) for d, x in ((d, F.get("_ca_v", F.lit(d))) for d in range(len(kept)))])))
    coords = _row_coordinates(y, [F.get("_ca_v", F.lit(d)) for d in range(len(kept))], evals[kept]).unionByName(cols)
    return CAResult(named, inertia, _scree(spark, evals, total), coords, [float(x) for x in evals], None)


def _orthonormal(inner: np.ndarray) -> np.ndarray:
    """The matrix that makes vectors with these inner products orthonormal."""
    values, vectors = np.linalg.eigh(inner)
    return vectors / np.sqrt(values)


def ca_biplot(coordinates: DataFrame, pad: float = 0.1) -> DataFrame:
    """CA7: the first two principal dimensions of rows and columns, with the
    plot extents padded by ``pad`` of their range (one aggregate)."""
    pts = (coordinates.filter(F.col("dimension") <= 2)
           .groupBy("kind", "label")
           .agg(F.max(F.when(F.col("dimension") == 1, F.col("principal"))).alias("dim1"),
                F.max(F.when(F.col("dimension") == 2, F.col("principal"))).alias("dim2")))
    ext = pts.agg(F.min("dim1").alias("a"), F.max("dim1").alias("b"),
                  F.min("dim2").alias("c"), F.max("dim2").alias("d"))
    a, b, c, d = (ext.select(x).scalar() for x in "abcd")
    return pts.select("kind", "label", "dim1", "dim2",
                      (a - (b - a) * pad).alias("xmin"), (b + (b - a) * pad).alias("xmax"),
                      (c - (d - c) * pad).alias("ymin"), (d + (d - c) * pad).alias("ymax"))
