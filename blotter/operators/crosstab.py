"""Crosstabs / pivot counts (AGG3-AGG5, AGG8, RSH3, NUL1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def qcol(name: str) -> Column:
    """Column by exact name (names here are data values such as ``1-URGENT``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def crosstab_wide(df: DataFrame, row, column: str, values: Sequence[str],
                  row_alias: str | None = None, weight: str | None = None) -> DataFrame:
    """Count records per ``row`` key for each listed value of ``column``.

    One output column per value, zero-filled; records whose ``column`` value
    is not listed still create their row key (with zeros).  NULL is a legal
    row key.  Written as one hash aggregate of ``count_if`` expressions: a
    single shuffle of per-task partial counts, no distinct pass over the
    pivot column and no second pivot aggregation.  ``weight`` names a count
    column when ``df`` is already aggregated (counts are summed).
    """
    key = F.col(row) if isinstance(row, str) else row
    name = row_alias or (row if isinstance(row, str) else None)
    if name is not None:
        key = key.alias(name)
    if weight is None:
        aggs = [F.count_if(F.col(column) == F.lit(v)).alias(str(v)) for v in values]
    else:
        aggs = [F.coalesce(F.sum(F.when(F.col(column) == F.lit(v), F.col(weight))), F.lit(0))
                .cast("long").alias(str(v)) for v in values]
    return df.groupBy(key).agg(*aggs)


def wide_to_long(wide: DataFrame, ids: Sequence[str], values: Sequence[str],
                 variable: str, value: str = "n") -> DataFrame:
    """RSH3 inverse: wide value columns -> ``(ids, variable, value)`` rows."""
    return wide.unpivot(list(ids), [qcol(str(v)) for v in values], variable, value)


def crosstab_long(df: DataFrame, row: str, column: str, values: Sequence[str],
                  row_filter: Sequence[str] | None = None, weight: str | None = None) -> DataFrame:
    """Complete ``(row, column, n)`` grid: every row key x every listed value.

    ``row_filter`` restricts the row keys to a list (e.g. the top-K
    premises).  The grid is completed through the wide form, so there is no
    cross join of key sets.
    """
    src = df if row_filter is None else df.filter(F.col(row).isin(list(row_filter)))
    wide = crosstab_wide(src, row, column, values, weight=weight)
    return wide_to_long(wide, [row], values, column, "n")


def pair_counts(df: DataFrame, row, column: str, name: str = "n") -> DataFrame:
    """Pre-aggregate ``(row, column)`` record counts.

    Top-K lists and crosstabs can both be taken from this one aggregate, so
    the raw records are scanned once instead of once per list plus once for
    the table.  The result is small (distinct key pairs).
    """
    key = F.col(row) if isinstance(row, str) else row
    return df.groupBy(key, F.col(column)).agg(F.count(F.lit(1)).alias(name))
