"""Top-K categories by record count (TOP1, TOP2, AGG1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_categories(df: DataFrame, column: str, k: int, by: Sequence[str] = (),
                   null_policy: str = "drop_after", weight: str | None = None) -> DataFrame:
    """Rank the values of ``column`` by record count, per group of ``by``.

    Returns ``(*by, column, n, rank)`` for ranks 1..k.  Ties are broken by
    the value, ascending, so the cut is deterministic.

    ``weight`` names a count column when ``df`` is already aggregated (the
    counts are summed instead of rows counted).

    ``null_policy='drop_after'`` lets NULL compete for a slot and removes it
    after the cut (the list can then be shorter than k, as in the original
    analysis); ``'drop_before'`` removes NULL first.

    Plan: a partial+final hash aggregate on ``(by, column)``, then a
    ``row_number() <= k`` window that Spark turns into a WindowGroupLimit
    which runs *before* the shuffle, so each map task forwards at most k rows
    per group; no task ever sees all categories of a group.
    """
    by = list(by)
    src = df if null_policy == "drop_after" else df.filter(F.col(column).isNotNull())
    n = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
    counts = src.groupBy(*by, column).agg(n.alias("n"))
    w = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc_nulls_last(column)) if by else \
        Window.orderBy(F.desc("n"), F.asc_nulls_last(column))
    ranked = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    if null_policy == "drop_after":
        ranked = ranked.filter(F.col(column).isNotNull())
    return ranked.select(*by, column, "n", F.col("rank").cast("int").alias("rank"))


def top_values(df: DataFrame, column: str, k: int, null_policy: str = "drop_after",
               weight: str | None = None) -> list:
    """The top-k category list itself (at most k values, in rank order).

    Pivots need their column list at planning time; this is the one place a
    result reaches the driver, and it is bounded by k.
    """
    rows = top_categories(df, column, k, null_policy=null_policy, weight=weight).orderBy("rank").collect()
    return [r[column] for r in rows]


def top_categories_by_field(df: DataFrame, fields: Sequence[str], k: int,
                            by: Sequence[str] = (), null_policy: str = "drop_after") -> DataFrame:
    """Top-K of several category columns in one scan and one aggregation.

    The fields are stacked into ``(field, category)`` pairs, so ranking three
    columns costs one scan and one shuffle instead of three.  Returns
    ``(*by, field, category, n, rank)``.
    """
    stacked = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("category"))
        for f in fields])))
    return top_categories(stacked, "category", k, by=[*by, "field"], null_policy=null_policy)
