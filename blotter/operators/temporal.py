"""Time-series counts (AGG4-AGG8, FLT6).

All series are built from the complete ``date x category`` grid of a pivot
(zero where a category has no record that day), because means, deviations
and minima over a category are only right when the zero days are present.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.crosstab import crosstab_wide, qcol, wide_to_long
from blotter.session import materialize


def daily_pivot(df: DataFrame, date_col: str, category: str, categories: Sequence[str],
                weight: str | None = None) -> DataFrame:
    """AGG4: one row per day, one zero-filled count column per category."""
    return crosstab_wide(df.filter(F.col(date_col).isNotNull()), date_col, category, categories,
                         weight=weight)


def hourly_pivot(df: DataFrame, ts_col: str, category: str, categories: Sequence[str],
                 hour_col: str = "hour", exclude: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """AGG5 + AGG8 + PRJ2: hour-of-day x category counts.

    Records without a parsable hour are dropped (the original zero-filled
    them into hour 0 by accident); ``exclude`` removes categories.
    """
    keep = [c for c in categories if c not in set(exclude)]
    hours = df if ts_col == hour_col else df.withColumn(hour_col, F.hour(F.col(ts_col)))
    hours = hours.filter(F.col(hour_col).isNotNull())
    return crosstab_wide(hours, hour_col, category, keep, weight=weight)


def pivot_to_long(wide: DataFrame, key: str, categories: Sequence[str], category: str,
                  value: str = "n") -> DataFrame:
    return wide_to_long(wide, [key], categories, category, value)


def monthly_resample(wide: DataFrame, date_col: str, categories: Sequence[str],
                     label: str = "month_end") -> DataFrame:
    """AGG6: month sums of a daily pivot, every month from first to last.

    Empty months are zero; each month is labelled by its last day.  The
    month spine comes from a one-row aggregate exploded by ``sequence`` (its
    size is the number of months, not rows), joined to the monthly sums.
    """
    month = F.trunc(F.col(date_col), "month")
    sums = wide.groupBy(month.alias("_m")).agg(*[F.sum(qcol(c)).alias(c) for c in categories])
    # The monthly sums (months x categories, tiny) are checkpointed once so
    # the spine and the join read them, instead of the optimizer pushing the
    # spine's min/max down into a second scan of the raw input.
    sums = materialize(sums)
    spine = (sums.agg(F.min("_m").alias("lo"), F.max("_m").alias("hi"))
             .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("_m")))
    full = spine.join(sums, "_m", "left")
    return full.select(F.last_day("_m").alias(label),
                       *[F.coalesce(qcol(c), F.lit(0)).cast("long").alias(c) for c in categories])


def seasonal_profile(wide: DataFrame, date_col: str, categories: Sequence[str],
                     part: str = "day", max_key: int | None = None) -> DataFrame:
    """AGG7: sum a daily pivot by day of month (``part='day'``) or month of year.

    ``max_key`` keeps only keys up to it (days 1..28, the days every month has).
    """
    fn = {"day": F.dayofmonth, "month": F.month}[part]
    out = wide.groupBy(fn(F.col(date_col)).alias(part)).agg(
        *[F.sum(qcol(c)).cast("long").alias(c) for c in categories])
    if max_key is not None:
        out = out.filter(F.col(part) <= max_key)
    return out
