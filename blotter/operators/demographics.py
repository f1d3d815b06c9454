"""Demographic tables: wide yearly matrices -> one long keyed table (RSH1, RSH2, JN1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.keys import region_year_key
from blotter.schema import DEMOGRAPHIC_DROP, DEMOGRAPHIC_YEARS


def unpivot_years(wide: DataFrame, measure: str, years: Sequence[str] = DEMOGRAPHIC_YEARS,
                  entity: str = "Borough", drop: Sequence[str] = DEMOGRAPHIC_DROP) -> DataFrame:
    """RSH1: ``(entity, y1, y2, ...)`` -> ``(entity, Year, measure)``.

    Year is the column name (text); the measure is cast with ``try_cast`` so
    a junk cell is NULL.  NULL cells are kept, as a melt keeps them.
    """
    w = wide.drop(*drop)
    w = w.select(entity, *[F.col(f"`{y}`").try_cast("double").alias(y) for y in years])
    return w.unpivot([entity], list(years), "Year", measure)


def assemble_demographics(parts: Mapping[str, DataFrame], keys: Sequence[str] = ("Borough", "Year"),
                          entity: str = "Borough") -> DataFrame:
    """RSH2 + JN1: inner-join the long measures on ``keys``, upper-case the
    entity and add ``Demo_Key = upper(entity) || Year``.

    Each part is (entities x years) rows, so the joins are between small
    dimension tables; the planner broadcasts them by their measured size.
    """
    measures = list(parts)
    joined = reduce(lambda a, b: a.join(b, list(keys), "inner"), [parts[m] for m in measures])
    joined = joined.withColumn(entity, F.upper(entity))
    return joined.select(*keys, *measures,
                         region_year_key(entity, "Year").alias("Demo_Key"))
