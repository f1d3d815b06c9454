"""Harmonize arrest and complaint feeds into one incident table (NRM1).

Covers PRJ1 (drop), PRJ3 (rename), PRJ5/PRJ6 (typed NULL + discriminator),
PRJ8 (code -> label), PRJ9 (numeric cast), FLT1/FLT2 (domain filters),
DT1/DT3 (date parts) and SET1 (union).  The whole thing is one lazy plan of
projections, filters and a union: no shuffle, no Python worker, and the
filters push into the scans of both feeds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.dates import date_parts
from blotter.schema import (ARREST_AGE_GROUPS, ARREST_DROP, ARREST_RENAMES, BOROUGH_CODES,
                            CIVIL_DATE_FORMAT, COMPLAINT_AGE_GROUPS, COMPLAINT_DROP,
                            INCIDENT_COLUMNS, SUSPECT_SEXES, VICTIM_SEXES)


def in_domain(column: str, values: Sequence[str]) -> Column:
    """FLT1: value is one of ``values``; NULL is rejected."""
    return F.col(column).isin(list(values))


def in_domain_or_null(column: str, values: Sequence[str]) -> Column:
    """FLT2: value is one of ``values`` or NULL."""
    return F.col(column).isin(list(values)) | F.col(column).isNull()


def map_codes(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ8: replace coded values by labels; unknown codes and NULL pass through."""
    return df.replace(dict(mapping), subset=[column])


def to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRJ9: numeric cast that turns junk text into NULL instead of failing."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in present})


def order_incident_columns(df: DataFrame) -> DataFrame:
    lead = [c for c in INCIDENT_COLUMNS if c in df.columns]
    rest = sorted(c for c in df.columns if c not in INCIDENT_COLUMNS)
    return df.select(*lead, *rest)


def harmonize(arrests: DataFrame, complaints: DataFrame, *,
              arrest_ages: Sequence[str] = ARREST_AGE_GROUPS,
              complaint_ages: Sequence[str] = COMPLAINT_AGE_GROUPS,
              suspect_sexes: Sequence[str] = SUSPECT_SEXES,
              victim_sexes: Sequence[str] = VICTIM_SEXES,
              borough_codes: Mapping[str, str] = BOROUGH_CODES,
              date_format: str = CIVIL_DATE_FORMAT) -> DataFrame:
    """Unify raw arrests and complaints into one typed incident table.

    * arrests: drop, rename to the complaint vocabulary, map borough codes,
      keep legal age groups only (NULL age rejected), ``RECORD_TYPE='A'``,
      date parts from ``ARREST_DATE``.
    * complaints: drop, keep legal-or-NULL suspect age, suspect sex and victim
      sex, ``RECORD_TYPE='C'``, date parts from ``CMPLNT_FR_DT``.
    * union by column name; a column one side lacks is NULL on that side.
    """
    a = arrests.drop(*ARREST_DROP).withColumnsRenamed(dict(ARREST_RENAMES))
    a = map_codes(a, "BORO_NM", borough_codes)
    a = a.filter(in_domain("SUSP_AGE_GROUP", arrest_ages))
    a = a.withColumn("RECORD_TYPE", F.lit("A")).withColumns(date_parts("ARREST_DATE", date_format))

    c = complaints.drop(*COMPLAINT_DROP)
    c = c.filter(in_domain_or_null("SUSP_AGE_GROUP", complaint_ages)
                 & in_domain_or_null("SUSP_SEX", suspect_sexes)
                 & in_domain_or_null("VIC_SEX", victim_sexes))
    c = c.withColumn("RECORD_TYPE", F.lit("C")).withColumns(date_parts("CMPLNT_FR_DT", date_format))

    u = a.unionByName(c, allowMissingColumns=True)
    u = to_double(u, ["Latitude", "Longitude"])
    return order_incident_columns(u)


def record_type(df: DataFrame, kind: str) -> DataFrame:
    """FLT3: one record type of the unified table ('A' arrests, 'C' complaints)."""
    return df.filter(F.col("RECORD_TYPE") == kind)


def since(df: DataFrame, start: str, date_col: str = "Date", year_col: str | None = "Year") -> DataFrame:
    """FLT6: rows on or after ``start`` (a sargable range predicate on the date).

    When the table also carries the year (its partition column once written
    by ``write_incidents``), the implied ``Year >= year(start)`` is added so
    whole year directories are pruned, not only row groups.
    """
    cond = F.col(date_col) >= F.lit(start).cast("date")
    if year_col and year_col in df.columns:
        cond = (F.col(year_col) >= F.lit(int(start[:4]))) & cond
    return df.filter(cond)
