"""Lenient civil-date and clock-time parsing (DT1-DT3).

Spark 4 runs in ANSI mode, where ``to_timestamp`` raises on text that does
not parse.  Raw feeds contain junk, so every parse goes through
``try_to_timestamp``: unparsable text, impossible dates (``13/45/2019``) and
``24:00:00`` all become NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.schema import CIVIL_DATE_FORMAT, CLOCK_TIME_FORMAT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def civil_date(c, fmt: str = CIVIL_DATE_FORMAT) -> Column:
    """``MM/dd/yyyy`` text (one-digit month/day accepted) -> DATE, NULL on junk."""
    return F.to_date(F.try_to_timestamp(_col(c), F.lit(fmt)))


def clock_hour(c, fmt: str = CLOCK_TIME_FORMAT) -> Column:
    """``HH:mm:ss`` text -> hour of day (INT), NULL on junk."""
    return F.hour(F.try_to_timestamp(_col(c), F.lit(fmt)))


def date_parts(c, fmt: str = CIVIL_DATE_FORMAT) -> dict[str, Column]:
    """``Year``, ``Month`` and ``Date`` derived from one civil-date text column."""
    d = civil_date(c, fmt)
    return {"Year": F.year(d), "Month": F.month(d), "Date": d}
