"""Sinks (SNK1, SNK2)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_incidents(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                    partition_by: tuple[str, ...] = ("RECORD_TYPE", "Year")) -> None:
    """Persist the unified table partitioned by record type and year.

    Every downstream analysis filters on ``RECORD_TYPE`` and a year range,
    so this layout turns those filters into directory pruning.  There is
    no repartition by the partition columns: with ~2 record types x ~14
    years that would funnel the whole table through ~28 tasks.  Each task
    writes its own slice of every partition (the writer sorts locally).
    """
    cols = list(partition_by)
    w = df.write.mode(mode)
    if cols:
        w = w.partitionBy(*cols)
    w.format(fmt).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                header: bool = True) -> None:
    """Write a (small) result table, e.g. long demographics as CSV with header."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", header)
    w.format(fmt).save(path)
