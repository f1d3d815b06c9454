"""Stratified sampling (SMP1, SPA4)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.schema import SAMPLE_SEED


def stratified_sample(df: DataFrame, stratum: str, fractions: Mapping, seed: int = SAMPLE_SEED) -> DataFrame:
    """Bernoulli sample with a per-stratum fraction (``DataFrame.sampleBy``).

    A stratum missing from ``fractions`` (and NULL) is sampled at 0.  Each
    partition samples independently: no shuffle, no global state.
    """
    return df.sampleBy(stratum, dict(fractions), seed)


def _fraction_of(stratum: str, fractions: Mapping) -> Column:
    if not fractions:
        return F.lit(0.0)
    m = F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(F.element_at(m, F.col(stratum)), F.lit(0.0))


def hash_unit(key) -> Column:
    """A reproducible number in [0, 1) from a key: first 32 bits of md5."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def stratified_sample_hash(df: DataFrame, stratum: str, fractions: Mapping, key: str) -> DataFrame:
    """Deterministic variant: keep a row when ``hash_unit(key) < fraction``.

    The same rows are chosen on every run and every engine (independent of
    partitioning), which makes the sample reproducible and checkable.
    """
    return df.filter(F.col(stratum).isNotNull()
                     & (hash_unit(key) < _fraction_of(stratum, fractions)))
