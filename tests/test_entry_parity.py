"""Driver contract and oracle parity (Spark vs DuckDB) on the driver tables."""

import importlib.util
from pathlib import Path

import pytest

import __spark_entry__ as E
from blotter.plans.catalog import ORACLES, QUERIES

_spec = importlib.util.spec_from_file_location(
    "check_oracle", Path(__file__).resolve().parents[1] / "scripts" / "check_oracle.py")
_chk = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_chk)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["PREM_TYP_DESC", "OFNS_DESC", "n"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    return _chk.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle_parity(spark, duck, sf_dir, name):
    s = E.queries()[name](spark, sf_dir).toPandas()
    d = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert _chk.norm(s, False) == _chk.norm(d, False)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, sf_dir, name):
    assert E.queries()[name](spark, sf_dir).count() > 0
