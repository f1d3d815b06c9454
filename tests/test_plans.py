"""Scale properties of every plan a registered query runs, eager jobs included (smallest tables)."""

import io
import re
from contextlib import redirect_stdout

import pytest

from blotter.plans.catalog import QUERIES

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow"]
EAGER = ["collect", "first", "count", "take", "checkpoint", "toPandas", "head"]


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture
def plans_of(spark, sf_dir, monkeypatch):
    """All plans of a query: those of the jobs that run while it is built, and the returned frame's."""
    seen = []
    kind = type(spark.range(1))
    for name in EAGER:
        def run(self, *args, _call=getattr(kind, name), **kwargs):
            seen.append(_plan(self))
            return _call(self, *args, **kwargs)
        monkeypatch.setattr(kind, name, run)

    def plans(name):
        seen.clear()
        last = QUERIES[name](spark, sf_dir)
        return [*seen, _plan(last)]

    return plans


def _scans(plans, column: str) -> int:
    """Scans of the table that owns ``column``, over all plans."""
    return sum(len(re.findall(rf"ReadSchema: struct<[^>]*\b{column}\b", p)) for p in plans)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_udf(plans_of, name):
    for text in plans_of(name):
        for op in FORBIDDEN:
            assert op not in text, f"{name}: {op} in plan"


def test_topk_limits_before_the_shuffle(plans_of):
    text = "".join(plans_of("topk_categories"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scans_are_pruned(plans_of):
    plans = plans_of("grid_density")
    schemas = re.findall(r"ReadSchema: struct<(l_[^>]*)>", "".join(plans))
    # lineitem is read for the 6 of its 11 columns the query needs, with a pushed filter
    assert schemas and all(s.count(",") + 1 <= 6 for s in schemas)
    assert "PushedFilters: [IsNotNull(l_partkey)" in "".join(plans)


@pytest.mark.parametrize("name", ["grid_density", "offence_kernel", "grid_kernel", "heat_points", "group_extent"])
def test_one_scan_for_the_list_and_the_result(plans_of, name):
    assert _scans(plans_of(name), "l_partkey") == 1


@pytest.mark.parametrize("name", ["demographics_long", "ca_scree_two_columns"])
def test_one_scan_of_the_orders(plans_of, name):
    assert _scans(plans_of(name), "o_custkey") == 1


def test_spatial_join_carries_no_whole_shapes(plans_of):
    joins = [p for p in plans_of("service_area_counts") if "_cx" in p and "Join" in p]
    assert joins and all(p.count("BroadcastHashJoin") + p.count("SortMergeJoin") <= 6 for p in joins)
