"""Summarise the physical plan of every registered query (for PLANS.md).

Usage: python scripts/plan_summary.py [sf_dir] > PLANS.md
Counts operators in the formatted physical plan before execution (AQE may
still coalesce partitions or turn a sort-merge join into a broadcast at run
time), over the plans of all jobs that run while a query is built (pivot value
lists, written intermediates, size checks) and of the returned frame.
"""

from __future__ import annotations

import io
import re
import sys
from contextlib import redirect_stdout
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from blotter.plans.catalog import QUERIES  # noqa: E402
from blotter.session import local_session  # noqa: E402

NODES = ["Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "Window", "WindowGroupLimit",
         "TakeOrderedAndProject", "Generate", "BatchEvalPython", "ArrowEvalPython", "Scan parquet"]


EAGER = ["collect", "first", "count", "take", "checkpoint", "toPandas", "head"]


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def record_jobs(kind, seen: list) -> None:
    """Keep the plan of every frame that runs a job."""
    for name in EAGER:
        def run(self, *args, _call=getattr(kind, name), **kwargs):
            seen.append(plan(self))
            return _call(self, *args, **kwargs)
        setattr(kind, name, run)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_summary.py` on `{sf_dir}` (plan before AQE re-optimisation).")
    print("Columns count operators in the formatted physical plan; `pushed` = scans with pushed filters,")
    print("`cols` = widest parquet read schema (columns read by one scan).\n")
    print("| query | " + " | ".join(n.replace("Scan parquet", "scans") for n in NODES) + " | pushed | cols |")
    print("|---" * (len(NODES) + 3) + "|")
    seen: list[str] = []
    record_jobs(type(spark.range(1)), seen)
    for name, fn in QUERIES.items():
        seen.clear()
        last = plan(fn(spark, sf_dir))
        text = "\n\n".join([*seen, last])
        tree = "\n".join(p.split("\n\n")[0] for p in [*seen, last])
        counts = []
        for n in NODES:
            pat = r"[-+:\s]" + re.escape(n) + r"(\s|\(|$)"
            counts.append(len(re.findall(pat, tree, flags=re.M)))
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", text))
        widths = [s.count(":") for s in re.findall(r"ReadSchema: struct<(.*)>", text)]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + f" | {pushed} | {max(widths or [0])} |")
    spark.stop()


if __name__ == "__main__":
    main()
