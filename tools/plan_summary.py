"""Summarise the executed physical plan of registered queries.

Usage: python tools/plan_summary.py [sf_dir] name ...

For each query: runs it once (so AQE's final plan is shown), then lists the
scans (ReadSchema, pushed filters), every shuffle exchange with its
partitioning, the join strategies, window / aggregate operators, and how
many operators run inside whole-stage codegen.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from punctual.catalog import QUERIES  # noqa: E402
from punctual.session import get_session  # noqa: E402


def summarise(plan: str) -> list[str]:
    final = plan.split("== Initial Plan ==")[0]
    out = []
    ops = Counter()
    codegen = 0
    for line in final.splitlines():
        m = re.match(r"^[\s:+\-|]*(\*\s*\(\d+\)\s*)?([A-Z][A-Za-z]+)", line)
        if not m:
            continue
        name = m.group(2)
        ops[name] += 1
        if m.group(1):
            codegen += 1
    for m in re.finditer(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|"
                         r"RoundRobinPartitioning\(\d+\)|SinglePartition)", final):
        out.append(f"  shuffle: {m.group(1)[:110]}")
    for m in re.finditer(r"FileScan parquet [^\[]*\[([^\]]*)\][^\n]*?PushedFilters: \[([^\]]*)\]"
                         r"[^\n]*?ReadSchema: (struct<[^>]*>)", final):
        out.append(f"  scan: filters=[{m.group(2)[:80]}] schema={m.group(3)[:110]}")
    keys = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
            "CartesianProduct", "Window", "HashAggregate", "SortAggregate",
            "ObjectHashAggregate", "TakeOrderedAndProject", "Expand", "Generate"]
    out.append("  operators: " + ", ".join(f"{k}={ops[k]}" for k in keys if ops[k]))
    out.append(f"  operators inside whole-stage codegen: {codegen}")
    return out


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    spark = get_session("local[8]")
    for n in names:
        df = QUERIES[n](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {n}")
        print("\n".join(summarise(plan)))
        print()


if __name__ == "__main__":
    main()
