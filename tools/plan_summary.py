"""Summarise the physical plan of every registered query (markdown table).

Usage: python tools/plan_summary.py [SF_DIR]

Counts, in each query's plan (outside cached sub-plans): shuffle exchanges,
broadcast exchanges, partial aggregates, partial window-group limits, sort-
merge joins and file scans, and says whether pushed filters reach a scan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitlens.plans import queries as Q  # noqa: E402
from visitlens.session import local_session  # noqa: E402


def summarise(plan: str) -> dict:
    outer = plan.split("InMemoryRelation")[0]
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning",
                                   outer)),
        "broadcasts": outer.count("BroadcastExchange"),
        "partial aggs": len(re.findall(r"functions=\[partial_", outer)),
        "partial top-k": outer.count("row_number(), ") and len(re.findall(r", Partial\b", outer)),
        "sort-merge joins": outer.count("SortMergeJoin"),
        "scans": outer.count("FileScan"),
        "pushed filters": "yes" if re.search(r"PushedFilters: \[[^\]]", outer) else "-",
        "cached inputs": plan.count("InMemoryRelation"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    rows = []
    for name, fn in Q.QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarise(plan)))
    cols = list(rows[0][1])
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, s in rows:
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
