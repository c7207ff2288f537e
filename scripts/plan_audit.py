"""Physical-plan audit of every catalog query (writes PLANS.md).

For each query: shuffles (Exchange), broadcasts, sorts, windows, generators,
Python evaluation nodes, parse calls, and the columns each Parquet scan reads.
usage: python scripts/plan_audit.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ptloom.plans.catalog import QUERIES
    from ptloom.session import local_session

    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan: what the planner chose up front
    print("# Physical plans (static, before adaptive re-planning)\n")
    print(f"Generated by `scripts/plan_audit.py` on `{sf_dir}`.  Counts are operators in the")
    print("physical plan; `scan columns` lists the columns each Parquet scan reads (pruned).  Queries that write")
    print("and read again, that scan in order or that train show the plan of their last job, over the tables written before.\n")
    print("| query | shuffles | broadcasts | sorts | windows | generators | python | json parses | scan columns |")
    print("|---|---:|---:|---:|---:|---:|---:|---:|---|")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan))
        bcast = plan.count("BroadcastExchange")
        sorts = len(re.findall(r"\bSort \[", plan))
        windows = len(re.findall(r"\bWindow \[", plan))
        gens = plan.count("Generate ")
        py = len(re.findall(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsIn|MapInPandas|MapInArrow)", plan))
        parses = plan.count("parseJson")
        scans = []
        for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+)\.parquet\]", plan):
            cols = [re.sub(r"#\d+L?", "", c) for c in m.group(1).split(",")]
            scans.append(f"{m.group(2)}({len(cols)})")
        print(f"| {name} | {shuffles} | {bcast} | {sorts} | {windows} | {gens} | {py} | {parses} | {', '.join(sorted(set(scans)))} |")
    spark.stop()


if __name__ == "__main__":
    main()
