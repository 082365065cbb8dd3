"""Write PLANS.md: the physical shape of every registered query.

For each query: hash/range shuffles, broadcasts, single-partition exchanges
(and what feeds them), aggregate operator kinds, joins, and the columns each
parquet scan reads.  Every query is run, and the plan is the final one, after
adaptive execution (reused exchanges are not counted again).

usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    single = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            feed = next((l.strip() for l in lines[i + 1:i + 4] if "Aggregate" in l or "Scan" in l or "Window" in l), "")
            single.append(re.sub(r"#\d+L?", "", feed)[:70])
    scans = []
    for line in lines:
        m = re.search(r"FileScan parquet \[([^\]]*)\]", line)
        if m:
            table = re.search(r"clickmart-tables/([a-z_]+)-", line) or re.search(r"/([a-z_]+)\.parquet", line)
            cols = [re.sub(r"#\d+L?", "", c) for c in m.group(1).split(",")]
            scans.append(f"{table.group(1) if table else '?'}({len(cols)})")
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "single": single,
        "aggs": sorted({a for a in re.findall(r"(HashAggregate|ObjectHashAggregate|SortAggregate)", plan)}),
        "joins": sorted({j for j in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                               r"BroadcastNestedLoopJoin|CartesianProduct)", plan)}),
        "window_limit": "WindowGroupLimit" in plan,
        "scans": scans,
        "python": "ArrowEvalPython" in plan or "BatchEvalPython" in plan,
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from clickmart.conf import get_session
    from clickmart.plans import registry
    spark = get_session("local[8]", 8)
    out = ["# PLANS — physical shape of every registered query", "",
           f"Generated by `tools/plan_report.py` on `{sf_dir}`: the plans that ran, after adaptive execution.",
           "Scans list `table(columns read)`: the materialised staged table (`stg_events`), the fused session",
           "table (`session_features`) or a driver table.  `1-part` lists what feeds each single-partition",
           "exchange: only global aggregates of already-aggregated rows and the histograms of scores and prices appear there.", "",
           "| query | shuffles | broadcasts | 1-part (fed by) | aggregates | joins | scans | python |",
           "|---|---|---|---|---|---|---|---|"]
    for name, fn in registry.QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan.split("== Initial Plan ==")[0])
        out.append(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {'; '.join(s['single']) or '-'} | "
                   f"{', '.join(s['aggs'])}{' +WindowGroupLimit' if s['window_limit'] else ''} | "
                   f"{', '.join(s['joins']) or '-'} | {', '.join(s['scans'])} | {'Arrow UDF' if s['python'] else '-'} |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
