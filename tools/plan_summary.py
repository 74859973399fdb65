"""Compact physical-plan summary of the headline queries (after execution, so AQE's
final choices show): exchanges, join strategies, pushed filters, read schemas, Python
stages. Writes Markdown to stdout."""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

HEADLINE = ["oee_daily", "machine_health", "production_summary", "maintenance_queue", "at_risk_machines",
            "similar_failures", "failure_history", "cooldown_events", "latest_recommendation", "dq_report",
            "coverage_gaps", "incremental_health"]


def summarize(plan: str) -> dict:
    ops = re.findall(r"\b(Exchange [a-zA-Z]+|BroadcastExchange|SortMergeJoin \w*|BroadcastHashJoin \w*|"
                     r"ShuffledHashJoin \w*|WindowGroupLimit|Window|HashAggregate|SortAggregate|ObjectHashAggregate|"
                     r"MapInPandas|MapInArrow|FlatMapGroupsInPandas|CartesianProduct|BroadcastNestedLoopJoin)", plan)
    counts = {}
    for o in ops:
        counts[o] = counts.get(o, 0) + 1
    pushed, schemas = set(), set()
    for line in plan.splitlines():
        if "PushedFilters: [" in line:
            frag = line.split("PushedFilters: [", 1)[1]
            frag = re.split(r"\], (?:ReadSchema|PartitionFilters)|\]$|, ReadSchema", frag)[0]
            if frag:
                pushed.add(frag)
        m = re.search(r"ReadSchema: (struct<.*?>)(?:$|\s)", line)
        if m:
            schemas.add(m.group(1))
    pushed, schemas = sorted(pushed), sorted(schemas)
    return {"ops": counts, "pushed": pushed, "schemas": schemas}


def main():
    from plantmetrics.session import local_session
    from query_registry import QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    print(f"# Physical plans of the headline queries ({os.path.basename(sf)}, local[8], AQE on)\n")
    print("Counts are over the final adaptive plan, including inline scalar subqueries; eager "
          "checkpoints (ids, cooldown) and the query-vector collect of `similar_failures` run as "
          "their own jobs before it. Regenerate with `python tools/plan_summary.py`.\n")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"## {name}\n")
        print("- operators: " + ", ".join(f"{k} ×{v}" for k, v in sorted(s["ops"].items())))
        for p in s["pushed"]:
            print(f"- pushed filters: `{p[:300]}`")
        for r in s["schemas"]:
            print(f"- read schema: `{r[:300]}`")
        print()


if __name__ == "__main__":
    main()
