"""Summarise the final (AQE) physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Each query is executed once (collect) so that the adaptive plan is final;
the counts below are read from that plan. Queries that write tables and
return a read-back only show the read-back plan. For small inputs: every
result is collected.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from strata.queries import REGISTRY  # noqa: E402
from strata.session import local_session  # noqa: E402


def summary(plan: str) -> dict[str, int]:
    plan = plan.split("== Initial Plan ==")[0]  # the final adaptive plan only
    scans = [l for l in plan.split("\n") if "FileScan" in l]
    return {
        "shuffles": len(re.findall(r"\bShuffleQueryStage\b", plan)),
        "broadcasts": len(re.findall(r"\bBroadcastQueryStage\b", plan)),
        "reused": plan.count("ReusedExchange"),
        "scans": len(scans),
        "scans_with_pushed_filters": sum(1 for l in scans if "PushedFilters: [" in l and "PushedFilters: []" not in l),
        "partial_group_limits": plan.count("WindowGroupLimit") and len(re.findall(r"row_number\(\), \d+, Partial", plan)),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "salted": int("_salt" in plan),
    }


DETAILED = ("order_revenue", "product_revenue")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("8", 16)
    cols = None
    print(f"# Final physical plans at {sf}\n")
    print("Generated by `tools/plan_report.py`. Counts are taken from the executed adaptive plan.\n")
    for name, fn in REGISTRY.items():
        df = fn(spark, sf)
        df.collect()
        s = summary(df._jdf.queryExecution().executedPlan().toString())
        if cols is None:
            cols = list(s)
            print("| query | " + " | ".join(cols) + " |")
            print("| --- |" + " --- |" * len(cols))
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    print(
        "\n## At-scale shape: hash exchanges per query\n\n"
        "Automatic broadcasts and AQE off, as when every table is large: the keys each query "
        "shuffles on (`tests/test_plans.py` pins the main ones), hot-key samples included. With automatic "
        "broadcasts on, the dimension tables (`nationkey`, `regionkey`, `state`) need none.\n"
    )
    print("| query | hash exchanges | reused ones besides | keys |")
    print("| --- | --- | --- | --- |")
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, fn in REGISTRY.items():
            plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
            lines = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
            found = [(re.sub(r"#\d+L?", "", re.search(r"hashpartitioning\((.*?), \d+\)", x)[1]), "Reused" in x) for x in lines]
            keys = sorted(k for k, reused in found if not reused)
            print(f"| {name} | {len(keys)} | {len(found) - len(keys)} | " + "; ".join(f"`{k}`" for k in keys) + " |", flush=True)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    for name in DETAILED:
        df = REGISTRY[name](spark, sf)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        print(f"\n## `{name}`: formatted plan (before adaptive re-planning)\n\n```\n{plan.strip()}\n```")


if __name__ == "__main__":
    main()
