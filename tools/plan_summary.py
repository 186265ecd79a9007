"""Summarise the physical plans of registered queries under both window plans.

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Counts, per query: shuffles (Exchange hashpartitioning / rangepartitioning), single-partition exchanges,
broadcasts, Window nodes and Python nodes, from ``explain`` text (no job runs except
the size checks and stored tables a query needs while it is built).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ["occ_features", "capacity_clean", "delta_targets", "occ_ema", "add_weather", "station_encodings",
           "weather_asof", "mae_naive", "mae_seasonal", "score_requests", "temporal_cut", "dev_sample", "snapshot_panel"]


def summary(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    # AQE wraps the plan; the initial plan is printed under "+- == Initial Plan =="
    if "Initial Plan" in plan:
        plan = plan.split("Initial Plan ==", 1)[1]
    return {
        "shuffle": len(re.findall(r"Exchange (hash|range)partitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast": len(re.findall(r"BroadcastExchange", plan)),
        "window": len(re.findall(r"\bWindow \[", plan)),
        "python": len(re.findall(r"MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython", plan)),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from dockcast.plans.registry import queries
    from dockcast.session import get_spark
    spark = get_spark("local[4]", 8)
    qs = queries()
    print("| query | plan | shuffles | single-partition | broadcasts | windows | python |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name in QUERIES:
        for strat in ("key", "blocked"):
            spark.conf.set("dockcast.sequence.strategy", strat)
            s = summary(qs[name](spark, sf))
            print(f"| {name} | {strat} | {s['shuffle']} | {s['single']} | {s['broadcast']} | {s['window']} | {s['python']} |")


if __name__ == "__main__":
    main()
