"""Wall-clock of the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list to override the set).
Each query is forced with the ``noop`` sink (every row computed, nothing
collected to the driver); two warm-up queries run first and are not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "occ_features", "capacity_clean", "delta_targets", "station_encodings", "add_weather", "weather_asof",
    "occ_ema", "mae_naive", "mae_seasonal", "comparison_table", "null_rates", "score_requests",
    "gamma_grid", "snapshot_panel", "gbfs_merge", "experiment",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from dockcast.plans.registry import queries
    from dockcast.session import get_spark
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    qs = queries()
    for w in ("panel_scan", "occ_features"):                                   # JIT / codegen warm-up, untimed
        qs[w](spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sfv = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_wall_clock", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sfv, "cpus": cpus}))


if __name__ == "__main__":
    main()
