"""Time the headline queries, each from the sample tables to its last row.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON
line. Every query builds all it needs itself; nothing is shared between queries. One unmeasured
run of the walk query starts the engine up.
"""

from __future__ import annotations

import json
import os
import time

from tidewatch import registry
from tidewatch.session import local_session

HEADLINE = (
    "money_edge",
    "money_walk",
    "round_trip",
    "layering",
    "pass_through",
    "mule_ring",
    "structuring_daily",
    "structuring_rolling",
    "shared_device_link",
    "acc_link",
    "nearest_session_join",
    "fk_violations",
    "fraud_alert",
    "benchmark",
    "rings_tiers_graph",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries = registry.queries()

    def run(name: str, folder: str = sf_dir) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("money_walk")
    times = {name: run(name) for name in HEADLINE}
    # about as many transfers as the published figures are for
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if os.path.isdir(small):
        times["round_trip_sf0.01"] = run("round_trip", small)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
