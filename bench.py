"""Time the headline queries and print one JSON line.

Each query is planned and written in full to the ``noop`` sink, twice; ``queries``
holds the second (warm) time and ``cold`` the first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from voidage.catalog import QUERIES
from voidage.session import local_session

HEADLINE = (
    "pvt_full_all",
    "pvt_full_active",
    "factor_asof_pair",
    "pressure_in_force",
    "reservoir_rollup",
    "running_sum_range",
    "vrr_view_pair",
    "vrr_view_pattern",
    "vrr_view_latest",
    "vrr_report",
)


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=cores)
    spark.range(1000).selectExpr("sum(id)").collect()
    cold, warm = {}, {}
    for name in names:
        cold[name] = timed(spark, sf_dir, name)
        warm[name] = timed(spark, sf_dir, name)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
