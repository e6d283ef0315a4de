"""Times the headline queries and prints one JSON line.

Each query is computed in full and written to Spark's ``noop`` sink, so nothing is collected. The
value is the sum over the queries, each the better of two runs; one query warms up the JVM first.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.queries import QUERIES
from workload.session import local_session

HEADLINE = [
    "q_m26_daily",
    "q_m01_new_customers",
    "q_m06_transacted_sales",
    "q_m08_birthday_sales",
    "q_m11_birthdays_per_day",
    "q_m13_enrolled_customers",
    "q_m14_members_archived",
    "q_m15_cross_channel_buyers",
    "q_m17_dormant_customers",
    "q_m19_active_customers",
    "q_m24_campaign_details",
    "q_spine",
    "q_population_by_day",
    "q_clean_ids",
    "q_snapshot_roundtrip",
]


def timed(spark, sf_dir: str, name: str) -> float:
    begin = time.perf_counter()
    QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    timed(spark, sf_dir, HEADLINE[0])
    seconds = {name: round(min(timed(spark, sf_dir, name) for _ in range(2)), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
