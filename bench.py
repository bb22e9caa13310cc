"""Times the registered queries and prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the tables, the cores and the timed runs
(median) after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from sigweave.plans.queries import QUERIES
from sigweave.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "parse_delimited",
    "json_to_delimited",
    "area_flags",
    "party_info",
    "terminal_info",
    "previous_value",
    "user_track",
    "location_stay",
    "event_throttle",
    "event_throttle_stream",
    "dedup_latest",
    "fan_out_sinks",
    "rule_chain",
    "rule_chain_stream",
    "enriched_events",
    "enriched_events_stream",
]


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
