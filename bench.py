"""Time the headline queries on one machine and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of threads. Every query runs once to
warm the JVM up and once for its time, both to the last row. Mining is timed a second time with large
tables kept from being broadcast.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cartyield.plans.queries import queries  # noqa: E402

HEADLINES = [
    "parse_transactions",
    "twu",
    "utility_list_twu",
    "mine_exact",
    "mine_endpoints",
    "mine_exact_suppliers",
    "summary_stats",
    "mine_stats",
    "run_text",
]
# Run once more with no table small enough to broadcast, as on large data.
SHUFFLED = ["mine_exact", "mine_endpoints"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cartyield-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cartyield-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINES

    def timed(name: str) -> float:
        for _ in range(2):
            started = time.perf_counter()
            queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - started
        return round(taken, 3)

    seconds = {name: timed(name) for name in chosen}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "300k")
    shuffled = {name: timed(name) for name in SHUFFLED if name in chosen}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "broadcasts_up_to_300k": shuffled,
                "threads": int(cpus),
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
