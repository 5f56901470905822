"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores,
``BENCH_RUNS`` how often each query is timed after one warm-up run (the median
counts).  Every query is run to its last row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from strandline.plans.catalogue import QUERIES
from strandline.session import build_session

HEADLINE = (
    "stage_projection",
    "dedup_latest",
    "dedup_rejects",
    "dup_intra_delivery",
    "dup_losing_copies",
    "scd2_history",
    "scd2_merge",
    "scd2_point_in_time",
    "scd2_interval_check",
    "tumbling_hour",
    "tumbling_quarter_profile",
    "hopping_all",
    "hopping_top5",
    "sliding_count",
    "sliding_top5",
    "session_windows",
    "session_top_days",
    "layer_counts",
    "entity_lineage",
    "integrity_problems",
    "relation_diff",
    "relation_diff_keyed",
    "pseudonymise",
    "surrogate_keys",
    "sequence_keys",
    "eav_pivot",
    "filename_partition",
    "pruned_sum",
)
# Input rows of the operators whose throughput is reported.
THROUGHPUT = {
    "dedup_latest": "orders",
    "scd2_merge": "orders",
    "hopping_all": "events",
    "sliding_count": "events",
    "session_windows": "events",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times[1:]), 4)

    rates = {
        name: round(
            spark.read.parquet(f"{sf_dir}/{source}.parquet").count() / seconds[name]
        )
        for name, source in THROUGHPUT.items()
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
