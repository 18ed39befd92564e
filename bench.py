"""Time the headline queries; print one JSON line.

BENCH_SF_DIR  folder of the test tables   (default /root/testdata/sf0.1)
BENCH_CPUS    threads of the local master (default 8)
BENCH_RUNS    timed runs per query        (default 3, the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.catalogue import QUERIES  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402

HEADLINE = (
    "ar_mart",
    "ar_corrections",
    "ar_keys",
    "either_key_join",
    "revenue_mart_a",
    "revenue_mart_b",
    "revenue_classify",
    "job_default_min_by",
    "client_keys",
    "ranked_parents",
    "rekey_duplicates",
)


def medians(builders: dict, runs: int) -> dict[str, float]:
    """Median seconds to build, plan and run each frame into a sink that keeps nothing.

    Rounds over all of them, the first one untimed, so that each is measured on
    an equally warm machine.
    """
    times = {name: [] for name in builders}
    for _ in range(1 + runs):
        for name, build in builders.items():
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - start)
    return {name: round(statistics.median(taken[1:]), 3) for name, taken in times.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        "ledgerloom-bench",
        shuffle_partitions=cpus,
        **{
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            # Compile generated methods of any size.
            "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = medians({name: partial(QUERIES[name], spark, sf_dir) for name in HEADLINE}, runs)
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
