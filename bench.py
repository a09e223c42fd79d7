"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  test-data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 4)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 5)
BENCH_ONLY    comma-separated query keys, in place of the headline ones
BENCH_SLOPE   0: leave out the runs on the folder of a tenth of the data beside it

``slope`` is the growth of a query's seconds from the smaller folder, as a power of the data: 1 is
in proportion, near 0 means that planning and start-up make up the time.
"""

from __future__ import annotations

import json
import math
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from haulback import build_session  # noqa: E402
from haulback.plans.registry import queries  # noqa: E402

HEADLINE = [
    "landings_crosstab", "reconcile_interval", "zone_point_in_polygon", "all_sets_fail", "bootstrap_ratio", "full_pipeline",
]


def timed(query, spark, sf_dir: str) -> float:
    """Seconds to plan and run a query completely, tables written on the way included."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def medians(spark, keys: list[str], sf_dir: str, runs: int) -> dict[str, float]:
    known = queries()
    seconds = {}
    for key in keys:
        timed(known[key], spark, sf_dir)
        seconds[key] = round(statistics.median(timed(known[key], spark, sf_dir) for _ in range(runs)), 3)
    return seconds


def scale_of(folder: str) -> float | None:
    name = Path(folder).name.removeprefix("sf")
    return float(name) if name.replace(".", "", 1).isdigit() else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = os.environ.get("BENCH_ONLY")
    keys = only.split(",") if only else HEADLINE
    spark = build_session("haulback-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="haulback-bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = medians(spark, keys, sf_dir, runs)
    scale = scale_of(sf_dir)
    result = {
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": scale if scale is not None else Path(sf_dir).name, "cpus": cpus,
    }
    smaller = Path(sf_dir).parent / f"sf{scale / 10:g}" if scale else None
    if smaller and smaller.is_dir() and os.environ.get("BENCH_SLOPE", "1") != "0":
        less = medians(spark, keys, str(smaller), runs)
        result |= {"smaller": less, "slope": {k: round(math.log10(seconds[k] / less[k]), 2) for k in keys}}
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
