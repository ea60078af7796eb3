"""Time the registered queries; prints one JSON line.

The offline mirror is built first and timed apart ("setup"): it stands in for
the code host and is not work of the engine. Every query then runs in registration
order into a no-op sink: once cold, and once more if that took under ``WARM_BELOW``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from pullgrid.plans import mirror
from pullgrid.plans.queries import QUERIES


WARM_BELOW = 10.0  # seconds


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pullgrid-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    setup = {}
    for build in (
        mirror.host_mirror,
        mirror.faulty_mirror,
        mirror.tick_mirror,
        mirror.tick_log,
        mirror.gap_log,
        mirror.moved_mirror,
        mirror.entry_files,
        mirror.warm_cache,
        # two queries write to a copy of it, twice each
        lambda s, d: mirror.spare_caches(s, d, copies=4),
    ):
        start = time.perf_counter()
        build(spark, sf_dir)
        setup[build.__name__.replace("<lambda>", "spare_caches")] = round(time.perf_counter() - start, 3)
    seconds, warm = {}, {}
    for name in names:
        run = lambda n=name: QUERIES[n](spark, sf_dir)
        seconds[name] = timed(run)
        if seconds[name] < WARM_BELOW:
            warm[name] = timed(run)
        print(f"{name} {seconds[name]} {warm.get(name, '-')}", file=sys.stderr)
    bodies = mirror.table(spark, sf_dir, "orders").count()
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "warm": warm,
        "sf": float(Path(sf_dir).name.removeprefix("sf")),
        "cpus": int(cpus),
        "setup": setup,
        "bodies": bodies,
    }
    # queries that read every body once
    whole = ("pr_scan", "pr_table", "decode_strict", "fetch_through_cache", "repo_summary")
    result["rows_per_sec"] = {n: round(bodies / seconds[n]) for n in whole if n in seconds}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
