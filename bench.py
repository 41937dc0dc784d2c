"""Benchmark: build the lake from the input tables, then run every registered
query. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; the median of the runs is reported per query),
BENCH_DRIVER_MEM (default 4g; local mode runs everything in the driver JVM),
BENCH_WARMUP (default 1: build once on the sibling sf0.001 folder first, so
JIT/codegen warm-up is not billed to the timings; the lake build is the
median of BENCH_REPEAT-1 builds).
Queries are executed with the ``noop`` sink, so every row is produced but
nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pacelake.plans.catalog import all_queries  # noqa: E402
from pacelake.plans.lake import AS_OF_YEAR, _LAKES, build_lake  # noqa: E402
from pacelake.session import build_session, scratch_path  # noqa: E402
from pacelake.streaming.replay import _OPEN, _REPLAYS, build_incremental, build_replay  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    mem = os.environ.get("BENCH_DRIVER_MEM", "4g")
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * cpus))),
        app_name="pacelake-bench",
        extra={"spark.driver.memory": mem},
    )

    # warm-up: one throwaway build and replay on the smallest sibling scale
    # factor, so JIT and code generation are not billed to the first timing
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.001"))
    warmed = os.path.isdir(warm_dir) and os.environ.get("BENCH_WARMUP", "1") == "1"
    if warmed:
        build_lake(spark, warm_dir, scratch_path(spark, "bench-warmup"), AS_OF_YEAR)
        build_replay(spark, warm_dir, scratch_path(spark, "bench-warmup-replay"), AS_OF_YEAR)
        build_incremental(spark, warm_dir, scratch_path(spark, "bench-warmup-incremental"))

    builds = []
    for _ in range(max(1, repeat - 1)):
        t0 = time.perf_counter()
        lake = build_lake(spark, sf_dir, scratch_path(spark, "bench-lake"), AS_OF_YEAR)
        builds.append(time.perf_counter() - t0)
    build_sec = statistics.median(builds)
    _LAKES[(spark.sparkContext.applicationId, sf_dir, AS_OF_YEAR)] = lake

    # the streaming path: the same rows landed as CSV files and ingested by
    # the triggered bronze -> silver -> fact streams plus the view rebuild
    t0 = time.perf_counter()
    replay = build_replay(spark, sf_dir, scratch_path(spark, "bench-replay"), AS_OF_YEAR)
    replay_sec = time.perf_counter() - t0
    _REPLAYS[(spark.sparkContext.applicationId, sf_dir, AS_OF_YEAR)] = replay

    # the same rows in three drops, each folded into the stored state
    t0 = time.perf_counter()
    folded = build_incremental(spark, sf_dir, scratch_path(spark, "bench-incremental"))
    folded_sec = time.perf_counter() - t0
    _OPEN[(spark.sparkContext.applicationId, "incremental", sf_dir)] = folded

    timings: dict[str, float] = {"lake_build": round(build_sec, 3), "stream_replay_build": round(replay_sec, 3), "incremental_build": round(folded_sec, 3)}
    for name, q in all_queries().items():
        runs = []
        for _ in range(repeat):
            t = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        timings[name] = round(statistics.median(runs), 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "lake_build_plus_all_queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": cpus,
                "n_queries": len(timings) - 3,
                "warmup": warmed,
                "lake_build_runs": [round(b, 3) for b in builds],
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
