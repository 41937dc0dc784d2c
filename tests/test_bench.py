"""bench.py prints exactly one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_REPEAT": "1", "BENCH_WARMUP": "0", "BENCH_CPUS": "4"}
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env, capture_output=True, text=True, timeout=900, check=True,
    ).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    from pacelake.plans.catalog import all_queries

    assert set(all_queries()) <= set(d["queries"])
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
