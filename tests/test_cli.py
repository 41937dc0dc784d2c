"""Command line smoke test (separate processes; each starts its own Spark)."""

import os
import subprocess
import sys

from conftest import ROOT


def _run(*args, cwd=ROOT):
    return subprocess.run(
        [sys.executable, "-m", "pacelake", "--master", "local[2]", "--shuffle-partitions", "4", *args],
        cwd=cwd, capture_output=True, text=True, timeout=600, check=True,
    ).stdout


def test_cli_init_validate_and_list(tmp_dir):
    _run("init", "--root", f"{tmp_dir}/races")
    assert os.path.isdir(f"{tmp_dir}/races/raw/historical") and os.path.isdir(f"{tmp_dir}/races/lake")
    with open(f"{tmp_dir}/specs.txt", "w") as fh:
        fh.write('{"event_name": "Aurora", "country": "nor", "distance_km": 100, "n_finishers": 80}\n')
        fh.write("nothing here\n")
    out = _run("validate", "--specs", f"{tmp_dir}/specs.txt")
    assert "Aurora (NOR)" in out and "no JSON object" in out
    names = _run("list").split()
    from pacelake.plans.catalog import all_queries

    assert names == list(all_queries())
