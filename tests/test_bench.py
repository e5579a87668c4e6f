"""bench.py runs and prints one JSON line with the expected fields."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="avg_captures_by_event,series_avg_max")
    done = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                          capture_output=True, text=True, timeout=600, cwd=ROOT)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [line for line in done.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"avg_captures_by_event", "series_avg_max"}
    parts = out["games_table_build_sec"] + out["rated_items_build_sec"] + sum(out["queries"].values())
    assert abs(out["value"] - parts) < 1e-3
