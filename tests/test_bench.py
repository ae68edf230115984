"""bench.py prints exactly one JSON line with the contract's keys."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "v07_station_performance",
                          "p03_usage_spikes"], env=env, capture_output=True, text=True, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert set(d) >= {"metric", "value", "unit", "queries", "sf"} and d["unit"] == "sec"
    assert set(d["queries"]) == {"v07_station_performance", "p03_usage_spikes"} and d["sf"] == 0.001
