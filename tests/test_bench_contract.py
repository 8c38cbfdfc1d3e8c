"""bench.py prints exactly one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "curate_standard", "latest_profile"],
                         capture_output=True, text=True, env=env, timeout=600, cwd="/tmp")
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    rec = json.loads(lines[0])
    assert set(rec) >= {"metric", "value", "unit", "queries", "sf"}
    assert rec["unit"] == "sec" and rec["sf"] == "0.001"
    assert set(rec["queries"]) == {"curate_standard", "latest_profile"}
    assert all(isinstance(v, float) for v in rec["queries"].values())
