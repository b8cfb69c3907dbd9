"""bench.py prints one JSON line with the contract fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_RUNS="1", BENCH_QUERIES="bar_range,content_hash")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and not rec["failed"]
    assert set(rec["queries"]) == {"bar_range", "content_hash"}
    assert rec["value"] > 0
