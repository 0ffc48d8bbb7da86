"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def test_bench_prints_one_json_line():
    if not os.path.isdir(SF):
        return
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_WARMUP_DIR="/nonexistent")
    proc = subprocess.run(
        [sys.executable, os.path.join(REPO, "bench.py"), "status_counts", "cancellation_rate"],
        capture_output=True, text=True, timeout=300, env=env,
    )
    lines = [l for l in proc.stdout.splitlines() if l.strip()]
    assert len(lines) == 1, proc.stdout + proc.stderr[-1000:]
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"status_counts", "cancellation_rate"} and "errors" not in out
