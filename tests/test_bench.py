"""bench.py prints exactly one JSON line with the required keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_contract():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="category_salary,cap_per_group", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    res = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(res)
    assert res["unit"] == "sec" and res["sf"] == 0.001
    assert set(res["queries"]) == {"category_salary", "cap_per_group"}
    assert set(res["cpu_seconds"]) in (set(), set(res["queries"]))
    assert res["rows"]["category_salary"] == 12 and "errors" not in res
