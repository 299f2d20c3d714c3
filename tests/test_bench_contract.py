import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4", BENCH_REPEATS="1")
    out = subprocess.run([sys.executable, "bench.py", "scan_filter", "period_compare"], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    d = json.loads(lines[-1])
    assert d["metric"] and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"scan_filter", "period_compare"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
