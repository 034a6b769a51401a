"""bench.py prints one JSON line with the driver's fields."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(smoke_dir):
    env = dict(os.environ, BENCH_SF_DIR=smoke_dir, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "recode", "choices"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"recode", "choices"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01 and "errors" not in d
