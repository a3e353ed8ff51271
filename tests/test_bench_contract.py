import json
import os
import subprocess
import sys

from .conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "topk_preview", "upsert_latest"],
                         capture_output=True, text=True, env=env, timeout=600, check=True).stdout
    lines = [l for l in out.splitlines() if l.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "total_sec" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"topk_preview", "upsert_latest"} and "errors" not in d
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
