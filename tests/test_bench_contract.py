"""bench.py prints exactly one JSON line on stdout (run in its own process)."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_WARMUP_DIR=SF_SMALL,
               BENCH_QUERIES="average_rating_per_movie,top_n_movies", BENCH_DRIVER_MEMORY="2g",
               BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"average_rating_per_movie", "top_n_movies"}
    assert rec["value"] > 0 and rec["sf"] == 0.001
