"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

import pytest

from tests.conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_REPEAT="1", BENCH_ONLY="^(g23|m11|w10)",
               BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900, check=True)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["metric"] and rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"g23_q1_fill_rates", "m11_ndcg", "w10_interval_overlaps"}
    assert rec["value"] == pytest.approx(sum(rec["queries"].values()), abs=1e-2)
