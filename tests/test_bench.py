"""bench.py prints the one JSON line the benchmark record needs."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_REPEAT="1", BENCH_QUERIES="a01,a03", BENCH_CPUS="2", BENCH_LITERAL="0")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         env=env, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    report = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(report)
    assert report["unit"] == "sec" and report["sf"] == 0.001 and not report["failed"]
    assert set(report["queries"]) == {"a01", "a03"} and report["value"] > 0
