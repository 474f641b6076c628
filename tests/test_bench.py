"""bench.py prints one JSON line in the shape the driver records."""

import json
import os
import subprocess
import sys

from core_helpers import ROOT, SF001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "kpi_count", "lineitem_daily"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    )
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001"
    assert set(rec["queries"]) == {"kpi_count", "lineitem_daily"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)
