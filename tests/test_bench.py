"""bench.py prints one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_bench_emits_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_OUT_DIR=str(tmp_path))
    proc = subprocess.run(
        [sys.executable, str(ROOT / "bench.py")], env=env, cwd=str(tmp_path),
        capture_output=True, text=True, timeout=900,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.startswith("{")]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["value"] > 0
    assert result["sf"] == 0.001
    assert {"build", "report_write"} <= set(result["queries"])
