"""The command line runs the daily job in its own process."""

import json
import os
import subprocess
import sys

from test_sources import _make_csvs

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_daily(tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw_dir)
    _make_csvs(raw_dir)
    env = dict(os.environ, PYTHONPATH=ROOT + os.pathsep + os.environ.get("PYTHONPATH", ""))
    out = subprocess.run([sys.executable, "-m", "tidemark", "daily", "--raw-dir", raw_dir,
                          "--warehouse", os.path.join(tmpdir_path, "wh")],
                         cwd=tmpdir_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    rows = [json.loads(line) for line in out.stdout.splitlines() if line.startswith("{")]
    assert {r["table_name"]: r["row_count"] for r in rows} == {
        "customers": "120", "events": "1500", "orders": "250", "churn_labels": "120"}
    assert os.path.isdir(os.path.join(tmpdir_path, "wh", "marts", "mart_customer_ltv"))
