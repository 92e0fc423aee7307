"""The driver entry points, started from a folder that is not the repository."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", len(e.entry(spark).collect()))
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_runs_from_another_folder(tmp_path):
    if not os.path.isdir("/root/testdata/sf0.001"):
        return
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert "ROWS 10" in done.stdout, done.stderr[-2000:]
