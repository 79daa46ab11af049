"""Queries with Python in their tasks run where the package is on the driver only."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]
DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="given tables are not here")
def test_tasks_get_the_code_from_the_driver(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = (
    SparkSession.builder.master("local[4]")
    .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
)
for key in e.queries():
    if key.split("_")[0] in ("op1", "op2", "op3", "op5", "op6", "op8", "op11", "op12", "op13"):
        assert e.queries()[key](spark, {str(DATA)!r}).count() > 0, key
"""
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-3000:]
