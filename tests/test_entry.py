"""The driver contract without the training-data subpackage, and from another folder."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
DATA = Path("/root/testdata/sf0.001")


def python(code, folder):
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_a_missing_package_leaves_the_other_queries(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
sys.modules["xxhash"] = None
import __spark_entry__ as e
found = e.queries()
assert len(found) > 40 and not any(key.startswith("op") for key in found)
assert set(e.oracle_sql()) <= set(found)
"""
    python(code, tmp_path)


@pytest.mark.skipif(not DATA.exists(), reason="given tables are not here")
def test_tasks_get_the_code_from_the_driver(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for key in ("archive_ingest", "typed_csv_scan"):
    assert e.queries()[key](spark, {str(DATA)!r}).count() > 0
"""
    python(code, tmp_path)
