"""The driver may run from any working directory: Python workers must still
import the package (it is shipped with addPyFile)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
print("ROWS", E.queries()["page_list_items"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_python_workers_import_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="silverline-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    rows = [line for line in out.stdout.splitlines() if line.startswith("ROWS")]
    assert rows and int(rows[0].split()[1]) > 0
