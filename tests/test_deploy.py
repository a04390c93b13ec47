"""The package runs when the driver starts from another folder: task-side
functions travel with the job (pickled by value), executors import nothing
from the repository."""

import os
import subprocess
import sys

from paths import ROOT

SCRIPT = r"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1] + "/__spark_entry__.py")
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
q = m.queries()
print("RESULT", q["nearest_assign"](spark, "/root/testdata/sf0.001").count(),
      q["row_map"](spark, "/root/testdata/sf0.001").count(), flush=True)
spark.stop()
"""


def test_runs_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert lines, out.stderr[-2000:]
    _, n_assign, n_rows = lines[0].split()
    assert int(n_assign) > 0 and int(n_rows) > 0
