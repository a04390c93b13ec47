"""Corpus queries run when the driver starts from another folder: executors need no copy
of the package."""

import os
import subprocess
import sys

from paths import ROOT

SCRIPT = r"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1] + "/__spark_entry__.py")
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
for name, q in m.queries().items():
    if name.split("_")[0] in ("op2", "op3", "op5", "op11", "op12", "op13"):
        print("RESULT", name, q(spark, "/root/testdata/sf0.001").count(), flush=True)
spark.stop()
"""


def test_runs_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    lines = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert len(lines) == 6, out.stderr[-2000:]
