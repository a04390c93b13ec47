"""Session helpers.

``get_session`` is what tests and ``bench.py`` use.  Library code never builds
its own session: it takes the caller's and reads settings from it
(``checkpoint_dir``), so the same code runs on a cluster where the operator
of the cluster has set those values.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "cellar", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (cluster jobs use their own)."""
    master = master or os.environ.get("CELLAR_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    A session in one local JVM that names none (tests, a trial run) gets a scratch
    folder, which its driver and tasks share.  On any cluster a missing setting
    raises: executors do not see each other's local folders.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("no shared folder: set spark.checkpoint.dir")
        path = tempfile.mkdtemp(prefix="cellar-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path if spark.conf.get("spark.checkpoint.dir", None) else spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the session's shared checkpoint folder (for model files,
    round-trip sinks and other artefacts that must outlive one executor)."""
    return "/".join([checkpoint_dir(spark).rstrip("/"), *parts])
