"""Spark session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "gridmargin", **overrides: str) -> SparkSession:
    """Create (or reuse) a session with the settings the results depend on.

    Sizing (executors, memory, shuffle partitions) is left to the deployment.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.extraJavaOptions": "-Duser.timezone=UTC",
        "spark.executor.extraJavaOptions": "-Duser.timezone=UTC",
        "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
        "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **overrides,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh directory path under the cluster's shared checkpoint folder.

    Only a session on one machine may go without such a folder: it gets a temporary one, which
    goes when Python ends. On several machines each executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines see")
        root = tempfile.mkdtemp(prefix="run-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/gridmargin-{uuid.uuid4().hex}"
