"""Folders for landed files and snapshots of the example queries."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one of the cluster (spark.checkpoint.dir); a temporary one only on one machine without it."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="rankwell-")
        atexit.register(shutil.rmtree, base, True)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
