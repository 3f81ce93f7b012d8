"""Tables that cut lineage: written once to the folder that driver and executors share, and read back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir. Where that is unset and all runs on this machine, a temporary folder takes its place and goes with the process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="digestlake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = "file://" + own
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and base.startswith("/"):
        base = "file://" + base
    return f"{base.rstrip('/')}/digestlake/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    path = folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
