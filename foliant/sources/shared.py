"""The folder that driver and executors share, for tables and files that one job writes and the next reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset and all runs in one process, as in tests, one of our own."""
    base = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{SETTING} has to name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="foliant-")
        spark.conf.set(SETTING, base)
    return base.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/foliant/{name}-{uuid.uuid4().hex}"
