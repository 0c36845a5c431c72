"""The folder that the driver and all executors see."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, without a slash at its end.

    Where the setting is absent and Spark runs in one process (tests), a temporary folder is made once and
    set on the session. On a cluster each machine has temporary folders of its own, so there the setting must be there.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='locuspark-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")
