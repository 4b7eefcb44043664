"""Where state that must outlive an executor goes."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only where that is unset on one machine, as in tests, a folder of our own."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get()
