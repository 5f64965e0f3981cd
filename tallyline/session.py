"""Session settings that the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="tallyline-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the checkpoint folder and read back from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
