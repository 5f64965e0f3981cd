"""Helpers the operators share: tables, the shared folder, batches, joins with hot keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import checkpoint_dir

#: Rows and bytes of one Arrow batch, unless the session sets its own.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20
#: So many of the largest groups are joined by broadcast; each other group holds at
#: most one part in HEAVY_GROUPS of the rows.
HEAVY_GROUPS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded size; a setting of the session stays."""
    for key, usual, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864", BATCH_BYTES),
    ):
        now = spark.conf.get(key, usual)
        if now in (usual, "64MB", "64m", "9223372036854775807", "-1"):
            spark.conf.set(key, str(value))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of this application in the shared checkpoint folder."""
    home = checkpoint_dir(spark).rstrip("/")
    return f"{home}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read from there.

    Lost executors cost the unfinished tasks only, and no step is computed twice.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def utf8(name: str = "text") -> Column:
    """The whole text in UTF-8; null counts as empty."""
    return text_or_empty(name).cast("binary")


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` with the columns of ``groups`` (one row per key, ``size`` its rows).

    The HEAVY_GROUPS largest groups go by broadcast (a fixed number of rows); of what
    is left no key holds more than one part in HEAVY_GROUPS, so an equality join deals
    it evenly. Keys are not null. Both inputs are read twice: pass stored tables.
    """
    heavy = F.broadcast(groups.orderBy(F.desc(size), *keys).limit(HEAVY_GROUPS))
    light = rows.join(heavy.select(*keys), keys, "left_anti").join(groups, keys)
    return rows.join(heavy, keys).unionByName(light)
