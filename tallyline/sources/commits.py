"""Stored batches that a reader sees whole or not at all.

A batch is written in two phases: its rows are staged in a folder of their own, then one
empty file in ``log`` names that folder. Creating the file is the commit; a folder that no
file names is never read, whether a task, the driver or the whole job was lost before. A
batch that is committed already is not written again, so a replay adds nothing.

Every so many batches the rows since become one folder, committed in the same way: a segment
with these rows or, with a ``merge`` (the last row of each key, say), a snapshot that takes
in the one before it. What the last but one covers is deleted, with staged folders of lost
attempts: beside snapshots and segments, the folders read and kept are those of at most two
times ``every`` batches, however many there have been.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "_batch"
#: Reduces the rows of a snapshot; takes them and the last batch of the snapshot before.
Merge = Callable[[DataFrame, int], DataFrame]


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, path = _path(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []


def _delete(spark: SparkSession, name: str) -> None:
    files, path = _path(spark, name)
    files.delete(path, True)


class CommittedBatches:
    """Writer for ``foreachBatch``; see the module. ``every`` = 0 makes no snapshots.

    Log entries are called ``kind.last batch.folder``. Should two attempts commit the same
    batch, the first name counts.
    """

    def __init__(self, folder: str, merge: Merge | None = None, every: int = 50):
        self.folder, self.merge, self.every = folder.rstrip("/"), merge, every

    def entries(self, spark: SparkSession, kind: str) -> dict[int, str]:
        """Last batch -> folder of the committed batches or snapshots."""
        out: dict[int, str] = {}
        for name in _names(spark, f"{self.folder}/log"):
            k, upto, where = name.split(".", 2) if name.count(".") >= 2 and not name.startswith(".") else ("", "", "")
            if k == kind:
                out.setdefault(int(upto), where)
        return out

    def stage(self, df: DataFrame, kind: str, upto: int) -> str:
        """First phase: the rows in a folder that nothing names."""
        where = f"{kind}-{upto}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/data/{where}")
        return where

    def commit(self, spark: SparkSession, kind: str, upto: int, where: str) -> None:
        """Second phase: one file, created at once, makes the staged rows count."""
        files, path = _path(spark, f"{self.folder}/log/{kind}.{upto}.{where}")
        files.createNewFile(path)

    def compacted(self, spark: SparkSession) -> dict[int, tuple[str, str]]:
        """Last batch -> kind and folder of the snapshots and segments."""
        return {k: (kind, where) for kind in ("segment", "snapshot") for k, where in self.entries(spark, kind).items()}

    def live(self, spark: SparkSession, upto: int | None = None) -> list[str]:
        """Folders that hold the committed rows, up to a batch if one is given."""
        within = lambda found: [(k, found[k]) for k in sorted(found) if upto is None or k <= upto]
        done, batches = within(self.compacted(spark)), within(self.entries(spark, "batch"))
        last = done[-1][0] if done else -1
        snapshots = [k for k, (kind, _) in done if kind == "snapshot"]
        old = [where for k, (_, where) in done if not snapshots or k >= snapshots[-1]]
        return old + [where for k, where in batches if k > last]

    def rows(self, spark: SparkSession, schema: T.StructType | None = None, upto: int | None = None) -> DataFrame:
        """The committed rows with the batch they came with."""
        return self._read(spark, self.live(spark, upto), schema)

    def last(self, spark: SparkSession) -> DataFrame:
        """The rows of the last committed batch, the state of a query in complete mode."""
        batches = self.entries(spark, "batch")
        return self._read(spark, [batches[k] for k in sorted(batches)[-1:]]).drop(BATCH)

    def _read(self, spark: SparkSession, folders: list[str], schema: T.StructType | None = None) -> DataFrame:
        if schema is not None:
            schema = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        if not folders:
            if schema is None:
                raise ValueError(f"nothing is committed in {self.folder}: give a schema")
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(*[f"{self.folder}/data/{f}" for f in folders])

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        done = self.compacted(spark)
        if batch_id > max(done, default=-1) and batch_id not in self.entries(spark, "batch"):
            rows = df.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
            self.commit(spark, "batch", batch_id, self.stage(rows, "batch", batch_id))
        else:  # a stream's state takes part in the replay, so the rows are made again
            df.write.format("noop").mode("append").save()
        if self.every and (batch_id + 1) % self.every == 0 and batch_id not in done:
            self.compact(spark, batch_id)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """One folder for the batches up to ``upto``; what the one before it covers is deleted."""
        before = max((k for k in self.compacted(spark) if k < upto), default=-1)
        if self.merge is None:
            batches = self.entries(spark, "batch")
            kind, rows = "segment", self._read(spark, [batches[k] for k in sorted(batches) if before < k <= upto])
        else:
            kind, rows = "snapshot", self.merge(self.rows(spark, upto=upto), before)
        self.commit(spark, kind, upto, self.stage(rows, kind, upto))
        self.retire(spark, before)

    def retire(self, spark: SparkSession, covered: int) -> None:
        """Deletes batches up to ``covered`` and snapshots before it: first the entries, then the rows.

        What the last snapshot covers stays until the next one, for readers that have begun.
        """
        for home, split in (("log", "."), ("data", "-")):
            for name in _names(spark, f"{self.folder}/{home}"):
                kind, upto, *_ = name.split(split, 2)
                if (kind == "batch" and int(upto) <= covered) or (kind == "snapshot" and int(upto) < covered):
                    _delete(spark, f"{self.folder}/{home}/{name}")


def newest(rows: DataFrame, keys: list[str], by: str = BATCH) -> DataFrame:
    """The row of each key with the largest ``by``."""
    values = F.struct(*[c for c in rows.columns if c not in keys])
    return rows.groupBy(*keys).agg(F.max_by(values, by).alias("_row")).select(*keys, "_row.*")
