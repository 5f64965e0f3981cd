"""Row-change envelopes: ``{"before", "after", "source": {"db","schema","table"}, "op"}``.

A ``position`` beside them, a number that grows with the source's log, tells the order of the
changes of a row, whatever the order they come in. With it, changes make a current table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.schema import CHANGE
from tallyline.sources.commits import BATCH, CommittedBatches, newest
from tallyline.sources.topics import parse_json


def changed_rows(df: DataFrame, on_error: str = "skip", value: str = "value") -> DataFrame:
    """``after`` as a text map with ``table_name`` and ``op``; changes without ``after`` are dropped.

    Works on static and streaming text. Deletes have no ``after`` and so give no row.
    """
    rows = parse_json(df, CHANGE, on_error, value).where(F.col("after").isNotNull())
    return rows.select("after", _table_name().alias("table_name"), "op")


def flatten_changes(
    df: DataFrame, schema: T.StructType | None = None, on_error: str = "skip", value: str = "value"
) -> DataFrame:
    """The changed row with the two added fields.

    With a ``schema`` its fields become columns; values that do not fit are NULL.
    Without one the result is one text map, whose added fields win over equal names.
    """
    rows = changed_rows(df, on_error, value)
    if schema is not None:
        names = [f for f in schema.fields if f.name not in ("table_name", "op")]
        return rows.select(
            *[F.try_element_at("after", F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in names],
            "table_name", "op",
        )
    own = F.map_filter("after", lambda k, _: ~k.isin("table_name", "op"))
    added = F.create_map(F.lit("table_name"), F.col("table_name"), F.lit("op"), F.col("op"))
    return rows.select(F.map_concat(own, added).alias("row"))


def snapshot_rows(df: DataFrame, table_name: str) -> DataFrame:
    """Rows of a table snapshot in the form of flattened changes, with the operation ``r``."""
    return df.withColumns({"table_name": F.lit(table_name), "op": F.lit("r")})


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, table_name: str) -> DataFrame:
    """Snapshot rows followed by the later changes of the same table, as one batch input."""
    later = changes.where(F.col("table_name") == table_name)
    return snapshot_rows(snapshot, table_name).unionByName(later, allowMissingColumns=True)


def keyed_changes(
    df: DataFrame, schema: T.StructType, keys: list[str], table_name: str, on_error: str = "skip",
    value: str = "value", position: str = "position",
) -> DataFrame:
    """Changes of one table, deletes too: its columns, ``op`` and ``position``.

    A delete has its keys from ``before`` and NULL for the rest. Changes without a full key
    are left out. ``position`` names the envelope's field with the place in the source's log;
    a change without one lies before all others.
    """
    fields = [T.StructField("before", CHANGE["after"].dataType), *CHANGE.fields, T.StructField(position, T.LongType())]
    rows = parse_json(df, T.StructType(fields), on_error, value).where(_table_name() == table_name)
    gone = F.col("after").isNull() | F.col("op").eqNullSafe("d")
    source = F.when(gone, F.col("before")).otherwise(F.col("after"))
    columns = [
        F.when(~gone | F.lit(f.name in keys), F.try_element_at(source, F.lit(f.name)).try_cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    op = F.when(gone, F.lit("d")).otherwise(F.col("op")).alias("op")
    known = rows.select(*columns, op, F.coalesce(position, F.lit(-1)).alias("position"))
    return known.dropna(subset=keys)


def as_changes(snapshot: DataFrame) -> DataFrame:
    """Rows of a snapshot as changes before all others, the operation is ``r``."""
    return snapshot.withColumns({"op": F.lit("r"), "position": F.lit(-1).cast("bigint")})


def last_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last change of each key by position; of changes at one position any delete is the last."""
    order = F.struct(F.col("position"), F.col("op").eqNullSafe("d"), F.xxhash64(*changes.columns))
    return newest(changes.withColumn("_order", order), keys, "_order").drop("_order")


def current_rows(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The table after all changes: the last row of each key that is not deleted.

    Each task sends one row per key it has seen, so a key with many changes costs
    no more than another one.
    """
    last = last_changes(changes, keys)
    return last.where(~F.col("op").eqNullSafe("d")).drop("op", "position", BATCH)


def current_table(folder: str, keys: list[str], every: int = 50, late: int = 1_000) -> CommittedBatches:
    """Writer of a current table for ``foreachBatch``: changes as they come, merged on read.

    Snapshots hold the last change of each key, a delete too while the snapshot before the
    last one is less than ``late`` batches behind it. A change that lies before the delete of
    its row in the source but comes that much later would count as new.
    """

    def merge(rows: DataFrame, before: int) -> DataFrame:
        last = last_changes(rows, keys)
        return last.where(~F.col("op").eqNullSafe("d") | (F.col(BATCH) > before - late))

    return CommittedBatches(folder, merge, every)


def read_current(spark: SparkSession, folder: str, keys: list[str], schema: T.StructType | None = None) -> DataFrame:
    """The current table behind ``current_table``; a schema is needed only while it has no batch."""
    return current_rows(current_table(folder, keys).rows(spark, schema), keys)


def _table_name() -> Column:
    return F.concat_ws(".", "source.db", "source.schema", "source.table")
