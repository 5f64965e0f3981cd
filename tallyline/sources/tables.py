"""Tables of other databases (by JDBC) and stored result tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, options: dict, table: str, partition_column: str | None = None,
    bounds: tuple | None = None, partitions: int = 32, fetch_size: int = 200,
) -> DataFrame:
    """Snapshot of a database table, read in parallel ranges of a numeric or date column.

    Url, driver and credentials come from ``options``; nothing is built in.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    reader = reader.option("fetchsize", fetch_size)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def register_table(spark: SparkSession, options: dict, table: str, view: str, **kwargs) -> DataFrame:
    """A database table as a view, e.g. the product dimension of the daily report."""
    df = read_table(spark, options, table, **kwargs)
    df.createOrReplaceTempView(view)
    return df


def copy_tables(
    tables: Iterable[str], read: Callable[[str], DataFrame], folder: str, mode: str = "overwrite"
) -> list[str]:
    """Whole tables copied to parquet, one folder each; the rows go executor to storage."""
    targets = []
    for table in tables:
        target = f"{folder.rstrip('/')}/{table}"
        read(table).write.mode(mode).parquet(target)
        targets.append(target)
    return targets


def read_result(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Stored result rows; column choice and day filters reach the scan."""
    df = spark.read.parquet(folder)
    return df.select(*columns) if columns else df
