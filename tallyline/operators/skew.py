"""Help for groups that are too big for one task.

Lists (paths, user ids, order traces) are the only results whose size grows with
a group. They are given in numbered parts of bounded size by one rule for every
group, or as one row per entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A table of a few numbers per row is broadcast up to this many rows (some 10 MB).
BROADCAST_ROWS = 200_000


def number_rows(
    rows: DataFrame, keys: list[str], at: str, tie: list[str], slice_size: int, position: str
) -> DataFrame:
    """Position (from 0) of each row in its group by ``at``, ``tie``.

    Groups are cut by time, so a group is spread over as many tasks as it has time
    slices: the rows before a slice come from slice counts, the rest is counted
    inside the slice. Join and inner window use the same hash partitioning.
    """
    cut = [*keys, "_slice"]
    sliced = rows.withColumn("_slice", F.floor(F.col(at) / slice_size))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy(*cut).agg(F.count("*").alias("_n"))
    before = counts.select(*cut, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*cut).orderBy(at, *tie)
    return (
        sliced.join(before, cut)
        .withColumn(position, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_slice", "_before")
    )


def hash_part(parts: Column, *by: Column | str) -> Column:
    """Part number of a row among ``parts`` by hash."""
    return F.pmod(F.xxhash64(*by), parts)
