"""Top-N per group and ordered text lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rn") -> DataFrame:
    """First ``n`` rows of each group, numbered from 1.

    Spark limits each group inside every map task before the shuffle, so at most
    ``n`` rows per group and task travel. ``order`` must end in a unique column.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(rank) <= n)


def text_list(value: Column | str, order: Column | str, separator: str = ",") -> Column:
    """Aggregate: values joined in the given order (for groups of bounded size)."""
    c = F.col(value) if isinstance(value, str) else value
    o = F.col(order) if isinstance(order, str) else order
    ordered = F.array_sort(F.collect_list(F.struct(o.alias("o"), c.alias("v"))))
    return F.array_join(F.transform(ordered, lambda e: e["v"]), separator)


def ranked_slots(value: str, rank: str, n: int, separator: str = ",") -> Column:
    """Aggregate: one slot per rank, an empty slot where a rank is missing."""
    slots = [F.max(F.when(F.col(rank) == k, F.col(value)).otherwise("")) for k in range(1, n + 1)]
    return F.concat_ws(separator, *slots)


#: Ranges that the values of a group are cut into for ``spread_ranks``.
RANGES = 64


def spread_ranks(rows: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """``rank() over (partition by keys order by measure desc)`` for groups of any size.

    ``measures`` maps the name of each rank to its numeric column. Quantiles of the group
    (a mergeable sketch) cut its values into RANGES ranges. The rows of the ranges before
    come from counts per range, the rank inside a range from a window over that range
    alone, and equal values are always in one range. A value that is a quantile itself has
    a range of its own: all its rows have the same rank and are dealt out by hash. So no
    task gets a whole group or all rows of a frequent value; how good the sketch is decides
    only how even the ranges are. NULL values rank last.
    """
    cuts = [k / RANGES for k in range(1, RANGES)]
    bounds = rows.groupBy(*keys).agg(
        *[F.percentile_approx(c, cuts, 1000).alias(f"_cuts_{name}") for name, c in measures.items()]
    )
    placed = join_same(rows, bounds, keys)
    columns = rows.columns
    for name, c in measures.items():
        found = F.col(f"_cuts_{name}")
        above = 2 * F.size(F.filter(found, lambda b: b > F.col(c)))
        alone = F.coalesce(F.exists(found, lambda b: b == F.col(c)), F.col(c).isNull())
        place = F.when(F.col(c).isNull(), F.lit(2 * RANGES)).otherwise(F.when(alone, above + 1).otherwise(above))
        deal = F.when(alone, F.pmod(F.xxhash64(*columns), F.lit(RANGES))).otherwise(F.lit(0))
        placed = placed.withColumns({f"_range_{name}": place, f"_deal_{name}": deal})
    placed = placed.drop(*[f"_cuts_{name}" for name in measures])
    for name, c in measures.items():
        part = [*keys, f"_range_{name}"]
        earlier = Window.partitionBy(*keys).orderBy(f"_range_{name}").rowsBetween(Window.unboundedPreceding, -1)
        counts = placed.groupBy(*part).agg(F.count("*").alias("_n"))
        before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
        inside = F.rank().over(Window.partitionBy(*part, f"_deal_{name}").orderBy(F.desc(c)))
        ranked = join_same(placed, before, part).withColumn(name, (F.col("_before") + inside).cast("int"))
        placed = ranked.drop("_before", f"_range_{name}", f"_deal_{name}")
    return placed


def join_same(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``groups`` (one row per key); NULL keys are keys."""
    renamed = groups.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return rows.join(renamed, same).drop(*[f"_of_{k}" for k in keys])
