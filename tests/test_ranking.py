"""Ranks of groups that are too big for one task."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline.operators.ranking import RANGES, spread_ranks


def plain(rows, keys, measures):
    return rows.withColumns({n: F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(c))) for n, c in measures.items()})


@pytest.mark.parametrize("kind", ["int", "double", "decimal(18,2)"])
def test_small_groups_nulls_and_ties(spark, kind):
    rows = spark.range(300).select(
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("shop"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 37 % 20)).cast(kind).alias("a"), (F.col("id") % 2).cast(kind).alias("b"),
        F.lit(None).cast(kind).alias("c"), F.lit("x").alias("r"),
    ).unionByName(spark.sql(f"select 9L shop, cast(1 as {kind}) a, cast(null as {kind}) b, cast(2 as {kind}) c, 'y' r"))
    measures = {"by_a": "a", "by_b": "b", "by_c": "c"}
    got, want = spread_ranks(rows, ["shop"], measures), plain(rows, ["shop"], measures)
    assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert spread_ranks(rows.limit(0), ["shop"], measures).count() == 0


def test_one_shop_of_a_million_products(spark):
    """Skewed values, half of them equal: no window holds more than a small part of the shop."""
    n = 1_000_000
    value = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.pow(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 1000, F.lit(3)).cast("int"))
    rows = spark.range(0, n, 1, 8).select(F.lit("s").alias("shop"), F.col("id").alias("product"), value.alias("amount"))
    got = spread_ranks(rows, ["shop"], {"place": "amount"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "rank(" in line]
    assert windows and all("_range_place" in w and "_deal_place" in w for w in windows)
    want = rows.groupBy("shop", "amount").count().withColumn("place", 1 + F.coalesce(F.sum("count").over(Window.partitionBy("shop").orderBy(F.desc("amount")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    both = got.groupBy("amount", "place").count().join(want.select("amount", F.col("place").cast("int").alias("place"), "count"), ["amount", "place", "count"])
    assert both.count() == want.count()
    assert got.count() == n


def test_ranges_of_a_million_are_even(spark):
    from tallyline.operators import ranking

    seen = []
    rows = spark.range(0, 200_000, 1, 8).select(F.lit("s").alias("shop"), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"), "id")
    usual = ranking.join_same

    def spy(placed, before, part):
        if "_range_place" in part:
            seen.append(placed.groupBy("_range_place", "_deal_place").count().agg(F.max("count")).first()[0])
        return usual(placed, before, part)

    ranking.join_same = spy
    try:
        spread_ranks(rows, ["shop"], {"place": "v"})
    finally:
        ranking.join_same = usual
    assert seen and seen[0] < 200_000 / RANGES * 2
