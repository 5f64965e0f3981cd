"""Connected components of a table of links, as rounds of joins over stored tables.

Links grow with the input, and files of a few bytes a link are 20 times as large in the
hash table of a broadcast, so the joins are merge joins whatever size Spark reads there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import common


def _through_smallest(links: DataFrame) -> DataFrame:
    """Each node's neighbours and itself, tied to the smallest of them.

    ``links`` holds (low, high), low < high, each once. For every node, its larger
    neighbours are tied to the smallest of all its neighbours and itself.
    """
    both = links.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(
        links.select(F.col("high").alias("u"), F.col("low").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = links.select(F.col("low").alias("u"), F.col("high").alias("v")).join(least.hint("merge"), "u")
    return larger.select(F.col("m").alias("low"), F.col("v").alias("high"))


def _among_smaller(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, tied to the smallest of those."""
    least = links.groupBy("high").agg(F.min("low").alias("m"))
    near = links.join(least.hint("merge"), "high")
    return near.select(F.col("m").alias("low"), F.col("low").alias("other")).where("low < other").select("low", F.col("other").alias("high")).unionByName(
        least.select(F.col("m").alias("low"), "high")
    )


def smallest_labels(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (low, high): root is the smallest reachable.

    Alternates the two star steps until nothing changes; the number of rounds grows with
    the logarithm of the longest chain. Only two counts go to the driver per round.
    """
    now = common.stored(links.where("low < high").distinct(), "star")
    while True:
        large = _through_smallest(now).distinct()
        after = common.stored(_among_smaller(large).distinct(), "star")
        if after.count() == now.count() and after.exceptAll(now).isEmpty():
            return after.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
                after.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
            )
        now = after
