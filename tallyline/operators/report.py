"""Daily report over the stored window results (see ``schema.WINDOW_RESULT``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.text import comma_count, percent_text, ratio
from tallyline.functions.times import parse_time, previous_day
from tallyline.operators.ranking import text_list, top_n
from tallyline.session import stored

# Fixed value: marker of a missing product list.
MISSING = "数据缺失"
DAY_KEYS = ["ds", "window_start", "window_end", "win_gmv", "top5_product_ids"]


def last_windows(results: DataFrame) -> DataFrame:
    """The last window of each day."""
    typed = results.select(
        F.col("ds").cast("string").alias("ds"),
        parse_time("window_start").alias("window_start"),
        parse_time("window_end").alias("window_end"),
        "win_gmv", "top5_product_ids",
    )
    last = top_n(typed, ["ds"], [F.desc("window_end"), F.desc("window_start")], 1)
    return last.select(*DAY_KEYS)


def day_products(days: DataFrame) -> DataFrame:
    """One row per listed product; days without a list and missing markers are dropped."""
    listed = days.where(F.col("top5_product_ids").isNotNull() & (F.col("top5_product_ids") != MISSING))
    parts = listed.select(*DAY_KEYS, F.posexplode(F.split("top5_product_ids", ",")).alias("pos", "product_id"))
    return parts.withColumn("product_id", F.trim("product_id")).where(F.col("product_id") != MISSING)


def with_descriptions(products: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left join to the product dimension (``product_id``, ``product_desc``).

    The dimension is cut down to the listed ids before it is joined; how, is left to
    Spark, which knows the sizes.
    """
    wanted = products.select("product_id").distinct()
    described = dimension.select("product_id", "product_desc").join(
        wanted, "product_id", "left_semi"
    )
    return products.join(described, "product_id", "left")


def joined_descriptions(described: DataFrame) -> DataFrame:
    """Descriptions of a day's products in list order, joined by a comma."""
    text = text_list("product_desc", F.struct("pos", "product_desc"), ", ")
    return described.groupBy(*DAY_KEYS).agg(
        F.when(F.count("product_desc") > 0, text).alias("product_descs")
    )


def day_on_day(days: DataFrame, measure: str = "win_gmv") -> DataFrame:
    """Change against the previous row by day, in percent; NULL where there is no base.

    One row per day, so the window without partition holds only as many rows as days.
    """
    before = F.lag(measure, 1, 0).over(Window.orderBy("ds"))
    return days.withColumn("_rate", ratio(F.col(measure) - before, before)).withColumns(
        {"mon_rate_percent": F.col("_rate") * 100, "mon_rate": percent_text(F.col("_rate"))}
    ).drop("_rate")


def overlap_with_day_before(products: DataFrame) -> DataFrame:
    """Number of products that the list of the previous calendar day has too."""
    cur = products.select("ds", "product_id")
    prev = products.select(F.col("ds").alias("prev_ds"), F.col("product_id").alias("prev_id"))
    same = (F.col("product_id") == F.col("prev_id")) & (F.col("prev_ds") == previous_day("ds"))
    return cur.join(prev, same).groupBy("ds").agg(F.count_distinct("product_id").alias("overlap_count"))


def with_similarity(days: DataFrame, overlap: DataFrame) -> DataFrame:
    """Overlap as share of the list length, as number and as percent text."""
    ids = F.col("top5_product_ids")
    count = F.coalesce("overlap_count", F.lit(0).cast("bigint"))
    share = F.when(ids.isNull() | (ids == ""), F.lit(0.0)).otherwise(ratio(count, comma_count(ids)))
    text = F.when(ids.isNull() | (ids == ""), "0%").otherwise(percent_text(share))
    return days.join(overlap, "ds", "left").withColumns(
        {"overlap_count": count, "similarity_percent": share * 100, "top5_similarity": text}
    )


def daily_report(results: DataFrame, dimension: DataFrame) -> DataFrame:
    """Last window, product descriptions, day-on-day rate and list similarity per day.

    The last windows, one row per day, are stored once because four steps read them.
    """
    products = day_products(stored(last_windows(results)))
    days = day_on_day(joined_descriptions(with_descriptions(products, dimension)))
    return with_similarity(days, overlap_with_day_before(products)).orderBy("ds")
