"""Order metrics on a stream of order events (with ``ts_ms``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.text import clean_id, filled, lenient_number
from tallyline.functions.times import DAY, ORDER_ZONE, wall_micros
from tallyline.operators.orders import (
    GMV, MONEY, SALES, STEP, rankable_rows, report_of_slices, sales_of_slices, top_rows_of_slices,
)
from tallyline.operators.ranking import ranked_slots, top_n
from tallyline.operators.windows import BOUNDS, show_bounds
from tallyline.sources.sinks import start_to_folder
from tallyline.streaming.windows import (
    DELAY, LOCAL, last_end, slice_sums, timed, window_of, window_sums, with_bounds,
)

# Lists of state that the rows of an open slice are spread over.
SHARES = 64


def window_sales(
    orders: DataFrame, size: int = STEP, slide: int | None = None, zone: str = ORDER_ZONE, delay: str = DELAY
) -> DataFrame:
    """Sales amount per tumbling or hopping window, in append mode."""
    amount = lenient_number("total_amount", "decimal(10,2)")
    sums = window_sums(timed(orders, zone=zone, delay=delay), size, {"total_sum": amount}, slide=slide)
    return show_bounds(sums.withColumn("total_sum", F.col("total_sum").cast(MONEY)))


def sales_slices(
    orders: DataFrame, step: int = STEP, zone: str = ORDER_ZONE, delay: str = DELAY
) -> DataFrame:
    """Closed slices of the sales amount, in append mode; the state holds the open slices only."""
    rows = timed(orders.where(filled("total_amount")), zone=zone, delay=delay)
    slices = slice_sums(rows, step, {SALES: lenient_number("total_amount", "decimal(10,2)")})
    return slices.withColumn(SALES, F.col(SALES).cast(MONEY))


def product_slices(
    orders: DataFrame, step: int = STEP, zone: str = ORDER_ZONE, delay: str = DELAY
) -> DataFrame:
    """Closed slices of the sales amount per product, in append mode."""
    amounts = orders.select(
        "ts_ms", clean_id("product_id").alias("product_id"),
        F.col("total_amount").cast("decimal(18,2)").alias("total_amount"),
    )
    slices = slice_sums(timed(amounts, zone=zone, delay=delay), step, {GMV: F.col("total_amount")}, ["product_id"])
    return slices.withColumn(GMV, F.col(GMV).cast(MONEY))


def top_row_slices(
    orders: DataFrame, step: int = STEP, n: int = 5, rank_by: str = "sale_num", zone: str = ORDER_ZONE,
    delay: str = DELAY,
) -> DataFrame:
    """The n best order rows of each closed slice and share of it, in append mode.

    The rows of an open slice are spread over SHARES lists of state by hash, and only
    the best of a list are given out. The order is that of the batch form: rank
    downwards with NULL last, then id, time and amount upwards with NULL first.
    """
    rows = timed(orders.where(filled("total_amount")), zone=zone, delay=delay)
    rows = rankable_rows(rows.withColumn("_at", wall_micros("ts_ms", zone)), rank_by, LOCAL)
    place = F.struct(F.col("_rank_by").isNull(), -F.col("_rank_by").cast("bigint"), "id", "_at", "_amount", "_rank_by")
    best = F.slice(F.array_sort(F.collect_list(place)), 1, n).alias("_best")
    share = F.pmod(F.xxhash64("id", "_at"), F.lit(SHARES)).alias("_share")
    closed = with_bounds(rows.groupBy(window_of(step), share).agg(best))
    return closed.select(F.col("window_start").alias("_slice"), F.inline("_best")).select(
        "_slice", "id", "_at", "_amount", "_rank_by"
    )


# The stored form of these streams are the closed slices (``sinks.start_to_folder``): one row per
# key and step. A cumulative window is read from the slices of its span; nothing but the
# open slices is state, and no window is stored twice. ``until`` (streaming.windows.closed_until)
# tells how far the watermark had come; without it windows end with the last closed slice.


def cumulative_sales(slices: DataFrame, step: int = STEP, span: int = DAY, until: int | None = None) -> DataFrame:
    """Sales amount per cumulative window from stored ``sales_slices``."""
    return sales_of_slices(slices, step, span, last_end(slices, step, until))


def cumulative_top_products(
    slices: DataFrame, step: int = STEP, span: int = DAY, n: int = 5, with_total: bool = False,
    until: int | None = None,
) -> DataFrame:
    """Best-selling products per cumulative window in the report form from stored ``product_slices``."""
    return report_of_slices(slices, step, span, n, with_total, last_end(slices, step, until))


def cumulative_top_rows(
    slices: DataFrame, step: int = STEP, span: int = DAY, n: int = 5, until: int | None = None
) -> DataFrame:
    """The n best order rows per cumulative window from stored ``top_row_slices``."""
    return top_rows_of_slices(slices, step, span, n, last_end(slices, step, until))


def start_tumbling_top_ids(
    orders: DataFrame, folder: str, checkpoint: str, step: int = STEP, n: int = 5,
    zone: str = ORDER_ZONE, delay: str = DELAY, every: str | None = None,
) -> StreamingQuery:
    """Ids with the highest summed ``sale_num`` per window; all ids of a window close in one batch."""
    rows = timed(orders.where(filled("sale_num") & filled("id")), zone=zone, delay=delay)
    sums = window_sums(rows, step, {"_total": lenient_number("sale_num", "int")}, ["id"])

    def rank(closed: DataFrame) -> DataFrame:
        ranked = top_n(closed, BOUNDS, [F.desc("_total"), F.asc("id")], n)
        return show_bounds(ranked.groupBy(*BOUNDS).agg(ranked_slots("id", "rn", n).alias("top5_ids")))

    return start_to_folder(sums, folder, checkpoint, every=every, batch=rank)
