"""Order metrics per tumbling, hopping and cumulative window.

Input rows have the columns of ``schema.ORDER`` plus the event time ``ts_ms``
(see ``sources.topics.orders_from_json``). Steps and spans are microseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.text import clean_id, filled, lenient_number
from tallyline.functions.times import (
    DAY, MINUTE, ORDER_ZONE, SECOND, floor_to, on_dates, wall_date, wall_micros,
)
from tallyline.operators.ranking import ranked_slots, text_list, top_n
from tallyline.operators.skew import number_rows
from tallyline.operators.windows import (
    BOUNDS, cumulate, cumulative_sums, hop_sums, show_bounds, slice_sums, spread_over_windows, tumble,
)

STEP = 10 * MINUTE
MONEY = "decimal(38,2)"
SALES, GMV = "total_cumulative_amount", "product_gmv"


def _amount() -> Column:
    return lenient_number("total_amount", "decimal(10,2)")


def _rows(df: DataFrame, dates, zone: str, *conditions: Column) -> DataFrame:
    """Rows of the wanted local dates (all if None) with their local time ``_at``."""
    if dates is not None:
        df = df.where(on_dates("ts_ms", dates, zone))
    for c in conditions:
        df = df.where(c)
    return df.where(F.col("ts_ms").isNotNull()).withColumn("_at", wall_micros("ts_ms", zone))


def window_sales(
    df: DataFrame, size: int = STEP, slide: int | None = None, dates=None, zone: str = ORDER_ZONE
) -> DataFrame:
    """Sales amount per hopping window (tumbling if no slide is given)."""
    rows = _rows(df, dates, zone)
    sums = hop_sums(rows, "_at", size, slide or size, [], {"total_sum": _amount()})
    return show_bounds(sums.withColumn("total_sum", F.col("total_sum").cast(MONEY)))


def cumulative_sales(
    df: DataFrame, step: int = STEP, span: int = DAY, dates=None, zone: str = ORDER_ZONE
) -> DataFrame:
    """Sales amount from the start of the span up to each step."""
    rows = _rows(df, dates, zone, filled("total_amount"))
    return sales_of_slices(slice_sums(rows, "_at", step, [], {SALES: _amount()}), step, span)


def sales_of_slices(slices: DataFrame, step: int, span: int, last_end: Column | int | None = None) -> DataFrame:
    """Cumulative sales from the sums of slices; with ``last_end`` no window ends later."""
    sums = spread_over_windows(slices, "_slice", step, span, [], [SALES], last_end)
    return show_bounds(sums.withColumn(SALES, F.col(SALES).cast(MONEY)))


def cumulative_top_rows(
    df: DataFrame, step: int = STEP, span: int = DAY, dates=None, n: int = 5,
    rank_by: str = "sale_num", zone: str = ORDER_ZONE,
) -> DataFrame:
    """The n order rows with the highest ``rank_by`` per cumulative window.

    ``total_cumulative_amount`` is the amount of these rows only. Rows are cut to
    the best n of each slice before they are repeated for the windows.
    """
    rows = rankable_rows(_rows(df, dates, zone, filled("total_amount")), rank_by).withColumn(
        "_slice", floor_to(F.col("_at"), step)
    )
    return top_rows_of_slices(top_n(rows, ["_slice"], _row_order(), n).drop("rn"), step, span, n)


def _row_order() -> list[Column]:
    return [F.desc("_rank_by"), F.asc("id"), F.asc("_at"), F.asc("_amount")]


def rankable_rows(rows: DataFrame, rank_by: str, *more: str) -> DataFrame:
    return rows.select(
        "id", "_at", _amount().alias("_amount"), lenient_number(rank_by, "int").alias("_rank_by"), *more
    )


def top_rows_of_slices(
    best: DataFrame, step: int, span: int, n: int, last_end: Column | int | None = None
) -> DataFrame:
    """Best rows of the cumulative windows from the n best rows of their slices (or of parts of them)."""
    ranked = top_n(cumulate(best, "_slice", step, span, last_end), BOUNDS, _row_order(), n)
    return show_bounds(
        ranked.groupBy(*BOUNDS).agg(
            F.sum("_amount").cast(MONEY).alias("total_cumulative_amount"),
            F.concat(F.lit("["), text_list("id", "rn"), F.lit("]")).alias("top5_ids"),
        )
    )


def tumbling_top_ids(
    df: DataFrame, step: int = STEP, dates=None, n: int = 5, key: str = "id",
    measure: str = "sale_num", zone: str = ORDER_ZONE,
) -> DataFrame:
    """Ids with the highest summed measure per tumbling window, one slot per rank."""
    rows = _rows(df, dates, zone, filled(measure), filled(key))
    sums = tumble(rows, "_at", step).groupBy(*BOUNDS, F.col(key).alias("id")).agg(
        F.sum(lenient_number(measure, "int")).alias("_total")
    )
    ranked = top_n(sums, BOUNDS, [F.desc("_total"), F.asc("id")], n)
    return show_bounds(ranked.groupBy(*BOUNDS).agg(ranked_slots("id", "rn", n).alias("top5_ids")))


def cumulative_trace(
    df: DataFrame, step: int = STEP, span: int = DAY, dates=None, zone: str = ORDER_ZONE,
    part_rows: int = 10_000,
) -> DataFrame:
    """Cumulative amount with the text ``id(amount)+id(amount)+...`` of all its orders.

    The orders of a span are numbered by time, then id; the text of a window is cut
    after every ``part_rows`` orders into rows numbered by ``part``, so no task ever
    holds a whole window. ``trace_orders`` gives the same content without any text.
    """
    numbered = _numbered(_trace_rows(df, dates, zone), step, span)
    entry = F.concat(F.col("id"), F.lit("("), F.col("_amount").cast("string"), F.lit(")"))
    texts = numbered.groupBy("_slice", F.floor(F.col("_pos") / part_rows).alias("part")).agg(
        text_list(entry, F.struct("_pos"), "+").alias("_text")
    )
    joined = (
        cumulate(texts, "_slice", step, span)
        .groupBy(*BOUNDS, "part")
        .agg(text_list(F.nullif("_text", F.lit("")), F.struct("_slice"), "+").alias("cumulative_process"))
    )
    sums = slice_sums(_trace_rows(df, dates, zone), "_at", step, [], {"period_amount": F.col("_amount")})
    amounts = spread_over_windows(sums, "_slice", step, span, [], ["period_amount"])
    return show_bounds(
        joined.join(amounts, BOUNDS).select(
            *BOUNDS, "part", F.col("period_amount").cast(MONEY).alias("period_amount"),
            "cumulative_process",
        )
    )


def _trace_rows(df: DataFrame, dates, zone: str) -> DataFrame:
    return _rows(df, dates, zone, filled("total_amount")).select("id", "_at", _amount().alias("_amount"))


def _numbered(rows: DataFrame, step: int, span: int) -> DataFrame:
    """Orders with their slice and their position in the span, counted by seconds first."""
    spans = rows.withColumn("_span", floor_to(F.col("_at"), span))
    return number_rows(spans, ["_span"], "_at", ["id", "_amount"], SECOND, "_pos").withColumn(
        "_slice", floor_to(F.col("_at"), step)
    )


def trace_orders(
    df: DataFrame, step: int = STEP, span: int = DAY, dates=None, zone: str = ORDER_ZONE
) -> DataFrame:
    """The trace as one row per order: first window that holds it, position and amount up to it.

    The trace of a window are the rows of its start up to its end by ``position``
    (from 0), so an order is stored once and not once per window.
    """
    rows = _numbered(_trace_rows(df, dates, zone), step, span)
    second = F.floor(F.col("_at") / SECOND)
    cut = ["_span", "_second"]
    earlier = Window.partitionBy("_span").orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*cut).orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timed = rows.withColumn("_second", second)
    before = timed.groupBy(*cut).agg(F.sum("_amount").alias("_sum")).select(
        *cut, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    running = F.col("_before") + F.coalesce(F.sum("_amount").over(inside), F.lit(0))
    return show_bounds(
        timed.join(before, cut).select(
            F.col("_span").alias("window_start"), (F.col("_slice") + step).alias("window_end"),
            F.col("_pos").alias("position"), "id", F.col("_amount").alias("amount"),
            running.cast(MONEY).alias("running_amount"),
        )
    )


def product_amounts(df: DataFrame, dates=None, zone: str = ORDER_ZONE) -> DataFrame:
    """Clean product id, strict amount and local time of the order rows."""
    return _rows(df, dates, zone).select(
        clean_id("product_id").alias("product_id"),
        F.col("total_amount").cast("decimal(18,2)").alias("total_amount"),
        "_at",
    )


def product_window_gmv(
    df: DataFrame, step: int = STEP, span: int = DAY, dates=None, zone: str = ORDER_ZONE
) -> DataFrame:
    """Sales amount per product and cumulative window."""
    rows = product_amounts(df, dates, zone)
    sums = cumulative_sums(rows, "_at", step, span, ["product_id"], {GMV: F.col("total_amount")})
    return show_bounds(sums.withColumn(GMV, F.col(GMV).cast(MONEY)))


def cumulative_product_gmv(
    df: DataFrame, step: int = STEP, span: int = DAY, dates=None, n: int = 5,
    zone: str = ORDER_ZONE, with_total: bool = False,
) -> DataFrame:
    """The n best-selling products per cumulative window, in the stored report form.

    ``win_gmv`` is the amount of these products only; ``with_total`` adds the amount
    of the whole window.
    """
    rows = product_amounts(df, dates, zone)
    slices = slice_sums(rows, "_at", step, ["product_id"], {GMV: F.col("total_amount")})
    return report_of_slices(slices, step, span, n, with_total)


def report_of_slices(
    slices: DataFrame, step: int, span: int, n: int = 5, with_total: bool = False,
    last_end: Column | int | None = None,
) -> DataFrame:
    """The report form from the sums of products per slice; with ``last_end`` no window ends later."""
    result = top_products(spread_over_windows(slices, "_slice", step, span, ["product_id"], [GMV], last_end), n)
    if with_total:
        whole = slices.groupBy("_slice").agg(F.sum(GMV).alias("total_gmv"))
        total = spread_over_windows(whole, "_slice", step, span, [], ["total_gmv"], last_end)
        result = result.join(total, BOUNDS).withColumn("total_gmv", F.col("total_gmv").cast("decimal(18,2)"))
    return show_bounds(result.withColumn("ds", wall_date("window_start")), as_text=True).select(
        "ds", *BOUNDS, "win_gmv", *(["total_gmv"] if with_total else []), "win_gmv_ids", "top5_product_ids"
    )


def top_products(sums: DataFrame, n: int = 5) -> DataFrame:
    """Best products of each window with their common amount and their ids by rank."""
    ranked = top_n(sums, BOUNDS, [F.desc(GMV), F.asc("product_id")], n)
    ids = text_list("product_id", "rn")
    return ranked.groupBy(*BOUNDS).agg(
        F.sum(GMV).cast("decimal(18,2)").alias("win_gmv"),
        ids.alias("win_gmv_ids"),
        ids.alias("top5_product_ids"),
    )
