"""Merchandising metric layer: detail cleaning, product summaries and reports.

Detail rows (visits, favourites, cart adds, orders) are reduced to one row per
product, day and user before anything is counted. Distinct users then need no
distinct aggregate, and a busy product is spread over its users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.text import ratio
from tallyline.functions.times import naive_micros
from tallyline.operators.ranking import spread_ranks, top_n

PRODUCT = ["shop_id", "product_id"]
PRODUCT_DAY = [*PRODUCT, "ds"]

# The columns of the detail tables and their types.
DETAILS = {
    "visits": {
        "user_id": "string", "product_id": "string", "shop_id": "string", "visit_time": "timestamp_ntz",
        "visit_reason": "string", "visit_count": "bigint", "stay_time": "bigint",
        "has_click": "boolean", "terminal_type": "string",
    },
    "favourites": {
        "user_id": "string", "product_id": "string", "shop_id": "string",
        "favorite_time": "timestamp_ntz", "is_cancel": "boolean", "terminal_type": "string",
    },
    "carts": {
        "user_id": "string", "product_id": "string", "shop_id": "string", "cart_time": "timestamp_ntz",
        "terminal_type": "string",
    },
    "orders": {
        "order_detail_id": "string", "order_id": "string", "product_id": "string", "quantity": "bigint",
        "price": "decimal(18,2)", "order_time": "timestamp_ntz", "user_id": "string",
        "shop_id": "string", "terminal_type": "string",
    },
}
TIMES = {"visits": "visit_time", "favourites": "favorite_time", "carts": "cart_time", "orders": "order_time"}

FLAGS = ["visited", "clicked", "favourited", "carted", "paid"]
SUMS = ["pv", "order_count", "pay_amount", "pay_quantity"]
NEW = "pay_new_buyer_count"


def clean_details(raw: DataFrame, kind: str, key: list[str] | None = None) -> DataFrame:
    """Typed rows of one detail table with day key ``ds``; repeated rows are kept once.

    Rows repeat each other if they are equal in all columns or, with a ``key``, in that;
    the largest of them stays. An empty ``key`` keeps all rows. Text is trimmed, values of a wrong type become NULL, and rows without user,
    product, shop or time are dropped.
    """
    typed = raw.select(
        *[
            (F.trim(name) if t == "string" else F.col(name).try_cast(t)).alias(name)
            for name, t in DETAILS[kind].items()
        ]
    )
    for needed in ("user_id", "product_id", "shop_id", TIMES[kind]):
        typed = typed.where(F.col(needed).isNotNull())
    if key is None:
        typed = typed.dropDuplicates()
    elif key:
        rest = [c for c in typed.columns if c not in key]
        largest = typed.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_rest"))
        typed = largest.select(*[F.col(c if c in key else f"_rest.{c}") for c in typed.columns])
    return typed.withColumn("ds", F.col(TIMES[kind]).cast("date").cast("string"))


def _tagged(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    zero = {**{f: F.lit(False) for f in FLAGS}, **{s: F.lit(0).cast("bigint") for s in SUMS}}
    zero["pay_amount"] = F.lit(0).cast("decimal(28,2)")
    return df.select(*keys, "user_id", *[values.get(c, zero[c]).alias(c) for c in FLAGS + SUMS])


def order_totals(orders: DataFrame, keys: list[str]) -> DataFrame:
    """Amount and quantity per key, user and order, so that later counts are plain sums."""
    return orders.groupBy(*keys, "user_id", "order_id").agg(
        F.sum(F.col("quantity") * F.col("price")).cast("decimal(28,2)").alias("pay_amount"),
        F.sum("quantity").alias("pay_quantity"),
    )


def user_activity(
    visits: DataFrame, favourites: DataFrame, carts: DataFrame, orders: DataFrame, keys: list[str] | None = None
) -> DataFrame:
    """One row per key and user with flags and sums over all four details."""
    keys = keys or PRODUCT_DAY
    yes = F.lit(True)
    rows = _tagged(visits, keys, {"visited": yes, "clicked": F.col("has_click"), "pv": F.col("visit_count")})
    rows = rows.unionByName(
        _tagged(favourites.where(~F.coalesce("is_cancel", F.lit(False))), keys, {"favourited": yes})
    )
    rows = rows.unionByName(_tagged(carts, keys, {"carted": yes}))
    paid = {
        "paid": yes, "order_count": F.lit(1).cast("bigint"),
        "pay_amount": F.col("pay_amount"), "pay_quantity": F.col("pay_quantity"),
    }
    rows = rows.unionByName(_tagged(order_totals(orders, keys), keys, paid))
    return rows.groupBy(*keys, "user_id").agg(
        *[F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in FLAGS], *[F.sum(s).alias(s) for s in SUMS]
    )


def summarise(activity: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Visitors, views, bounce rate, favourites, carts, buyers, orders, amount and quantity.

    Bounce rate: visitors without any click among all visitors.
    """
    keys = keys or PRODUCT_DAY
    counts = activity.groupBy(*keys).agg(
        F.count_if("visited").alias("visitor_count"),
        F.sum("pv").alias("pv"),
        F.count_if(F.col("visited") & ~F.col("clicked")).alias("_bounced"),
        F.count_if("favourited").alias("favorite_count"),
        F.count_if("carted").alias("cart_count"),
        F.count_if("paid").alias("buyer_count"),
        F.sum("order_count").alias("order_count"),
        F.sum("pay_amount").cast("decimal(38,2)").alias("pay_amount"),
        F.sum("pay_quantity").alias("pay_quantity"),
    )
    return counts.withColumn("bounce_rate", ratio(F.col("_bounced"), F.col("visitor_count"))).drop("_bounced")


def new_and_returning(orders: DataFrame, per: list[str] | None = None) -> DataFrame:
    """Paying buyers per day: first purchase within ``per`` on that day, or earlier."""
    per = per or PRODUCT
    days = orders.select(*per, "user_id", "ds").distinct()
    first = F.min("ds").over(Window.partitionBy(*per, "user_id"))
    return days.withColumn("_new", first == F.col("ds")).groupBy(*per, "ds").agg(
        F.count_if("_new").alias("pay_new_buyer_count"), F.count_if(~F.col("_new")).alias("pay_old_buyer_count")
    )


def with_rates(summary: DataFrame) -> DataFrame:
    """Conversion rates on visitors and spend per buyer; NULL where the base is zero."""
    visitors = F.col("visitor_count")
    rates = {
        "visit_to_favorite_rate": "favorite_count", "visit_to_cart_rate": "cart_count",
        "visit_to_order_rate": "order_count", "pay_conversion_rate": "buyer_count",
    }
    return summary.withColumns(
        {
            **{name: ratio(F.col(part), visitors) for name, part in rates.items()},
            "unit_price": ratio(F.col("pay_amount"), F.col("buyer_count")),
        }
    )


def product_result(activity: DataFrame, orders: DataFrame) -> DataFrame:
    """Product summary with new and returning buyers and all rates."""
    buyers = new_and_returning(orders)
    joined = summarise(activity).join(buyers, PRODUCT_DAY, "left")
    filled = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("pay_new_buyer_count", "pay_old_buyer_count")}
    return with_rates(joined.withColumns(filled))


def trailing_summary(activity: DataFrame, days: int) -> DataFrame:
    """Summary per product over the last ``days`` days, for each day with any activity.

    Users are counted once per period without repeating their rows for every report
    day: a user counts from an active day until the period has passed or the next
    active day begins, i.e. +1 and -1 on two days, summed up over time. A buyer is new
    in a period that holds the first purchase of the product, else returning.
    """
    flags = {
        "visited": "visitor_count", "clicked": "_clickers", "favourited": "favorite_count", "carted": "cart_count",
        "paid": "buyer_count",
    }
    day = F.unix_date(F.col("ds").cast("date"))
    rows = activity.select(*PRODUCT, "user_id", day.alias("_day"), *flags, *SUMS)
    first = F.min(F.when(F.col("paid"), F.col("_day"))).over(Window.partitionBy(*PRODUCT, "user_id"))
    rows = rows.withColumn(NEW, (F.col("paid") & (F.col("_day") == first)).cast("bigint"))
    sums = [*SUMS, NEW]
    later = Window.partitionBy(*PRODUCT, "user_id").orderBy(F.desc("_day")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ends = {
        f"_end_{f}": F.when(
            F.col(f),
            F.least(F.col("_day") + days, F.last(F.when(F.col(f), F.col("_day")), ignorenulls=True).over(later)),
        )
        for f in flags
    }
    changes = [
        F.struct(
            F.col("_day").alias("_day"), F.lit(1).cast("bigint").alias("_active"),
            *[F.col(f).cast("bigint").alias(f) for f in flags], *[F.col(s).alias(s) for s in sums],
        )
    ]
    for f in flags:
        nothing = [
            (F.lit(0).cast("decimal(28,2)") if s == "pay_amount" else F.lit(0).cast("bigint")).alias(s) for s in sums
        ]
        changes.append(
            F.struct(
                F.col(f"_end_{f}").alias("_day"), F.lit(0).cast("bigint").alias("_active"),
                *[F.lit(-1 if g == f else 0).cast("bigint").alias(g) for g in flags], *nothing,
            )
        )
    measures = [*flags, *sums]
    per_day = (
        rows.withColumns(ends)
        .select(*PRODUCT, F.inline(F.array(*[F.when(c["_day"].isNotNull(), c) for c in changes])))
        .where(F.col("_day").isNotNull())
        .groupBy(*PRODUCT, "_day")
        .agg(F.sum("_active").alias("_active"), *[F.sum(m).alias(m) for m in measures])
    )
    by_day = Window.partitionBy(*PRODUCT).orderBy("_day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    period = by_day.rangeBetween(-(days - 1), Window.currentRow)
    counted = per_day.withColumns(
        {
            **{flags[f]: F.sum(f).over(so_far) for f in flags},
            **{f"_{s}": F.sum(s).over(period) for s in sums},
        }
    ).where(F.col("_active") > 0)
    amount = F.col("_pay_amount").cast("decimal(38,2)")
    periods = counted.select(
        *PRODUCT, F.date_from_unix_date("_day").cast("string").alias("ds"), *flags.values(),
        *[(amount if s == "pay_amount" else F.col(f"_{s}")).alias(s) for s in sums],
    )
    bounced = F.col("visitor_count") - F.col("_clickers")
    return with_rates(
        periods.withColumns(
            {
                "bounce_rate": ratio(bounced, F.col("visitor_count")),
                "pay_old_buyer_count": F.col("buyer_count") - F.col(NEW),
            }
        ).drop("_clickers")
    )


def band_label(value: Column, bounds: list) -> Column:
    """Half-open band that holds the value, e.g. ``[10,50)``; bounds rise."""
    label = F.when(value < bounds[0], f"<{bounds[0]}")
    for low, high in zip(bounds, bounds[1:]):
        label = label.when(value < high, f"[{low},{high})")
    return label.when(value >= bounds[-1], f">={bounds[-1]}")


def segment_analysis(sales: DataFrame, price: list, quantity: list, amount: list) -> DataFrame:
    """Products, amount, quantity and unit price per price, quantity and amount band.

    Input: ``shop_id``, ``product_id``, ``ds``, ``pay_quantity``, ``pay_amount``.
    """
    totals = sales.groupBy(*PRODUCT_DAY).agg(
        F.sum("pay_quantity").alias("pay_quantity"), F.sum("pay_amount").cast("decimal(38,2)").alias("pay_amount")
    )
    unit = ratio(F.col("pay_amount"), F.col("pay_quantity"))
    banded = totals.withColumns(
        {
            "price_band": band_label(unit, price),
            "order_band": band_label(F.col("pay_quantity"), quantity),
            "amount_band": band_label(F.col("pay_amount"), amount),
        }
    )
    result = banded.groupBy("shop_id", "ds", "price_band", "order_band", "amount_band").agg(
        F.count("*").alias("product_count"),
        F.sum("pay_amount").cast("decimal(38,2)").alias("total_pay_amount"),
        F.sum("pay_quantity").alias("total_pay_quantity"),
    )
    return result.withColumn("avg_unit_price", ratio(F.col("total_pay_amount"), F.col("total_pay_quantity")))


def product_ranking(summary: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Ranks of the products of a shop and day by amount, quantity, visitors and conversion.

    The products of a shop are ranked over all tasks, see ``ranking.spread_ranks``.
    """
    ranks = {
        "sales_amount_rank": "pay_amount", "sales_quantity_rank": "pay_quantity",
        "visitor_rank": "visitor_count", "conversion_rank": "pay_conversion_rate",
    }
    return spread_ranks(with_rates(summary), by or ["shop_id", "ds"], ranks)


def sku_sales(orders: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Quantity per SKU, its share of the product and its rank within the product."""
    keys = keys or PRODUCT
    totals = orders.groupBy(*keys, "sku_id").agg(F.sum("quantity").alias("pay_quantity"))
    product = Window.partitionBy(*keys)
    return totals.withColumns(
        {
            "quantity_ratio": ratio(F.col("pay_quantity"), F.sum("pay_quantity").over(product)),
            "sales_rank": F.rank().over(product.orderBy(F.desc("pay_quantity"))),
        }
    )


def stock_days(orders: DataFrame, stock: DataFrame, days: int, last: str) -> DataFrame:
    """Days that the stock lasts at the mean daily sales of the period; NULL without sales.

    The period are the ``days`` days up to ``last``. Input: ``orders`` with ``sku_id``,
    ``ds`` and ``quantity``, ``stock`` with ``sku_id`` and ``current_stock``.
    """
    day, end = F.col("ds").cast("date"), F.lit(last).cast("date")
    held = orders.where((day > F.date_sub(end, days)) & (day <= end))
    sales = held.groupBy("sku_id").agg(F.sum("quantity").alias("pay_quantity"))
    mean = ratio(F.coalesce("pay_quantity", F.lit(0)), F.lit(days))
    joined = stock.select("sku_id", "current_stock").join(sales, "sku_id", "left")
    return joined.withColumn("stock_sale_days", ratio(F.col("current_stock"), mean))


def traffic_sources(visits: DataFrame, orders: DataFrame, keys: list[str] | None = None, n: int = 10) -> DataFrame:
    """Visitors, paying buyers and conversion per visit reason, the n busiest per key.

    A visitor pays if they bought within the same key. Both sides are distinct per
    key and user before they are joined, so no pairs pile up.
    """
    keys = keys or PRODUCT_DAY
    visitors = visits.select(*keys, "visit_reason", "user_id").distinct()
    buyers = orders.select(*keys, "user_id").distinct().withColumn("_paid", F.lit(True))
    counts = visitors.join(buyers, [*keys, "user_id"], "left").groupBy(*keys, "visit_reason").agg(
        F.count("*").alias("visitor_count"), F.count("_paid").alias("pay_buyer_count")
    )
    order = [F.desc("visitor_count"), F.asc("visit_reason")]
    return top_n(counts, keys, order, n, "traffic_rank").withColumn(
        "pay_conversion_rate", ratio(F.col("pay_buyer_count"), F.col("visitor_count"))
    )


def order_touches(visits: DataFrame, orders: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """First and last visit reason at or before each order, per user and product.

    Visits and orders are put on one time line instead of being joined. The line of
    a user and product is cut into time slices: the touches before a slice are
    carried into it as one extra row, so even the busiest user is spread over slices.
    """
    line = ["user_id", "product_id"]

    def points(df: DataFrame, time: str, kind: int, channel: Column, detail: Column) -> DataFrame:
        return df.select(
            *line, naive_micros(time).alias("_at"), F.lit(kind).alias("_kind"), channel.alias("_first"),
            channel.alias("_last"), detail.alias("order_detail_id"),
        ).withColumn("_slice", F.floor(F.col("_at") / (slice_seconds * 1_000_000)))

    nothing = F.lit(None).cast("string")
    seen = points(visits, "visit_time", 0, F.col("visit_reason"), nothing)
    bought = points(orders, "order_time", 1, nothing, F.col("order_detail_id"))
    both = seen.unionByName(bought)
    touch = F.when(F.col("_kind") == 0, F.struct("_at", "_last"))
    slices = both.groupBy(*line, "_slice").agg(
        F.min(touch).alias("_min"), F.max(touch).alias("_max"), F.max("_kind").alias("_orders")
    )
    earlier = Window.partitionBy(*line).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumns(
        {
            "_first": F.first("_min", ignorenulls=True).over(earlier)["_last"],
            "_carry": F.last("_max", ignorenulls=True).over(earlier),
        }
    ).where((F.col("_orders") == 1) & F.col("_carry").isNotNull())
    carried = carried.select(
        *line, F.lit(None).cast("bigint").alias("_at"), F.lit(-1).alias("_kind"), "_first",
        F.col("_carry._last").alias("_last"), nothing.alias("order_detail_id"), "_slice",
    )
    so_far = (
        Window.partitionBy(*line, "_slice")
        .orderBy(F.asc_nulls_first("_at"), "_kind", "_last")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    touched = both.unionByName(carried).withColumns(
        {
            "first_touch": F.first("_first", ignorenulls=True).over(so_far),
            "last_touch": F.last("_last", ignorenulls=True).over(so_far),
        }
    )
    return touched.where(F.col("_kind") == 1).select("order_detail_id", *line, "first_touch", "last_touch")


def channel_attribution(touches: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders, amount and buyers per channel by first and by last touch.

    Each order counts for one channel only, so nobody is counted twice within a rule.
    Orders without an earlier visit have the channel NULL.
    """
    amounts = orders.select(
        "order_detail_id", (F.col("quantity") * F.col("price")).cast("decimal(28,2)").alias("amount")
    )
    rules = F.array(
        F.struct(F.lit("first").alias("rule"), F.col("first_touch").alias("channel")),
        F.struct(F.lit("last").alias("rule"), F.col("last_touch").alias("channel")),
    )
    rows = touches.join(amounts, "order_detail_id").select("user_id", "amount", F.inline(rules))
    per_user = rows.groupBy("rule", "channel", "user_id").agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount")
    )
    return per_user.groupBy("rule", "channel").agg(
        F.sum("n").alias("order_count"),
        F.sum("amount").cast("decimal(38,2)").alias("pay_amount"),
        F.count("*").alias("buyer_count"),
    )
