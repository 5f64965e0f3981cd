"""Merchandising layer over events and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import merch
from tallyline.plans.standins import DETAILS_SQL, details, table

PRICE_BANDS = [100, 1000, 2000]
QUANTITY_BANDS = [10, 25, 50]
AMOUNT_BANDS = [1000, 20000, 80000]
LAST_DAY = "2024-01-30"


def cleaned(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {kind: merch.clean_details(raw, kind) for kind, raw in details(spark, folder).items()}


def activity(spark: SparkSession, folder: str, keys: list[str] | None = None) -> DataFrame:
    return merch.user_activity(**cleaned(spark, folder), keys=keys)


def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order details after cleaning, from input in which every row comes twice."""
    raw = details(spark, folder)["orders"]
    return merch.clean_details(raw.unionByName(raw), "orders").withColumn(
        "order_time", F.date_trunc("second", "order_time").cast("timestamp_ntz").cast("string")
    )


def summary(spark: SparkSession, folder: str) -> DataFrame:
    return merch.summarise(activity(spark, folder))


def terminal_summary(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["shop_id", "terminal_type", "ds"]
    return merch.summarise(activity(spark, folder, keys), keys)


def result(spark: SparkSession, folder: str) -> DataFrame:
    clean = cleaned(spark, folder)
    return merch.product_result(merch.user_activity(**clean), clean["orders"])


def trailing(days: int):
    return lambda spark, folder: merch.trailing_summary(activity(spark, folder), days)


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the order date; a shop stands for ten suppliers."""
    items, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    sales = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_suppkey") % 10).cast("string").alias("shop_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("ds"),
        F.col("l_quantity").cast("bigint").alias("pay_quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("pay_amount"),
    )
    return merch.segment_analysis(sales, PRICE_BANDS, QUANTITY_BANDS, AMOUNT_BANDS)


def ranking(spark: SparkSession, folder: str) -> DataFrame:
    ranked = merch.product_ranking(summary(spark, folder))
    return ranked.select(
        *merch.PRODUCT_DAY, "sales_amount_rank", "sales_quantity_rank", "visitor_rank", "conversion_rank"
    )


def _sku_orders(spark: SparkSession, folder: str) -> DataFrame:
    sku = F.concat("product_id", F.lit("-"), F.col("order_detail_id").cast("bigint") % 3)
    return cleaned(spark, folder)["orders"].withColumn("sku_id", sku)


def skus(spark: SparkSession, folder: str) -> DataFrame:
    return merch.sku_sales(_sku_orders(spark, folder))


def stock(days: int):
    """Stock from the parts, one row per part and third SKU, at the sales up to the last day of the events."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        part = table(spark, folder, "part")
        rows = part.select(
            F.concat(F.col("p_partkey"), F.lit("-"), F.col("p_partkey") % 3).alias("sku_id"),
            (F.col("p_size") * 10).alias("current_stock"),
        )
        return merch.stock_days(_sku_orders(spark, folder), rows, days, LAST_DAY)

    return query


def traffic(spark: SparkSession, folder: str) -> DataFrame:
    clean = cleaned(spark, folder)
    return merch.traffic_sources(clean["visits"], clean["orders"], ["shop_id", "ds"])


def touches(spark: SparkSession, folder: str) -> DataFrame:
    clean = cleaned(spark, folder)
    return merch.order_touches(clean["visits"], clean["orders"])


def attribution(spark: SparkSession, folder: str) -> DataFrame:
    clean = cleaned(spark, folder)
    return merch.channel_attribution(merch.order_touches(clean["visits"], clean["orders"]), clean["orders"])


QUERIES = {
    "clean_order_details": clean_orders,
    "product_summary": summary,
    "terminal_summary": terminal_summary,
    "new_and_returning_buyers": lambda spark, folder: merch.new_and_returning(cleaned(spark, folder)["orders"]),
    "product_result": result,
    "trailing_summary_1d": trailing(1),
    "trailing_summary_7d": trailing(7),
    "trailing_summary_30d": trailing(30),
    "segment_analysis": segments,
    "product_ranking": ranking,
    "sku_sales": skus,
    "stock_days": stock(30),
    "stock_days_7d": stock(7),
    "traffic_sources": traffic,
    "order_touches": touches,
    "channel_attribution": attribution,
}

_D = f"WITH {DETAILS_SQL}"


def _summary_sql(keys: str) -> str:
    return f"""
    vs AS (SELECT {keys}, count(DISTINCT user_id) AS visitor_count, sum(visit_count) AS pv FROM v GROUP BY ALL),
    cl AS (SELECT {keys}, count(DISTINCT user_id) AS clickers FROM v WHERE has_click GROUP BY ALL),
    fs AS (SELECT {keys}, count(DISTINCT user_id) AS favorite_count FROM f WHERE NOT is_cancel GROUP BY ALL),
    ks AS (SELECT {keys}, count(DISTINCT user_id) AS cart_count FROM k GROUP BY ALL),
    bs AS (SELECT {keys}, count(DISTINCT user_id) AS buyer_count, count(DISTINCT (user_id, order_id)) AS order_count,
                  sum(quantity * price) AS pay_amount, sum(quantity) AS pay_quantity FROM b GROUP BY ALL),
    ps AS (SELECT {keys}, coalesce(visitor_count, 0) AS visitor_count, coalesce(pv, 0) AS pv,
                  coalesce(favorite_count, 0) AS favorite_count, coalesce(cart_count, 0) AS cart_count,
                  coalesce(buyer_count, 0) AS buyer_count, coalesce(order_count, 0) AS order_count,
                  coalesce(pay_amount, 0) AS pay_amount, coalesce(pay_quantity, 0) AS pay_quantity,
                  CAST(visitor_count - coalesce(clickers, 0) AS DOUBLE) / visitor_count AS bounce_rate
           FROM vs LEFT JOIN cl USING ({keys}) FULL JOIN fs USING ({keys}) FULL JOIN ks USING ({keys})
                FULL JOIN bs USING ({keys}))"""


_PRODUCT = _summary_sql("shop_id, product_id, ds")
_NEW = """
    nb AS (SELECT DISTINCT shop_id, product_id, user_id, ds FROM b),
    nf AS (SELECT *, min(ds) OVER (PARTITION BY shop_id, product_id, user_id) AS first_ds FROM nb),
    nr AS (SELECT shop_id, product_id, ds, count(*) FILTER (WHERE ds = first_ds) AS pay_new_buyer_count,
                  count(*) FILTER (WHERE ds > first_ds) AS pay_old_buyer_count FROM nf GROUP BY ALL)"""
_SKU = """
    sk AS (SELECT shop_id, product_id, sku_id, sum(quantity) AS pay_quantity FROM b GROUP BY ALL)"""
_TOUCH = """
    ft AS (SELECT b.order_detail_id, b.product_id, b.user_id, arg_min(visit_reason, row(v.ts, visit_reason)) AS first_touch,
                  arg_max(visit_reason, row(v.ts, visit_reason)) AS last_touch, any_value(quantity * price) AS amount
           FROM b LEFT JOIN v ON b.user_id = v.user_id AND b.product_id = v.product_id AND v.ts <= b.ts GROUP BY ALL)"""


def _trailing_sql(days: int) -> str:
    def users(name: str, source: str, where: str = "TRUE") -> str:
        return f"""(SELECT count(DISTINCT user_id) FROM {source} x WHERE x.shop_id = d.shop_id
            AND x.product_id = d.product_id AND {where} AND CAST(x.ds AS DATE)
            BETWEEN CAST(d.ds AS DATE) - {days - 1} AND CAST(d.ds AS DATE)) AS {name}"""

    window = f"""OVER (PARTITION BY shop_id, product_id ORDER BY CAST(ds AS DATE)
        RANGE BETWEEN INTERVAL {days - 1} DAY PRECEDING AND CURRENT ROW)"""
    return f"""{_D}, {_PRODUCT},
        fb AS (SELECT shop_id, product_id, user_id, min(CAST(ds AS DATE)) AS first_day FROM b GROUP BY ALL),
        d AS (SELECT shop_id, product_id, ds, sum(pv) {window} AS pv, sum(order_count) {window} AS order_count,
                     sum(pay_amount) {window} AS pay_amount, sum(pay_quantity) {window} AS pay_quantity FROM ps),
        c AS (SELECT d.*, {users('visitor_count', 'v')}, {users('clickers', 'v', 'has_click')},
               {users('favorite_count', 'f', 'NOT is_cancel')}, {users('cart_count', 'k')}, {users('buyer_count', 'b')},
               (SELECT count(*) FROM fb x WHERE x.shop_id = d.shop_id AND x.product_id = d.product_id AND first_day
                BETWEEN CAST(d.ds AS DATE) - {days - 1} AND CAST(d.ds AS DATE)) AS pay_new_buyer_count FROM d)
        SELECT * EXCLUDE (clickers), buyer_count - pay_new_buyer_count AS pay_old_buyer_count,
               CAST(visitor_count - clickers AS DOUBLE) / nullif(visitor_count, 0) AS bounce_rate,
               CAST(favorite_count AS DOUBLE) / nullif(visitor_count, 0) AS visit_to_favorite_rate,
               CAST(cart_count AS DOUBLE) / nullif(visitor_count, 0) AS visit_to_cart_rate,
               CAST(order_count AS DOUBLE) / nullif(visitor_count, 0) AS visit_to_order_rate,
               CAST(buyer_count AS DOUBLE) / nullif(visitor_count, 0) AS pay_conversion_rate,
               CAST(pay_amount AS DOUBLE) / nullif(buyer_count, 0) AS unit_price FROM c"""


def _stock_sql(days: int) -> str:
    return f"""{_D},
        sk AS (SELECT sku_id, sum(quantity) AS pay_quantity FROM b WHERE CAST(ds AS DATE)
               BETWEEN DATE '{LAST_DAY}' - {days - 1} AND DATE '{LAST_DAY}' GROUP BY 1),
        st AS (SELECT p_partkey || '-' || (p_partkey % 3) AS sku_id, p_size * 10 AS current_stock FROM part)
        SELECT sku_id, current_stock, pay_quantity,
               CAST(current_stock AS DOUBLE) / nullif(CAST(coalesce(pay_quantity, 0) AS DOUBLE) / {days}, 0)
                 AS stock_sale_days FROM st LEFT JOIN sk USING (sku_id)"""


def _band_sql(value: str, bounds: list) -> str:
    cases = [f"WHEN {value} < {bounds[0]} THEN '<{bounds[0]}'"]
    cases += [f"WHEN {value} < {b} THEN '[{a},{b})'" for a, b in zip(bounds, bounds[1:])]
    return f"CASE {' '.join(cases)} ELSE '>={bounds[-1]}' END"


SQL = {
    "clean_order_details": f"""{_D}
        SELECT order_detail_id, CAST(order_id AS VARCHAR) AS order_id, product_id, quantity, price,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS order_time, user_id, shop_id, terminal_type, ds FROM b""",
    "product_summary": f"{_D}, {_PRODUCT} SELECT * FROM ps",
    "terminal_summary": f"{_D}, {_summary_sql('shop_id, terminal_type, ds')} SELECT * FROM ps",
    "new_and_returning_buyers": f"{_D}, {_NEW} SELECT * FROM nr",
    "product_result": f"""{_D}, {_PRODUCT}, {_NEW}
        SELECT ps.*, coalesce(pay_new_buyer_count, 0) AS pay_new_buyer_count,
               coalesce(pay_old_buyer_count, 0) AS pay_old_buyer_count,
               CAST(favorite_count AS DOUBLE) / nullif(visitor_count, 0) AS visit_to_favorite_rate,
               CAST(cart_count AS DOUBLE) / nullif(visitor_count, 0) AS visit_to_cart_rate,
               CAST(order_count AS DOUBLE) / nullif(visitor_count, 0) AS visit_to_order_rate,
               CAST(buyer_count AS DOUBLE) / nullif(visitor_count, 0) AS pay_conversion_rate,
               CAST(pay_amount AS DOUBLE) / nullif(buyer_count, 0) AS unit_price
        FROM ps LEFT JOIN nr USING (shop_id, product_id, ds)""",
    "trailing_summary_1d": _trailing_sql(1),
    "trailing_summary_7d": _trailing_sql(7),
    "trailing_summary_30d": _trailing_sql(30),
    "segment_analysis": f"""
        WITH x AS (SELECT CAST(l_suppkey % 10 AS VARCHAR) AS shop_id, l_partkey, strftime(o_orderdate, '%Y-%m') AS ds,
                          sum(CAST(l_quantity AS BIGINT)) AS q, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS a
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)
        SELECT shop_id, ds, {_band_sql('CAST(a AS DOUBLE) / q', PRICE_BANDS)} AS price_band,
               {_band_sql('q', QUANTITY_BANDS)} AS order_band, {_band_sql('a', AMOUNT_BANDS)} AS amount_band,
               count(*) AS product_count, sum(a) AS total_pay_amount, sum(q) AS total_pay_quantity,
               CAST(sum(a) AS DOUBLE) / CAST(sum(q) AS DOUBLE) AS avg_unit_price
        FROM x GROUP BY 1, 2, 3, 4, 5""",
    "product_ranking": f"""{_D}, {_PRODUCT},
        r AS (SELECT *, CAST(buyer_count AS DOUBLE) / nullif(visitor_count, 0) AS rate FROM ps)
        SELECT shop_id, product_id, ds,
               rank() OVER (PARTITION BY shop_id, ds ORDER BY pay_amount DESC) AS sales_amount_rank,
               rank() OVER (PARTITION BY shop_id, ds ORDER BY pay_quantity DESC) AS sales_quantity_rank,
               rank() OVER (PARTITION BY shop_id, ds ORDER BY visitor_count DESC) AS visitor_rank,
               rank() OVER (PARTITION BY shop_id, ds ORDER BY rate DESC NULLS LAST) AS conversion_rank FROM r""",
    "sku_sales": f"""{_D}, {_SKU}
        SELECT *, CAST(pay_quantity AS DOUBLE) / CAST(sum(pay_quantity) OVER (PARTITION BY shop_id, product_id) AS DOUBLE)
                    AS quantity_ratio,
               rank() OVER (PARTITION BY shop_id, product_id ORDER BY pay_quantity DESC) AS sales_rank FROM sk""",
    "stock_days": _stock_sql(30),
    "stock_days_7d": _stock_sql(7),
    "traffic_sources": f"""{_D},
        x AS (SELECT DISTINCT shop_id, ds, visit_reason, user_id FROM v),
        y AS (SELECT DISTINCT shop_id, ds, user_id, 1 AS paid FROM b),
        n AS (SELECT shop_id, ds, visit_reason, count(*) AS visitor_count, count(paid) AS pay_buyer_count
              FROM x LEFT JOIN y USING (shop_id, ds, user_id) GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY shop_id, ds ORDER BY visitor_count DESC, visit_reason)
                          AS traffic_rank FROM n)
        SELECT *, CAST(pay_buyer_count AS DOUBLE) / visitor_count AS pay_conversion_rate FROM r WHERE traffic_rank <= 10""",
    "order_touches": f"""{_D}, {_TOUCH}
        SELECT order_detail_id, user_id, product_id, first_touch, last_touch FROM ft""",
    "channel_attribution": f"""{_D}, {_TOUCH},
        x AS (SELECT 'first' AS rule, first_touch AS channel, user_id, amount FROM ft
              UNION ALL SELECT 'last', last_touch, user_id, amount FROM ft)
        SELECT rule, channel, count(*) AS order_count, sum(amount) AS pay_amount,
               count(DISTINCT user_id) AS buyer_count FROM x GROUP BY 1, 2""",
}
