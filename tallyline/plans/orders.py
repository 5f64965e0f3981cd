"""Order windows, top lists and the daily report over purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.times import MINUTE
from tallyline.operators import orders as op
from tallyline.operators import report
from tallyline.operators.windows import BOUNDS
from tallyline.plans.standins import (
    BOUNDS_SQL, CUMULATE_SQL, ORDERS_SQL, event_millis, orders, products, table,
)
from tallyline.schema import ORDER
from tallyline.sources.topics import orders_from_json, unreadable

DAYS = ["2024-01-03", "2024-01-04", "2024-01-05", "2024-01-07"]


def _text_bounds(df: DataFrame) -> DataFrame:
    return df.withColumns({b: F.col(b).cast("string") for b in BOUNDS})


def _over_orders(job, **kwargs):
    return lambda spark, folder: _text_bounds(job(orders(spark, folder), **kwargs))


def order_text(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases as JSON messages: seconds or milliseconds by turns, some cut off or with bad amounts."""
    n = F.col("event_id")
    bought = table(spark, folder, "events").where(F.col("event_type") == "purchase")
    text = F.to_json(
        F.struct(
            n.cast("string").alias("id"), F.get_json_object("props", "$.k").alias("product_id"),
            F.when(n % 30 == 1, F.lit("abc")).otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias(
                "total_amount"
            ),
            F.when(n % 2 == 0, event_millis()).otherwise(F.floor(event_millis() / 1000)).alias("ts"),
        )
    )
    return bought.select(F.when(n % 40 == 3, F.substring(text, 1, 25)).otherwise(text).alias("value"))


def parsed_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _text_bounds(op.window_sales(orders_from_json(order_text(spark, folder)), size=60 * MINUTE))


def unreadable_orders(spark: SparkSession, folder: str) -> DataFrame:
    return unreadable(order_text(spark, folder), ORDER)


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    result = op.cumulative_product_gmv(orders(spark, folder), with_total=True)
    return result.withColumn("ds", F.col("ds").cast("string"))


def top_products_of_days(spark: SparkSession, folder: str) -> DataFrame:
    result = op.cumulative_product_gmv(orders(spark, folder), dates=DAYS)
    return result.withColumn("ds", F.col("ds").cast("string"))


def daily_report(spark: SparkSession, folder: str) -> DataFrame:
    results = op.cumulative_product_gmv(orders(spark, folder))
    return report.daily_report(results, products(spark, folder)).select(
        "ds", *[F.col(b).cast("string").alias(b) for b in BOUNDS], "win_gmv", "top5_product_ids",
        "product_descs", "mon_rate_percent", "overlap_count", "similarity_percent", "top5_similarity",
    )


def last_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _text_bounds(report.last_windows(op.cumulative_product_gmv(orders(spark, folder))))


QUERIES = {
    "order_window_sales": _over_orders(op.window_sales),
    "order_hopping_sales": _over_orders(op.window_sales, size=30 * MINUTE, slide=10 * MINUTE),
    "order_cumulative_sales": _over_orders(op.cumulative_sales),
    "order_cumulative_top_rows": _over_orders(op.cumulative_top_rows),
    "order_tumbling_top_ids": _over_orders(op.tumbling_top_ids),
    "order_cumulative_trace": _over_orders(op.cumulative_trace),
    "order_trace_rows": _over_orders(op.trace_orders),
    "product_window_gmv": _over_orders(op.product_window_gmv),
    "cumulative_top_products": top_products,
    "cumulative_top_products_of_days": top_products_of_days,
    "orders_from_json": parsed_orders,
    "orders_unreadable": unreadable_orders,
    "report_last_windows": last_windows,
    "daily_report": daily_report,
}

_CUM = "WITH" + ORDERS_SQL + "," + CUMULATE_SQL.format(source="o")
_TOP = """,
g AS (SELECT ws, we, product_id, sum(amount) AS gmv FROM c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY ws, we ORDER BY gmv DESC, product_id) AS rn FROM g),
t AS (SELECT ws, we, CAST(sum(gmv) AS DECIMAL(18,2)) AS win_gmv,
             string_agg(product_id, ',' ORDER BY rn) AS ids FROM r WHERE rn <= 5 GROUP BY ALL)"""
_TOP_COLUMNS = f"""
SELECT strftime(ws, '%Y-%m-%d') AS ds, {BOUNDS_SQL}, win_gmv, ids AS win_gmv_ids, ids AS top5_product_ids"""

SQL = {
    "order_window_sales": f"""WITH {ORDERS_SQL}
        SELECT strftime(time_bucket(INTERVAL 10 MINUTE, tm), '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(time_bucket(INTERVAL 10 MINUTE, tm) + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
               sum(amount) AS total_sum FROM o GROUP BY 1, 2""",
    "order_hopping_sales": f"""WITH {ORDERS_SQL},
        h AS (SELECT *, unnest(generate_series(time_bucket(INTERVAL 10 MINUTE, tm) - INTERVAL 20 MINUTE,
                     time_bucket(INTERVAL 10 MINUTE, tm), INTERVAL 10 MINUTE)) AS ws FROM o)
        SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(ws + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
               sum(amount) AS total_sum FROM h GROUP BY 1, 2""",
    "order_cumulative_sales": f"""{_CUM}
        SELECT {BOUNDS_SQL}, sum(amount) AS total_cumulative_amount FROM c GROUP BY 1, 2""",
    "order_cumulative_top_rows": f"""{_CUM},
        r AS (SELECT *, row_number() OVER (PARTITION BY ws, we ORDER BY sale_num DESC, id) AS rn FROM c)
        SELECT {BOUNDS_SQL}, sum(amount) AS total_cumulative_amount,
               '[' || string_agg(id, ',' ORDER BY rn) || ']' AS top5_ids FROM r WHERE rn <= 5 GROUP BY 1, 2""",
    "order_trace_rows": f"""WITH {ORDERS_SQL}
        SELECT strftime(date_trunc('day', tm), '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(time_bucket(INTERVAL 10 MINUTE, tm) + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
               row_number() OVER w - 1 AS position, id, amount, sum(amount) OVER w AS running_amount
        FROM o WINDOW w AS (PARTITION BY date_trunc('day', tm) ORDER BY tm, id)""",
    "order_tumbling_top_ids": f"""WITH {ORDERS_SQL},
        w AS (SELECT time_bucket(INTERVAL 10 MINUTE, tm) AS ws, id, sum(sale_num) AS n FROM o GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY n DESC, id) AS rn FROM w)
        SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(ws + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
               concat(max(CASE WHEN rn = 1 THEN id ELSE '' END), ',', max(CASE WHEN rn = 2 THEN id ELSE '' END), ',',
                      max(CASE WHEN rn = 3 THEN id ELSE '' END), ',', max(CASE WHEN rn = 4 THEN id ELSE '' END), ',',
                      max(CASE WHEN rn = 5 THEN id ELSE '' END)) AS top5_ids
        FROM r WHERE rn <= 5 GROUP BY ws""",
    "order_cumulative_trace": f"""{_CUM}
        SELECT {BOUNDS_SQL}, CAST(0 AS BIGINT) AS part, sum(amount) AS period_amount,
               string_agg(id || '(' || amount || ')', '+' ORDER BY tm, id) AS cumulative_process
        FROM c GROUP BY 1, 2""",
    "product_window_gmv": f"""{_CUM}
        SELECT product_id, {BOUNDS_SQL}, sum(amount) AS product_gmv FROM c GROUP BY 1, 2, 3""",
    "cumulative_top_products": f"""{_CUM}{_TOP},
        a AS (SELECT ws, we, CAST(sum(amount) AS DECIMAL(18,2)) AS total_gmv FROM c GROUP BY ALL)
        {_TOP_COLUMNS}, total_gmv FROM t JOIN a USING (ws, we)""",
    "cumulative_top_products_of_days": f"""{_CUM}{_TOP}{_TOP_COLUMNS}
        FROM t WHERE strftime(ws, '%Y-%m-%d') IN ({", ".join(f"'{d}'" for d in DAYS)})""",
    "orders_from_json": """
        WITH o AS (SELECT CASE WHEN event_id % 30 = 1 THEN NULL ELSE CAST(value AS DECIMAL(10,2)) END AS amount,
                          CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END + INTERVAL 8 HOUR AS tm
                   FROM events WHERE event_type = 'purchase' AND event_id % 40 <> 3)
        SELECT strftime(date_trunc('hour', tm), '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(date_trunc('hour', tm) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
               sum(amount) AS total_sum FROM o GROUP BY 1, 2""",
    "orders_unreadable": """
        SELECT count(*) FILTER (WHERE event_id % 40 = 3) AS unreadable_rows, count(*) AS all_rows
        FROM events WHERE event_type = 'purchase'""",
    "report_last_windows": f"""{_CUM}{_TOP}
        SELECT strftime(ws, '%Y-%m-%d') AS ds, {BOUNDS_SQL}, win_gmv, ids AS top5_product_ids
        FROM t WHERE we = ws + INTERVAL 1 DAY""",
    "daily_report": f"""{_CUM}{_TOP},
        d AS (SELECT strftime(ws, '%Y-%m-%d') AS ds, ws, we, win_gmv, ids FROM t WHERE we = ws + INTERVAL 1 DAY),
        x AS (SELECT d.*, unnest(string_split(ids, ',')) AS pid,
                     unnest(range(length(ids) - length(replace(ids, ',', '')) + 1)) AS pos FROM d),
        n AS (SELECT ds, string_agg(p_name, ', ' ORDER BY pos) AS product_descs
              FROM x LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = pid GROUP BY ds),
        y AS (SELECT cur.ds, count(DISTINCT cur.pid) AS overlap_count FROM x cur JOIN x prev
              ON cur.pid = prev.pid AND prev.ds = strftime(CAST(cur.ds AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d')
              GROUP BY cur.ds),
        q AS (SELECT d.*, lag(win_gmv) OVER (ORDER BY ds) AS before FROM d)
        SELECT q.ds, {BOUNDS_SQL}, win_gmv, ids AS top5_product_ids, product_descs,
               CAST(win_gmv - before AS DOUBLE) / CAST(before AS DOUBLE) * 100 AS mon_rate_percent,
               coalesce(overlap_count, 0) AS overlap_count,
               CAST(coalesce(overlap_count, 0) AS DOUBLE) / len(string_split(ids, ',')) * 100 AS similarity_percent,
               round(CAST(coalesce(overlap_count, 0) AS DOUBLE) / len(string_split(ids, ',')) * 100, 2) || '%'
                 AS top5_similarity
        FROM q JOIN n USING (ds) LEFT JOIN y USING (ds)""",
}
