"""The provided tables in the shape of the operators' inputs.

Each view has a Spark form and, for the checks, the same as SQL. The derived
fields (device, address, words) follow from ids, so both forms agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.times import naive_micros
from tallyline.sources.topics import with_event_time

PAGE_OF_EVENT = {
    "signup": "login", "view": "product_detail", "click": "search", "purchase": "payment", "error": "error",
}
PLATS = ["iPhone OS", "iOS 17", "ANDROID 14", "HarmonyOS"]
BRANDS = [
    "iPhone", "HUAWEI", "honor", "Redmi", "Xiaomi", "OPPO", "vivo", "Samsung", "realme", "Nokia", None, "Mi 14",
]
CHANNELS = ["手淘搜索", "效果广告", "内容广告", "购物车", "我的淘宝", "站外广告"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: list, index: Column) -> Column:
    """Entry of a fixed list by row number."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int") + 1)


def pick_sql(values: list, index: str) -> str:
    entries = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"([{entries}])[CAST({index} AS INTEGER) + 1]"


def _product() -> Column:
    return F.get_json_object("props", "$.k")


def event_millis() -> Column:
    return F.floor(naive_micros("ts") / 1000)


def order_rows(events: DataFrame) -> DataFrame:
    """Purchases as order events, numbers as text."""
    bought = events.where(F.col("event_type") == "purchase")
    return with_event_time(
        bought.select(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_id").cast("string").alias("order_id"),
            F.col("user_id").cast("string").alias("user_id"),
            _product().alias("product_id"),
            (F.lit(1) + F.col("event_id") % 5).cast("string").alias("sale_num"),
            F.col("value").cast("decimal(18,2)").cast("string").alias("total_amount"),
            event_millis().alias("ts"),
        )
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_rows(table(spark, folder, "events"))


ORDERS_SQL = """
o AS (
  SELECT CAST(event_id AS VARCHAR) AS id, regexp_extract(props, '[0-9]+') AS product_id,
         CAST(value AS DECIMAL(18,2)) AS amount, 1 + event_id % 5 AS sale_num,
         date_trunc('millisecond', ts) + INTERVAL 8 HOUR AS tm
  FROM events WHERE event_type = 'purchase'
)"""

CUMULATE_SQL = """
c AS (
  SELECT *, date_trunc('day', tm) AS ws,
         unnest(generate_series(time_bucket(INTERVAL 10 MINUTE, tm) + INTERVAL 10 MINUTE,
                                date_trunc('day', tm) + INTERVAL 1 DAY, INTERVAL 10 MINUTE)) AS we
  FROM {source}
)"""

BOUNDS_SQL = (
    "strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(we, '%Y-%m-%d %H:%M:%S') AS window_end"
)


def log_rows(events: DataFrame) -> DataFrame:
    """Events as flat log rows, before region lookup."""
    event, user = F.col("event_id"), F.col("user_id")
    page = F.create_map(*[F.lit(x) for pair in PAGE_OF_EVENT.items() for x in pair])
    return events.select(
        pick(PLATS, user % 4).alias("plat"),
        pick(BRANDS, user % 12).alias("brand"),
        F.concat(F.lit("m"), event % 3).alias("model"),
        event.cast("string").alias("log_id"),
        F.when(user % 11 == 0, F.format_string("2001:db8:%x::%x", user % 30 + 200, event % 250))
        .otherwise(F.concat(F.lit("10."), user % 220, F.lit("."), event % 250, F.lit(".7"))).alias("ip"),
        page[F.col("event_type")].alias("log_type"),
        event_millis().cast("string").alias("ts"),
        _product().alias("product_id"),
        user.cast("string").alias("user_id"),
        F.concat(F.lit("kw"), _product().cast("int") % 40, F.lit("， kw"), event % 7, F.lit(",")).alias("keywords"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("formatted_time"),
    )


def logs(spark: SparkSession, folder: str) -> DataFrame:
    return log_rows(table(spark, folder, "events"))


_PAGE_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PAGE_OF_EVENT.items())
LOGS_SQL = f"""
l AS (
  SELECT {pick_sql(PLATS, 'user_id % 4')} AS plat, {pick_sql(BRANDS, 'user_id % 12')} AS brand,
         'm' || (event_id % 3) AS model, CAST(event_id AS VARCHAR) AS log_id,
         CAST(user_id AS VARCHAR) AS user_id, CASE event_type {_PAGE_CASE} END AS log_type,
         epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S') AS clock,
         hour(ts) AS hour, regexp_extract(props, '[0-9]+') AS product_id,
         'kw' || (CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 40) || '， kw' || (event_id % 7) || ',' AS keywords,
         CASE WHEN user_id % 11 = 0 THEN printf('2001:db8:%x::%x', (user_id % 30 + 200)::INT, (event_id % 250)::INT)
              ELSE '10.' || (user_id % 220) || '.' || (event_id % 250) || '.7' END AS ip, ts, event_id, user_id AS uid
  FROM events
)"""

# The places of the address ranges: nations, eight second octets and one third group each.
RANGE_SIZE = 8 * 65_536
RANGE_START = 10 * 16_777_216


def ip_ranges(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    key = F.col("n_nationkey").cast("int")
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).withColumn(
        "_ends",
        F.explode(
            F.array(
                F.struct(F.format_string("10.%d.0.0", key * 8).alias("lo"), F.format_string("10.%d.255.255", key * 8 + 7).alias("hi")),
                F.struct(F.format_string("2001:DB8:%x::", key + 200).alias("lo"), F.format_string("2001:db8:%x:ffff:ffff:ffff:ffff:ffff", key + 200).alias("hi")),
            )
        ),
    )
    return named.select(
        "_ends.*", F.col("r_name").alias("country"), F.col("n_name").alias("province"),
        F.when(F.col("n_nationkey") % 3 == 0, "").otherwise(F.concat(F.lit("C"), "n_nationkey")).alias("city"),
    )


RANGES_SQL = f"""
g AS (
  SELECT n_nationkey + 200 AS third, {RANGE_START} + n_nationkey::BIGINT * {RANGE_SIZE} AS lo,
         {RANGE_START} + (n_nationkey::BIGINT + 1) * {RANGE_SIZE} - 1 AS hi, r_name AS country,
         n_name AS province, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE 'C' || n_nationkey END AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
located AS (
  SELECT l.*, coalesce(country, '') AS country, coalesce(province, '') AS province, coalesce(city, '') AS city,
         concat_ws(' ', nullif(country, ''), nullif(province, ''), nullif(city, '')) AS region
  FROM l LEFT JOIN g ON CASE WHEN uid % 11 = 0 THEN third = uid % 30 + 200
                             ELSE 167772160 + (uid % 220) * 65536 + (event_id % 250) * 256 + 7 BETWEEN lo AND hi END
)"""


def raw_log_text(events: DataFrame) -> DataFrame:
    """Events as nested JSON log records; every 50th has no device, every 60th is cut off."""
    flat = log_rows(events).withColumn("_n", F.col("log_id").cast("bigint"))
    device = F.when(F.col("_n") % 50 != 0, F.struct("plat", "brand", "model"))
    words = F.to_json(F.split("keywords", "[,，] ?"))
    text = F.to_json(
        F.struct(
            "log_id", device.alias("device"), F.struct("ip").alias("gis"),
            F.struct(F.lit("wifi").alias("net")).alias("network"), "log_type",
            F.when(F.col("_n") % 2 == 0, F.col("ts")).otherwise(
                (F.col("ts").cast("bigint") / 1000).cast("decimal(20,3)").cast("string")
            ).alias("ts"),
            "product_id", "user_id", words.alias("keywords"),
        )
    )
    return flat.select(F.when(F.col("_n") % 60 == 7, F.substring(text, 1, 30)).otherwise(text).alias("value"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Product dimension."""
    part = table(spark, folder, "part")
    return part.select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_desc"))


def details(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Visits, favourites, cart adds and orders from views, signups, clicks and purchases."""
    events = table(spark, folder, "events").withColumn("_k", _product().cast("int"))
    event, user = F.col("event_id"), F.col("user_id")
    common = [
        user.alias("user_id"), F.col("_k").alias("product_id"), (F.col("_k") % 7).alias("shop_id"),
        F.when(user % 2 == 0, "pc").otherwise("wireless").alias("terminal_type"),
    ]
    of = {k: events.where(F.col("event_type") == k) for k in PAGE_OF_EVENT}
    return {
        "visits": of["view"].select(
            *common, F.col("ts").alias("visit_time"), pick(CHANNELS, event % 6).alias("visit_reason"),
            (F.lit(1) + event % 3).alias("visit_count"), (event % 90).alias("stay_time"),
            (event % 4 == 0).alias("has_click"),
        ),
        "favourites": of["signup"].select(
            *common, F.col("ts").alias("favorite_time"), (event % 5 == 0).alias("is_cancel")
        ),
        "carts": of["click"].select(*common, F.col("ts").alias("cart_time")),
        "orders": of["purchase"].select(
            *common, F.col("ts").alias("order_time"), event.alias("order_detail_id"),
            F.floor(event / 2).alias("order_id"), (F.lit(1) + event % 5).alias("quantity"),
            F.col("value").alias("price"),
        ),
    }


DETAILS_SQL = f"""
e AS (
  SELECT *, CAST(user_id AS VARCHAR) AS u, regexp_extract(props, '[0-9]+') AS p,
         CAST(CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 7 AS VARCHAR) AS s,
         strftime(ts, '%Y-%m-%d') AS ds, CASE WHEN user_id % 2 = 0 THEN 'pc' ELSE 'wireless' END AS t
  FROM events
),
v AS (SELECT s AS shop_id, p AS product_id, ds, u AS user_id, t AS terminal_type, ts,
             {pick_sql(CHANNELS, 'event_id % 6')} AS visit_reason, 1 + event_id % 3 AS visit_count,
             event_id % 4 = 0 AS has_click FROM e WHERE event_type = 'view'),
f AS (SELECT s AS shop_id, p AS product_id, ds, u AS user_id, t AS terminal_type, event_id % 5 = 0 AS is_cancel
      FROM e WHERE event_type = 'signup'),
k AS (SELECT s AS shop_id, p AS product_id, ds, u AS user_id, t AS terminal_type FROM e WHERE event_type = 'click'),
b AS (SELECT s AS shop_id, p AS product_id, ds, u AS user_id, t AS terminal_type, ts,
             CAST(event_id AS VARCHAR) AS order_detail_id, event_id // 2 AS order_id, 1 + event_id % 5 AS quantity,
             CAST(value AS DECIMAL(18,2)) AS price, p || '-' || (event_id % 3) AS sku_id
      FROM e WHERE event_type = 'purchase')"""
