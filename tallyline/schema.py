"""Record schemas of the topics and tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


ORDER = T.StructType(
    _strings(
        "id", "order_id", "user_id", "user_name", "phone_number", "product_link",
        "product_id", "color", "size", "item_id", "material", "sale_num", "sale_amount",
        "total_amount", "product_name", "is_online_sales", "shipping_address",
        "recommendations_product_ids", "ds",
    )
    + [T.StructField("ts", T.StringType())]
    + _strings("insert_time", "table_name", "op")
)

DEVICE = T.StructType(_strings("plat", "brand", "model"))

RAW_LOG = T.StructType(
    _strings("log_id")
    + [
        T.StructField("device", DEVICE),
        T.StructField("gis", T.StructType(_strings("ip"))),
        T.StructField("network", T.StructType(_strings("net"))),
    ]
    + _strings("opa", "log_type", "ts", "product_id", "order_id", "user_id", "keywords")
)

ENRICHED_LOG = T.StructType(
    _strings(
        "plat", "brand", "model", "log_id", "ip", "net", "opa", "log_type", "ts",
        "formatted_time", "product_id", "order_id", "user_id", "keywords", "country",
        "province", "city", "region",
    )
)

CHANGE = T.StructType(
    [
        T.StructField("after", T.MapType(T.StringType(), T.StringType())),
        T.StructField("source", T.StructType(_strings("db", "schema", "table"))),
        T.StructField("op", T.StringType()),
    ]
)

WINDOW_RESULT = T.StructType(
    [T.StructField("ds", T.DateType())]
    + _strings("window_start", "window_end")
    + [T.StructField("win_gmv", T.DecimalType(18, 2))]
    + _strings("win_gmv_ids", "top5_product_ids")
)

IP_RANGE = T.StructType(
    [T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]
    + _strings("country", "province", "city")
)
