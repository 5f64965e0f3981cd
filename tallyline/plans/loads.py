"""Loading, change rows and web pages over the provided tables."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators import clicks, web
from tallyline.plans.clicks import part_words, region_counts
from tallyline.plans.clicks import SQL as CLICK_SQL
from tallyline.plans.standins import LOGS_SQL, logs, table
from tallyline.session import checkpoint_dir
from tallyline.sources import sinks, tables
from tallyline.sources.changes import changed_rows, current_rows, flatten_changes, keyed_changes, snapshot_then_changes
from tallyline.sources.topics import logs_from_json, since
from tallyline.streaming.clicks import log_time

ORDER_ROW = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DecimalType(18, 2)),
    ]
)
PAGE_LAYOUT = web.PageLayout(title=web.Block("h1"), content=web.Block("article"))
BASE = "https://pages.example.com/"


def change_text(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and customers as change envelopes; every fourth order is a delete."""

    def envelope(df: DataFrame, name: str, row, op) -> DataFrame:
        after = F.when(op != "d", row)
        source = F.struct(F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit(name).alias("table"))
        return df.select(F.to_json(F.struct(after.alias("after"), source.alias("source"), op.alias("op"))).alias("value"))

    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    op = F.element_at(F.array(*[F.lit(o) for o in "crud"]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    price = F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
    row = F.struct("o_orderkey", "o_custkey", "o_orderstatus", price)
    return envelope(orders, "orders", row, op).unionByName(
        envelope(customer, "customer", F.struct("c_custkey", "c_name"), F.lit("r"))
    )


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = flatten_changes(change_text(spark, folder), ORDER_ROW)
    return rows.where(F.col("table_name") == "shop.public.orders")


def change_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = changed_rows(change_text(spark, folder))
    return rows.groupBy("table_name", "op").agg(
        F.count("*").alias("rows"), F.sum(F.size("after")).alias("fields")
    )


def snapshot_and_changes(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as a snapshot, then the changes of that table."""
    price = F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
    snapshot = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", price)
    return snapshot_then_changes(snapshot, flatten_changes(change_text(spark, folder), ORDER_ROW), "shop.public.orders")


def order_history(spark: SparkSession, folder: str) -> DataFrame:
    """Every order's changes one after the other as envelopes with their position, and some snapshot rows.

    Of four orders one is made, one changed later, one deleted in the end, one deleted and made
    again; the price grows by one each time. Some orders are in a snapshot, one in eight only there.
    """
    price = F.col("o_totalprice").cast("decimal(18,2)")
    key = F.col("o_orderkey")
    steps = F.element_at(F.array(*[F.split(F.lit(o), "") for o in ("c", "cu", "cud", "cdc")]), (key % 4 + 1).cast("int"))
    steps = F.when(key % 8 == 7, F.array().cast("array<string>")).otherwise(steps)
    first = F.when(key % 8 >= 6, F.array(F.lit("r"))).otherwise(F.array().cast("array<string>"))
    rows = table(spark, folder, "orders").withColumn("first", F.size(first)).select(
        "*", F.posexplode(F.concat(first, steps)).alias("at", "op")
    )
    step = F.col("at") - F.col("first") + 1

    def row(by):
        grown = (price + F.greatest(by, F.lit(0))).cast("decimal(18,2)")
        return F.struct("o_orderkey", "o_custkey", "o_orderstatus", grown.alias("o_totalprice"))

    source = F.struct(F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit("orders").alias("table"))
    envelope = F.struct(
        F.when(F.col("op").isin("u", "d"), row(step - 1)).alias("before"), F.when(F.col("op") != "d", row(step)).alias("after"),
        source.alias("source"), "op", F.when(F.col("op") != "r", step * 1_000_000_000_000 + key).alias("position"),
    )
    return rows.select(F.to_json(envelope).alias("value"))


def current_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders after all their changes."""
    changes = keyed_changes(order_history(spark, folder), ORDER_ROW, ["o_orderkey"], "shop.public.orders")
    return current_rows(changes, ["o_orderkey"])


def copied_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and customers copied to the shared folder, then read with few columns."""
    home = f"{checkpoint_dir(spark).rstrip('/')}/copies/{uuid.uuid4().hex}"
    orders, customer = tables.copy_tables(["orders", "customer"], lambda name: table(spark, folder, name), home)
    bought = tables.read_result(spark, orders, "o_orderkey", "o_custkey")
    names = tables.read_result(spark, customer, "c_custkey", "c_name")
    return bought.join(names, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def later_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Log messages parsed again, from a start position on."""
    rows = log_time(logs_from_json(_as_text(logs(spark, folder))))
    return since(rows, "ts_ms", datetime(2024, 1, 15, tzinfo=UTC)).select(
        "log_id", "plat", "brand", "model", "ip", "log_type", "ts", "user_id", "keywords"
    )


def loaded_views(spark: SparkSession, folder: str) -> DataFrame:
    text = _as_text(clicks.page_view_users(logs(spark, folder)).withColumn("emit_time", F.lit("2024-02-01 00:00:00")))
    rows = sinks.load_json(text, sinks.PAGE_VIEWS, proc_time=False)
    return rows.withColumn("emit_time", F.col("emit_time").cast("string"))


def _word_text(spark: SparkSession, folder: str) -> DataFrame:
    return _as_text(clicks.daily_top_words(part_words(spark, folder)).withColumn("emit_time", F.lit("now")))


def loaded_words(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.load_json(_word_text(spark, folder), sinks.SEARCH_WORDS, proc_time=False).drop("emit_time")


def loaded_all_words(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.load_all_words(_word_text(spark, folder)).drop("emit_time")


def loaded_regions(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.load_json(_as_text(region_counts(spark, folder)), sinks.REGIONS, proc_time=False)


def device_text(spark: SparkSession, folder: str) -> DataFrame:
    """Device counts as messages with the field ``system``; odd models have a bad count."""
    rows = clicks.device_models(logs(spark, folder)).withColumnRenamed("platform", "system")
    count = F.when(F.col("model") == "m1", "many").otherwise(F.col("count").cast("string"))
    return _as_text(rows.withColumn("count", count))


def shown_devices(loaded: DataFrame) -> DataFrame:
    return loaded.select(
        "platform", "brand", "model", F.col("stat_date").cast("string").alias("stat_date"), "count",
        F.col("proc_time").isNotNull().alias("has_proc_time"),
    )


def loaded_devices(spark: SparkSession, folder: str) -> DataFrame:
    return shown_devices(sinks.load_json(device_text(spark, folder), sinks.DEVICES))


def links(spark: SparkSession, folder: str) -> DataFrame:
    return web.page_links(table(spark, folder, "pages"), BASE)


def fields(spark: SparkSession, folder: str) -> DataFrame:
    return web.page_fields(table(spark, folder, "pages"), PAGE_LAYOUT)


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a detail page: nested and upper-case tags, references, a footer behind the text."""
    page, address = F.col("page_id").cast("string"), F.replace("url", F.lit("&"), F.lit("&amp;"))
    parts = [
        "<html><body><H1 align='center' data-title='no'>Page &#78;&#x6f; ", page, " &amp; more<br></H1>",
        "<p class='xx'>来源：office", page, " <b>发布日期：2024-01-", page, "</b> read</p><p>〔2024〕", page, "号</p>",
        '<div class="v_news_content"><div><p>', address, "<p>second &lt;", page, "&gt;</div><!-- </div> --><P>third</P></div>",
        "<div class='footer'>footer</div></body></html>",
    ]
    html = F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])
    return table(spark, folder, "pages").select(F.concat(F.lit(f"{BASE}p"), page).alias("url"), html.alias("html"))


def details(spark: SparkSession, folder: str) -> DataFrame:
    return web.page_fields(detail_pages(spark, folder))


def merged(spark: SparkSession, folder: str) -> DataFrame:
    """All links with the fields of their pages: a link leads as many pages on as its name is long."""
    pages = table(spark, folder, "pages").withColumn("url", F.col("page_id").cast("string"))
    listed = web.page_links(pages, BASE)
    target = F.concat(F.lit(f"{BASE}p"), F.col("page_url").cast("bigint") + F.length("name"))
    return web.merged_pages(listed.withColumn("link", target), details(spark, folder))


QUERIES = {
    "order_changes": order_changes,
    "change_counts": change_counts,
    "snapshot_and_changes": snapshot_and_changes,
    "current_orders": current_orders,
    "copied_tables": copied_tables,
    "later_logs": later_logs,
    "load_page_views": loaded_views,
    "load_search_words": loaded_words,
    "load_all_search_words": loaded_all_words,
    "load_regions": loaded_regions,
    "load_devices": loaded_devices,
    "page_links": links,
    "page_fields": fields,
    "page_detail_fields": details,
    "merged_pages": merged,
}

_CLEAN = """p AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'),
    '<script\\b.*?</script\\s*>', '', 'gsi'), '<style\\b.*?</style\\s*>', '', 'gsi') AS h FROM pages)"""


# Character references of the given pages, the ampersand last.
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "),
    ("&copy;", "©"), ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"), ("&amp;", "&"),
]


def _decoded(text: str) -> str:
    for name, char in ENTITIES:
        text = f"replace({text}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    return text


_LINKS = f"""{_CLEAN},
    a AS (SELECT page_id, url, unnest(regexp_extract_all(h, '<li[^>]*>\\s*(<a\\b[^>]*>.*?)</a>', 1, 's')) AS a FROM p),
    b AS (SELECT page_id, url, trim(regexp_extract(a, 'href=["'']([^"'']*)["'']', 1)) AS href,
                 trim({_decoded("regexp_replace(a, '<[^>]*>', '', 'g')")}) AS t FROM a),
    n AS (SELECT page_id, url AS page_url, CASE WHEN href LIKE 'http%' THEN href
                   ELSE '{BASE}' || regexp_replace(href, '^/+', '') END AS link,
                 CASE WHEN length(t) > 10 AND contains(substring(t, 1, 10), '-') THEN trim(substring(t, 11), E' \\t\\r\\n') ELSE t END AS name
          FROM b WHERE href <> '' AND t <> '')"""
_TITLE = "trim(" + _decoded("regexp_extract(h, '<h1[^>]*>([^<]*)', 1)") + ")"
# What the detail pages say, without any markup.
_DETAILS = f"""d AS (SELECT '{BASE}p' || page_id AS url, 'Page No ' || page_id || ' & more' AS title,
    'office' || page_id AS publish_dept, '2024-01-' || page_id AS publish_date, '〔2024〕' || page_id || '号' AS doc_number,
    'office' || page_id AS source,
    url || E'\\n\\n' || 'second <' || page_id || '>' || E'\\n\\n' || 'third' AS content FROM pages)"""
_WORDS = CLICK_SQL["item_daily_top_words"].split("SELECT day, string_agg")[0]

SQL = {
    "current_orders": """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2))
        + CASE WHEN o_orderkey % 8 = 7 THEN 0 ELSE o_orderkey % 4 + CASE WHEN o_orderkey % 4 = 3 THEN 0 ELSE 1 END END AS DECIMAL(18,2)) AS o_totalprice
        FROM orders WHERE o_orderkey % 4 <> 2""",
    "order_changes": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
               'shop.public.orders' AS table_name, ['c', 'r', 'u', 'd'][o_orderkey % 4 + 1] AS op
        FROM orders WHERE o_orderkey % 4 <> 3""",
    "change_counts": """
        SELECT 'shop.public.orders' AS table_name, ['c', 'r', 'u', 'd'][o_orderkey % 4 + 1] AS op,
               count(*) AS rows, 4 * count(*) AS fields FROM orders WHERE o_orderkey % 4 <> 3 GROUP BY ALL
        UNION ALL SELECT 'shop.public.customer', 'r', count(*), 2 * count(*) FROM customer""",
    "load_page_views": f"""WITH {LOGS_SQL}
        SELECT replace(day, '-', '') AS day, log_type AS page, count(*) AS pv,
               '["' || string_agg(DISTINCT user_id, '","' ORDER BY user_id) || '"]' AS user_ids,
               '2024-02-01 00:00:00' AS emit_time
        FROM l GROUP BY l.day, log_type""",
    "load_search_words": f"{_WORDS} SELECT day, word, cnt FROM r WHERE rn = 1",
    "load_all_search_words": f"{_WORDS} SELECT day, word, cnt FROM r WHERE rn <= 10",
    "load_regions": CLICK_SQL["region_counts"],
    "load_devices": f"""
        SELECT platform, brand, model, stat_date, CASE WHEN model = 'm1' THEN NULL ELSE count END AS count,
               TRUE AS has_proc_time FROM ({CLICK_SQL["device_models"]})""",
    "page_links": f"WITH {_LINKS} SELECT * EXCLUDE (page_id) FROM n",
    "page_fields": f"""WITH {_CLEAN},
        t AS (SELECT url, {_TITLE} AS title,
                     [trim({_decoded("x")}, E' \\t\\r\\n') FOR x IN
                      string_split(regexp_replace(regexp_extract(h, '<article>(.*)</article>', 1, 's'),
                                                  '<[^>]*>', chr(1), 'g'), chr(1))] AS nodes FROM p)
        SELECT url, title, '' AS publish_dept, '' AS publish_date, '' AS doc_number, '' AS source,
               array_to_string([x FOR x IN nodes IF x <> ''], E'\\n\\n') AS content FROM t""",
    "page_detail_fields": f"WITH {_DETAILS} SELECT * FROM d",
    "merged_pages": f"""WITH {_LINKS}, {_DETAILS},
        m AS (SELECT '{BASE}p' || (page_id + length(name)) AS url, name FROM n)
        SELECT m.url AS link, name, coalesce(title, '') AS title, coalesce(publish_dept, '') AS publish_dept,
               coalesce(publish_date, '') AS publish_date, coalesce(doc_number, '') AS doc_number,
               coalesce(source, '') AS source, coalesce(content, '') AS content FROM m LEFT JOIN d USING (url)""",
}

SQL |= {
    "snapshot_and_changes": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
               'shop.public.orders' AS table_name, 'r' AS op FROM orders
        UNION ALL {SQL["order_changes"]}""",
    "copied_tables": "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
    "later_logs": f"""WITH {LOGS_SQL}
        SELECT log_id, plat, brand, model, ip, log_type, CAST(ms AS VARCHAR) AS ts, user_id, keywords
        FROM l WHERE ms >= epoch_ms(TIMESTAMP '2024-01-15 00:00:00')""",
}
