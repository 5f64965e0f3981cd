"""The same tables read as streams; results of windows that have closed at their end."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.times import MINUTE
from tallyline.operators import clicks, paths, profiles
from tallyline.operators.ranking import top_n
from tallyline.operators.windows import BOUNDS
from tallyline.plans import loads
from tallyline.plans.clicks import SQL as CLICK_SQL
from tallyline.plans.clicks import path_rows, profile_rows, region_rows
from tallyline.plans.loads import SQL as LOAD_SQL
from tallyline.plans.orders import SQL as ORDER_SQL
from tallyline.plans.standins import log_rows, order_rows
from tallyline.session import checkpoint_dir
from tallyline.sources import changes, sinks
from tallyline.streaming import clicks as stream_clicks
from tallyline.streaming import orders as stream_orders
from tallyline.streaming.windows import closed_until

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    ]
)

#: Files of a batch of messages while not all executors have come.
LEAST_FILES = 8


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(folder)


@contextmanager
def _state_partitions(spark: SparkSession):
    """A local session needs no more state partitions than cores."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(key, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _run(spark: SparkSession, start: Callable[[str, str], object]) -> str:
    """Runs a query to the end of its input; returns the folder of its results."""
    return _finished(spark, start)[0]


def _finished(spark: SparkSession, start: Callable[[str, str], object]) -> tuple[str, int | None]:
    """The folder of a query's results and how far its watermark has come."""
    home = f"{checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"
    with _state_partitions(spark):
        query = start(f"{home}/out", f"{home}/checkpoint")
        query.awaitTermination()
    return f"{home}/out", closed_until(query)


def _text_bounds(df: DataFrame) -> DataFrame:
    return df.withColumns({b: F.col(b).cast("string") for b in BOUNDS})


def window_sales(spark: SparkSession, folder: str) -> DataFrame:
    rows = stream_orders.window_sales(order_rows(events(spark, folder)))
    return _text_bounds(sinks.read_batches(spark, _run(spark, lambda out, ck: sinks.start_to_folder(rows, out, ck))))


def _cumulative(slices, windows) -> Callable[[SparkSession, str], DataFrame]:
    """Closed slices stored by the stream, the cumulative windows made of them on read."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = slices(order_rows(events(spark, folder)))
        out, until = _finished(spark, lambda o, ck: sinks.start_to_folder(rows, o, ck))
        return windows(sinks.read_batches(spark, out), until=until)

    return query


def top_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_rows(events(spark, folder))
    out = _run(spark, lambda target, checkpoint: stream_orders.start_tumbling_top_ids(rows, target, checkpoint))
    return _text_bounds(sinks.read_batches(spark, out))


def _logs_to(job, mode: str):
    """Log rows through ``job``; returns the folder of its batches."""

    def run(spark: SparkSession, folder: str) -> str:
        rows = job(log_rows(events(spark, folder)))
        return _run(spark, lambda out, checkpoint: sinks.start_to_folder(rows, out, checkpoint, mode=mode))

    return run


def _latest(job, keys: list[str], then=lambda df: df):
    run = _logs_to(job, "update")
    return lambda spark, folder: then(sinks.read_latest(spark, run(spark, folder), keys))


def _daily(job, keys: list[str], then=lambda df: df):
    """A daily table with bounded state, stored with snapshots, then the second level on read."""
    stored = [stream_clicks.STATE_DAY, *keys]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = stream_clicks.by_day(job, log_rows(events(spark, folder)))
        write = lambda out, ck: sinks.start_batches(rows, sinks.keyed_batches(out, stored), ck, mode="update")
        table = sinks.read_latest(spark, _run(spark, write), stored)
        return then(stream_clicks.over_days(table, keys))

    return query


def _complete(job):
    run = _logs_to(job, "complete")
    return lambda spark, folder: sinks.latest_batch(spark, run(spark, folder))


def windowed_profiles(spark: SparkSession, folder: str) -> DataFrame:
    out = _logs_to(stream_clicks.user_profiles, "append")(spark, folder)
    return _text_bounds(profile_rows(sinks.read_batches(spark, out)))


def _closed_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of two-hour windows as a stream stores them."""
    job = lambda logs: stream_clicks.user_paths(logs, 120 * MINUTE)
    return sinks.read_batches(spark, _logs_to(job, "append")(spark, folder))


def windowed_paths(spark: SparkSession, folder: str) -> DataFrame:
    return path_rows(_text_bounds(paths.longer_paths(_closed_paths(spark, folder))))


def _path_statistics(then):
    """First level streamed (closed paths), second level on read, as often as it is wanted."""
    return lambda spark, folder: then(_closed_paths(spark, folder))


def _patterns(rows: DataFrame) -> DataFrame:
    return paths.count_patterns(rows, ["user_id", "date", "window_start"])


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.read_batches(spark, _logs_to(paths.purchase_alerts, "append")(spark, folder))


def _profile_table(then):
    """Behaviours streamed into a keyed table, the second level on read."""
    return _daily(profiles.behaviours, ["user_id", "date", "time_slot"], then)


def fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """Three results from one parsed stream."""
    metrics = {
        "page_views": lambda b: clicks.page_views(b).select("date", F.col("page").alias("name"), F.col("pv").alias("n")),
        "devices": lambda b: clicks.device_counts(b).select("date", F.col("category").alias("name"), F.col("cnt").alias("n")),
        "alerts": lambda b: paths.purchase_alerts(b).select("date", F.col("user_id").alias("name"), F.lit(1).alias("n")),
    }
    rows = log_rows(events(spark, folder))
    out = _run(spark, lambda o, ck: sinks.start_batches(rows, sinks.fan_out(metrics, o), ck))
    parts = [
        sinks.read_batches(spark, f"{out}/{m}").groupBy("date", "name").agg(F.sum("n").alias("n")).withColumn("metric", F.lit(m))
        for m in metrics
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _as_files(text: DataFrame, batches: int) -> DataFrame:
    """Messages as a stream of several batches, in no order of their content; every core has a file of each."""
    spark = text.sparkSession
    home = f"{checkpoint_dir(spark).rstrip('/')}/messages/{uuid.uuid4().hex}"
    each = max(spark.sparkContext.defaultParallelism, LEAST_FILES)
    text.repartition(batches * each, F.xxhash64("value")).write.parquet(home)
    files = len(spark.read.schema(text.schema).parquet(home).inputFiles())  # empty parts have none
    return spark.readStream.schema(text.schema).option("maxFilesPerTrigger", -(-files // batches)).parquet(home)


def current_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The current table of the orders behind a stream of their changes, which come out of order."""
    keys, given = ["o_orderkey"], _as_files(loads.order_history(spark, folder), 5)
    rows = changes.keyed_changes(given, loads.ORDER_ROW, keys, "shop.public.orders")
    write = lambda out, ck: sinks.start_batches(rows, changes.current_table(out, keys, every=2), ck)
    return changes.read_current(spark, _run(spark, write), keys)


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = changes.flatten_changes(_as_files(loads.change_text(spark, folder), 3), loads.ORDER_ROW)
    rows = rows.where(F.col("table_name") == "shop.public.orders")
    return sinks.read_batches(spark, _run(spark, lambda out, ck: sinks.start_to_folder(rows, out, ck)))


def loaded_devices(spark: SparkSession, folder: str) -> DataFrame:
    """The lenient load of device counts from a stream of messages."""
    rows = sinks.load_json(_as_files(loads.device_text(spark, folder), 3), sinks.DEVICES)
    return loads.shown_devices(sinks.read_batches(spark, _run(spark, lambda out, ck: sinks.start_to_folder(rows, out, ck))))


def frequent_words(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent search words of the whole stream from sketches of bounded size."""
    rows = log_rows(events(spark, folder))
    write = lambda out, ck: sinks.start_batches(rows, stream_clicks.word_batches(out), ck)
    return clicks.frequent_words(sinks.read_batches(spark, _run(spark, write)))


QUERIES = {
    "stream_frequent_words": frequent_words,
    "stream_current_orders": current_orders,
    "stream_order_changes": order_changes,
    "stream_load_devices": loaded_devices,
    "stream_window_sales": window_sales,
    "stream_cumulative_sales": lambda s, f: _text_bounds(
        _cumulative(stream_orders.sales_slices, stream_orders.cumulative_sales)(s, f)
    ),
    "stream_cumulative_top_products": lambda s, f: _cumulative(
        stream_orders.product_slices, partial(stream_orders.cumulative_top_products, with_total=True)
    )(s, f).withColumn("ds", F.col("ds").cast("string")),
    "stream_cumulative_top_rows": lambda s, f: _text_bounds(
        _cumulative(stream_orders.top_row_slices, stream_orders.cumulative_top_rows)(s, f)
    ),
    "stream_tumbling_top_ids": top_ids,
    "stream_page_views": _daily(clicks.page_views, ["date", "page"]),
    "stream_top_keywords": _latest(
        clicks.keyword_counts, ["word"], lambda d: d.orderBy(F.desc("cnt"), "word").limit(10)
    ),
    "stream_top_keywords_complete": _complete(clicks.top_keywords),
    "stream_daily_words": _daily(
        stream_clicks.daily_word_counts, ["day", "word"],
        lambda d: top_n(d, ["day"], [F.desc("cnt"), F.asc("word")], 10).drop("rn"),
    ),
    "stream_platform_share": _complete(clicks.platform_share),
    "stream_live_monitor": _complete(paths.live_monitor),
    "stream_users_per_slot": _profile_table(profiles.slots_of),
    "stream_user_summary": _profile_table(profiles.summary_of),
    "stream_top_brands": _daily(clicks.raw_devices, ["date", "plat", "brand"], clicks.top_brands_of),
    "stream_device_models": _daily(
        clicks.device_models, ["platform", "brand", "model", "stat_date"],
        lambda d: d.withColumn("stat_date", F.col("stat_date").cast("string")),
    ),
    "stream_region_counts": _daily(
        lambda rows, extra: clicks.address_counts(region_rows(rows), extra), ["date", "region_raw", "ip"],
        lambda d: clicks.named_regions(clicks.days_told_apart(d)),
    ),
    "stream_page_view_users": _daily(
        clicks.page_day_users, ["day", "page", "user_id"], clicks.user_lists
    ),
    "stream_top_path_patterns": _path_statistics(lambda p: paths.top_patterns(_patterns(p))),
    "stream_path_pattern_lengths": _path_statistics(lambda p: paths.pattern_lengths(_patterns(p))),
    "stream_path_conversions": _path_statistics(paths.path_conversions),
    "stream_user_profiles": windowed_profiles,
    "stream_user_paths": windowed_paths,
    "stream_purchase_alerts": alerts,
    "stream_fan_out": fan_out,
}

# Windows count as closed up to the largest event time less the watermark delay.
_CLOSED_ORDERS = """SELECT * FROM ({sql}) WHERE CAST(window_end AS TIMESTAMP) <=
    (SELECT max(date_trunc('millisecond', ts)) + INTERVAL 8 HOUR - INTERVAL 5 SECOND FROM events WHERE event_type = 'purchase')"""
_CLOSED_LOGS = """SELECT {columns} FROM ({sql}) WHERE CAST(window_end AS TIMESTAMP) <=
    (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 5 SECOND FROM events {rows})"""

_CLOSED_PATHS = _CLOSED_LOGS.format(
    sql=CLICK_SQL["user_paths_windowed"], rows="WHERE event_type <> 'error'", columns="*"
)
_PATTERNS = f"WITH n AS (SELECT path AS pattern, path_length, count(*) AS cnt FROM ({_CLOSED_PATHS}) GROUP BY ALL)"

SQL = {
    "stream_frequent_words": CLICK_SQL["top_keywords"],
    "stream_current_orders": LOAD_SQL["current_orders"],
    "stream_order_changes": LOAD_SQL["order_changes"],
    "stream_load_devices": LOAD_SQL["load_devices"],
    "stream_window_sales": _CLOSED_ORDERS.format(sql=ORDER_SQL["order_window_sales"]),
    "stream_cumulative_sales": _CLOSED_ORDERS.format(sql=ORDER_SQL["order_cumulative_sales"]),
    "stream_cumulative_top_products": _CLOSED_ORDERS.format(sql=ORDER_SQL["cumulative_top_products"]),
    "stream_cumulative_top_rows": _CLOSED_ORDERS.format(sql=ORDER_SQL["order_cumulative_top_rows"]),
    "stream_tumbling_top_ids": _CLOSED_ORDERS.format(sql=ORDER_SQL["order_tumbling_top_ids"]),
    "stream_page_views": CLICK_SQL["page_views"],
    "stream_top_keywords": CLICK_SQL["top_keywords"],
    "stream_top_keywords_complete": CLICK_SQL["top_keywords"],
    "stream_daily_words": CLICK_SQL["keyword_counts"].split(", w AS")[0] + """,
        w AS (SELECT day, trim(unnest(string_split(replace(keywords, '，', ','), ','))) AS word FROM l),
        n AS (SELECT day, word, count(*) AS cnt FROM w WHERE word <> '' GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY cnt DESC, word) AS rn FROM n)
        SELECT day, word, cnt FROM r WHERE rn <= 10""",
    "stream_platform_share": CLICK_SQL["platform_share"],
    "stream_live_monitor": CLICK_SQL["live_monitor"],
    "stream_users_per_slot": CLICK_SQL["users_per_slot"],
    "stream_user_profiles": _CLOSED_LOGS.format(sql=CLICK_SQL["user_profiles_windowed"], rows="", columns="*"),
    "stream_user_paths": _CLOSED_PATHS,
    "stream_user_summary": CLICK_SQL["user_summary"],
    "stream_top_brands": CLICK_SQL["top_brands"],
    "stream_device_models": CLICK_SQL["device_models"],
    "stream_region_counts": CLICK_SQL["region_counts"],
    "stream_page_view_users": CLICK_SQL["page_view_users"],
    "stream_top_path_patterns": f"{_PATTERNS} SELECT * FROM n ORDER BY cnt DESC, pattern LIMIT 5",
    "stream_path_pattern_lengths": f"""{_PATTERNS}
        SELECT CAST(sum(path_length) AS DOUBLE) / count(*) AS avg_path_length,
               CAST(sum(path_length * cnt) AS DOUBLE) / sum(cnt) AS weighted_path_length FROM n""",
    "stream_path_conversions": f"""SELECT count(*) FILTER (WHERE has_purchase) AS conversion_paths,
        count(*) FILTER (WHERE has_purchase AND end_page = 'payment') AS payment_end_paths FROM ({_CLOSED_PATHS})""",
    "stream_purchase_alerts": CLICK_SQL["purchase_alerts"],
    "stream_fan_out": f"""
        SELECT 'page_views' AS metric, date, page AS name, pv AS n FROM ({CLICK_SQL["page_views"]})
        UNION ALL SELECT 'devices', date, category, cnt FROM ({CLICK_SQL["device_counts"]})
        UNION ALL SELECT 'alerts', date, user_id, count(*) FROM ({CLICK_SQL["purchase_alerts"]}) GROUP BY 2, 3""",
}
