"""Streams over several micro-batches give the rows of the batch operators, and a replay adds none."""

import shutil
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline.functions.times import MINUTE
from tallyline.operators import clicks, geo, orders, paths, profiles
from tallyline.operators.windows import BOUNDS
from tallyline.plans import streams
from tallyline.plans.clicks import region_rows
from tallyline.plans.standins import ip_ranges, log_rows, order_rows, raw_log_text
from tallyline.plans.streams import EVENTS
from tallyline.schema import RAW_LOG
from tallyline.sources import sinks
from tallyline.sources.topics import parse_json
from tallyline.streaming import clicks as stream_clicks
from tallyline.streaming import orders as stream_orders
from tallyline.streaming.windows import closed_until

FILES = 4


@pytest.fixture(scope="module")
def events(spark, folder):
    return spark.read.parquet(f"{folder}/events.parquet")


@pytest.fixture(scope="module")
def split(events, tmp_path_factory):
    """The events of three days as files in the order of time, each one micro-batch."""
    home = tmp_path_factory.mktemp("events")
    some = events.where("ts < timestamp_ntz'2024-01-04 00:00:00'")
    ranked = some.withColumn("file", F.ntile(FILES).over(Window.orderBy("ts")))
    for k in range(1, FILES + 1):
        ranked.where(F.col("file") == k).drop("file").coalesce(1).write.mode("append").parquet(str(home))
    return str(home)


def stream(spark, split):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(split)


def finish(query):
    assert query.awaitTermination(180)
    assert query.exception() is None


def same(got, want):
    want = want.select(got.columns)
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def closed_before(rows, batch):
    """Batch rows whose windows the stream has given out."""
    last = rows.agg(F.max("window_end").cast("string")).first()[0]
    return batch.where(F.col("window_end").cast("string") <= last)


def test_window_sales(spark, split, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    finish(sinks.start_to_folder(stream_orders.window_sales(order_rows(stream(spark, split))), out, ck))
    got = sinks.read_batches(spark, out)
    want = orders.window_sales(order_rows(spark.read.parquet(split)))
    same(got, closed_before(got, want))
    assert want.count() - got.count() <= 2


CUMULATIVE = {
    "sales": (stream_orders.sales_slices, stream_orders.cumulative_sales, orders.cumulative_sales),
    "products": (
        stream_orders.product_slices, partial(stream_orders.cumulative_top_products, with_total=True),
        partial(orders.cumulative_product_gmv, with_total=True),
    ),
    "rows": (stream_orders.top_row_slices, stream_orders.cumulative_top_rows, orders.cumulative_top_rows),
}


@pytest.mark.parametrize("name", CUMULATIVE)
def test_cumulative_windows_and_replay(spark, split, tmp_path, name):
    slices, windows, batch = CUMULATIVE[name]
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    query = sinks.start_to_folder(slices(order_rows(stream(spark, split))), out, ck)
    finish(query)
    got = windows(sinks.read_batches(spark, out), until=closed_until(query))
    assert len(list(Path(out, "log").glob("batch.*"))) >= 3
    want = batch(order_rows(spark.read.parquet(split)))
    same(got, closed_before(got, want))
    # without a mark the windows end with the last closed slice
    rows = windows(sinks.read_batches(spark, out))
    same(rows, closed_before(rows, want))
    # the state of the last batch holds open slices only: two at most, 64 shares of the rows each
    state = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    products = order_rows(spark.read.parquet(split)).select("product_id").distinct().count()
    assert state <= 2 * {"sales": 1, "products": products, "rows": stream_orders.SHARES}[name]

    # The commit of the last batch is lost: it runs again and adds nothing.
    stored = sinks.read_batches(spark, out).count()
    again = str(tmp_path / "ck-again")
    commits = sorted((int(p.name) for p in Path(ck, "commits").iterdir() if p.name.isdigit()))
    lost = {str(commits[-1]), f".{commits[-1]}.crc"}
    shutil.copytree(ck, again, ignore=lambda d, names: lost & set(names) if d.endswith("commits") else set())
    finish(sinks.start_to_folder(slices(order_rows(stream(spark, split))), out, again))
    assert sinks.read_batches(spark, out).count() == stored


def test_top_ids(spark, split, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    finish(stream_orders.start_tumbling_top_ids(order_rows(stream(spark, split)), out, ck))
    got = sinks.read_batches(spark, out)
    same(got, closed_before(got, orders.tumbling_top_ids(order_rows(spark.read.parquet(split)))))


def test_profiles_and_paths(spark, split, tmp_path):
    logs, static = log_rows(stream(spark, split)), log_rows(spark.read.parquet(split))
    finish(sinks.start_to_folder(stream_clicks.user_profiles(logs), str(tmp_path / "p"), str(tmp_path / "pc")))
    got = sinks.read_batches(spark, str(tmp_path / "p"))
    same(got, closed_before(got, profiles.user_profiles(static, window=profiles.WINDOW)))
    job = stream_clicks.user_paths(logs, 60 * MINUTE)
    finish(sinks.start_to_folder(job, str(tmp_path / "q"), str(tmp_path / "qc")))
    got = sinks.read_batches(spark, str(tmp_path / "q"))
    same(got, closed_before(got, paths.user_paths(static, 60 * MINUTE)))


@pytest.mark.parametrize(
    "job,keys", [(clicks.page_views, ["date", "page"]), (clicks.keyword_counts, ["word"]), (profiles.behaviours, ["user_id", "date", "time_slot"])]
)
def test_update_mode_table(spark, split, tmp_path, job, keys):
    """The last row per key over all micro-batches is the batch result."""
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    finish(sinks.start_to_folder(job(log_rows(stream(spark, split))), out, ck, mode="update"))
    assert len(list(Path(out, "log").glob("batch.*"))) >= FILES
    same(sinks.read_latest(spark, out, keys), job(log_rows(spark.read.parquet(split))))


DAILY = {
    "views": (clicks.page_views, ["date", "page"]),
    "users": (clicks.page_day_users, ["day", "page", "user_id"]),
    "words": (stream_clicks.daily_word_counts, ["day", "word"]),
    "behaviours": (profiles.behaviours, ["user_id", "date", "time_slot"]),
    "regions": (
        lambda rows, extra=None: clicks.address_counts(region_rows(rows), extra), ["date", "region_raw", "ip"]
    ),
}


@pytest.mark.parametrize("name", DAILY)
def test_daily_table_is_bounded(spark, split, tmp_path, name):
    """Past days leave the state, and batches behind a snapshot are not read any more."""
    job, keys = DAILY[name]
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stored = [stream_clicks.STATE_DAY, *keys]
    rows = stream_clicks.by_day(job, log_rows(stream(spark, split)))
    query = sinks.start_batches(rows, sinks.keyed_batches(out, stored, every=2), ck, mode="update")
    finish(query)
    want = job(log_rows(spark.read.parquet(split)))
    same(stream_clicks.over_days(sinks.read_latest(spark, out, stored), keys), want)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < want.count()
    assert sum(p["stateOperators"][0]["numRowsRemoved"] for p in query.recentProgress if p["stateOperators"]) > 0
    batches = query.lastProgress["batchId"] + 1
    log = sorted(p.name.rsplit(".", 1)[0] for p in Path(out, "log").iterdir() if not p.name.startswith("."))
    last = (batches // 2) * 2 - 1
    assert log == sorted([f"snapshot.{last}", f"snapshot.{last - 2}"] + [f"batch.{k}" for k in range(last - 1, batches)])
    assert len([p for p in Path(out, "data").iterdir()]) == len(log)


@pytest.mark.parametrize(
    "job", [clicks.top_keywords, clicks.platform_share, clicks.region_logins, clicks.page_view_reach, paths.live_monitor]
)
def test_complete_mode(spark, split, tmp_path, job):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    with_region = lambda df: log_rows(df).withColumn("region", F.concat(F.lit("r"), F.col("user_id").cast("int") % 5))
    finish(sinks.start_to_folder(job(with_region(stream(spark, split))), out, ck, mode="complete"))
    same(sinks.latest_batch(spark, out), job(with_region(spark.read.parquet(split))))


def test_late_rows_are_dropped(spark, split, tmp_path):
    """A row whose window has been given out changes neither that window nor later ones."""
    home = tmp_path / "in"
    rows = spark.read.parquet(split)
    late = rows.where("event_type = 'purchase' and ts < timestamp_ntz'2024-01-01 06:00:00'")
    first, second = F.expr("timestamp_ntz'2024-01-02 00:00:00'"), F.expr("timestamp_ntz'2024-01-03 00:00:00'")
    for part in (
        rows.where(F.col("ts") < first),
        rows.where((F.col("ts") >= first) & (F.col("ts") < second)),
        rows.where(F.col("ts") >= second).unionByName(late),
    ):
        part.coalesce(1).write.mode("append").parquet(str(home))
    for name, (slices, windows, batch) in CUMULATIVE.items():
        out, ck = str(tmp_path / name), str(tmp_path / f"{name}-ck")
        query = sinks.start_to_folder(slices(order_rows(stream(spark, str(home)))), out, ck)
        finish(query)
        got = windows(sinks.read_batches(spark, out), until=closed_until(query))
        same(got, closed_before(got, batch(order_rows(rows))))


@pytest.mark.parametrize("name", CUMULATIVE)
def test_quiet_stretches(spark, tmp_path, name):
    """Windows of hours without any row come as soon as the watermark has passed them."""
    minutes = [[1, 2], [185, 186], [187], [190 + 24 * 60]]
    home = str(tmp_path / "in")
    for k, batch in enumerate(minutes):
        rows = [(f"{k}-{m}", "p", str(m % 4), f"{m}.50", 1_761_494_400_000 + m * 60_000) for m in batch]
        df = spark.createDataFrame(rows, "id string, product_id string, sale_num string, total_amount string, ms bigint")
        df.coalesce(1).write.mode("append").parquet(home)
    schema = spark.read.parquet(home).schema
    timed = lambda df: df.withColumn("ts_ms", F.timestamp_millis("ms")).drop("ms")
    slices, windows, batch = CUMULATIVE[name]
    given = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(home)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    query = sinks.start_to_folder(slices(timed(given)), out, ck)
    finish(query)
    got = windows(sinks.read_batches(spark, out), until=closed_until(query))
    want = batch(timed(spark.read.parquet(home)))
    # the last order lies at 03:10 of the next day: all windows of the first day have closed
    last = "2025-10-28 03:00:00"
    same(got, want.where(F.col("window_end").cast("string") <= last))
    assert got.count() == 144


def test_alerts_console_and_memory(spark, split, tmp_path):
    job = paths.purchase_alerts(log_rows(stream(spark, split))).select("user_id", "log_id")
    finish(sinks.start_memory(job, "alerts", str(tmp_path / "ck1")))
    want = paths.purchase_alerts(log_rows(spark.read.parquet(split))).select("user_id", "log_id")
    same(spark.table("alerts"), want)
    finish(sinks.start_console(job.where("user_id = 'nobody'"), str(tmp_path / "ck2")))


def test_enrichment_and_load_on_a_stream(spark, split, folder, tmp_path):
    """Parsing, address lookup against a static table, and a JSON-path load."""
    ranges = ip_ranges(spark, folder)

    def enriched(rows):
        return geo.enrich_logs(parse_json(raw_log_text(rows), RAW_LOG), ranges)

    def loaded(rows):
        text = enriched(rows).select(F.to_json(F.struct(F.col("plat").alias("system"), "brand", "model")).alias("value"))
        return sinks.load_json(text, sinks.DEVICES).drop("proc_time")

    for name, job in {"enriched": enriched, "loaded": loaded}.items():
        out = str(tmp_path / name)
        finish(sinks.start_to_folder(job(stream(spark, split)), out, f"{out}-ck"))
        same(sinks.read_batches(spark, out), job(spark.read.parquet(split)))


def test_bounds_are_local(spark, split):
    rows = stream_orders.window_sales(order_rows(stream(spark, split)))
    assert [dict(rows.dtypes)[b] for b in BOUNDS] == ["timestamp_ntz"] * 2


def test_days_told_apart(spark):
    """The last date is the current day; ties keep their rows, a row without a date is history."""
    rows = [("20250102", "CN|P|C|m", "1"), ("20250102", "CN|P|C|m", "1"), ("20250102", None, None), ("20250101", "CN|P||m", "1"), (None, "CN|P|C|m", "1")]
    counts = clicks.address_counts(spark.createDataFrame(rows, "date string, region_raw string, ip string"))
    got = {(r["date"], r["region_raw"]): (r["type"], r["count"], r["abnormal"]) for r in clicks.named_regions(clicks.days_told_apart(counts)).collect()}
    assert got == {
        ("20250102", "CN|P|C|m"): ("periodic", 2, False), ("20250102", None): ("periodic", 1, True),
        ("20250101", "CN|P||m"): ("history", 1, True), (None, "CN|P|C|m"): ("history", 1, False),
    }
    assert clicks.days_told_apart(counts.limit(0)).count() == 0


def test_messages_are_shared_by_the_cores(spark, tmp_path):
    """Batches of messages: as many as asked for, every row once, each batch in a file per core."""
    text = spark.range(4000).select(F.when(F.col("id") > 1, F.concat(F.lit("m"), "id")).alias("value"))
    seen = []

    def write(df, batch):
        seen.append((df.select(F.input_file_name()).distinct().count(), [r.value for r in df.collect()]))

    finish(sinks.start_batches(streams._as_files(text, 3), write, str(tmp_path / "checkpoint")))
    assert [n for n, _ in seen] == [max(spark.sparkContext.defaultParallelism, streams.LEAST_FILES)] * 3
    assert sorted(v or "" for _, rows in seen for v in rows) == sorted(["", "", *(f"m{i}" for i in range(2, 4000))])


@pytest.mark.parametrize("rows", [0, 1, 5])
def test_few_messages(spark, tmp_path, rows):
    text = spark.range(rows).select(F.col("id").cast("string").alias("value"))
    seen = []
    write = lambda df, batch: seen.extend(r.value for r in df.collect())
    finish(sinks.start_batches(streams._as_files(text, 3), write, str(tmp_path / "checkpoint")))
    assert sorted(seen) == [str(i) for i in range(rows)]
