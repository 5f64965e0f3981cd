import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators import geo
from tallyline.schema import ENRICHED_LOG, IP_RANGE, ORDER, RAW_LOG
from tallyline.sources import changes, sinks, tables, topics


def text(spark, *rows):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "value string")


def test_orders_skip_or_fail(spark):
    df = text(spark, {"id": "1", "ts": 1761500000, "total_amount": "5"}, "{broken", {"id": "2"})
    got = {r.id: (r.ts, r.ts_ms is None, r.total_amount) for r in topics.orders_from_json(df).collect()}
    assert got == {"1": (1761500000, False, "5"), "2": (None, True, None)}
    assert topics.unreadable(df, ORDER).first()[0] == 1
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        topics.orders_from_json(df, on_error="fail").collect()


def test_start_position():
    now = datetime(2025, 10, 29, 17, tzinfo=timezone.utc)  # already the 30th in the order zone
    assert topics.start_options("earliest") == {"startingOffsets": "earliest"}
    midnight = datetime(2025, 10, 29, 16, tzinfo=timezone.utc)
    assert topics.start_options("today", now=now) == {"startingTimestamp": str(int(midnight.timestamp() * 1000))}
    assert topics.start_options(now + timedelta(seconds=1)) == {"startingTimestamp": "1761757201000"}


def test_pace():
    assert topics.pace_options(max_rows=300_000) == {"maxOffsetsPerTrigger": "300000"}


def test_changes(spark):
    source = {"db": "d", "schema": "s", "table": "t"}
    df = text(
        spark,
        {"before": None, "after": {"id": 1, "name": "x", "op": "old"}, "source": source, "op": "c"},
        {"before": {"id": 1}, "after": None, "source": source, "op": "d"},
        {"source": source, "op": "u"},
        {"after": {"id": "seven"}, "source": {**source, "table": "u"}, "op": "r"},
    )
    flat = [r[0] for r in changes.flatten_changes(df).collect()]
    assert {"id": "1", "name": "x", "op": "c", "table_name": "d.s.t"} in flat and len(flat) == 2
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    rows = {tuple(r) for r in changes.flatten_changes(df, schema).collect()}
    assert rows == {(1, "x", "d.s.t", "c"), (None, None, "d.s.u", "r")}


def test_snapshot_then_changes(spark):
    source = {"db": "d", "schema": "s", "table": "t"}
    df = text(spark, {"after": {"id": 2}, "source": source, "op": "c"}, {"after": {"id": 9}, "source": {**source, "table": "x"}, "op": "c"})
    schema = T.StructType([T.StructField("id", T.LongType())])
    both = changes.snapshot_then_changes(spark.range(2), changes.flatten_changes(df, schema), "d.s.t")
    assert sorted(map(tuple, both.collect())) == [(0, "d.s.t", "r"), (1, "d.s.t", "r"), (2, "d.s.t", "c")]


def test_loads(spark):
    words = text(
        spark,
        {"day": "2025-11-05", "top10": [{"word": "a", "cnt": 3}, {"word": "b", "cnt": 2}], "emit_time": "2025-11-05 10:00:00"},
        {"day": "2025-11-06", "top10": []},
        {"day": "2025-11-07", "top10": [{"word": "c", "cnt": "x"}]},
    )
    got = {r.day: (r.word, r.cnt) for r in sinks.load_json(words, sinks.SEARCH_WORDS).collect()}
    assert got == {"2025-11-05": ("a", 3), "2025-11-06": (None, None), "2025-11-07": ("c", None)}
    assert sinks.load_json(words, sinks.SEARCH_WORDS).where("proc_time is null").count() == 0
    assert sinks.load_all_words(words).count() == 3
    devices = text(
        spark,
        {"system": "iOS", "brand": "Apple", "model": "m", "stat_date": "2025-11-05", "count": 7, "proc_time": "2025-11-05 01:00:00"},
        {"brand": None, "count": "many", "stat_date": "today"},
    )
    rows = sinks.load_json(devices, sinks.DEVICES).orderBy("platform").collect()
    assert (rows[1].platform, rows[1]["count"], str(rows[1].proc_time)) == ("iOS", 7, "2025-11-05 01:00:00")
    assert (rows[0].platform, rows[0].brand, rows[0]["count"], rows[0].stat_date) == (None, None, None, None)
    assert rows[0].proc_time is not None


def test_bucketed_table(spark):
    df = text(spark, {"day": "20251105", "page": "home", "pv": 1, "user_ids": '["1"]'})
    sinks.write_bucketed(sinks.load_json(df, sinks.PAGE_VIEWS), "views_bucketed", sinks.PAGE_VIEWS)
    info = {r[0]: r[1] for r in spark.sql("describe extended views_bucketed").collect()}
    assert info["Num Buckets"] == "8" and info["Bucket Columns"] == "[`day`]"
    assert spark.table("views_bucketed").first()["user_ids"] == '["1"]'


def test_copy_and_read_back(spark, folder, tmp_path):
    done = tables.copy_tables(["nation", "region"], lambda t: spark.read.parquet(f"{folder}/{t}.parquet"), str(tmp_path))
    assert [d.split("/")[-1] for d in done] == ["nation", "region"]
    assert tables.read_result(spark, done[0], "n_name").columns == ["n_name"]
    assert tables.read_result(spark, done[0]).count() == 25
    sinks.write_json(tables.read_result(spark, done[1]), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 5


def test_database_read_needs_bounds(spark):
    with pytest.raises(ValueError, match="bound"):
        tables.read_table(spark, {"url": "jdbc:none"}, "t", partition_column="id")


RANGES = [
    (16777216, 16777471, "中国", "福建", "福州"),  # 1.0.0.0/24
    (16777472, 33554431, "AU", "", ""),  # the rest of 1.0.0.0/8, over many prefixes
    (3232235776, 3232235780, "LAN", "p", ""),  # 192.168.1.0-4
]


def logs(spark):
    base = {"device": {"plat": "iOS", "brand": "iPhone", "model": "15"}, "network": {"net": "5g"}, "user_id": "u", "log_type": "login"}
    return topics.parse_json(
        text(
            spark,
            {**base, "log_id": "a", "gis": {"ip": "1.0.0.9"}, "ts": "1761500000", "keywords": '["x","y"]'},
            {**base, "log_id": "b", "gis": {"ip": "1.7.0.1"}, "ts": "1761500000000", "keywords": "bad"},
            {**base, "log_id": "c", "gis": {"ip": "192.168.1.5"}, "keywords": None},
            {**base, "log_id": "d", "gis": None, "ts": "later"},
            {**base, "log_id": "e", "gis": {"ip": "::1"}},
            {**base, "log_id": "f", "gis": {"ip": "192.168.1.4"}},
            {"log_id": "none", "ts": "1"},
        ),
        RAW_LOG,
    )


def test_enrichment(spark):
    ranges = spark.createDataFrame(RANGES, IP_RANGE)
    rows = geo.enrich_logs(logs(spark), ranges)
    assert rows.columns == ENRICHED_LOG.fieldNames()
    got = {r.log_id: r for r in rows.collect()}
    assert {k: r.region for k, r in got.items()} == {
        "a": "中国 福建 福州", "b": "AU", "c": "", "d": "", "e": "", "f": "LAN p",
    }
    assert got["a"].keywords == "x,y" and got["b"].keywords == "" and got["c"].keywords is None
    assert got["d"].formatted_time == "时间格式错误" and got["c"].formatted_time == "Invalid Time"
    assert got["a"].formatted_time == got["b"].formatted_time == "2025-10-26 17:33:20"
    assert got["d"].ip is None and got["a"].net == "5g" and got["a"].plat == "iOS"


ADDRESSES = [
    "1.0.0.9", "255.255.255.255", "256.0.0.1", "1.2.3", "01.2.3.4", "::", "::1", "1::", "fe80::1:2", "FE80:0:0:0:0:0:1:2", "2001:db8::ffff",
    "::ffff:1.0.0.9", "::FFFF:100:9", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8:9", "1::2::3", ":1", "1:", "12345::", "g::", "",
    None, "1:2:3:4:5:6:1.2.3.4", "::1.2.3.400", "fe80::1%eth0", "1:2:3:4:5:6:7:8::",
]


def test_address_keys(spark):
    import ipaddress

    def plain(text):
        try:
            n = ipaddress.ip_address(text)
        except ValueError:
            return None
        if "%" in text:
            return None  # of one machine only
        return f"{int(n) + (0xFFFF << 32 if n.version == 4 else 0):032x}"

    rows = spark.createDataFrame([(a,) for a in ADDRESSES], "ip string").select("ip", geo.ip_key("ip").alias("key")).collect()
    # leading zeros of dotted numbers are read as they always were
    assert {r.ip: r.key for r in rows} == {a: plain(a) if a != "01.2.3.4" else plain("1.2.3.4") for a in ADDRESSES}


def test_sweep_of_many_slices(spark):
    """One address with most rows, ranges over many slices, ends of ranges, gaps and both kinds of address."""
    import bisect
    import ipaddress

    n = F.col("id")
    v4 = F.concat_ws(".", F.lit("1"), n % 7, n * 31 % 256, n * 17 % 256)
    v6 = F.format_string("2001:db8:%x::%x", n % 5, n % 300)
    ip = F.when(n % 3 > 0, "1.0.0.9").when(n % 30 == 0, None).when(n % 2 == 0, v4).otherwise(v6)
    rows = spark.range(6000).select(n.cast("string").alias("log_id"), ip.alias("ip"), F.lit("clash").alias("hi"), F.lit("k").alias("_hi2"))
    spans = [("1.0.0.0", "1.0.0.9", "a"), ("1.0.0.10", "1.3.255.255", "b"), ("1.5.0.0", "1.6.77.0", "c"), ("2001:db8::", "2001:db8:2:ffff::", "d"), ("2001:db8:4::", "2001:db8:4::ff", "e")]
    ranges = spark.createDataFrame([(lo, hi, c, "", "") for lo, hi, c in spans], "lo string, hi string, country string, province string, city string")
    number = lambda t: (lambda a: int(a) + (0xFFFF << 32 if a.version == 4 else 0))(ipaddress.ip_address(t))
    lows = sorted((number(lo), number(hi), c) for lo, hi, c in spans)

    def plain(t):
        k = bisect.bisect_right(lows, (number(t), 1 << 130, "")) - 1 if t else -1
        return lows[k][2] if k >= 0 and number(t) <= lows[k][1] else ""

    got = geo.locate(rows, ranges)
    assert got.columns == [*rows.columns, "country", "province", "city"]
    found = got.collect()
    assert len(found) == 6000 and len({r.log_id for r in found}) == 6000
    assert all(r.country == plain(r.ip) for r in found)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert geo.locate(rows.limit(0), ranges).count() == 0 and geo.locate(rows, ranges.limit(0)).where("country <> ''").count() == 0


def test_enrichment_without_ranges(spark):
    assert {r.region for r in geo.enrich_logs(logs(spark)).collect()} == {""}
