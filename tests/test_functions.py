from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyline.functions import text, times


def values(spark, expression, *inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_epoch_seconds_and_millis_are_the_same_instant(spark):
    got = values(spark, F.unix_millis(times.epoch_to_timestamp("c")), "1761500000", "1761500000000", "x", None)
    assert got == [1761500000000, 1761500000000, None, None]


def test_absurd_epochs_are_unreadable(spark):
    far = ["9223372036854775807", "-9223372036854775808", "99999999999999999", "-62135596801"]
    assert values(spark, F.unix_millis(times.epoch_to_timestamp("c")), *far) == [None] * 4


def test_epoch_text(spark):
    got = values(
        spark, times.epoch_text("c"), "1761500000", "1761500000.75", "1761500000000", "", None, "soon", "1e300"
    )
    day = "2025-10-26 17:33:20"
    assert got == [day, day, day, times.NO_TIME, times.NO_TIME, times.BAD_TIME, times.BAD_TIME]


def test_epoch_date(spark):
    assert values(spark, times.epoch_date("c"), "1761500000", "x", None) == ["2025-10-26", "unknown", "unknown"]


def test_thresholds_differ(spark):
    """5e11 is already milliseconds for orders but still seconds for logs."""
    order = values(spark, F.unix_millis(times.epoch_to_timestamp("c")), "500000000000")
    log = values(spark, times.log_epoch_millis("c"), "5000000000")
    assert order == [500000000000] and log == [5000000000000]


@pytest.mark.parametrize(
    "hour,label",
    [
        (0, "凌晨(0-6点)"), (5, "凌晨(0-6点)"), (6, "早晨(6-9点)"), (8, "早晨(6-9点)"), (9, "上午(9-12点)"),
        (11, "上午(9-12点)"), (12, "中午(12-14点)"), (13, "中午(12-14点)"), (14, "下午(14-18点)"),
        (17, "下午(14-18点)"), (18, "晚上(18-22点)"), (21, "晚上(18-22点)"), (22, "深夜(22-24点)"),
        (23, "深夜(22-24点)"),
    ],
)
def test_time_slot(spark, hour, label):
    assert values(spark, times.time_slot("c"), f"2025-10-27 {hour:02d}:59:59") == [label]


def test_time_slot_of_bad_text(spark):
    assert values(spark, times.time_slot("c"), times.NO_TIME, times.BAD_TIME, None, "x y") == ["未知时段"] * 4


def test_date_part(spark):
    assert values(spark, times.date_part_of("c"), "2025-10-27 01:02:03", None) == ["2025-10-27", "未知日期"]


def test_local_day_bounds(spark):
    """Local midnight in the order zone, whatever the session zone is."""
    first = datetime(2025, 10, 26, 16, tzinfo=timezone.utc)
    df = spark.createDataFrame([(int(first.timestamp() * 1000) + d,) for d in (-1, 0, 86_399_999, 86_400_000)], "ms long")
    df = df.withColumn("t", F.timestamp_millis("ms"))
    got = df.orderBy("ms").select(times.on_dates("t", "2025-10-27"), times.wall_date(times.wall_micros("t"))).collect()
    assert [r[0] for r in got] == [False, True, True, False]
    assert [r[1].isoformat() for r in got] == ["2025-10-26", "2025-10-27", "2025-10-27", "2025-10-28"]


def test_date_list_with_a_gap(spark):
    days = [date(2025, 10, 24), "2025-10-25", "2025-10-26", "2025-10-28"]
    df = spark.range(8).select(F.timestamp_seconds(F.lit(1761177600) + F.col("id") * 86400).alias("t"))
    kept = df.where(times.on_dates("t", days)).select(times.wall_date(times.wall_micros("t")).cast("string")).collect()
    assert sorted(r[0] for r in kept) == ["2025-10-24", "2025-10-25", "2025-10-26", "2025-10-28"]


def test_daylight_saving(spark):
    """A wall-clock day in a zone with clock changes."""
    df = spark.range(1).select(F.timestamp_seconds(F.lit(1743296400)).alias("t"))  # 2025-03-30 01:00 UTC
    got = df.select(times.wall_text(times.wall_micros("t", "Europe/Berlin"))).first()[0]
    assert got == "2025-03-30 03:00:00"


def test_previous_day(spark):
    assert values(spark, times.previous_day("c"), "2025-03-01", "x") == ["2025-02-28", None]


def test_parse_time(spark):
    got = values(spark, times.parse_time("c").cast("string"), "2025-10-27 10:20:00", "never")
    assert got == ["2025-10-27 10:20:00", None]


def test_parse_time_takes_one_form(spark):
    """What a cast would take as well is no report time; neither is a day or hour that does not exist."""
    others = ["2025-10-27", "2025-10-27T10:20:00", "2025-10-27 10:20", "2025-10-27 10:20:00.5", " 2025-10-27 10:20:00",
              "2025-10-27 10:20:00+08:00", "2025-1-7 1:2:3", "2025-02-30 10:20:00", "2025-10-27 24:20:00", "2025-10-27 10:20:00\n", "", None]
    assert values(spark, times.parse_time("c").cast("string"), *others) == [None] * len(others)
    assert values(spark, times.parse_time("c").cast("string"), "2024-02-29 23:59:59") == ["2024-02-29 23:59:59"]



def test_clean_id(spark):
    assert values(spark, text.clean_id("c"), " 12\n", "1\\n2 ", None) == ["12", "12", None]


def test_lenient_number(spark):
    got = values(spark, text.lenient_number("c", "decimal(10,2)").cast("string"), "1.005", "abc", "", None)
    assert got == ["1.01", None, None, None]


def test_json_words(spark):
    got = values(spark, text.json_words("c"), '["a","b"]', "[]", "nope", "", None)
    assert got == ["a,b", "", "", "", None]


def test_word_array(spark):
    got = values(spark, text.word_array("c"), "a, b，c", " ,，", "0x,1", None)
    assert got == [["a", "b", "c"], [], ["0x", "1"], None]


def test_platform(spark):
    got = values(spark, text.platform_label("c"), "iPhone 15", "iOS", "ANDROID", "Harmony", None)
    assert got == ["iOS", "iOS", "Android", "unknown", "unknown"]


def test_brand_order_matters(spark):
    given = ["iPhone", "HUAWEI", "honor", "Redmi", "mi", "OPPO", "vivo", "Samsung", "realme", "Nokia", None, "honor mi"]
    want = [
        "Apple", "Huawei", "Honor", "Xiaomi", "Xiaomi", "OPPO", "Vivo", "Samsung", "Realme", "Other", "unknown", "Honor",
    ]
    assert values(spark, text.brand_label("c"), *given) == want


def test_region(spark):
    df = spark.createDataFrame([("中国", "广西", "南宁"), ("中国", "", "南宁"), ("", None, "")], "a string, b string, c string")
    assert [r[0] for r in df.select(text.region_text("a", "b", "c")).collect()] == ["中国 广西 南宁", "中国 南宁", ""]


def test_region_parts(spark):
    df = spark.createDataFrame([("广西|南宁|电信",), ("广西",)], "c string")
    got = df.select(*[text.region_part("c", k) for k in (1, 2, 3)]).collect()
    assert [tuple(r) for r in got] == [("广西", "南宁", "电信"), ("广西", None, None)]


def test_percent_and_counts(spark):
    df = spark.createDataFrame([(2, 5), (1, 0)], "a int, b int")
    got = [r[0] for r in df.select(text.percent_text(text.ratio(F.col("a"), F.col("b")))).collect()]
    assert got == ["40.0%", None]
    assert values(spark, text.comma_count("c"), "1", "1,2,3") == [1, 3]


def test_key_pages(spark):
    assert values(spark, text.is_key_page("c"), "home", "error", None) == [True, False, False]


def test_zone_free_time_in_summer(spark):
    """The session zone has daylight saving; zone-free arithmetic must not see it."""
    df = spark.sql("select timestamp_ntz'2024-07-01 12:30:15.123456' t, timestamp_ntz'2024-03-10 02:30:00' gap")
    got = df.select(times.naive_micros("t"), times.naive_micros("gap"), times.wall_text(times.naive_micros("gap"))).first()
    base = datetime(1970, 1, 1)
    assert got[0] == (datetime(2024, 7, 1, 12, 30, 15, 123456) - base) // times.timedelta(microseconds=1)
    assert got[1] == (datetime(2024, 3, 10, 2, 30) - base) // times.timedelta(microseconds=1)
    assert got[2] == "2024-03-10 02:30:00"


@pytest.mark.parametrize(
    "text,name",
    [
        ("2024-01-01\n  Name one", "Name one"), ("\xa02024-01-01　Name\ttwo \n", "Name\ttwo"), ("2024-01-01", "2024-01-01"),
        ("\n plain name \x0b", "plain name"), ("   ", ""),
    ],
)
def test_names_of_dated_links(spark, text, name):
    from tallyline.operators.web import link_name

    got = spark.createDataFrame([("", text)], "title string, text string").select(link_name(F.col("title"), F.col("text"))).first()[0]
    assert got == name
