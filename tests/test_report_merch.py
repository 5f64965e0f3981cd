from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline.functions.times import DAY, MINUTE
from tallyline.operators import clicks, merch, orders, report
from tallyline.operators.windows import cumulate, hop
from tallyline.schema import WINDOW_RESULT
from tallyline.sources.topics import with_event_time

Q = Decimal


@pytest.fixture(scope="module")
def results(spark):
    def day(d, gmv, ids, end="23:50:00"):
        ds = datetime.fromisoformat(d).date()
        return ds, f"{d} 00:00:00", f"{d} {end}", Q(gmv), ids, ids

    rows = [
        day("2025-10-24", "10.00", "9", "10:00:00"),
        day("2025-10-24", "100.00", "1, 2,3"),
        day("2025-10-25", "150.00", "2,3,4,5,6"),
        day("2025-10-26", "0.00", None),  # no list: the day is not in the report
        day("2025-10-27", "0.00", "7,2"),
        day("2025-10-28", "30.00", "数据缺失"),
        day("2025-10-29", "60.00", "7,7,8"),
    ]
    return spark.createDataFrame(rows, WINDOW_RESULT)


def test_daily_report(spark, results):
    dim = spark.createDataFrame([("1", "one"), ("2", "two"), ("4", None), ("7", "seven")], "product_id string, product_desc string")
    rows = report.daily_report(results, dim).collect()
    assert [r.ds for r in rows] == ["2025-10-24", "2025-10-25", "2025-10-27", "2025-10-29"]
    assert [r.win_gmv for r in rows] == [Q("100.00"), Q("150.00"), Q("0.00"), Q("60.00")]
    assert [r.product_descs for r in rows] == ["one, two", "two", "seven, two", "seven, seven"]
    # The first day and a day after zero sales have no base; the rate looks at the previous row.
    assert [r.mon_rate for r in rows] == [None, "50.0%", "-100.0%", None]
    # The overlap looks at the previous calendar day: none for the 27th and 29th.
    assert [r.overlap_count for r in rows] == [0, 2, 0, 0]
    assert [r.top5_similarity for r in rows] == ["0.0%", "40.0%", "0.0%", "0.0%"]


def order(i, at, amount="1", num="1", product="p"):
    return str(i), product, num, amount, str(at)


@pytest.fixture(scope="module")
def few_orders(spark):
    midnight = 1_761_494_400  # 2025-10-27 00:00 in the order zone, in seconds
    rows = [
        order(1, midnight, "10.00", "2"),
        order(2, midnight * 1000 + 599_999, "20.00", "abc", " p\n"),
        order(3, midnight + 600, "5.55", "9", "q"),  # exactly on a bound: the next slice
        order(4, midnight * 1000 + DAY // 1000 - 1, "1.00", "5"),
        order(5, midnight * 1000 - 1, "7.00", "1"),  # the day before
        order(6, midnight + 60, "abc", "9"),
        order(7, midnight + 60, "", "9"),
        order(8, midnight + 60, None, None),
    ]
    return with_event_time(spark.createDataFrame(rows, "id string, product_id string, sale_num string, total_amount string, ts string"))


def by_end(df, column):
    return {str(r.window_end): r[column] for r in df.collect()}


def test_cumulative_sales_edges(few_orders):
    got = by_end(orders.cumulative_sales(few_orders, dates="2025-10-27"), "total_cumulative_amount")
    assert len(got) == 144
    assert got["2025-10-27 00:10:00"] == Q("30.00") and got["2025-10-27 00:20:00"] == Q("35.55")
    assert got["2025-10-27 23:50:00"] == Q("35.55") and got["2025-10-28 00:00:00"] == Q("36.55")


def test_top_rows_edges(few_orders):
    got = by_end(orders.cumulative_top_rows(few_orders, dates="2025-10-27"), "top5_ids")
    assert got["2025-10-27 00:10:00"] == "[6,1,2]"  # unreadable sale_num last
    assert got["2025-10-28 00:00:00"] == "[3,6,4,1,2]"


def test_trace_edges(few_orders):
    got = by_end(orders.cumulative_trace(few_orders, dates="2025-10-27"), "cumulative_process")
    assert got["2025-10-27 00:10:00"] == "1(10.00)+2(20.00)"


def test_tumbling_top_ids_edges(few_orders):
    got = by_end(orders.tumbling_top_ids(few_orders, dates="2025-10-27"), "top5_ids")
    assert got["2025-10-27 00:20:00"] == "3,,,,"


def test_product_gmv_is_strict_and_clean(few_orders):
    good = few_orders.where("id not in ('6', '7')")
    got = orders.cumulative_product_gmv(good, dates=["2025-10-27"]).where("window_end = '2025-10-27 00:20:00'").first()
    assert (got.win_gmv, got.top5_product_ids, str(got.ds)) == (Q("35.55"), "p,q", "2025-10-27")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        orders.cumulative_product_gmv(few_orders).collect()


@pytest.mark.parametrize("step,span", [(10, 1440), (7, 21), (60, 60)])
def test_cumulative_sums_equal_repeated_rows(spark, step, span):
    """Running sums per slice against every row repeated for each of its windows."""
    rows = spark.range(400).select(
        (F.col("id") * 7919 % 6000 * MINUTE).alias("at"), (F.col("id") % 3).cast("string").alias("k"), (F.col("id") % 11 - 3).alias("v")
    )
    from tallyline.operators.windows import cumulative_sums

    got = cumulative_sums(rows, "at", step * MINUTE, span * MINUTE, ["k"], {"v": F.col("v")})
    want = cumulate(rows, "at", step * MINUTE, span * MINUTE).groupBy("k", "window_start", "window_end").agg(F.sum("v").alias("v"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hop(spark):
    rows = spark.createDataFrame([(25,)], "at long")
    got = {(r.window_start, r.window_end) for r in hop(rows, "at", 30, 10).collect()}
    assert got == {(0, 30), (10, 40), (20, 50)}


def test_span_must_fit(spark):
    with pytest.raises(ValueError, match="multiple"):
        cumulate(spark.range(1), "id", 7, 10)


def detail(spark, kind, *rows):
    return merch.clean_details(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in merch.DETAILS[kind])), kind)


def test_product_summary_edges(spark):
    t = "2025-10-27 10:00:00"
    visits = detail(
        spark, "visits",
        ("u1", "p", "s", t, "购物车", "2", "5", "true", "pc"), ("u1", "p", "s", t, "购物车", "2", "5", "true", "pc"),
        (" u2 ", "p", "s", t, "手淘搜索", "1", "5", "false", "pc"), (None, "p", "s", t, "x", "1", "1", "true", "pc"),
    )
    favourites = detail(spark, "favourites", ("u1", "p", "s", t, "true", "pc"), ("u3", "only-fav", "s", t, "false", "pc"))
    carts = detail(spark, "carts", ("u1", "p", "s", t, "pc"), ("u1", "p", "s", t, "wireless"))
    bought = detail(
        spark, "orders",
        ("d1", "o1", "p", "2", "10.00", t, "u1", "s", "pc"), ("d2", "o1", "p", "1", "5.00", t, "u1", "s", "pc"),
        ("d3", "o2", "only-order", "1", "7.50", t, "u9", "s", "pc"), ("d4", "o3", "p", "x", "1", "never", "u1", "s", "pc"),
    )
    got = {r.product_id: r for r in merch.product_result(merch.user_activity(visits, favourites, carts, bought), bought).collect()}
    p = got["p"]
    assert (p.visitor_count, p.pv, p.bounce_rate, p.favorite_count, p.cart_count) == (2, 3, 0.5, 0, 1)
    assert (p.order_count, p.buyer_count, p.pay_amount, p.pay_quantity) == (1, 1, Q("25.00"), 3)
    assert (p.pay_new_buyer_count, p.pay_old_buyer_count, p.pay_conversion_rate, p.unit_price) == (1, 0, 0.5, 25.0)
    only = got["only-order"]
    assert (only.visitor_count, only.bounce_rate, only.pay_conversion_rate, only.buyer_count) == (0, None, None, 1)
    assert got["only-fav"].favorite_count == 1 and got["only-fav"].unit_price is None


def test_trailing_counts_users_once(spark):
    rows = spark.range(200).select(
        F.lit("s").alias("shop_id"), (F.col("id") % 2).cast("string").alias("product_id"),
        (F.col("id") * 31 % 7).cast("string").alias("user_id"),
        F.date_add(F.lit("2025-10-01").cast("date"), (F.col("id") * 17 % 23).cast("int")).cast("string").alias("ds"),
        (F.col("id") % 3 == 0).alias("visited"), F.lit(False).alias("clicked"), (F.col("id") % 4 == 0).alias("favourited"),
        F.lit(True).alias("carted"), (F.col("id") % 5 == 0).alias("paid"), F.lit(1).cast("bigint").alias("pv"),
        F.lit(0).cast("bigint").alias("order_count"), F.lit(1).cast("decimal(28,2)").alias("pay_amount"),
        F.lit(1).cast("bigint").alias("pay_quantity"),
    )
    keys = ["shop_id", "product_id", "ds", "user_id"]
    activity = rows.groupBy(*keys).agg(*[F.bool_or(f).alias(f) for f in merch.FLAGS], *[F.sum(s).alias(s) for s in merch.SUMS]).persist()
    raw = activity.collect()
    for days in (1, 5, 30):
        for r in merch.trailing_summary(activity, days).collect():
            last = datetime.fromisoformat(r.ds)
            held = [x for x in raw if x.product_id == r.product_id and 0 <= (last - datetime.fromisoformat(x.ds)).days < days]
            assert r.visitor_count == len({x.user_id for x in held if x.visited})
            assert r.favorite_count == len({x.user_id for x in held if x.favourited})
            assert (r.cart_count, r.pv) == (len({x.user_id for x in held}), sum(x.pv for x in held))
            buyers = {x.user_id for x in held if x.paid}
            before = (last - timedelta(days=days - 1)).date().isoformat()
            old = {x.user_id for x in raw if x.paid and x.product_id == r.product_id and x.ds < before}
            assert (r.buyer_count, r.pay_new_buyer_count, r.pay_old_buyer_count) == (len(buyers), len(buyers - old), len(buyers & old))


def test_touches_of_one_busy_user(spark):
    """All rows of one user and product, over many slices, against brute force."""
    n = F.col("id")
    time = F.expr("timestamp_ntz'2025-10-27 00:00:00' + make_dt_interval(0, 0, 0, cast(id * 7919 % 20000 as int))")
    rows = spark.range(1500).select("id", time.alias("t"), F.lit("u").alias("user_id"), F.lit("p").alias("product_id"))
    visits = rows.where(n % 5 > 0).select("user_id", "product_id", F.col("t").alias("visit_time"), F.concat(F.lit("c"), n % 4).alias("visit_reason"))
    bought = rows.where(n % 5 == 0).select("user_id", "product_id", F.col("t").alias("order_time"), n.cast("string").alias("order_detail_id"))
    got = {r.order_detail_id: (r.first_touch, r.last_touch) for r in merch.order_touches(visits, bought, 600).collect()}
    seen = [(r.visit_time, r.visit_reason) for r in visits.collect()]
    want = {}
    for r in bought.collect():
        before = [v for v in seen if v[0] <= r.order_time]
        want[r.order_detail_id] = (min(before)[1], max(before)[1]) if before else (None, None)
    assert got == want


def test_stock_days(spark):
    """Only the sales of the period count; no sales, no value."""
    sold = [("a", "2025-10-30", 40), ("a", "2025-10-01", 20), ("a", "2025-09-30", 500), ("a", "2025-10-31", 500), ("b", "2025-10-02", 0)]
    orders = spark.createDataFrame(sold, "sku_id string, ds string, quantity long")
    stock = spark.createDataFrame([("a", 10), ("b", 5), ("c", 5)], "sku_id string, current_stock long")
    got = merch.stock_days(orders, stock, 30, "2025-10-30").collect()
    assert {r.sku_id: r.stock_sale_days for r in got} == {"a": 5.0, "b": None, "c": None}


def test_cleaning_by_key(spark):
    t = "2025-10-27 10:00:00"
    rows = [("u1", "p", "s", t, "pc"), ("u1", "p", "s", t, "pc"), ("u1", "p", "s", t, "wireless"), ("u2", "p", "s", t, "pc")]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in merch.DETAILS["carts"]))
    assert merch.clean_details(raw, "carts").count() == 3
    assert merch.clean_details(raw, "carts", []).count() == 4
    kept = merch.clean_details(raw, "carts", ["user_id"]).collect()
    assert {(r.user_id, r.terminal_type) for r in kept} == {("u1", "wireless"), ("u2", "pc")}


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 9.99, 10.0, 50.0)], "v double")
    assert [r[0] for r in df.select(merch.band_label(F.col("v"), [0, 10, 50])).collect()] == ["<0", "[0,10)", "[0,10)", "[10,50)", ">=50"]


def test_incomplete_log_rows_are_counted(spark):
    df = spark.createDataFrame([("home", "2025-10-27 00:00:00"), (None, "2025-10-27 00:00:00"), ("home", None)], "log_type string, formatted_time string")
    assert tuple(clicks.incomplete_rows(df).first()) == (2, 3) and clicks.page_views(df).count() == 1


def test_web_fields(spark):
    from tallyline.operators import web

    listing = """<div class='fylb'><ul><li><a href="/info/1.htm">2025-10-27 关于&amp;通知</a></li>
        <li><a title=" 标题 " href="https://other.example.org/2.htm">x</a></li><li><a href="">none</a></li>
        <li><a href="/3.htm"><!-- x --></a></li></ul></div><ul><li><a href="/outside">no</a></li></ul>"""
    page = """<h1 align="center"> 通知 </h1><p class="xx">来源：教育部 <b>发布日期：2025-10-27</b> 阅读</p>
        <p>教基〔2025〕6号</p><div class="v_news_content"><p>第一 段</p><script>var a = "<p>";</script><p> 第二&nbsp;段 </p></div>"""
    pages = spark.createDataFrame([("list", listing), ("https://base.example.org/info/1.htm", page), ("empty", "<p></p>")], "url string, html string")
    links = web.page_links(pages, "https://base.example.org/", web.PageLayout())
    assert {(r.link, r.name) for r in links.collect()} == {
        ("https://base.example.org/info/1.htm", "关于&通知"), ("https://other.example.org/2.htm", "标题"),
    }
    rows = {r.link: r for r in web.merged_pages(links, web.page_fields(pages)).collect()}
    one = rows["https://base.example.org/info/1.htm"]
    assert (one.title, one.source, one.publish_dept, one.publish_date) == ("通知", "教育部", "教育部", "2025-10-27")
    assert (one.doc_number, one.content) == ("教基〔2025〕6号", "第一 段\n\n第二 段")
    assert rows["https://other.example.org/2.htm"].content == ""


def test_web_nesting(spark):
    """Footers, nested blocks, anchors anywhere in an entry, attribute names, letter case, references."""
    from tallyline.operators import web

    base = "https://base.example.org/"
    pages = {
        "nested": "<div class='fylb'><div><p>x</p></div><ul><li><a href='1'>one</a></li></ul></div>"
                  "<div class='fylb'><ul><li><span>new</span> <a href='2'>two</a><a href='3'>three</a></ul></div>"
                  "<ul><li><a href='4'>outside</a></li></ul>",
        "names": "<link rel='x'><DIV CLASS='fylb'><UL><LI><A data-href='no' data-title='no' HREF=5 title=''>&#20116;&#x4e94;</A></LI></UL></DIV>",
        "none": None, "empty": "", "odd": "<div class='fylb'><![if x]><ul><li><a href='6'>six<li><a href='7'>seven",
    }
    rows = spark.createDataFrame(list(pages.items()), "url string, html string")
    got = sorted((r.page_url, r.link.removeprefix(base), r.name) for r in web.page_links(rows, base, web.PageLayout()).collect())
    assert got == [
        ("names", "5", "五五"), ("nested", "1", "one"), ("nested", "2", "two"), ("nested", "3", "three"),
        ("odd", "6", "six"), ("odd", "7", "seven"),
    ]
    assert web.page_links(rows, base).where("name = 'outside'").count() == 1
    page = ("<h1>no</h1><h1 align=center>T</h1><div class=v_news_content><div>a</div>b</div><div>footer</div>"
            "<div class=v_news_content>again</div>")
    fields = web.page_fields(spark.createDataFrame([("p", page), ("n", None)], "url string, html string")).collect()
    by_url = {r.url: r for r in fields}
    assert (by_url["p"].title, by_url["p"].content) == ("T", "a\n\nb")
    assert set(by_url["n"][1:]) == {""}
