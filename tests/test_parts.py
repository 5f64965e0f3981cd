"""Groups that are too big for one row: same content as one big group, in bounded parts."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyline.operators import clicks, orders, paths
from tallyline.operators.skew import number_rows
from tallyline.sources.topics import with_event_time

START = 1_761_500_000_000


@pytest.fixture(scope="module")
def logs(spark):
    """One user holds half of all rows."""
    n = F.col("id")
    rows = spark.range(3000).select(
        n.cast("string").alias("log_id"),
        F.when(n % 2 == 0, "hot").otherwise(F.concat(F.lit("u"), n % 300)).alias("user_id"),
        F.element_at(F.array(*[F.lit(p) for p in ("home", "search", "payment", "cart", "error")]), (n * 7 % 5 + 1).cast("int")).alias("log_type"),
        (F.lit(START) + n * 7919 % 3000 * 40).cast("string").alias("ts"),
        F.lit("2025-10-26 17:33:20").alias("formatted_time"),
    )
    return rows.persist()


def brute_paths(logs):
    steps = defaultdict(list)
    for r in logs.collect():
        if r.log_type != "error":
            steps[r.user_id].append((int(r.ts), r.log_id, r.log_type))
    return {u: [p for _, _, p in sorted(s)] for u, s in steps.items()}


@pytest.mark.parametrize("part_steps", [10, 100, 100_000])
def test_paths(logs, part_steps):
    parts, brute = defaultdict(dict), brute_paths(logs)
    for r in paths.user_paths(logs, part_steps=part_steps).collect():
        assert len(r.path) <= part_steps
        parts[r.user_id][r.part] = r.path
        assert r.path_length == len(brute[r.user_id])
        assert (r.start_page, r.end_page) == (brute[r.user_id][0], brute[r.user_id][-1])
    got = {u: [p for k in sorted(ps) for p in ps[k]] for u, ps in parts.items()}
    assert got == brute
    assert all(sorted(ps) == list(range(len(ps))) for ps in parts.values())


def test_patterns_in_parts(logs):
    """Equal long paths of two users stay one pattern."""
    twin = logs.where("user_id = 'hot'").withColumn("user_id", F.lit("twin"))
    both = logs.unionByName(twin)
    whole = {r.cnt for r in paths.path_patterns(both).where("path_length > 1000").collect()}
    parted = paths.path_patterns(both, part_steps=50).where("path_length > 1000").collect()
    assert whole == {2} and [r.cnt for r in parted] == [2]
    same = Counter({r.pattern: r.cnt for r in paths.path_patterns(both).collect()})
    assert same == Counter({r.pattern: r.cnt for r in paths.path_patterns(both, part_steps=50).collect()})


def test_windowed_paths(logs):
    whole = paths.user_paths(logs, window=paths.WINDOW)
    parted = paths.user_paths(logs, window=paths.WINDOW, part_steps=20)
    joined = parted.groupBy("user_id", "date", "window_start").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "path"))), lambda e: e["path"])).alias("path")
    )
    want = whole.select("user_id", "date", "window_start", "path")
    assert parted.where("part > 0").count() > 0
    assert want.exceptAll(joined).count() == 0 and joined.exceptAll(want).count() == 0


@pytest.mark.parametrize("part_rows", [7, 100, 10_000])
def test_page_users(logs, part_rows):
    rows = clicks.page_view_users(logs, part_rows).withColumn("ids", F.from_json("user_ids", "array<string>")).collect()
    got, pv, raw = defaultdict(list), Counter(), logs.collect()
    for r in rows:
        got[r.page] += r.ids
        pv[r.page] += r.pv
        assert r.users == len(r.ids) == len(set(r.ids))
    assert {p: sorted(i) for p, i in got.items()} == {
        p: sorted({x.user_id for x in raw if x.log_type == p}) for p in got
    }
    assert pv == Counter(x.log_type for x in raw)
    if part_rows == 10_000:
        assert {r.part for r in rows} == {0}


def test_long_forms(logs):
    """One row per step and per user hold what the lists hold."""
    steps = paths.path_positions(logs).collect()
    got = {u: [p for _, p in sorted((r.position, r.page) for r in steps if r.user_id == u)] for u in {r.user_id for r in steps}}
    assert got == brute_paths(logs)
    views = Counter()
    for r in clicks.page_day_users(logs).collect():
        views[r.page] += r.pv
    assert views == Counter(r.log_type for r in logs.collect())


def test_nothing_runs_before_the_result_is_asked_for(spark, logs, order_rows):
    logs.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building")
    try:
        paths.path_patterns(logs), clicks.page_view_users(logs), orders.cumulative_trace(order_rows)
        assert not tracker.getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_numbering(spark):
    rows = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"), (F.col("id") * 37 % 101).alias("t"), "id"
    )
    got = number_rows(rows, ["k"], "t", ["id"], 10, "pos").collect()
    for key in "ab":
        mine = sorted((r.t, r.id) for r in got if r.k == key)
        assert {(r.t, r.id): r.pos for r in got if r.k == key} == {x: i for i, x in enumerate(mine)}


@pytest.fixture(scope="module")
def order_rows(spark):
    """A third of the orders in one ten-minute slice."""
    n = F.col("id")
    minute = F.when(n % 3 == 0, n % 10).otherwise(n * 13 % 1000)
    return with_event_time(
        spark.range(900).select(
            n.cast("string").alias("id"), n.cast("string").alias("product_id"),
            F.lit("1").alias("sale_num"), F.when(n % 50 == 0, "abc").otherwise((n % 9 + 1).cast("string")).alias("total_amount"),
            (F.lit(1_761_494_400_000) + minute * 60_000 + n).cast("string").alias("ts"),
        )
    )


@pytest.mark.parametrize("part_rows", [5, 64, 10_000])
def test_trace(order_rows, part_rows):
    whole = {(r.window_start, r.window_end): r for r in orders.cumulative_trace(order_rows).collect()}
    parts = defaultdict(dict)
    for r in orders.cumulative_trace(order_rows, part_rows=part_rows).collect():
        key = (r.window_start, r.window_end)
        parts[key][r.part] = r.cumulative_process
        assert r.period_amount == whole[key].period_amount
        assert r.cumulative_process is None or r.cumulative_process.count("+") < part_rows
    assert set(parts) == set(whole)
    for key, row in whole.items():
        assert "+".join(t for _, t in sorted(parts[key].items()) if t) == row.cumulative_process


def test_trace_rows(order_rows):
    """The rows of a window, put together, are its trace and its amount."""
    rows = sorted(orders.trace_orders(order_rows).collect(), key=lambda r: (r.window_start, r.position))
    for w in orders.cumulative_trace(order_rows).collect():
        mine = [r for r in rows if r.window_start == w.window_start and r.window_end <= w.window_end]
        assert "+".join(f"{r.id}({r.amount})" for r in mine if r.amount is not None) == w.cumulative_process
        assert mine[-1].running_amount == w.period_amount


def test_lines(logs):
    from tallyline.operators import lines, profiles

    assert lines.page_view_lines(clicks.page_views(logs).where("page = 'home'")).first()[0] == "日期: 2025-10-26, 页面: home, PV: 600"
    share = clicks.platform_share(logs.withColumn("plat", F.expr("if(user_id = 'hot', 'ios', 'android')")))
    assert lines.platform_lines(share).first()[0] == "平台分布 - iOS: 1500 (50.00%), Android: 1500 (50.00%)"
    assert lines.user_summary_lines(profiles.user_summary(logs)).first()[0].startswith("总用户数: 151\n有购买行为用户: ")
    hot = profiles.profile_text(profiles.user_profiles(logs)).where("user_id = 'hot'").first().line
    assert hot == "用户ID: hot, 登录天数: 1天(2025-10-26), 购买: 是, 搜索: 是, 浏览: 是, 登录时段: 下午(14-18点)"
    path = paths.path_text(paths.user_paths(logs)).where("user_id = 'u1'").first().line
    assert path.startswith("用户路径 - 用户ID: u1, 日期: 2025-10-26, 路径: ")
    text = logs.limit(1).select(paths.sequence_text(F.array(F.lit("home"), F.lit("payment"))), paths.sequence_text(F.array()))
    assert text.first()[0] == "起始页: home, 结束页: payment, 搜索: 无, 商品详情: 无, 支付: 有" and text.first()[1] == "空路径"
