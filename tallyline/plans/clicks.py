"""Clickstream results over all events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.times import MINUTE, epoch_date, epoch_text, time_slot
from tallyline.operators import clicks, geo, lines, paths, profiles
from tallyline.operators.windows import BOUNDS
from tallyline.plans.standins import LOGS_SQL, RANGES_SQL, ip_ranges, logs, raw_log_text, table
from tallyline.schema import RAW_LOG
from tallyline.sources.topics import parse_json

HOUR = 60 * MINUTE


def _over_logs(job, *then, **kwargs):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = job(logs(spark, folder), **kwargs)
        for step in then:
            df = step(df)
        return df

    return query


def _text_bounds(df: DataFrame) -> DataFrame:
    return df.withColumns({b: F.col(b).cast("string") for b in BOUNDS})


def located_logs(spark: SparkSession, folder: str) -> DataFrame:
    return geo.locate(logs(spark, folder), ip_ranges(spark, folder)).withColumn(
        "region", geo.region_text("country", "province", "city")
    )


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    raw = parse_json(raw_log_text(table(spark, folder, "events")), RAW_LOG)
    rows = geo.enrich_logs(raw, ip_ranges(spark, folder))
    return rows.select(
        "log_id", "plat", "brand", "ip", "net", "log_type", "formatted_time", "user_id", "keywords", "region"
    )


def region_logins(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.region_logins(located_logs(spark, folder))


def part_words(spark: SparkSession, folder: str) -> DataFrame:
    """Part names of all line items as search words of their ship dates."""
    items, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    return items.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_shipdate").cast("string").alias("formatted_time"),
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("keywords"),
    )


def item_keywords(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.top_keywords(part_words(spark, folder))


def item_daily_words(spark: SparkSession, folder: str) -> DataFrame:
    words = clicks.daily_top_words(part_words(spark, folder))
    text = F.array_join(F.transform("top10", lambda e: F.concat(e["word"], F.lit(":"), e["cnt"])), " ")
    return words.select("day", text.alias("top10"))


def drill_down(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and their balance by region, nation and segment, with all subtotals."""
    customer, nation, region = (table(spark, folder, t) for t in ("customer", "nation", "region"))
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return clicks.region_drill_down(
        rows.select(
            F.col("r_name").alias("country"), F.col("n_name").alias("province"),
            F.col("c_mktsegment").alias("city"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        ),
        ["country", "province", "city"],
        {"customers": F.lit(1), "balance": F.col("balance")},
    ).withColumn("balance", F.col("balance").cast("decimal(38,2)"))


def region_rows(rows: DataFrame) -> DataFrame:
    """Log rows with a date and a region text of their user."""
    level = F.col("user_id").cast("int")
    text = F.concat(
        F.lit("CN|P"), level % 5, F.lit("|"), F.when(level % 4 == 0, "").otherwise(F.concat(F.lit("C"), level % 6)),
        F.lit("|"), F.when(level % 2 == 0, "mobile").otherwise("fixed"),
    )
    day = F.replace(F.split_part("formatted_time", F.lit(" "), F.lit(1)), F.lit("-"), F.lit(""))
    return rows.withColumns({"date": day, "region_raw": text})


def region_counts(spark: SparkSession, folder: str) -> DataFrame:
    """History and current day (the last one) with their region levels."""
    flat = region_rows(logs(spark, folder)).select("date", "region_raw", "ip")
    last = flat.agg(F.max("date")).scalar()
    # rows without a date belong to the history
    both = clicks.with_history(
        flat.where(F.col("date").isNull() | (F.col("date") < last)), flat.where(F.col("date") == last)
    )
    return clicks.region_counts(both)


def profile_rows(df: DataFrame) -> DataFrame:
    lists = {c: F.array_join(c, ",") for c in ("login_dates", "login_time_slots")}
    return df.withColumns(lists)


def windowed_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return _text_bounds(profile_rows(profiles.user_profiles(logs(spark, folder), window=profiles.WINDOW)))


def path_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("path", F.array_join("path", paths.ARROW))


def windowed_paths(window: int, at_least: int):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = paths.user_paths(logs(spark, folder), window=window)
        return path_rows(_text_bounds(paths.longer_paths(rows, at_least)))

    return query


def time_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Events per time of day, with the UTC date taken from the epoch."""
    rows = logs(spark, folder)
    return rows.groupBy(epoch_date("ts").alias("date"), time_slot(epoch_text("ts")).alias("slot")).agg(
        F.count("*").alias("cnt")
    )


def sequence_checks(spark: SparkSession, folder: str) -> DataFrame:
    return paths.sequence_flags(logs(spark, folder)).groupBy(
        "start_page", "end_page", "has_search", "has_product_detail", "has_payment"
    ).agg(F.count("*").alias("cnt"))


def report_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The readable lines of the click results, each with the name of its report."""
    rows = logs(spark, folder)
    reports = {
        "page_views": lines.page_view_lines(clicks.page_views(rows)),
        "keywords": lines.keyword_lines(clicks.top_keywords(rows)),
        "devices": lines.device_lines(clicks.device_counts(rows)),
        "slots": lines.slot_lines(profiles.users_per_slot(rows)),
    }
    named = [df.select(F.lit(name).alias("report"), "line") for name, df in reports.items()]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


def period_users(sketches: DataFrame, days: int) -> DataFrame:
    return clicks.users_of_periods(sketches, days).withColumn("date", F.col("date").cast("string"))


def path_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = logs(spark, folder)
    return lines.path_statistics_lines(
        paths.top_path_patterns(rows), paths.path_conversions(paths.path_metrics(rows)),
        paths.pattern_lengths(paths.pattern_digests(rows)),
    )


QUERIES = {
    "report_lines": report_lines,
    "path_report": path_report,
    "page_views": _over_logs(clicks.page_views),
    "keyword_counts": _over_logs(clicks.keyword_counts),
    "top_keywords": _over_logs(clicks.top_keywords),
    "item_top_keywords": item_keywords,
    "item_daily_top_words": item_daily_words,
    "region_logins": region_logins,
    "device_counts": _over_logs(clicks.device_counts),
    "platform_share": _over_logs(clicks.platform_share),
    "top_brands": _over_logs(clicks.top_brands),
    "device_models": _over_logs(clicks.device_models, lambda d: d.withColumn("stat_date", F.col("stat_date").cast("string"))),
    "time_of_day": time_labels,
    "enriched_logs": enriched,
    "region_counts": region_counts,
    "region_drill_down": drill_down,
    "user_profiles": _over_logs(profiles.user_profiles, profile_rows),
    "user_profiles_windowed": windowed_profiles,
    "user_summary": _over_logs(profiles.user_summary),
    "users_per_slot": _over_logs(profiles.users_per_slot),
    "user_paths": _over_logs(paths.user_paths, path_rows),
    "user_paths_windowed": windowed_paths(2 * HOUR, 2),
    "user_paths_two_minutes": windowed_paths(paths.WINDOW, 1),  # few events share two minutes
    "user_path_steps": _over_logs(paths.path_positions),
    "path_metrics": _over_logs(paths.path_metrics),
    "path_sequence_metrics": sequence_checks,
    "path_patterns": _over_logs(paths.path_patterns),
    "top_path_patterns": _over_logs(paths.top_path_patterns),
    "path_pattern_lengths": _over_logs(paths.pattern_digests, paths.pattern_lengths),
    "path_conversions": _over_logs(paths.path_metrics, paths.path_conversions),
    "live_monitor": _over_logs(paths.live_monitor),
    "purchase_alerts": _over_logs(paths.purchase_alerts),
    "page_view_users": _over_logs(clicks.page_view_users),
    "page_users_week": _over_logs(clicks.user_sketches, lambda d: period_users(d, 7)),
    "page_users_month": _over_logs(clicks.user_sketches, lambda d: period_users(d, 30)),
    "page_day_users": _over_logs(clicks.page_day_users),
}

_L = f"WITH {LOGS_SQL}"
_PLATFORM = """CASE WHEN lower(plat) LIKE '%iphone%' OR lower(plat) LIKE '%ios%' THEN 'iOS'
                    WHEN lower(plat) LIKE '%android%' THEN 'Android' ELSE 'unknown' END"""
_BRAND = """CASE WHEN brand IS NULL THEN 'unknown' WHEN lower(brand) LIKE '%iphone%' THEN 'Apple'
                 WHEN lower(brand) LIKE '%huawei%' THEN 'Huawei' WHEN lower(brand) LIKE '%honor%' THEN 'Honor'
                 WHEN lower(brand) LIKE '%mi%' THEN 'Xiaomi' WHEN lower(brand) LIKE '%oppo%' THEN 'OPPO'
                 WHEN lower(brand) LIKE '%vivo%' THEN 'Vivo' WHEN lower(brand) LIKE '%samsung%' THEN 'Samsung'
                 WHEN lower(brand) LIKE '%realme%' THEN 'Realme' ELSE 'Other' END"""
_SLOT = """CASE WHEN hour < 6 THEN '凌晨(0-6点)' WHEN hour < 9 THEN '早晨(6-9点)' WHEN hour < 12 THEN '上午(9-12点)'
                WHEN hour < 14 THEN '中午(12-14点)' WHEN hour < 18 THEN '下午(14-18点)'
                WHEN hour < 22 THEN '晚上(18-22点)' ELSE '深夜(22-24点)' END"""
_WORDS = f"""{_L}, w AS (SELECT trim(unnest(string_split(replace(keywords, '，', ','), ','))) AS word FROM l),
    n AS (SELECT word, count(*) AS cnt FROM w WHERE word <> '' GROUP BY 1)"""
_ITEM_WORDS = """WITH w AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, unnest(string_split(p_name, ' ')) AS word
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_DEVICE = f"""{_L}, d AS (SELECT day AS date, {_PLATFORM} AS platform, {_BRAND} AS b FROM l),
    known AS (SELECT * FROM d WHERE platform <> 'unknown')"""
_PROFILE = f"""string_agg(DISTINCT day, ',' ORDER BY day) AS login_dates,
    string_agg(DISTINCT {_SLOT}, ',' ORDER BY {_SLOT}) AS login_time_slots,
    bool_or(log_type = 'payment') AS has_purchase, bool_or(log_type = 'search') AS has_search,
    bool_or(log_type IN ('product_list', 'product_detail', 'home')) AS has_browse,
    count(DISTINCT day) AS login_days"""
_STEPS = f"{_L}, s AS (SELECT *, ms AS tm, log_type AS page FROM l WHERE log_type <> 'error')"
_METRICS = """count(*) AS path_length, bool_or(page = 'payment') AS has_purchase,
    bool_or(page = 'search') AS has_search, arg_min(page, row(tm, log_id)) AS start_page,
    arg_max(page, row(tm, log_id)) AS end_page, min(tm) AS start_time, max(tm) AS end_time,
    max(tm) - min(tm) AS duration"""
_PATH = "string_agg(page, '->' ORDER BY tm, log_id)"
_PATTERNS = f"""{_STEPS}, p AS (SELECT user_id, day, {_PATH} AS pattern, count(*) AS path_length FROM s GROUP BY 1, 2),
    pat AS (SELECT pattern, path_length, count(*) AS cnt FROM p WHERE path_length >= 2 GROUP BY 1, 2)"""


def _period_users_sql(days: int) -> str:
    return f"""{_L},
        d AS (SELECT DISTINCT log_type AS page, CAST(day AS DATE) AS date FROM l),
        x AS (SELECT d.page, d.date, l.user_id, count(*) FILTER (WHERE CAST(l.day AS DATE) > d.date - {days}) AS pv,
                     bool_or(CAST(l.day AS DATE) > d.date - {days}) AS now, bool_or(CAST(l.day AS DATE) <= d.date - {days}) AS before
              FROM d JOIN l ON l.log_type = d.page AND CAST(l.day AS DATE) BETWEEN d.date - {2 * days - 1} AND d.date GROUP BY 1, 2, 3)
        SELECT page, CAST(date AS VARCHAR) AS date, CAST(sum(pv) AS BIGINT) AS pv, count(user_id) FILTER (WHERE now) AS users,
               count(user_id) FILTER (WHERE now AND before) AS returning FROM x GROUP BY 1, 2"""


def _windowed_paths_sql(size: str, at_least: int) -> str:
    return f"""{_STEPS}, x AS (SELECT *, time_bucket(INTERVAL {size}, ts) AS ws FROM s)
        SELECT user_id, day AS date, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(ws + INTERVAL {size}, '%Y-%m-%d %H:%M:%S') AS window_end, CAST(0 AS BIGINT) AS part,
               {_PATH} AS path, {_METRICS} FROM x GROUP BY user_id, day, ws HAVING count(*) >= {at_least}"""


SQL = {
    "page_views": f"{_L} SELECT day AS date, log_type AS page, count(*) AS pv FROM l GROUP BY 1, 2",
    "keyword_counts": f"{_WORDS} SELECT word, cnt FROM n",
    "top_keywords": f"{_WORDS} SELECT word, cnt FROM n ORDER BY cnt DESC, word LIMIT 10",
    "item_top_keywords": f"{_ITEM_WORDS} SELECT word, count(*) AS cnt FROM w GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "item_daily_top_words": f"""{_ITEM_WORDS},
        n AS (SELECT day, word, count(*) AS cnt FROM w GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY cnt DESC, word) AS rn FROM n)
        SELECT day, string_agg(word || ':' || cnt, ' ' ORDER BY rn) AS top10 FROM r WHERE rn <= 10 GROUP BY 1""",
    "region_logins": f"""{_L}, {RANGES_SQL}
        SELECT region, count(*) AS cnt FROM located WHERE log_type = 'login' AND region <> '' GROUP BY 1""",
    "device_counts": f"""{_DEVICE},
        x AS (SELECT date, unnest([platform, b]) AS category FROM known)
        SELECT date, category, count(*) AS cnt FROM x
        WHERE category IN ('iOS', 'Android', 'Apple', 'Huawei', 'Xiaomi', 'OPPO', 'Vivo', 'Samsung') GROUP BY 1, 2""",
    "platform_share": f"""{_DEVICE}, n AS (SELECT count(*) FILTER (WHERE platform = 'iOS') AS i,
        count(*) FILTER (WHERE platform = 'Android') AS a FROM known)
        SELECT i AS ios_count, a AS android_count, CAST(i * 100 AS DOUBLE) / (i + a) AS ios_percent,
               CAST(a * 100 AS DOUBLE) / (i + a) AS android_percent FROM n""",
    "top_brands": f"{_DEVICE} SELECT b AS brand, count(*) AS cnt FROM known GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "device_models": f"""{_L} SELECT {_PLATFORM} AS platform, brand, model, day AS stat_date, count(*) AS count
        FROM l GROUP BY ALL""",
    "time_of_day": f"{_L} SELECT day AS date, {_SLOT} AS slot, count(*) AS cnt FROM l GROUP BY 1, 2",
    "enriched_logs": f"""{_L}, {RANGES_SQL}
        SELECT log_id, plat, brand, ip, 'wifi' AS net, log_type, day || ' ' || clock AS formatted_time, user_id,
               'kw' || (CAST(product_id AS INTEGER) % 40) || ',kw' || (event_id % 7) || ',' AS keywords, region
        FROM located WHERE event_id % 50 <> 0 AND event_id % 60 <> 7""",
    "region_counts": f"""{_L},
        x AS (SELECT replace(day, '-', '') AS date, uid % 5 AS a, uid % 4 = 0 AS none, uid % 6 AS c,
                     CASE WHEN uid % 2 = 0 THEN 'mobile' ELSE 'fixed' END AS operator, ip FROM l),
        y AS (SELECT *, 'P' || a || '|' || CASE WHEN none THEN '' ELSE 'C' || c END || '|' || operator AS region FROM x)
        SELECT date, region, 'P' || a AS province, CASE WHEN none THEN NULL ELSE 'C' || c END AS city,
               operator AS district, count(*) AS count, none AS abnormal, 'CN|' || region AS region_raw,
               CASE WHEN date = (SELECT max(date) FROM y) THEN 'periodic' ELSE 'history' END AS type, ip
        FROM y GROUP BY ALL""",
    "region_drill_down": """
        SELECT r_name AS country, n_name AS province, c_mktsegment AS city,
               grouping(r_name, n_name, c_mktsegment) AS level_mask, count(*) AS customers,
               sum(CAST(c_acctbal AS DECIMAL(18,2))) AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY ROLLUP (r_name, n_name, c_mktsegment)""",
    "user_profiles": f"{_L} SELECT user_id, {_PROFILE} FROM l GROUP BY 1",
    "user_profiles_windowed": f"""{_L}
        SELECT user_id, strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
               {_PROFILE} FROM l GROUP BY 1, 2, 3""",
    "user_summary": f"""{_L}, u AS (SELECT user_id, {_PROFILE} FROM l GROUP BY 1)
        SELECT count(*) AS total_users, count(*) FILTER (WHERE has_purchase) AS purchase_users,
               count(*) FILTER (WHERE has_search) AS search_users, count(*) FILTER (WHERE has_browse) AS browse_users,
               CAST(count(*) FILTER (WHERE has_purchase) * 100 AS DOUBLE) / count(*) AS purchase_percent,
               CAST(count(*) FILTER (WHERE has_search) * 100 AS DOUBLE) / count(*) AS search_percent,
               CAST(count(*) FILTER (WHERE has_browse) * 100 AS DOUBLE) / count(*) AS browse_percent,
               CAST(sum(login_days) AS DOUBLE) / count(*) AS avg_login_days FROM u""",
    "users_per_slot": f"{_L} SELECT {_SLOT} AS time_slot, count(DISTINCT user_id) AS users FROM l GROUP BY 1",
    "user_paths": f"""{_STEPS}
        SELECT user_id, day AS date, CAST(0 AS BIGINT) AS part, {_PATH} AS path, {_METRICS} FROM s GROUP BY 1, 2""",
    "user_paths_windowed": _windowed_paths_sql("2 HOUR", 2),
    "user_paths_two_minutes": _windowed_paths_sql("2 MINUTE", 1),
    "user_path_steps": f"""{_STEPS}
        SELECT user_id, day AS date, row_number() OVER (PARTITION BY user_id, day ORDER BY tm, log_id) - 1 AS position,
               page, tm AS "at", log_id FROM s""",
    "path_metrics": f"{_STEPS} SELECT user_id, day AS date, {_METRICS} FROM s GROUP BY 1, 2",
    "path_sequence_metrics": f"""{_STEPS},
        p AS (SELECT {_METRICS}, bool_or(page = 'product_detail') AS has_product_detail FROM s GROUP BY user_id, day)
        SELECT start_page, end_page, has_search, has_product_detail, has_purchase AS has_payment, count(*) AS cnt
        FROM p GROUP BY ALL""",
    "path_patterns": f"{_PATTERNS} SELECT * FROM pat",
    "top_path_patterns": f"{_PATTERNS} SELECT * FROM pat ORDER BY cnt DESC, pattern LIMIT 5",
    "path_pattern_lengths": f"""{_PATTERNS}
        SELECT CAST(sum(path_length) AS DOUBLE) / count(*) AS avg_path_length,
               CAST(sum(path_length * cnt) AS DOUBLE) / sum(cnt) AS weighted_path_length FROM pat""",
    "path_conversions": f"""{_STEPS}, p AS (SELECT {_METRICS} FROM s GROUP BY user_id, day)
        SELECT count(*) FILTER (WHERE has_purchase) AS conversion_paths,
               count(*) FILTER (WHERE has_purchase AND end_page = 'payment') AS payment_end_paths
        FROM p WHERE path_length >= 2""",
    "live_monitor": f"""{_STEPS}
        SELECT count(*) AS path_count, arg_max(user_id, row(tm, log_id)) AS user_id,
               arg_max(page, row(tm, log_id)) AS page FROM s""",
    "purchase_alerts": f"{_STEPS} SELECT user_id, day AS date, tm AS \"at\", log_id, "
        "'🔥 转化路径提醒 - 用户' || user_id || '完成购买，路径: payment' AS line FROM s WHERE page = 'payment'",
    "page_day_users": f"""{_L}
        SELECT replace(day, '-', '') AS day, log_type AS page, user_id, count(*) AS pv FROM l
        GROUP BY l.day, log_type, user_id""",
    "page_users_week": _period_users_sql(7),
    "page_users_month": _period_users_sql(30),
    "page_view_users": f"""{_L}
        SELECT replace(day, '-', '') AS day, log_type AS page, CAST(0 AS BIGINT) AS part, count(*) AS pv,
               count(DISTINCT user_id) AS users,
               '["' || string_agg(DISTINCT user_id, '","' ORDER BY user_id) || '"]' AS user_ids
        FROM l GROUP BY l.day, log_type""",
}

# The output texts, as in operators.lines and operators.paths.
SQL |= {
    "report_lines": f"""
        SELECT 'page_views' AS report, printf('日期: %s, 页面: %s, PV: %d', date, page, pv) AS line FROM ({SQL["page_views"]})
        UNION ALL SELECT 'keywords', printf('搜索词: %s, 次数: %d', word, cnt) FROM ({SQL["top_keywords"]})
        UNION ALL SELECT 'devices', printf('设备统计 - 日期: %s, 类型: %s, 数量: %d', date, category, cnt) FROM ({SQL["device_counts"]})
        UNION ALL SELECT 'slots', printf('  %s: %d用户', time_slot, users) FROM ({SQL["users_per_slot"]})""",
    "path_report": f"""
        SELECT E'\\n=== 路径分析统计 ===\\n最常见路径TOP5:\\n'
               || (SELECT string_agg('  ' || pattern || ': ' || cnt || E'次\\n', '' ORDER BY cnt DESC, pattern) FROM ({SQL["top_path_patterns"]}))
               || E'转化统计:\\n' || CASE WHEN conversion_paths > 0 THEN '  总转化路径: ' || conversion_paths || E'\\n' ELSE '' END
               || CASE WHEN payment_end_paths > 0 THEN '  支付结束路径: ' || payment_end_paths || E'\\n' ELSE '' END
               || printf(E'平均路径长度: %.1f\\n', avg_path_length) || E'==================\\n' AS line
        FROM ({SQL["path_conversions"]}), ({SQL["path_pattern_lengths"]})""",
}
