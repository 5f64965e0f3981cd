"""Readable lines of the click results, one text column ``line`` per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The texts below, with their labels and number formats.


def _line(df: DataFrame, form: str, *columns: str) -> DataFrame:
    return df.select(F.format_string(form, *[F.col(c) for c in columns]).alias("line"))


def page_view_lines(views: DataFrame) -> DataFrame:
    return _line(views, "日期: %s, 页面: %s, PV: %d", "date", "page", "pv")


def keyword_lines(words: DataFrame) -> DataFrame:
    return _line(words, "搜索词: %s, 次数: %d", "word", "cnt")


def region_lines(regions: DataFrame) -> DataFrame:
    return _line(regions, "地区: %s, 访问量: %d", "region", "cnt")


def device_lines(devices: DataFrame) -> DataFrame:
    return _line(devices, "设备统计 - 日期: %s, 类型: %s, 数量: %d", "date", "category", "cnt")


def platform_lines(share: DataFrame) -> DataFrame:
    return _line(
        share, "平台分布 - iOS: %d (%.2f%%), Android: %d (%.2f%%)",
        "ios_count", "ios_percent", "android_count", "android_percent",
    )


def user_summary_lines(summary: DataFrame) -> DataFrame:
    return _line(
        summary,
        "总用户数: %d\n有购买行为用户: %d (%.1f%%)\n有搜索行为用户: %d (%.1f%%)\n"
        "有浏览行为用户: %d (%.1f%%)\n平均登录天数: %.1f天",
        "total_users", "purchase_users", "purchase_percent", "search_users", "search_percent",
        "browse_users", "browse_percent", "avg_login_days",
    )


def slot_lines(slots: DataFrame) -> DataFrame:
    return _line(slots, "  %s: %d用户", "time_slot", "users")


def monitor_lines(monitor: DataFrame) -> DataFrame:
    return _line(
        monitor, "实时路径监控 - 总路径数: %d, 最新: 用户%s访问%s页面", "path_count", "user_id", "page"
    )


def path_statistics_lines(top: DataFrame, conversions: DataFrame, lengths: DataFrame) -> DataFrame:
    """The path report as one row: best patterns, conversion counts, mean length.

    Input: ``paths.top_patterns`` (at most a few rows), ``path_conversions`` and
    ``pattern_lengths``. Counts of zero and a missing mean have no line.
    """
    entry = F.struct((-F.col("cnt")).alias("order"), "pattern", F.format_string("  %s: %d次\n", "pattern", "cnt").alias("text"))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"])
    best = top.agg(F.array_join(listed, "").alias("_best"))
    count = lambda label, c: F.when(F.col(c) > 0, F.format_string(f"  {label}: %d\n", c)).otherwise("")
    counts = conversions.select(
        F.concat(count("总转化路径", "conversion_paths"), count("支付结束路径", "payment_end_paths")).alias("_counts")
    )
    average = F.col("avg_path_length").cast("double")
    mean = lengths.select(F.when(average.isNull(), "").otherwise(F.format_string("平均路径长度: %.1f\n", average)).alias("_mean"))
    one = F.lit(1).alias("_one")
    parts = [df.select("*", one) for df in (best, counts, mean)]
    row = parts[0].join(parts[1], "_one").join(parts[2], "_one")
    text = F.concat(
        F.lit("\n=== 路径分析统计 ===\n最常见路径TOP5:\n"), "_best", F.lit("转化统计:\n"), "_counts", "_mean", F.lit("==================\n")
    )
    return row.select(text.alias("line"))
