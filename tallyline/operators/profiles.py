"""User profiles: active dates, times of day and behaviour flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import BROWSE_PAGES, PURCHASE_PAGES, SEARCH_PAGES, ratio, yes_no
from tallyline.functions.times import MINUTE, date_part_of, floor_to, log_epoch_millis, time_slot
from tallyline.operators.windows import show_bounds

FLAGS = {"has_purchase": PURCHASE_PAGES, "has_search": SEARCH_PAGES, "has_browse": BROWSE_PAGES}
WINDOW = 5 * MINUTE


def behaviours(logs: DataFrame, login_only: bool = False, extra: list[str] | None = None) -> DataFrame:
    """One row per user, date and time of day with the behaviour flags.

    This is the reduced form that all profile results start from: its size does
    not depend on how many rows one user has. With ``login_only`` just login rows
    count as dates and times of day.
    """
    known = logs.where(
        F.col("user_id").isNotNull() & F.col("log_type").isNotNull() & F.col("formatted_time").isNotNull()
    )
    counts = (F.col("log_type") == "login") if login_only else F.lit(True)
    return known.groupBy(
        "user_id", *(extra or []),
        F.when(counts, date_part_of("formatted_time")).alias("date"),
        F.when(counts, time_slot("formatted_time")).alias("time_slot"),
    ).agg(*[F.bool_or(F.col("log_type").isin(pages)).alias(flag) for flag, pages in FLAGS.items()])


def user_profiles(logs: DataFrame, window: int | None = None, login_only: bool = False) -> DataFrame:
    """Profile per user, or per user and event-time window of the given size."""
    extra = []
    if window:
        at = log_epoch_millis("ts") * 1000
        logs = logs.withColumn("window_start", floor_to(at, window)).where(F.col("window_start").isNotNull())
        extra = ["window_start"]
    profiles = behaviours(logs, login_only, extra).groupBy("user_id", *extra).agg(
        F.array_sort(F.collect_set("date")).alias("login_dates"),
        F.array_sort(F.collect_set("time_slot")).alias("login_time_slots"),
        *[F.bool_or(flag).alias(flag) for flag in FLAGS],
    )
    profiles = profiles.withColumn("login_days", F.size("login_dates"))
    if window:
        return show_bounds(profiles.withColumn("window_end", F.col("window_start") + window))
    return profiles


def user_flags(logs: DataFrame) -> DataFrame:
    """Login days and flags per user, without the lists."""
    return _flags_of(behaviours(logs))


def _flags_of(rows: DataFrame) -> DataFrame:
    per_day = rows.groupBy("user_id", "date").agg(
        *[F.bool_or(flag).alias(flag) for flag in FLAGS]
    )
    return per_day.groupBy("user_id").agg(
        F.count("date").alias("login_days"), *[F.bool_or(flag).alias(flag) for flag in FLAGS]
    )


def user_summary(logs: DataFrame) -> DataFrame:
    """Users in total and with each behaviour, as count and percent, and mean login days."""
    return summary_of(behaviours(logs))


def summary_of(rows: DataFrame) -> DataFrame:
    """``user_summary`` from the rows of ``behaviours``, which a stream keeps as a table."""
    names = {"has_purchase": "purchase", "has_search": "search", "has_browse": "browse"}
    totals = _flags_of(rows).agg(
        F.count("*").alias("total_users"),
        *[F.count_if(flag).alias(f"{name}_users") for flag, name in names.items()],
        F.sum("login_days").alias("_days"),
    )
    return totals.select(
        "total_users",
        *[F.col(f"{name}_users") for name in names.values()],
        *[
            ratio(F.col(f"{name}_users") * 100, F.col("total_users")).alias(f"{name}_percent")
            for name in names.values()
        ],
        ratio(F.col("_days"), F.col("total_users")).alias("avg_login_days"),
    )


def users_per_slot(logs: DataFrame) -> DataFrame:
    """Distinct users per time of day, most frequent first."""
    return slots_of(behaviours(logs))


def slots_of(rows: DataFrame) -> DataFrame:
    """``users_per_slot`` from the rows of ``behaviours``."""
    pairs = rows.select("user_id", "time_slot").distinct()
    return pairs.groupBy("time_slot").agg(F.count("*").alias("users")).orderBy(F.desc("users"), "time_slot")


def profile_text(profiles: DataFrame) -> DataFrame:
    """Readable line per profile (fixed text)."""
    return profiles.select(
        "user_id",
        F.format_string(
            "用户ID: %s, 登录天数: %d天(%s), 购买: %s, 搜索: %s, 浏览: %s, 登录时段: %s",
            F.col("user_id"), F.size("login_dates"), F.array_join("login_dates", ","),
            *[yes_no(F.col(flag)) for flag in FLAGS], F.array_join("login_time_slots", ","),
        ).alias("line"),
    )
