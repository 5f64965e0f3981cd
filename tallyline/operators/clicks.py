"""Clickstream counts over enriched log rows (see ``schema.ENRICHED_LOG``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import (
    COUNTED_BRANDS, PLATFORMS, brand_label, filled, platform_label, ratio, region_part, word_array,
)
from tallyline.functions.times import date_part_of
from tallyline.operators.ranking import top_n
from tallyline.operators.skew import hash_part

#: A user sketch keeps up to 2^SKETCH_SIZE users exactly (half a megabyte); error 0.4 % beyond.
SKETCH_SIZE = 16
#: Words that a sketch of search words keeps count of.
TRACKED_WORDS = 10_000


def page_views(logs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Views per date and page; rows without a page or a time are left out.

    ``extra``: further columns to group by, here and below.
    """
    rows = logs.where(F.col("log_type").isNotNull() & F.col("formatted_time").isNotNull())
    return rows.groupBy(
        *(extra or []), date_part_of("formatted_time").alias("date"), F.col("log_type").alias("page")
    ).agg(F.count("*").alias("pv"))


def incomplete_rows(logs: DataFrame) -> DataFrame:
    """Count of the rows that ``page_views`` leaves out."""
    missing = F.col("log_type").isNull() | F.col("formatted_time").isNull()
    return logs.agg(F.count_if(missing).alias("incomplete_rows"), F.count("*").alias("all_rows"))


def keyword_counts(logs: DataFrame) -> DataFrame:
    words = logs.select(F.explode(word_array("keywords")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("cnt"))


def top_keywords(logs: DataFrame, n: int = 10) -> DataFrame:
    return keyword_counts(logs).orderBy(F.desc("cnt"), "word").limit(n)


def region_logins(logs: DataFrame) -> DataFrame:
    """Logins per region, the data of the heat map."""
    region = F.trim("region")
    rows = logs.where((F.col("log_type") == "login") & (region != ""))
    return rows.groupBy(region.alias("region")).agg(F.count("*").alias("cnt"))


def raw_devices(logs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Rows per date and raw device texts."""
    return logs.where(filled("formatted_time")).groupBy(
        *(extra or []), date_part_of("formatted_time").alias("date"), "plat", "brand"
    ).agg(F.count("*").alias("cnt"))


def _devices(counts: DataFrame) -> DataFrame:
    """``raw_devices`` with labels; rows without date or known platform dropped.

    Rows are counted by their raw texts first, so the label rules run once per
    distinct text and not once per row. A label can occur in several rows.
    """
    labelled = counts.select(
        "date", platform_label("plat").alias("platform"), brand_label("brand").alias("brand"), "cnt"
    )
    return labelled.where((F.col("date") != "") & F.col("platform").isin(PLATFORMS))


def device_counts(logs: DataFrame) -> DataFrame:
    """Devices per date and category: both platforms and the six counted brands."""
    both = _devices(raw_devices(logs)).select("date", F.explode(F.array("platform", "brand")).alias("category"), "cnt")
    kept = both.where(F.col("category").isin(PLATFORMS + COUNTED_BRANDS))
    return kept.groupBy("date", "category").agg(F.sum("cnt").alias("cnt"))


def platform_share(logs: DataFrame) -> DataFrame:
    """iOS against Android over all dates; one global aggregation, so it also streams."""
    platform = platform_label("plat")
    rows = logs.where(filled("formatted_time") & (date_part_of("formatted_time") != ""))
    counts = rows.agg(
        F.count_if(platform == "iOS").alias("ios_count"),
        F.count_if(platform == "Android").alias("android_count"),
    )
    total = F.col("ios_count") + F.col("android_count")
    return counts.select(
        "ios_count", "android_count",
        F.coalesce(ratio(F.col("ios_count") * 100, total), F.lit(0.0)).alias("ios_percent"),
        F.coalesce(ratio(F.col("android_count") * 100, total), F.lit(0.0)).alias("android_percent"),
    )


def top_brands(logs: DataFrame, n: int = 10) -> DataFrame:
    return top_brands_of(raw_devices(logs), n)


def top_brands_of(counts: DataFrame, n: int = 10) -> DataFrame:
    """Top brands of ``raw_devices``, which a stream keeps as a table."""
    counts = _devices(counts).groupBy("brand").agg(F.sum("cnt").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "brand").limit(n)


def device_models(logs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Rows per platform, brand, model and date, the shape of the stored device table."""
    return logs.where(filled("formatted_time")).groupBy(
        *(extra or []), platform_label("plat").alias("platform"), "brand", "model",
        date_part_of("formatted_time").try_cast("date").alias("stat_date"),
    ).agg(F.count("*").alias("count"))


def _day_key(formatted_time: str):
    return F.replace(date_part_of(formatted_time), F.lit("-"), F.lit(""))


def page_day_users(logs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Views per day, page and user: one row per user, however many a page-day has."""
    rows = logs.where(F.col("log_type").isNotNull() & F.col("formatted_time").isNotNull())
    return rows.groupBy(
        *(extra or []), _day_key("formatted_time").alias("day"), F.col("log_type").alias("page"), "user_id"
    ).agg(F.count("*").alias("pv"))


def page_view_users(logs: DataFrame, part_rows: int = 10_000) -> DataFrame:
    """Views per day and page with the JSON list of its distinct users.

    The users of a page-day are spread by hash over as many ``part``s as keep each
    list near ``part_rows``. ``pv`` and ``users`` are those of the row's own users, so
    their sums over a page-day are the same however it is split.
    """
    return user_lists(page_day_users(logs), part_rows)


def user_lists(per_user: DataFrame, part_rows: int = 10_000) -> DataFrame:
    """The lists of ``page_view_users`` from the rows of ``page_day_users``."""
    keys = ["day", "page"]
    parts = per_user.groupBy(*keys).agg(
        F.ceil(F.greatest(F.count("user_id"), F.lit(1)) / part_rows).alias("_parts")
    )
    split = per_user.join(parts, keys).withColumn("part", hash_part(F.col("_parts"), "user_id"))
    return split.groupBy(*keys, "part").agg(
        F.sum("pv").alias("pv"), F.count("user_id").alias("users"),
        F.to_json(F.array_sort(F.collect_list("user_id"))).alias("user_ids"),
    )


def page_view_reach(logs: DataFrame) -> DataFrame:
    """Views per day and page with an approximate user count, usable on streams."""
    rows = logs.where(F.col("log_type").isNotNull() & F.col("formatted_time").isNotNull())
    return rows.groupBy(_day_key("formatted_time").alias("day"), F.col("log_type").alias("page")).agg(
        F.count("*").alias("pv"), F.approx_count_distinct("user_id").alias("about_users")
    )


def user_sketches(logs: DataFrame, extra: list[str] | None = None, size: int = SKETCH_SIZE) -> DataFrame:
    """Views per date and page with a sketch of its users, for storage: its size does not grow with them.

    A sketch keeps up to 2^``size`` users exactly and estimates beyond that, with a standard error
    of 1/sqrt(2^size). Rows without a date are left out, null users are not counted.
    """
    date = date_part_of("formatted_time").try_cast("date")
    rows = logs.where(F.col("log_type").isNotNull() & date.isNotNull())
    return rows.groupBy(*(extra or []), date.alias("date"), F.col("log_type").alias("page")).agg(
        F.count("*").alias("pv"), F.theta_sketch_agg("user_id", size).alias("users")
    )


def users_of_periods(sketches: DataFrame, days: int, size: int = SKETCH_SIZE) -> DataFrame:
    """Views and distinct users per page in the ``days`` up to each date that has views.

    ``returning`` are users of the period who came in the ``days`` before it as well. All of it is
    made of the rows of ``user_sketches``, stored or not, one per date and page (or several).
    """
    later = F.explode(F.sequence("date", F.date_add("date", 2 * days - 1))).alias("until")
    spread = sketches.select("page", "date", "pv", "users", later)
    now = F.col("date") > F.date_sub("until", days)
    merged = spread.groupBy("page", "until").agg(
        F.bool_or(F.col("date") == F.col("until")).alias("_seen"),
        F.sum(F.when(now, F.col("pv"))).alias("pv"),
        F.theta_union_agg(F.when(now, F.col("users")), size).alias("_now"),
        F.theta_union_agg(F.when(~now, F.col("users")), size).alias("_before"),
    )
    return merged.where("_seen").select(
        "page", F.col("until").alias("date"), "pv", F.theta_sketch_estimate("_now").alias("users"),
        F.theta_sketch_estimate(F.theta_intersection("_now", "_before")).alias("returning"),
    )


def word_sketch(logs: DataFrame, tracked: int = TRACKED_WORDS) -> DataFrame:
    """One row: a sketch of the most frequent search words, of bounded size.

    Counts are exact while there are no more than 0.75 x ``tracked`` different words. Beyond
    that a count is too small or too large by at most 3.5 x all words / ``tracked``.
    """
    words = logs.select(F.explode(word_array("keywords")).alias("word"))
    return words.agg(F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("words"))


def merged_word_sketches(sketches: DataFrame, tracked: int = TRACKED_WORDS) -> DataFrame:
    """One sketch of all rows of ``word_sketch``; other columns keep their largest value."""
    others = [F.max(c).alias(c) for c in sketches.columns if c != "words"]
    return sketches.agg(F.expr(f"approx_top_k_combine(words, {tracked})").alias("words"), *others)


def frequent_words(sketches: DataFrame, n: int = 10, tracked: int = TRACKED_WORDS) -> DataFrame:
    """The n most frequent words of all sketches together."""
    top = F.expr(f"approx_top_k_estimate(words, {tracked})")
    words = merged_word_sketches(sketches.select("words"), tracked).select(F.explode(top).alias("w"))
    return words.select(F.col("w.item").alias("word"), F.col("w.count").alias("cnt")).orderBy(F.desc("cnt"), "word").limit(n)


def daily_words(logs: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent words of each day, one row per word.

    Equal keyword texts of a day are counted before they are split into words.
    """
    texts = logs.where(F.col("formatted_time").isNotNull()).groupBy(
        date_part_of("formatted_time").alias("day"), "keywords"
    ).agg(F.count("*").alias("n"))
    words = texts.select("day", "n", F.explode(word_array("keywords")).alias("word"))
    counts = words.groupBy("day", "word").agg(F.sum("n").alias("cnt"))
    return top_n(counts, ["day"], [F.desc("cnt"), F.asc("word")], n)


def daily_top_words(logs: DataFrame, n: int = 10) -> DataFrame:
    """``daily_words`` as one array of (word, cnt) per day."""
    ordered = F.array_sort(F.collect_list(F.struct("rn", "word", "cnt")))
    return daily_words(logs, n).groupBy("day").agg(
        F.transform(ordered, lambda e: F.struct(e["word"].alias("word"), e["cnt"].alias("cnt"))).alias("top10")
    )


def stamped(df: DataFrame) -> DataFrame:
    """A result with the time at which it is given out."""
    return df.withColumn("emit_time", F.current_timestamp())


def with_history(history: DataFrame, today: DataFrame) -> DataFrame:
    """Earlier days and the current day as one input, told apart by ``type``."""
    return history.withColumn("type", F.lit("history")).unionByName(
        today.withColumn("type", F.lit("periodic")), allowMissingColumns=True
    )


def region_counts(rows: DataFrame) -> DataFrame:
    """Rows per date, region, address and type.

    Input: ``date``, ``region_raw`` (``country|province|city|operator``), ``ip`` and
    ``type``. A region is abnormal if one of its three levels is missing.
    """
    return named_regions(address_counts(rows, ["type"]))


def address_counts(rows: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Rows per date, region and address: what a stream of regions keeps per day."""
    return rows.groupBy(*(extra or []), "date", "region_raw", "ip").agg(F.count("*").alias("count"))


def days_told_apart(counts: DataFrame) -> DataFrame:
    """Adds ``type`` on read: the last date is the current day, all others, and no date, are history."""
    last = counts.agg(F.max("date")).scalar()
    return counts.withColumn("type", F.when(F.col("date") == last, "periodic").otherwise("history"))


def named_regions(counts: DataFrame) -> DataFrame:
    """``address_counts`` by ``type`` with the levels of each region."""
    region = F.regexp_replace("region_raw", r"^[^|]*\|?", "")
    levels = {"province": 1, "city": 2, "district": 3}
    named = counts.withColumn("region", region).withColumns(
        {name: region_part("region", k) for name, k in levels.items()}
    )
    missing = F.col("province").isNull() | F.col("city").isNull() | F.col("district").isNull()
    return named.withColumn("abnormal", missing).select(
        "date", "region", *levels, "count", "abnormal", "region_raw", "type", "ip"
    )


def region_drill_down(rows: DataFrame, levels: list[str], measures: dict) -> DataFrame:
    """Sums for every prefix of the levels, from the whole down to the finest one.

    Rows are summed at the finest level first, so only these sums are repeated.
    """
    finest = rows.groupBy(*levels).agg(*[F.sum(c).alias(m) for m, c in measures.items()])
    return finest.rollup(*levels).agg(
        F.grouping_id().alias("level_mask"), *[F.sum(m).alias(m) for m in measures]
    )
