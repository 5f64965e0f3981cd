"""Clickstream results on a stream of log rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import word_array
from tallyline.functions.times import LOG_ZONE, date_part_of, log_epoch_millis, time_slot
from tallyline.operators.clicks import TRACKED_WORDS, merged_word_sketches, word_sketch
from tallyline.operators.paths import WINDOW as PATH_WINDOW
from tallyline.operators.paths import list_metrics, path_steps
from tallyline.operators.profiles import FLAGS
from tallyline.operators.profiles import WINDOW as PROFILE_WINDOW
from tallyline.operators.windows import show_bounds
from tallyline.sources.commits import CommittedBatches
from tallyline.streaming.windows import DELAY, LOCAL, timed, window_of, with_bounds

#: Event-time day whose rows of a daily table are one row of state; see ``by_day``.
STATE_DAY = "_day"


def log_time(logs: DataFrame) -> DataFrame:
    """Adds the event time ``ts_ms`` of the log epoch."""
    return logs.withColumn("ts_ms", F.timestamp_millis(log_epoch_millis("ts")))


def user_profiles(logs: DataFrame, window: int = PROFILE_WINDOW, delay: str = DELAY) -> DataFrame:
    """Profile per user and event-time window; lists hold at most a window's dates and labels."""
    known = logs.where(
        F.col("user_id").isNotNull() & F.col("log_type").isNotNull() & F.col("formatted_time").isNotNull()
    )
    rows = timed(log_time(known), zone=LOG_ZONE, delay=delay)
    profiles = rows.groupBy(window_of(window), "user_id").agg(
        F.array_sort(F.collect_set(date_part_of("formatted_time"))).alias("login_dates"),
        F.array_sort(F.collect_set(time_slot("formatted_time"))).alias("login_time_slots"),
        *[F.bool_or(F.col("log_type").isin(pages)).alias(flag) for flag, pages in FLAGS.items()],
    )
    return show_bounds(with_bounds(profiles.withColumn("login_days", F.size("login_dates"))))


def user_paths(logs: DataFrame, window: int = PATH_WINDOW, delay: str = DELAY) -> DataFrame:
    """Path per user, date and event-time window, given out when the window has closed."""
    steps = path_steps(logs).withColumn("ts_ms", F.timestamp_millis("at"))
    rows = timed(steps, zone=LOG_ZONE, delay=delay)
    ordered = F.array_sort(F.collect_list(F.struct("at", "log_id", "page")))
    paths = rows.groupBy(window_of(window), "user_id", "date").agg(ordered.alias("_steps"))
    return show_bounds(with_bounds(paths.withColumns(list_metrics("_steps")).drop("_steps")))


def daily_word_counts(logs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Counts per day and word for update mode; the top words follow on read."""
    words = logs.where(F.col("formatted_time").isNotNull()).select(
        *(extra or []), date_part_of("formatted_time").alias("day"), F.explode(word_array("keywords")).alias("word")
    )
    return words.groupBy(*(extra or []), "day", "word").agg(F.count("*").alias("cnt"))


def word_batches(folder: str, tracked: int = TRACKED_WORDS, every: int = 50) -> Callable[[DataFrame, int], None]:
    """Writer of log rows for ``foreachBatch``: one sketch of the search words per batch.

    The stream has no state, and what is stored does not grow with the number of words or of
    batches: sketches are put together in snapshots. Read with ``clicks.frequent_words``.
    """
    store = CommittedBatches(folder, lambda rows, _: merged_word_sketches(rows, tracked), every)
    return lambda logs, batch_id: store(word_sketch(logs, tracked), batch_id)


def by_day(job: Callable[..., DataFrame], logs: DataFrame, delay: str = DELAY) -> DataFrame:
    """A daily table of ``job(logs, extra=[...])`` in update mode with bounded state.

    Rows are grouped by their event-time day as well, so a day leaves the state once
    the watermark has passed it. Rows without an event time are left out, and rows
    behind the watermark are late. ``over_days`` takes the added column off on read.
    """
    rows = timed(log_time(logs), zone=LOG_ZONE, delay=delay).withColumn("_w", F.window(LOCAL, "1 day"))
    counted = job(rows, extra=["_w"])
    return counted.select(F.col("_w.start").alias(STATE_DAY), *[c for c in counted.columns if c != "_w"])


def over_days(table: DataFrame, keys: list[str]) -> DataFrame:
    """The stored table of ``by_day`` by its own keys: counts summed, flags joined by or."""
    values = [(c, t) for c, t in table.dtypes if c not in (*keys, STATE_DAY)]
    return table.groupBy(*keys).agg(*[(F.bool_or(c) if t == "boolean" else F.sum(c)).alias(c) for c, t in values])
