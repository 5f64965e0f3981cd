"""Event time and closing windows on streams."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.times import ORDER_ZONE

DELAY = "5 seconds"
LOCAL = "_local"
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def timed(df: DataFrame, ts: str = "ts_ms", zone: str = ORDER_ZONE, delay: str = DELAY) -> DataFrame:
    """Adds the local event time with its watermark; built-in windows then follow local days."""
    known = df.where(F.col(ts).isNotNull())
    return known.withColumn(LOCAL, F.from_utc_timestamp(ts, zone)).withWatermark(LOCAL, delay)


def size_text(micros: int) -> str:
    return f"{micros} microseconds"


def window_of(size: int, slide: int | None = None) -> Column:
    return F.window(LOCAL, size_text(size), size_text(slide or size)).alias("_w")


def with_bounds(df: DataFrame) -> DataFrame:
    """The window of a closed aggregation as bounds in local microseconds."""
    bounds = {"window_start": F.unix_micros("_w.start"), "window_end": F.unix_micros("_w.end")}
    return df.withColumns(bounds).drop("_w")


def window_sums(
    df: DataFrame, size: int, sums: dict[str, Column], keys: list[str] | None = None, slide: int | None = None
) -> DataFrame:
    """Sums per window and key, given out once when the watermark has passed the window."""
    grouped = df.groupBy(window_of(size, slide), *(keys or []))
    return with_bounds(grouped.agg(*[F.sum(c).alias(name) for name, c in sums.items()]))


def slice_sums(df: DataFrame, step: int, sums: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """Closed slices: the stream state holds only the slices that are still open."""
    closed = window_sums(df, step, sums, keys)
    return closed.withColumnRenamed("window_start", "_slice").drop("window_end")


def closed_until(query: StreamingQuery) -> int | None:
    """The engine's watermark of the query's last batch in local microseconds; None before there is one.

    All windows that end by then have been given out, those of quiet stretches too.
    """
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"]]
    known = [datetime.fromisoformat(m) - EPOCH for m in marks if not m.startswith("1970-01-01T00:00:00")]
    return max((t // timedelta(microseconds=1) for t in known), default=None)


def last_end(slices: DataFrame, step: int, until: int | None = None) -> Column:
    """Up to where cumulative windows are known: ``until``, or else the end of the last closed slice."""
    if until is not None:
        return F.lit(until // step * step)
    return slices.agg((F.max("_slice") + step).alias("end")).scalar()
