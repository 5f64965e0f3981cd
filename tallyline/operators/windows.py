"""Tumbling, hopping and cumulative windows over local time.

All sizes are microseconds; bounds are local microseconds (see functions.times)
until ``show_bounds`` turns them into zone-free timestamps.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.times import floor_to, wall_text, wall_time

BOUNDS = ["window_start", "window_end"]


def tumble(df: DataFrame, at: str, size: int) -> DataFrame:
    start = floor_to(F.col(at), size)
    return df.withColumn("window_start", start).withColumn("window_end", F.col("window_start") + size)


def hop(df: DataFrame, at: str, size: int, slide: int) -> DataFrame:
    """Each row once per window that holds it; a plain tumble where slide = size."""
    if slide == size:
        return tumble(df, at, size)
    last = floor_to(F.col(at), slide)
    first = floor_to(F.col(at) - size, slide) + slide
    return df.withColumn("window_start", F.explode(F.sequence(first, last, F.lit(slide)))).withColumn(
        "window_end", F.col("window_start") + size
    )


def hop_sums(
    df: DataFrame, at: str, size: int, slide: int, keys: list[str], sums: dict[str, Column]
) -> DataFrame:
    """Sums per hopping window: summed per slice first, so only slices are repeated."""
    cut = gcd(size, slide)
    sliced = df.groupBy(*keys, floor_to(F.col(at), cut).alias("_slice")).agg(
        *[F.sum(c).alias(name) for name, c in sums.items()]
    )
    windows = hop(sliced, "_slice", size, slide)
    return windows.groupBy(*keys, *BOUNDS).agg(*[F.sum(name).alias(name) for name in sums])


def cumulate(
    df: DataFrame, at: str, step: int, span: int, last_end: Column | int | None = None
) -> DataFrame:
    """Each row once per cumulative window that holds it.

    A window runs from the start of the span to a multiple of ``step``. The row
    count grows by up to span/step, so reduce to slices before where possible.
    With ``last_end`` no window ends later than that.
    """
    _check(step, span)
    first_end = floor_to(F.col(at), step) + step
    until = F.col("window_start") + span
    if last_end is not None:
        until = F.least(until, F.lit(last_end))
    started = df.withColumn("window_start", floor_to(F.col(at), span)).where(until >= first_end)
    return started.withColumn("window_end", F.explode(F.sequence(first_end, until, F.lit(step))))


def cumulative_sums(
    df: DataFrame, at: str, step: int, span: int, keys: list[str], sums: dict[str, Column]
) -> DataFrame:
    """Sums per key and cumulative window.

    The rows are summed per (key, slice) with map-side combine, then a running sum
    over the few slices of a key gives the value after each slice. A value holds
    until the key's next slice, so each (key, window) is produced exactly once and
    no second aggregation is needed.
    """
    sliced = slice_sums(df, at, step, keys, sums)
    return spread_over_windows(sliced, "_slice", step, span, keys, list(sums))


def slice_sums(df: DataFrame, at: str, step: int, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Sums per key and slice of one step."""
    return df.groupBy(*keys, floor_to(F.col(at), step).alias("_slice")).agg(
        *[F.sum(c).alias(name) for name, c in sums.items()]
    )


def spread_over_windows(
    sliced: DataFrame, at: str, step: int, span: int, keys: list[str], sums: list[str],
    last_end: Column | int | None = None,
) -> DataFrame:
    """Running sums of per-slice rows, repeated for each window up to the next slice.

    With ``last_end`` no window ends later than that.
    """
    _check(step, span)
    by_time = Window.partitionBy(*keys, "window_start").orderBy(at)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead(at).over(by_time), F.col("window_start") + span)
    if last_end is not None:
        until = F.least(until, F.lit(last_end))
    return (
        sliced.withColumn("window_start", floor_to(F.col(at), span))
        .withColumns({**{s: F.sum(s).over(so_far) for s in sums}, "_until": until})
        .where(F.col("_until") > F.col(at))
        .withColumn("window_end", F.explode(F.sequence(F.col(at) + step, F.col("_until"), F.lit(step))))
        .select(*keys, *BOUNDS, *sums)
    )


def show_bounds(df: DataFrame, as_text: bool = False) -> DataFrame:
    """Bounds as zone-free timestamps, or as ``yyyy-MM-dd HH:mm:ss`` text."""
    show = wall_text if as_text else wall_time
    return df.withColumns({b: show(b) for b in BOUNDS})


def _check(step: int, span: int) -> None:
    if step <= 0 or span % step:
        raise ValueError("the span must be a multiple of the step")
