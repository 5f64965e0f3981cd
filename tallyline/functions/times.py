"""Epochs, local wall-clock time, day keys and time-of-day labels.

Window arithmetic is done on *local microseconds*: the wall-clock reading in a
zone, counted from 1970-01-01 00:00 of that zone. They are plain bigints, so the
results do not depend on the session time zone and stay in generated code.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_ZONE = "Asia/Shanghai"
LOG_ZONE = "UTC"

# Below the limit an epoch counts seconds, from it on milliseconds.
ORDER_MILLIS_FROM = 100_000_000_000
LOG_MILLIS_FROM = 1_000_000_000_000

SECOND = 1_000_000
MINUTE = 60 * SECOND
DAY = 24 * 60 * MINUTE

# First millisecond outside the years that the text form can show.
_YEAR_10000_MS = 253_402_300_800_000
#: Seconds from the year 1 to 1970.
_YEAR_1_S = 62_135_596_800

NO_TIME = "Invalid Time"
BAD_TIME = "时间格式错误"
NO_DATE = "未知日期"
BAD_DATE = "unknown"

# Time-of-day labels with the first hour after each slot.
TIME_SLOTS = [
    (6, "凌晨(0-6点)"),
    (9, "早晨(6-9点)"),
    (12, "上午(9-12点)"),
    (14, "中午(12-14点)"),
    (18, "下午(14-18点)"),
    (22, "晚上(18-22点)"),
]
LAST_TIME_SLOT = "深夜(22-24点)"
NO_TIME_SLOT = "未知时段"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_timestamp(ts: Column | str, millis_from: int = ORDER_MILLIS_FROM) -> Column:
    """Epoch seconds or milliseconds (number or text) as a timestamp.

    NULL if unreadable or outside the years 1 to 9999.
    """
    n = col_of(ts).try_cast("bigint")
    ms = F.when(n.between(-_YEAR_1_S, millis_from - 1), n * 1000).when(n >= millis_from, n)
    return F.timestamp_millis(F.when(ms < _YEAR_10000_MS, ms))


def log_epoch_millis(ts: Column | str, millis_from: int = LOG_MILLIS_FROM) -> Column:
    """Log epoch text, possibly with a fraction, as whole milliseconds; NULL if unreadable."""
    d = col_of(ts).try_cast("double")
    ms = F.when(d >= millis_from, d).otherwise(d * 1000)
    return F.when(F.abs(ms) < _YEAR_10000_MS, ms.cast("bigint"))


def utc_text(ms: Column) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss`` in UTC, whatever the session zone is."""
    return wall_text(F.floor(ms / 1000) * SECOND)


def epoch_text(ts: Column | str, millis_from: int = LOG_MILLIS_FROM) -> Column:
    """Formatted UTC time of a log epoch, with the two labels for absent and bad input."""
    c = col_of(ts)
    return F.when(c.isNull() | (c == ""), NO_TIME).otherwise(
        F.coalesce(utc_text(log_epoch_millis(c, millis_from)), F.lit(BAD_TIME))
    )


def epoch_date(ts: Column | str, millis_from: int = LOG_MILLIS_FROM) -> Column:
    """UTC date of a log epoch as ``yyyy-MM-dd`` text, ``unknown`` if unreadable."""
    return F.coalesce(
        F.split_part(utc_text(log_epoch_millis(ts, millis_from)), F.lit(" "), F.lit(1)),
        F.lit(BAD_DATE),
    )


def date_part_of(formatted_time: Column | str) -> Column:
    c = col_of(formatted_time)
    return F.coalesce(F.split_part(c, F.lit(" "), F.lit(1)), F.lit(NO_DATE))


def time_slot(formatted_time: Column | str) -> Column:
    """Time-of-day label of a ``yyyy-MM-dd HH:mm:ss`` text."""
    clock = F.split_part(col_of(formatted_time), F.lit(" "), F.lit(2))
    hour = F.split_part(clock, F.lit(":"), F.lit(1)).try_cast("int")
    label = F.when(hour.isNull(), NO_TIME_SLOT).when(hour < 0, LAST_TIME_SLOT)
    for end, name in TIME_SLOTS:
        label = label.when(hour < end, name)
    return label.otherwise(LAST_TIME_SLOT)


def wall_micros(ts: Column | str, zone: str = ORDER_ZONE) -> Column:
    """Local microseconds of an instant: its wall-clock reading in ``zone``."""
    return F.unix_micros(F.from_utc_timestamp(col_of(ts), zone))


def naive_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zone-free (``timestamp_ntz``) value.

    From its parts: the difference of two zone-free times would pass through the
    session zone and lose an hour in summer.
    """
    c = col_of(ts)
    minutes = F.unix_date(c.cast("date")).cast("bigint") * 1440 + F.hour(c) * 60 + F.minute(c)
    seconds = F.extract(F.lit("SECOND"), c)
    return minutes * MINUTE + (seconds * SECOND).cast("bigint")


def wall_time(micros: Column | str) -> Column:
    """Local microseconds as a zone-free timestamp."""
    return F.timestamp_add(
        "MICROSECOND", col_of(micros), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )


def wall_text(micros: Column | str) -> Column:
    """Local microseconds (whole seconds) as ``yyyy-MM-dd HH:mm:ss``."""
    return wall_time(micros).cast("string")


def wall_date(micros: Column | str) -> Column:
    return wall_time(micros).cast("date")


def floor_to(micros: Column, size: int) -> Column:
    """Start of the aligned interval of ``size`` microseconds that holds the value."""
    return micros - F.pmod(micros, F.lit(size))


def as_date(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def on_dates(ts: Column | str, dates, zone: str = ORDER_ZONE) -> Column:
    """Local date of ``ts`` is one of ``dates``.

    Written as instant ranges with constant bounds (neighbouring days merged), so
    that it can reach the file scan when ``ts`` is a stored column.
    """
    one = isinstance(dates, (str, date))
    days = sorted({as_date(d) for d in ([dates] if one else dates)})
    spans: list[list[date]] = []
    for day in days:
        if spans and spans[-1][1] == day:
            spans[-1][1] = day + timedelta(days=1)
        else:
            spans.append([day, day + timedelta(days=1)])
    hit = F.lit(False)
    for first, after in spans:
        low, high = (datetime.combine(d, time.min, ZoneInfo(zone)) for d in (first, after))
        c = col_of(ts)
        hit = hit | ((c >= F.lit(low)) & (c < F.lit(high)))
    return hit


def parse_time(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as a zone-free timestamp; NULL for any other form or no such time."""
    c = col_of(text)
    return F.when(c.rlike(r"\A\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"), c).try_cast("timestamp_ntz")


def previous_day(ds: Column | str) -> Column:
    """The calendar day before a ``yyyy-MM-dd`` key, in the same text form."""
    return F.date_sub(col_of(ds).try_cast("date"), 1).cast("string")
