"""Message topics: connection options, start position and parsing.

The message source needs the Kafka package of Spark on the class path. Everything
behind it takes a DataFrame with a text column, so files work the same way.
"""

from __future__ import annotations

from datetime import datetime, time
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.times import ORDER_ZONE, epoch_to_timestamp
from tallyline.schema import ENRICHED_LOG, ORDER

_BAD = "_unreadable"


def start_of_today(zone: str = ORDER_ZONE, now: datetime | None = None) -> datetime:
    now = now or datetime.now(ZoneInfo(zone))
    return datetime.combine(now.astimezone(ZoneInfo(zone)).date(), time.min, ZoneInfo(zone))


def start_options(start: str | datetime, zone: str = ORDER_ZONE, now: datetime | None = None) -> dict:
    """Topic options for ``earliest``, ``latest``, ``today`` or a given instant."""
    if start in ("earliest", "latest"):
        return {"startingOffsets": start}
    at = start_of_today(zone, now) if start == "today" else start
    return {"startingTimestamp": str(int(at.timestamp() * 1000))}


def pace_options(max_rows: int | None = None, max_files: int | None = None, max_bytes: str | None = None) -> dict:
    """Input pacing per micro-batch: rows (topics), files or bytes (file streams)."""
    options = {"maxOffsetsPerTrigger": max_rows, "maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    return {k: str(v) for k, v in options.items() if v is not None}


def read_topic(
    spark: SparkSession, options: dict, start: str | datetime = "earliest", streaming: bool = True,
    zone: str = ORDER_ZONE,
) -> DataFrame:
    """Topic as text column ``value``; servers, topic and credentials come from ``options``."""
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format("kafka").options(**start_options(start, zone), **options).load()
        .select(F.col("value").cast("string").alias("value"))
    )


def parse_json(df: DataFrame, schema: T.StructType, on_error: str = "skip", value: str = "value") -> DataFrame:
    """JSON text to columns; absent fields are NULL.

    Unreadable text is skipped or, with ``on_error="fail"``, ends the job. The
    parsed record is unpacked by a generator, so no filter makes Spark read or parse
    the text a second time.
    """
    fail = on_error == "fail"
    record = F.from_json(value, schema, {"mode": "FAILFAST"}) if fail else _parsed(schema, value)
    rows = df.select(F.inline(F.when(F.trim(value) != "", F.array(record))))
    return rows if fail else rows.where(F.col(_BAD).isNull()).drop(_BAD)


def _parsed(schema: T.StructType, value: str):
    with_bad = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    return F.from_json(value, with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})


def unreadable(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Count of the rows that ``parse_json`` skips."""
    bad = F.coalesce(F.trim(value) == "", F.lit(True)) | _parsed(schema, value)[_BAD].isNotNull()
    return df.agg(F.count_if(bad).alias("unreadable_rows"), F.count("*").alias("all_rows"))


def orders_from_json(df: DataFrame, on_error: str = "skip", value: str = "value") -> DataFrame:
    """Order events with event time ``ts_ms``."""
    return with_event_time(parse_json(df, ORDER, on_error, value))


def with_event_time(orders: DataFrame) -> DataFrame:
    return orders.withColumn("ts", F.col("ts").try_cast("bigint")).withColumn("ts_ms", epoch_to_timestamp("ts"))


def logs_from_json(df: DataFrame, on_error: str = "skip", value: str = "value") -> DataFrame:
    """Enriched log events, parsed once for all metrics."""
    return parse_json(df, ENRICHED_LOG, on_error, value)


def since(df: DataFrame, ts: str, start: datetime) -> DataFrame:
    """Batch form of a start position."""
    return df.where(F.col(ts) >= F.lit(start))
