"""Loading of JSON messages into result tables, and the sinks of the jobs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallyline.sources.commits import BATCH, CommittedBatches, newest


@dataclass(frozen=True)
class LoadSpec:
    """JSON path, column name and type of each column of a load, in order."""

    columns: tuple[tuple[str, str, str], ...]
    bucket_by: str
    sort_by: tuple[str, ...]
    buckets: int = 8


# The paths and columns of the four result tables.
PAGE_VIEWS = LoadSpec(
    (
        ("$.day", "day", "string"), ("$.page", "page", "string"), ("$.pv", "pv", "bigint"),
        ("$.user_ids", "user_ids", "string"), ("$.emit_time", "emit_time", "timestamp_ntz"),
    ),
    "day", ("day", "page"),
)
SEARCH_WORDS = LoadSpec(
    (
        ("$.day", "day", "string"), ("$.top10[0].word", "word", "string"),
        ("$.top10[0].cnt", "cnt", "bigint"), ("$.emit_time", "emit_time", "timestamp_ntz"),
    ),
    "day", ("day", "word"),
)
REGIONS = LoadSpec(
    (
        ("$.date", "date", "string"), ("$.region", "region", "string"),
        ("$.province", "province", "string"), ("$.city", "city", "string"),
        ("$.district", "district", "string"), ("$.count", "count", "bigint"),
        ("$.abnormal", "abnormal", "boolean"), ("$.region_raw", "region_raw", "string"),
        ("$.type", "type", "string"), ("$.ip", "ip", "string"),
    ),
    "date", ("date", "region", "province", "city"),
)
DEVICES = LoadSpec(
    (
        ("$.system", "platform", "string"), ("$.brand", "brand", "string"),
        ("$.model", "model", "string"), ("$.stat_date", "stat_date", "date"),
        ("$.count", "count", "bigint"), ("$.proc_time", "proc_time", "timestamp_ntz"),
    ),
    "platform", ("platform", "brand", "model", "stat_date"),
)


def load_json(
    df: DataFrame, spec: LoadSpec, value: str = "value", proc_time: bool = True
) -> DataFrame:
    """Columns of a load from JSON text.

    The text is parsed once; paths below the first level look into the text of
    their field. A missing path or a value of another type gives NULL. An absent
    ``proc_time`` is the time of loading.
    """
    roots = sorted({_root(path) for path, _, _ in spec.columns})
    schema = T.StructType([T.StructField(r, T.StringType()) for r in roots])
    rows = df.select(F.from_json(value, schema).alias("_r"))
    loaded = rows.select(*[_field(path).try_cast(kind).alias(name) for path, name, kind in spec.columns])
    if not proc_time:
        return loaded
    now = F.current_timestamp().cast("timestamp_ntz")
    given = "proc_time" in loaded.columns
    return loaded.withColumn("proc_time", F.coalesce("proc_time", now) if given else now)


def _root(path: str) -> str:
    return path.removeprefix("$.").split(".")[0].split("[")[0]


def _field(path: str):
    root = _root(path)
    rest = path.removeprefix("$.").removeprefix(root)
    column = F.col(f"_r.`{root}`")
    return F.get_json_object(column, f"${rest}") if rest else column


def load_all_words(df: DataFrame, value: str = "value") -> DataFrame:
    """All words of the day's list instead of the first one only."""
    top = "array<struct<word:string,cnt:string>>"
    rows = df.select(F.from_json(value, f"day string, top10 {top}, emit_time string").alias("_r"))
    return rows.select("_r.day", "_r.emit_time", F.inline("_r.top10")).select(
        "day", "word", F.col("cnt").try_cast("bigint").alias("cnt"),
        F.col("emit_time").try_cast("timestamp_ntz").alias("emit_time"),
    )


def write_bucketed(df: DataFrame, table: str, spec: LoadSpec, mode: str = "overwrite") -> None:
    """Catalog table with the hash layout and sort order of the load."""
    df.write.mode(mode).bucketBy(spec.buckets, spec.bucket_by).sortBy(*spec.sort_by).saveAsTable(table)


def write_json(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(folder)


def batch_folder(folder: str, every: int = 50) -> CommittedBatches:
    """Writer for ``foreachBatch``: a batch counts once, and only when all of it is stored."""
    return CommittedBatches(folder, every=every)


def fan_out(
    metrics: dict[str, Callable[[DataFrame], DataFrame]], folder: str
) -> Callable[[DataFrame, int], None]:
    """Writer that derives several results from one batch, which is parsed only once."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for name, metric in metrics.items():
                batch_folder(f"{folder.rstrip('/')}/{name}")(metric(df), batch_id)
        finally:
            df.unpersist()

    return write


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start_to_folder(
    df: DataFrame, folder: str, checkpoint: str, mode: str = "append", every: str | None = None,
    batch: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Stream into committed batches; without ``every`` it ends when the input is read.

    ``batch`` is applied to each micro-batch first (ranking, second aggregation).
    """
    store = batch_folder(folder) if mode != "complete" else CommittedBatches(folder, lambda rows, _: _last_batch(rows))

    def write(rows: DataFrame, batch_id: int) -> None:
        store(batch(rows) if batch else rows, batch_id)

    return _start(df.writeStream.outputMode(mode).foreachBatch(write), checkpoint, every)


def start_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    return _start(df.writeStream.outputMode(mode).foreachBatch(write), checkpoint, every)


def start_console(df: DataFrame, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).format("console").option("truncate", False)
    return _start(writer, checkpoint, every)


def start_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """In-memory table for tests; all rows end on the driver, so not for production."""
    writer = df.writeStream.outputMode(mode).format("memory").queryName(name)
    return _start(writer, checkpoint, None)


def read_batches(spark, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of all committed batches; a schema is needed only while there is none."""
    return CommittedBatches(folder).rows(spark, schema).drop(BATCH)


def keyed_batches(folder: str, keys: list[str], every: int = 50) -> CommittedBatches:
    """Writer for update mode; snapshots hold the last row of each key."""
    return CommittedBatches(folder, lambda rows, _: newest(rows, keys), every)


def read_latest(spark, folder: str, keys: list[str]) -> DataFrame:
    """The last stored row of each key: the table behind a query in update mode."""
    return newest(keyed_batches(folder, keys).rows(spark), keys).drop(BATCH)


def latest_batch(spark, folder: str) -> DataFrame:
    """Rows of the last batch, the current state of a query in complete mode."""
    return CommittedBatches(folder).last(spark)


def _last_batch(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(BATCH) == rows.agg(F.max(BATCH)).scalar())
