"""User paths over the key pages: steps, patterns, conversion and monitoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.text import is_key_page, ratio, yes_no
from tallyline.functions.times import MINUTE, epoch_date, floor_to, log_epoch_millis
from tallyline.operators.ranking import text_list
from tallyline.operators.skew import number_rows
from tallyline.operators.windows import show_bounds

WINDOW = 2 * MINUTE
PART_STEPS = 100_000
ARROW = "->"
#: (modulus, base) of the digests of a pattern. Moduli are primes below 2^31, so products fit 64 bits.
DIGESTS = [(2147483647, 1000003), (2147483629, 998244353), (2147483587, 1664525)]
METRICS = [
    "path_length", "has_purchase", "has_search", "start_page", "end_page",
    "start_time", "end_time", "duration",
]


def path_steps(logs: DataFrame, window: int | None = None) -> DataFrame:
    """Key-page rows with readable time, keyed by user, UTC date and optional window."""
    steps = logs.where(F.col("user_id").isNotNull() & is_key_page("log_type")).select(
        "user_id", epoch_date("ts").alias("date"), F.col("log_type").alias("page"),
        log_epoch_millis("ts").alias("at"), "log_id",
    ).where(F.col("at").isNotNull())
    if window:
        steps = steps.withColumn("window_start", floor_to(F.col("at") * 1000, window))
    return steps


def _keys(window: int | None) -> list[str]:
    return ["user_id", "date", *(["window_start"] if window else [])]


def _metrics() -> list[Column]:
    order = F.struct("at", "log_id")
    return [
        F.count("*").alias("path_length"),
        F.bool_or(F.col("page") == "payment").alias("has_purchase"),
        F.bool_or(F.col("page") == "search").alias("has_search"),
        F.min_by("page", order).alias("start_page"),
        F.max_by("page", order).alias("end_page"),
        F.min("at").alias("start_time"),
        F.max("at").alias("end_time"),
        (F.max("at") - F.min("at")).alias("duration"),
    ]


def path_metrics(logs: DataFrame, window: int | None = None) -> DataFrame:
    """Length, flags, first and last page and duration (ms) per path, without its steps.

    Plain aggregates with map-side combine, so long paths cost nothing extra.
    """
    steps = path_steps(logs, window)
    return _shown(steps.groupBy(*_keys(window)).agg(*_metrics()), window)


def user_paths(logs: DataFrame, window: int | None = None, part_steps: int = PART_STEPS) -> DataFrame:
    """Pages of each path in the order of time and log id, with the path's metrics.

    Steps are numbered and the path is cut after every ``part_steps`` of them into
    rows numbered by ``part``; the metrics are those of the whole path in each.
    """
    keys = _keys(window)
    entries = F.array_sort(F.collect_list(F.struct("position", "page")))
    parts = path_positions(logs, window).groupBy(
        *keys, F.floor(F.col("position") / part_steps).alias("part")
    ).agg(F.transform(entries, lambda e: e["page"]).alias("path"))
    metrics = path_steps(logs, window).groupBy(*keys).agg(*_metrics())
    return _shown(parts.join(metrics, keys).select(*keys, "part", "path", *METRICS), window)


def path_positions(logs: DataFrame, window: int | None = None) -> DataFrame:
    """Every step of every path with its ``position`` (from 0) by time and log id.

    A step is one row, however long its path, and a path is counted by seconds first,
    so no task holds more than a second of it.
    """
    return _positions(path_steps(logs, window), _keys(window))


def _positions(steps: DataFrame, keys: list[str]) -> DataFrame:
    numbered = number_rows(steps, keys, "at", ["log_id", "page"], 1000, "position")
    return numbered.select(*keys, "position", "page", "at", "log_id")


def list_metrics(steps: str) -> dict[str, Column]:
    """Pages and metrics of a path that is whole in one ordered list of steps (``part`` 0)."""
    page, at = F.col(f"{steps}.page"), F.col(f"{steps}.at")
    first, last = F.lit(1), F.lit(-1)
    return {
        "part": F.lit(0).cast("bigint"),
        "path": page,
        "path_length": F.size(page).cast("bigint"),
        "has_purchase": F.array_contains(page, "payment"),
        "has_search": F.array_contains(page, "search"),
        "start_page": F.element_at(page, first),
        "end_page": F.element_at(page, last),
        "start_time": F.element_at(at, first),
        "end_time": F.element_at(at, last),
        "duration": F.element_at(at, last) - F.element_at(at, first),
    }


def _shown(df: DataFrame, window: int | None) -> DataFrame:
    if not window:
        return df
    return show_bounds(df.withColumn("window_end", F.col("window_start") + window))


def longer_paths(paths: DataFrame, at_least: int = 2) -> DataFrame:
    return paths.where(F.col("path_length") >= at_least)


def _power(base: int, modulus: int, n: str) -> str:
    """SQL of base^n modulo ``modulus`` for a column below 2^40, four bits at a time."""
    out = "1L"
    for shift in range(0, 40, 4):
        table = ", ".join(f"{pow(base, digit << shift, modulus)}L" for digit in range(16))
        out = f"({out} * array({table})[CAST(shiftright({n}, {shift}) & 15 AS INT)] % {modulus}L)"
    return out


def pattern_digests(logs: DataFrame, window: int | None = None) -> DataFrame:
    """(digest, path_length, cnt, path): each page sequence of two or more steps, without its text.

    A digest is the sum of page codes times powers of a base by position, modulo a prime, under
    three primes; sequences are equal if all three and their lengths agree (93 bits). It is
    summed over the seconds of a path, each shifted by the number of steps before it, so the
    source is read once, no path is put together, and a path is one row per second (86,400 at
    most) where its seconds meet. ``path`` is the key of one path with the sequence.
    """
    keys = _keys(window)
    second = [*keys, "_second"]
    inside = Window.partitionBy(*second).orderBy("at", "log_id", "page")
    steps = path_steps(logs, window).withColumn("_second", F.floor(F.col("at") / 1000))
    steps = steps.withColumn("_n", (F.row_number().over(inside) - 1).cast("bigint"))
    code = lambda m: f"(pmod(xxhash64(page), {m - 1}L) + 1)"
    parts = steps.groupBy(*second).agg(
        F.count("*").alias("_steps"),
        *[F.expr(f"sum({code(m)} * {_power(b, m, '_n')} % {m}L) % {m}L").alias(f"_d{i}") for i, (m, b) in enumerate(DIGESTS)],
    )
    earlier = Window.partitionBy(*keys).orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("_before", F.coalesce(F.sum("_steps").over(earlier), F.lit(0)))
    whole = placed.groupBy(*keys).agg(
        F.sum("_steps").alias("path_length"),
        F.struct(*[F.expr(f"sum(_d{i} * {_power(b, m, '_before')} % {m}L) % {m}L").alias(f"d{i}") for i, (m, b) in enumerate(DIGESTS)]).alias("digest"),
    )
    return longer_paths(whole).groupBy("digest", "path_length").agg(
        F.count("*").alias("cnt"), F.min(F.struct(*keys)).alias("path")
    )


def path_patterns(logs: DataFrame, window: int | None = None, part_steps: int = PART_STEPS) -> DataFrame:
    """How often each page sequence of two or more steps occurs, with text ``a->b->c``.

    Sequences are counted by their digests; one path of each is read again for its text.
    """
    return _with_text(logs, pattern_digests(logs, window), window, part_steps)


def top_path_patterns(logs: DataFrame, n: int = 5, window: int | None = None, part_steps: int = PART_STEPS) -> DataFrame:
    """The n most frequent sequences; text is made only for those that are as frequent as the n-th."""
    digests = pattern_digests(logs, window)
    least = digests.orderBy(F.desc("cnt")).limit(n).agg(F.min("cnt")).scalar()
    return top_patterns(_with_text(logs, digests.where(F.col("cnt") >= least), window, part_steps), n)


def _with_text(logs: DataFrame, digests: DataFrame, window: int | None, part_steps: int) -> DataFrame:
    keys = _keys(window)
    wanted = digests.select("path.*", "path_length", "cnt")
    steps = path_steps(logs, window).join(wanted.select(*keys), keys, "left_semi")
    pages = F.transform(F.array_sort(F.collect_list(F.struct("position", "page"))), lambda e: e["page"])
    parts = _positions(steps, keys).groupBy(*keys, F.floor(F.col("position") / part_steps).alias("part")).agg(
        F.array_join(pages, ARROW).alias("_text")
    )
    texts = parts.groupBy(*keys).agg(text_list("_text", F.struct("part", "_text"), ARROW).alias("pattern"))
    return texts.join(wanted, keys).select("pattern", "path_length", "cnt")


def count_patterns(paths: DataFrame, keys: list[str]) -> DataFrame:
    """Patterns of path rows that are stored with their pages, their parts put together."""
    texts = longer_paths(paths).select(*keys, "part", "path_length", F.array_join("path", ARROW).alias("_text"))
    whole = texts.groupBy(*keys, "path_length").agg(
        text_list("_text", F.struct("part", "_text"), ARROW).alias("pattern")
    )
    return whole.groupBy("pattern", "path_length").agg(F.count("*").alias("cnt"))


def top_patterns(patterns: DataFrame, n: int = 5) -> DataFrame:
    return patterns.orderBy(F.desc("cnt"), "pattern").limit(n)


def pattern_lengths(patterns: DataFrame) -> DataFrame:
    """Mean length over distinct patterns (or their digests), and weighted by how often they occur."""
    return patterns.agg(
        ratio(F.sum("path_length"), F.count("*")).alias("avg_path_length"),
        ratio(F.sum(F.col("path_length") * F.col("cnt")), F.sum("cnt")).alias("weighted_path_length"),
    )


def path_conversions(metrics: DataFrame) -> DataFrame:
    """Paths of two or more steps with a purchase, and those that end with it."""
    return longer_paths(metrics).agg(
        F.count_if("has_purchase").alias("conversion_paths"),
        F.count_if(F.col("has_purchase") & (F.col("end_page") == "payment")).alias("payment_end_paths"),
    )


def live_monitor(logs: DataFrame) -> DataFrame:
    """Number of key-page rows so far and the latest of them."""
    steps = path_steps(logs)
    latest = F.max_by(F.struct("user_id", "page"), F.struct("at", "log_id"))
    return steps.agg(F.count("*").alias("path_count"), latest.alias("_latest")).select(
        "path_count", F.col("_latest.user_id").alias("user_id"), F.col("_latest.page").alias("page")
    )


def purchase_alerts(logs: DataFrame) -> DataFrame:
    """One row per payment with its fixed text; stateless, so it streams as it is."""
    steps = path_steps(logs).where(F.col("page") == "payment")
    text = F.format_string("🔥 转化路径提醒 - 用户%s完成购买，路径: %s", F.col("user_id"), F.col("page"))
    return steps.select("user_id", "date", "at", "log_id", text.alias("line"))


def sequence_flags(logs: DataFrame, window: int | None = None) -> DataFrame:
    """``sequence_metrics`` of every path as plain aggregates, so that no path is put together."""
    has = {f"has_{stage}": F.bool_or(F.col("page") == stage) for stage in ("search", "product_detail", "payment")}
    order = F.struct("at", "log_id", "page")
    ends = [F.min_by("page", order).alias("start_page"), F.max_by("page", order).alias("end_page")]
    return path_steps(logs, window).groupBy(*_keys(window)).agg(*ends, *[c.alias(n) for n, c in has.items()])


def sequence_metrics(path: Column | str) -> dict[str, Column]:
    """First and last page and the presence of the main stages of a page array."""
    c = F.col(path) if isinstance(path, str) else path
    return {
        "start_page": F.try_element_at(c, F.lit(1)),
        "end_page": F.try_element_at(c, F.lit(-1)),
        "has_search": F.array_contains(c, "search"),
        "has_product_detail": F.array_contains(c, "product_detail"),
        "has_payment": F.array_contains(c, "payment"),
    }


def sequence_text(path: Column | str) -> Column:
    """Readable line of ``sequence_metrics`` (fixed text); a label of its own for an empty path."""
    c = F.col(path) if isinstance(path, str) else path
    m = sequence_metrics(c)
    line = F.format_string(
        "起始页: %s, 结束页: %s, 搜索: %s, 商品详情: %s, 支付: %s",
        m["start_page"], m["end_page"],
        *[yes_no(m[k], "有", "无") for k in ("has_search", "has_product_detail", "has_payment")],
    )
    return F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, "空路径").otherwise(line)


def path_text(paths: DataFrame) -> DataFrame:
    """Readable line per path row (fixed text)."""
    return paths.select(
        "user_id", "date", "part",
        F.format_string(
            "用户路径 - 用户ID: %s, 日期: %s, 路径: %s, 长度: %d, 购买: %s, 搜索: %s, 时长: %d秒",
            F.col("user_id"), F.col("date"), F.array_join("path", " -> "), F.col("path_length"),
            yes_no(F.col("has_purchase")), yes_no(F.col("has_search")),
            F.floor(F.col("duration") / 1000),
        ).alias("line"),
    )
