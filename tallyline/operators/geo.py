"""Log flattening and the lookup of addresses in a table of address ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.text import json_words, region_text
from tallyline.functions.times import col_of, epoch_text
from tallyline.schema import ENRICHED_LOG

PLACES = ["country", "province", "city"]
#: The first 24 of 32 hexadecimal digits of every IPv4 address, as an IPv6 address holds it.
V4 = "00000000000000000000ffff"
#: At most so many slices; each has about as many addresses.
SLICES = 2_000


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ip_number(ip: Column | str) -> Column:
    """Dotted IPv4 address as a number; NULL for anything else."""
    octets = F.transform(F.split(col_of(ip), r"\."), lambda o: o.try_cast("bigint"))

    def number(o: Column) -> Column:
        value = F.get(o, F.lit(0)) * 16777216 + F.get(o, F.lit(1)) * 65536 + F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3))
        return F.when((F.size(o) == 4) & F.forall(o, lambda x: x.between(0, 255)), value)

    return _let(octets, number)


def number_key(number: Column | str) -> Column:
    """The key of an IPv4 address given as a number."""
    return _let(col_of(number), lambda n: F.when(n.between(0, 0xFFFFFFFF), F.concat(F.lit(V4), F.lpad(F.lower(F.hex(n)), 8, "0"))))


def ip_key(ip: Column | str) -> Column:
    """IPv4 or IPv6 address as 32 hexadecimal digits, which sort as the 128-bit number; NULL for anything else.

    ``::`` and a dotted IPv4 end are read; ``::ffff:1.2.3.4`` is the same as ``1.2.3.4``.
    """
    dotted = r"(?<=:)[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$"

    def plain(text: Column) -> Column:
        """The text with a dotted end written as two groups; NULL if that is no address."""
        number = ip_number(F.regexp_substr(text, F.lit(dotted)))
        digits = _let(number, lambda n: F.concat(F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(n.bitwiseAND(F.lit(65535))))))
        return F.when(~text.contains("."), text).otherwise(F.concat(F.regexp_replace(text, dotted, ""), digits))

    def groups(half: Column) -> Column:
        return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":"))

    def filled(halves: Column) -> Column:
        """Groups of both sides, with as many zeros between them as the address leaves out."""
        sides = F.transform(halves, groups)
        return _let(sides, lambda s: F.when(
            (F.size(s) == 2) & (F.size(F.flatten(s)) < 8),
            F.concat(F.get(s, F.lit(0)), F.array_repeat(F.lit("0"), 8 - F.size(F.flatten(s))), F.get(s, F.lit(1))),
        ).when(F.size(s) == 1, F.get(s, F.lit(0))))

    def shown(whole: Column) -> Column:
        fine = (F.size(whole) == 8) & F.forall(whole, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(fine, F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), ""))

    text = F.lower(col_of(ip))
    v6 = F.when(text.contains(":"), _let(filled(F.split(_let(text, plain), "::")), shown))
    return F.coalesce(number_key(ip_number(ip)), v6)


def _size(key: Column | str) -> Column:
    """The key as a double; never smaller for a larger key."""
    c = col_of(key)
    high, low = (F.conv(F.substring(c, at, 16), 16, 10).cast("double") for at in (1, 17))
    return high * float(1 << 64) + low


def _keyed(ranges: DataFrame) -> DataFrame:
    """The ranges with the keys of their ends, which are IPv4 numbers or addresses of either kind."""
    kinds = dict(ranges.dtypes)
    ends = {f"_{e}": ip_key(e) if kinds[e] == "string" else number_key(F.col(e).cast("bigint")) for e in ("lo", "hi")}
    return ranges.select(*[c.alias(n) for n, c in ends.items()], *PLACES).where(F.col("_lo") <= F.col("_hi"))


def locate(rows: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Adds country, province and city of the (disjoint) range that holds the IPv4 or IPv6 address.

    Addresses and ranges are swept in one order: in each slice of the address space the
    last range that begins at or before an address is the only one that can hold it. A
    range is put into every slice that it reaches into, so a slice begins with the range
    that is open there. Slices are cut at quantiles of the addresses (a mergeable sketch
    inside the query, no job of its own); an address that is many of the quantiles has the
    slices between them, dealt by hash. Rows without a readable address are dealt by hash
    and meet nothing. A stream is joined with the ranges by address prefix instead, as it
    cannot be sorted.
    """
    if rows.isStreaming:
        return _locate_by_prefix(rows, _keyed(ranges), ip)
    slices = min(SLICES, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), ip_key(ip).alias("_key"))
    cuts = keyed.where(F.col("_key").isNotNull()).agg(
        F.percentile_approx(_size("_key"), [k / slices for k in range(1, slices)], 10 * slices).alias("cuts")
    ).scalar()

    def slots(key: str) -> Column:
        """First and last slice of a key: the quantiles below it, and those not above it."""
        below = lambda size, c: F.aggregate(cuts_of, F.lit(0), lambda n, b: n + c(b, size).cast("int"))
        cuts_of = F.coalesce("_cuts", F.array().cast("array<double>"))
        return _let(_size(key), lambda s: F.struct(below(s, lambda b, z: b < z).alias("first"), below(s, lambda b, z: b <= z).alias("last")))

    sized = keyed.withColumn("_cuts", cuts).withColumn("_at", F.when(F.col("_key").isNotNull(), slots("_key")))
    deal = F.xxhash64("_row")
    of_row = F.when(F.col("_key").isNull(), F.pmod(deal, F.lit(slices))).otherwise(
        F.col("_at.first") + F.pmod(deal, F.col("_at.last") - F.col("_at.first") + 1)
    )
    spans = _keyed(ranges).withColumn("_cuts", cuts).withColumns({"_from": slots("_lo"), "_to": slots("_hi")})
    place = F.struct(F.col("_hi").alias("hi"), *PLACES)
    both = sized.select("_row", "_key", of_row.cast("int").alias("_slice")).unionByName(
        spans.select(F.explode(F.sequence("_from.first", "_to.last")).alias("_slice"), F.col("_lo").alias("_key"), place.alias("_range")),
        allowMissingColumns=True,
    )
    # a range comes before the address it begins with; NULL keys come first and meet nothing
    sweep = Window.partitionBy("_slice").orderBy("_key", F.col("_row").isNotNull())
    open_range = F.last("_range", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = both.withColumn("_open", open_range).where(F.col("_row").isNotNull())
    holds = F.col("_key") <= F.col("_open.hi")
    return swept.select("_row.*", *[F.coalesce(F.when(holds, F.col(f"_open.{c}")), F.lit("")).alias(c) for c in PLACES])


def _prefix(key: str) -> Column:
    """Sixteen bits of the address and its kind as a number."""
    c = F.col(key)
    v4 = c.startswith(V4)
    bits = F.conv(F.when(v4, F.substring(c, 25, 4)).otherwise(F.substring(c, 1, 4)), 16, 10).cast("int")
    return F.when(v4, bits - 65_536).otherwise(bits)


def _locate_by_prefix(rows: DataFrame, ranges: DataFrame, ip: str) -> DataFrame:
    """An equality join on prefixes, the ranges cut at them, with the range test as filter."""
    cut = ranges.withColumn("_prefix", F.explode(F.sequence(_prefix("_lo"), _prefix("_hi"))))
    numbered = rows.withColumn("_key", ip_key(ip)).withColumn("_at", _prefix("_key"))
    match = (F.col("_at") == F.col("_prefix")) & F.col("_key").between(F.col("_lo"), F.col("_hi"))
    own = cut.withColumnsRenamed({c: f"_{c}" for c in PLACES})
    return numbered.join(own, match, "left").select(
        *[F.col(f"`{c}`") for c in rows.columns], *[F.coalesce(f"_{c}", F.lit("")).alias(c) for c in PLACES]
    )


def flatten_logs(logs: DataFrame) -> DataFrame:
    """Nested log record (``schema.RAW_LOG``) as flat row; rows without device are dropped."""
    return logs.where(F.col("device").isNotNull()).select(
        "device.*", "log_id", "gis.ip", "network.net", "opa", "log_type", "ts",
        epoch_text("ts").alias("formatted_time"), "product_id", "order_id", "user_id",
        json_words("keywords").alias("keywords"),
    )


def enrich_logs(logs: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Flat log rows with country, province, city and their joined text (blank if unknown)."""
    flat = flatten_logs(logs)
    if ranges is None:
        located = flat.withColumns({c: F.lit("") for c in PLACES})
    else:
        located = locate(flat, ranges)
    region = region_text(*PLACES)
    return located.withColumn("region", region).select(*ENRICHED_LOG.fieldNames())
