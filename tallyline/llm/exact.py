"""Exact dedup: sorted digest runs merged over a tree of exchanges.

Every document belongs to one of ``fan ** levels`` runs. A run is sorted by digest and holds
each of its digests once, with the identifier that stays and the number of copies: a task
sorts its rows before it sends any, and neighbours with one digest become one row. In round k
the runs that differ only in digit k of their number exchange rows: each of them keeps
the slice of digests that has its own digit there, and merges the ``fan`` pieces it
gets in the order of their digests, joining neighbours again. Sorting and merging are
Spark's external sort under a sort aggregate, so a run may be larger than memory. After the
last round each run holds one slice of all digests, and no task ever sees more than its
slice. Every level joins copies before the next exchange, so a text that fills a third of
the corpus moves ``runs`` rows at most.

Texts count as equal when SHA-256, a second independent hash and the length all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common

#: Runs combined by one exchange, and the fewest exchanges.
FAN, LEVELS = 16, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Only A-Z change; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and the digests of the normalised text."""
    text = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("t"))
    return text.select(
        "doc_id",
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.xxhash64("t").alias("check"),
        F.octet_length("t").cast("long").alias("bytes"),
    )


def rounds(spark: SparkSession, fan: int = FAN) -> int:
    """Exchanges that give every shuffle partition of the session a run of its own."""
    partitions, levels = int(spark.conf.get("spark.sql.shuffle.partitions")), LEVELS
    while fan**levels < partitions:
        levels += 1
    return levels


def merged(rows: DataFrame, fan: int = FAN, levels: int | None = None) -> DataFrame:
    """(digest, check, bytes, keep_id, group_size) once per text, by rounds of exchanges.

    The largest identifier of a text stays; a null identifier only if there is no other.
    The number of rounds follows the session's shuffle partitions unless it is given;
    the result does not depend on it.
    """
    levels = rounds(rows.sparkSession, fan) if levels is None else levels
    runs = fan**levels
    keys = ["slot", "digest", "check", "bytes"]
    slice_of = F.pmod(F.xxhash64("digest"), F.lit(runs))
    level = rows.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(runs)))
    # the largest of structs is kept by neighbours in sorted order, never in a hash table
    level = level.groupBy(*keys).agg(F.max(F.struct("doc_id")).alias("kept"), F.count(F.lit(1)).alias("group_size"))
    for k in range(levels):
        digit = lambda c, k=k: F.floor(c / F.lit(fan**k)) % fan
        moved = F.col("slot") + (digit(slice_of) - digit(F.col("slot"))) * F.lit(fan**k)
        level = (
            level.withColumn("slot", moved.cast("long"))
            .repartition("slot")
            .groupBy(*keys)
            .agg(F.max("kept").alias("kept"), F.sum("group_size").alias("group_size"))
        )
    return level.select("digest", "check", "bytes", F.col("kept.doc_id").alias("keep_id"), "group_size")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Null texts are empty texts; empty texts form a group like any other. Rows that
    share an identifier are one document: they are counted singly and kept together.
    Rows without an identifier lose to any with one. Other columns are not looked at.
    """
    rows = common.stored(digests(docs, id_col, text_col), "digests")
    groups = common.stored(merged(rows), "groups")
    return common.attach(rows, groups, ["digest", "check", "bytes"], "group_size").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(common.table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
