"""SimHash near-dedup by deletion-variant signatures.

A fingerprint has 64 bits and links to others at DISTANCE or fewer differing bits.
Cut into DISTANCE // 2 + 1 segments, two linked fingerprints have one segment that
differs by one bit at most. Each segment is indexed once per bit position with that
bit wiped (a wildcard), so linked fingerprints share a key of one equality join; the
join condition then counts the differing bits of the whole fingerprint. A pair is
taken under one of its shared keys only.

Components instead of pairs: copies are one fingerprint from the start, and links are
searched at growing distances (1, 2, then DISTANCE). What is connected already shares
a label, and the join gives out pairs of different labels only. A dense group of near
copies is joined through its closest members first, so its pairs are never written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common
from tallyline.llm.links import smallest_labels

BITS, SHINGLE, DISTANCE, SEED = 64, 4, 4, 42
#: Shingles of a very long text are counted in blocks of this many.
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if it is set in over half of the hashes of the word shingles.

    ``bytes.lower`` and ``bytes.split`` know ASCII only: A-Z and \\x20, \\x09-\\x0D.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    last = max(n - shingle, 0)
    total = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    join = b" ".join
    for at in range(0, last + 1, BLOCK):
        end = min(at + BLOCK, last + 1)
        h = np.array([digest(join(words[i : i + shingle]), seed) for i in range(at, end)], np.dtype("<u8"))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = total * 2 > last + 1
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (64 bits as a long): one row per row of ``docs``; no words: zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    common.small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), common.utf8(text_col).alias("t")).mapInArrow(run, f"doc_id {kind}, fp bigint")


def _segments(parts: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    edges = [round(i * BITS / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def variants(points: DataFrame, parts: int) -> DataFrame:
    """(fp, label) once per one-wildcard variant: wild bit, bits left of the segment."""
    keys = [
        F.struct(F.lit(bit).cast("int").alias("wild"), F.col("fp").bitwiseAND(F.lit(_signed((((1 << w) - 1) << a) & ~(1 << bit))).cast("long")).alias("rest"))
        for a, w in _segments(parts)
        for bit in range(a, a + w)
    ]
    return points.select("fp", "label", F.explode(F.array(*keys)).alias("k")).select("fp", "label", "k.wild", "k.rest")


def new_links(points: DataFrame, distance: int) -> DataFrame:
    """Pairs of labels (low, high) of fingerprints at most ``distance`` bits apart.

    Every such pair of fingerprints with different labels is found: with
    distance // 2 + 1 segments one of them differs by one bit at most. The pair counts
    in the first such segment only, under the differing bit or, if none, the first one.
    """
    parts = distance // 2 + 1
    # Spark does not count the rows that explode adds: sized by the points, the variants would go to the driver for a broadcast
    side = variants(points, parts).hint("merge")
    a, b = side.alias("a"), side.alias("b")
    diff = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    within = lambda s: diff.bitwiseAND(F.lit(_signed(((1 << s[1]) - 1) << s[0])).cast("long"))
    chosen = F.lit(-1)
    for s in reversed(_segments(parts)):
        x = within(s)
        # the wild bit of a segment that differs by one bit: its place is the number of bits below it
        place = F.when(x == 0, F.lit(s[0])).otherwise(F.bit_count(F.when(x == F.lit(-(1 << 63)), F.lit((1 << 63) - 1)).otherwise(x - 1)))
        chosen = F.when(F.bit_count(x) <= 1, place).otherwise(chosen)
    on = (
        (F.col("a.wild") == F.col("b.wild"))
        & (F.col("a.rest") == F.col("b.rest"))
        & (F.col("a.label") < F.col("b.label"))
        & (F.bit_count(diff) <= distance)
        & (F.col("a.wild") == chosen)
    )
    return a.join(b, on).select(F.col("a.label").alias("low"), F.col("b.label").alias("high")).distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp, component_id (smallest id reachable over links), component_size.

    One row per row of ``docs``. Null and empty texts have fingerprint zero and link like
    any other. Rows that share an identifier are linked through it as well as through
    their texts only if their fingerprints are; a null identifier is never the smallest.
    Other columns are not looked at.
    """
    rows = common.stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    points = rows.groupBy("fp").agg(F.min("doc_id").alias("label"), F.count(F.lit(1)).alias("n"))
    # a fingerprint of rows without any identifier still needs a label of its own
    points = common.stored(points.select("fp", F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.col("fp")).alias("id")).alias("label"), "n"), "points")
    for step in sorted({min(1, distance), min(2, distance), distance}):
        links = common.stored(new_links(points, step) if step else points.limit(0).select(F.col("label").alias("low"), F.col("label").alias("high")), "links")
        if links.isEmpty():
            continue
        merged = smallest_labels(links)
        points = common.stored(
            points.join(merged, points["label"] == merged["node"], "left").select("fp", F.coalesce("root", "label").alias("label"), "n"), "points"
        )
    sizes = points.groupBy("label").agg(F.sum("n").alias("component_size"))
    known = common.stored(points.join(sizes, "label").select("fp", F.when(~F.col("label.none"), F.col("label.id")).alias("component_id"), "component_size", "n"), "known")
    return common.attach(rows, known, ["fp"], "n").select("doc_id", "fp", "component_id", "component_size")


def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component_size")
