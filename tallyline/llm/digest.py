"""Document fingerprints: quartile bucket digests.

Six byte triplets of every five-byte window are hashed into BUCKETS counters. The
digest keeps for each bucket which quartile its count falls in (two bits), the
logarithm of the length, the ratios of the quartiles and a check byte. Two digests are
compared by the sum of bounded steps; ``likeness`` maps it to 0 to 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common

BUCKETS = 256
#: Places of the three bytes in a window of five.
TRIPLETS = [(0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4)]
#: Bytes of a text counted at once.
BLOCK = 1 << 18
#: A bucket whose quartiles are one, two or three steps apart costs so much.
STEPS = np.array([0, 1, 3, 6])
LENGTH_STEP, LENGTH_MOST = 4, 48
RATIO_STEP, RATIO_MOST = 2, 24
#: The difference of two unrelated texts; at and beyond it the likeness is 0.
MOST = BUCKETS * 2 + LENGTH_MOST + 2 * RATIO_MOST


def _mixed() -> np.ndarray:
    """A fixed permutation of the byte values."""
    return np.random.RandomState(17).permutation(256).astype(np.uint8)


TABLE = _mixed()


def counts(data: bytes) -> np.ndarray:
    """Bucket counts of the whole text, in blocks; shorter than a triplet: none."""
    total = np.zeros(BUCKETS, np.int64)
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    for at in range(0, n, BLOCK):
        # four more bytes, so that windows over the edge count once
        part = raw[at : at + BLOCK + 4]
        for salt, (i, j, k) in enumerate(TRIPLETS):
            m = min(len(part) - k, BLOCK)
            if m > 0:
                h = TABLE[TABLE[TABLE[part[i : i + m] ^ np.uint8(salt * 37)] ^ part[j : j + m]] ^ part[k : k + m]]
                total += np.bincount(h, minlength=BUCKETS)
    return total


def digest(data: bytes) -> str:
    """Check byte, length class, two quartile ratios and the buckets, in hexadecimal."""
    c = counts(data)
    q1, q2, q3 = np.sort(c)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    level = (c > q1).astype(np.uint8) + (c > q2) + (c > q3)
    size = min(255, round(8 * np.log2(1 + len(data))))
    ratio = [int(15 * q / q3) if q3 else 0 for q in (q1, q2)]
    check = hashlib.blake2b(data, digest_size=1).digest()[0]
    packed = level[0::4] | level[1::4] << 2 | level[2::4] << 4 | level[3::4] << 6
    return bytes([check, size, ratio[0] << 4 | ratio[1]]).hex() + packed.astype(np.uint8).tobytes().hex()


def _levels(packed: str) -> np.ndarray:
    b = np.frombuffer(bytes.fromhex(packed[6:]), np.uint8)
    return np.stack([b & 3, b >> 2 & 3, b >> 4 & 3, b >> 6], 1).ravel().astype(np.int64)


def difference(a: str, b: str) -> int:
    """Steps between two digests, each part bounded; 0 for equal digests."""
    if a == b:
        return 0
    (ca, sa, ra), (cb, sb, rb) = bytes.fromhex(a[:6]), bytes.fromhex(b[:6])
    out = int(STEPS[np.abs(_levels(a) - _levels(b))].sum()) + int(ca != cb)
    out += min(LENGTH_MOST, LENGTH_STEP * max(0, abs(sa - sb) - 1))
    for x, y in ((ra >> 4, rb >> 4), (ra & 15, rb & 15)):
        out += min(RATIO_MOST, RATIO_STEP * abs(x - y))
    return out


def likeness(a: str, b: str) -> float:
    return 1 - min(difference(a, b), MOST) / MOST


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint: one row per row; null is empty, equal texts have equal digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([digest(t.as_py()) for t in b.column(1)], pa.string())], ["doc_id", "fingerprint"])

    common.small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), common.utf8(text_col).alias("t")).mapInArrow(run, f"doc_id {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half replaced by the start of the next text, as long as that reaches."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(text: str, own: str, following: str, next_fingerprint: str) -> dict:
    changed = edited(text, following)
    data = changed.encode()
    other = digest(data)
    return {
        "n_chars": len(text), "edited_sha256": hashlib.sha256(data).hexdigest(), "fingerprint": own,
        "edited_fingerprint": other, "near_edited": likeness(own, other), "near_next": likeness(own, next_fingerprint),
    }


RESULT = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited form and against the next document by identifier.

    The documents are sorted over all tasks by identifier and hash of the text, so that
    equal identifiers have an order (the keys only are sampled for the ranges); a null identifier comes first. Inside a task the next
    document is the next row. The first and last row of every task are stored besides,
    and the last one meets the first one of the next task that has rows; behind the
    last document of all comes the first. A single document is its own next. Null text
    is empty; an empty table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    common.small_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_or_empty(text_col).alias("t"))
    key = ["doc_id", F.xxhash64("t")]
    sorted_rows = rows.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("part", F.spark_partition_id())
    id_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    schema = pa.schema([("doc_id", id_type), ("part", pa.int32()), ("edge", pa.string()), ("t", pa.string()), *RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for b in batches:
            out = []
            for doc_id, text, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                now = {"doc_id": doc_id, "part": part, "t": text, "own": digest(text.encode())}
                if before is None:
                    out.append({"doc_id": doc_id, "part": part, "edge": "first", "t": text, "fingerprint": now["own"]})
                else:
                    out.append({"doc_id": before["doc_id"], "part": part} | compared(before["t"], before["own"], text, now["own"]))
                before = now
            yield pa.RecordBatch.from_pylist(out, schema)
        if before is not None:
            yield pa.RecordBatch.from_pylist([{"doc_id": before["doc_id"], "part": before["part"], "edge": "last", "t": before["t"], "fingerprint": before["own"]}], schema)

    columns = f"doc_id {kind}, part int, edge string, t string, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    done = common.stored(sorted_rows.mapInArrow(run, columns), "digests")
    # one number per task
    parts = sorted(r.part for r in done.where("edge = 'last'").select("part").collect())
    following = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]], strict=True)), "part int, then int")
    first = done.where("edge = 'first'").select(F.col("part").alias("then"), F.col("t").alias("next_t"), F.col("fingerprint").alias("next_own"))
    last = done.where("edge = 'last'").join(following, "part").join(first, "then").select("doc_id", "t", "fingerprint", "next_t", "next_own")

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = pa.schema([("doc_id", id_type), *RESULT])
        for b in batches:
            yield pa.RecordBatch.from_pylist([{"doc_id": r["doc_id"]} | compared(r["t"], r["fingerprint"], r["next_t"], r["next_own"]) for r in b.to_pylist()], kept)

    wanted = ["doc_id", *(n for n, _ in RESULT)]
    return done.where("edge IS NULL").select(*wanted).unionByName(last.mapInArrow(edges, columns.replace("part int, edge string, t string, ", "")))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(common.table(spark, sf_dir, "documents"))
