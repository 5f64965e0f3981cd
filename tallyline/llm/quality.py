"""Quality classifier: a factorisation machine over hashed words and text structure.

score(x) = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise part
is half of |sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2, so a text costs one pass over its
features. Inputs come from the text alone: hashed words, shares of character classes,
line and word statistics, and its size. The model is fitted on at most SAMPLE labelled
rows (those with the smallest hash of their identifier); everything else is scored
where it lies.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common

#: Labelled rows that the fit may see; hashed word features; rank of the interactions.
SAMPLE, WORDS, RANK = 8_000, 1 << 12, 8
EPOCHS, STEP, L2, BATCH, SEED = 10, 0.1, 1e-5, 128, 7
FOLDS, THRESHOLD = 5, 0.3

CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"|", b"#$%&*@^~", b"()[]{}<>\"'`", b"=+-/\\_", b" \t", b"\n\r",
    bytes(range(128, 256)),
]
CLASS_OF = np.zeros((256, len(CLASSES)))
for _i, _c in enumerate(CLASSES):
    CLASS_OF[list(_c), _i] = 1
STATS = len(CLASSES) + 9


def structure(data: bytes, words: list[bytes], counts: Counter) -> np.ndarray:
    """Shares of character classes, then word, line and size statistics."""
    n = max(len(data), 1)
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ CLASS_OF / n
    lines = [line for line in data.split(b"\n") if line]
    total = max(len(words), 1)
    return np.concatenate([
        shares,
        [
            len(set(lines)) / max(len(lines), 1),
            np.log1p(n / max(len(lines), 1)),
            len(counts) / total,
            max(counts.values(), default=0) / total,
            sum(map(len, words)) / total / 10,
            sum(w.isalpha() or not w.isascii() for w in words) / total,
            sum(w.isupper() for w in words) / total,
            np.log1p(len(data)) / 10,
            np.log1p(total) / 10,
        ],
    ])


def features(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed word indices, their values, structure statistics) of a whole text in UTF-8."""
    words = data.split()
    stats = structure(data, words, Counter(words))
    bag = Counter(data.lower().split())
    index = np.fromiter((zlib.crc32(w) for w in bag), np.int64, len(bag)) % WORDS
    weight = np.bincount(index, np.log1p(np.fromiter(bag.values(), float, len(bag))), WORDS)
    kept = np.flatnonzero(weight)
    value = weight[kept]
    norm = np.sqrt((value**2).sum())
    return kept, value / norm if norm else value, stats


@dataclass
class Model:
    """Features are the hashed words, then the standardised statistics."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    std: np.ndarray

    def row(self, index: np.ndarray, value: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((stats - self.mean) / self.std, -4, 4) / 4
        return np.concatenate([index, np.arange(WORDS, WORDS + STATS)]), np.concatenate([value, z])

    def score(self, data: bytes) -> float:
        i, x = self.row(*features(data))
        v = self.v[i]
        pairs = ((x @ v) ** 2).sum() - (x**2 @ (v**2)).sum()
        return float(1 / (1 + np.exp(-np.clip(self.bias + x @ self.w[i] + pairs / 2, -30, 30))))


def fitted(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Logistic loss by AdaGrad on a bounded sample; without rows every score is one half."""
    good = float(labels.sum())
    bias = float(np.log((good + 1) / (len(labels) - good + 1)))
    rng = np.random.default_rng(SEED)
    size = WORDS + STATS
    model = Model(bias, np.zeros(size), rng.normal(0, 0.05, (size, RANK)), np.zeros(STATS), np.ones(STATS))
    if not 0 < good < len(labels):
        model.v[:] = 0
        return model
    stats = np.array([r[2] for r in rows])
    model.mean, model.std = stats.mean(0), stats.std(0) + 1e-6
    rows = [model.row(*r) for r in rows]
    gw, gv, gb = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            i = np.concatenate([rows[k][0] for k in some])
            x = np.concatenate([rows[k][1] for k in some])
            starts = np.cumsum([0] + [len(rows[k][0]) for k in some[:-1]])
            of = np.repeat(np.arange(len(some)), np.diff([*starts, len(i)]))
            xv = model.v[i] * x[:, None]
            sums = np.add.reduceat(xv, starts)
            z = model.bias + np.add.reduceat(model.w[i] * x, starts) + ((sums**2).sum(1) - np.add.reduceat((xv**2).sum(1), starts)) / 2
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]) / len(some)
            dw = np.bincount(i, error[of] * x, size) + L2 * model.w
            per = (error[of] * x)[:, None] * (sums[of] - xv)
            dv = np.stack([np.bincount(i, per[:, f], size) for f in range(RANK)], 1) + L2 * model.v
            gw += dw**2
            gv += dv**2
            gb += error.sum() ** 2
            model.w -= STEP * dw / np.sqrt(gw)
            model.v -= STEP * dv / np.sqrt(gv)
            model.bias -= STEP * error.sum() / np.sqrt(gb)
    return model


def held_out(id_col: Column) -> Column:
    """Rows never learnt from; those without an identifier are among them."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled rows of ``docs`` outside the held-out fold.

    At most ``sample`` rows are used, chosen by the hash of the identifier; only their
    features reach the driver. Null labels and labels without a document are left out.
    """
    chosen = (
        labels.where(~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
        .select(F.col("doc_id").alias("of"), F.col("quality").cast("double").alias("y"), F.xxhash64("doc_id").alias("rank"))
        .orderBy("rank", "of", "y")
        .limit(sample)
    )
    own = docs.select(F.col("doc_id").alias("own"), common.utf8().alias("t"))
    # a fixed number of label rows at most
    rows = own.join(F.broadcast(chosen), F.col("own") == F.col("of")).select("rank", "of", "y", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [features(t.as_py()) for t in b.column(3)]
            packed = [
                pa.array([f[0].astype("<u2").tobytes() for f in parts], pa.binary()),
                pa.array([f[1].astype("<f4").tobytes() for f in parts], pa.binary()),
                pa.array([f[2].astype("<f8").tobytes() for f in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *packed], ["rank", "of", "y", "i", "x", "s"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = (
        rows.mapInArrow(run, f"rank bigint, of {kind}, y double, i binary, x binary, s binary")
        .orderBy("rank", "of", "y", "i", "x")
        .limit(sample)
        .collect()
    )
    parts = [(np.frombuffer(r.i, "<u2").astype(np.int64), np.frombuffer(r.x, "<f4").astype(float), np.frombuffer(r.s, "<f8")) for r in got]
    return fitted(parts, np.array([r.y for r in got], float))


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(doc, score): each whole row as a struct, and its score from 0 to 1.

    Null texts count as empty; those are scored as well. The row is passed on as it is,
    so columns of any name are safe, and repeated rows stay repeated with equal scores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.score(t.as_py()) for t in b.column(1)], pa.float64())], ["doc", "score"])

    common.small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), common.utf8(text_col).alias("t"))
    return rows.mapInArrow(run, f"doc {docs.schema.simpleString()}, score double")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    # the text is not needed behind the score
    rows = scored(docs.select("doc_id", "text"), model).select("doc.doc_id", "score")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
