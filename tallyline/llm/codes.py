"""Vector codes: k-means of integer sub-vectors in rounds over Hilbert-sorted blocks.

A vector is cut into PARTS parts, each with a codebook of ENTRIES integer vectors. The
vectors are stored once, in chunks of some thousand rows. In a chunk the sub-vectors of
each part are sorted along a Hilbert curve and cut into flat blocks of BLOCK neighbours;
a block has the smallest and largest value of each component (its box) and the sums.

In a round, the least and the largest distance from a block's box to each entry leave a
shortlist: an entry whose least distance is over another's largest one cannot be the
nearest. A block with a shortlist of one adds its stored sums and looks at no sub-vector;
the others compare their sub-vectors with the entries of the shortlist in exact integers.
A round moves only sums: ENTRIES rows of the dimension from a task, added up by Spark.
No vector moves between tasks at any time, since a chunk holds all parts of its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CHUNK, BLOCK = 1 << 13, 64
#: Components below this keep all squared distances in 64 bits; others use Python's integers.
SMALL = 1 << 28


def hilbert(points: np.ndarray) -> np.ndarray:
    """Place of each point (rows of integers) on a Hilbert curve through their box."""
    n, dim = points.shape
    bits = max(1, min(16, 63 // max(dim, 1)))
    low = points.min(axis=0) if n else np.zeros(dim)
    span = max(int((points.max(axis=0) - low).max()), 1) if n and dim else 1
    x = [((points[:, i] - low[i]).astype(np.float64) * ((1 << bits) - 1) / span).astype(np.uint64) for i in range(min(dim, 63))]
    place = np.zeros(n, np.uint64)
    if not x:
        return place
    for level in range(bits - 1, 0, -1):  # undo the turns of the cells on this level
        bit, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(len(x)):
            high = (x[i] & bit) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(n, np.uint64)
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> np.uint64(level)) & np.uint64(1), turn ^ np.uint64((1 << level) - 1), turn)
    for level in range(bits - 1, -1, -1):
        for c in x:
            place = (place << np.uint64(1)) | (((c ^ turn) >> np.uint64(level)) & np.uint64(1))
    return place


def bounds(dim: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin and the last one ends; equal parts if ``parts`` divides ``dim``."""
    return [dim * i // parts for i in range(parts + 1)]


def integers(vectors: np.ndarray) -> np.ndarray:
    whole = np.floor(vectors.astype(np.float64) * SCALE)
    if whole.size and np.abs(whole).max() >= 2.0**62:
        raise ValueError("components of 2^50 or more cannot be coded")
    return whole.astype(np.int64)


class Blocks:
    """Sorted sub-vectors of one part of a chunk with the boxes and sums of their blocks."""

    def __init__(self, points: np.ndarray, order: np.ndarray, boxes: np.ndarray):
        self.points, self.order = points, order
        self.low, self.high, self.sums = boxes
        self.starts = np.arange(0, len(points), BLOCK)
        self.sizes = np.diff(np.append(self.starts, len(points)))

    @classmethod
    def build(cls, points: np.ndarray) -> Blocks:
        order = np.argsort(hilbert(points), kind="stable").astype(np.int32)
        points = points[order]
        starts = np.arange(0, len(points), BLOCK)
        boxes = np.stack([f.reduceat(points, starts, axis=0) for f in (np.minimum, np.maximum, np.add)])
        return cls(points, order, boxes)

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return self.points.tobytes(), self.order.tobytes(), np.stack([self.low, self.high, self.sums]).tobytes()

    @classmethod
    def unpacked(cls, points: bytes, order: bytes, boxes: bytes, dim: int) -> Blocks:
        at = np.frombuffer(order, np.int32)
        n = -(-len(at) // BLOCK)
        return cls(np.frombuffer(points, np.int64).reshape(len(at), dim), at, np.frombuffer(boxes, np.int64).reshape(3, n, dim))

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """Per block and entry: may the entry be the nearest to a point of the block?"""
        least, most = [], []
        for e in entries:
            below, above = self.low - e, e - self.high
            gap, far = np.maximum(np.maximum(below, above), 0), np.maximum(np.abs(below), np.abs(above))
            least.append((gap * gap).sum(axis=1))
            most.append((far * far).sum(axis=1))
        return (np.array(least) <= np.array(most).min(axis=0)).T

    def nearest(self, entries: np.ndarray, distances: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        """Entry of each point in sorted order, its squared distance if asked for, blocks of one entry."""
        large = max(int(np.abs(a).max(initial=0)) for a in (self.points, entries)) >= SMALL
        if large:
            entries, plain = entries.astype(object), self
            self = Blocks(plain.points.astype(object), plain.order, np.stack([plain.low, plain.high, plain.sums]).astype(object))
        short = self.shortlists(entries).astype(bool)
        lone = short.sum(axis=1) == 1
        index = np.repeat(short.argmax(axis=1), self.sizes)
        best = np.full(len(self.points), -1, object if large else np.int64)
        seek = short if distances else short & ~lone[:, None]
        for k, e in enumerate(entries):
            rows = np.flatnonzero(np.repeat(seek[:, k], self.sizes))
            away = self.points[rows] - e
            dist = (away * away).sum(axis=1) if large else np.einsum("ij,ij->i", away, away)
            closer = (best[rows] < 0) | (dist < best[rows])
            best[rows[closer]], index[rows[closer]] = dist[closer], k
        return index, best if distances else None, lone


def _round(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """part, entry, at, total, n: sums of the sub-vectors nearest to each entry, one set per task."""
    sums = [[[0] * b.shape[1] for _ in b] for b in books]
    counts = [[0] * len(b) for b in books]
    for part, own in _blocks(batches, [b.shape[1] for b in books]):
        index, _, lone = own.nearest(books[part], False)
        single = np.flatnonzero(lone)
        of_block = index[own.starts[single]] if len(single) else np.array([], int)
        rest = np.flatnonzero(~np.repeat(lone, own.sizes))
        for k in range(len(books[part])):
            some, blocks = rest[index[rest] == k], single[of_block == k]
            counts[part][k] += len(some) + int(own.sizes[blocks].sum())
            sums[part][k] = [s + int(x) + int(y) for s, x, y in zip(sums[part][k], _sum(own.points[some]), _sum(own.sums[blocks]), strict=True)]
    rows = [(p, k, i, x, counts[p][k]) for p, per in enumerate(sums) for k, s in enumerate(per) for i, x in enumerate(s) if counts[p][k]]
    if rows:
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64())
        cols = [list(c) for c in zip(*rows, strict=True)]
        cols[3] = [str(x) for x in cols[3]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["part", "entry", "at", "total", "n"])


def _sum(rows: np.ndarray) -> np.ndarray:
    """Exact sums of the columns: high and low halves are added apart."""
    low = (rows & 0xFFFFFFFF).sum(axis=0).astype(object)
    return low + ((rows >> 32).sum(axis=0).astype(object) << 32)


def _blocks(batches: Iterator[pa.RecordBatch], dims: list[int]) -> Iterator[tuple[int, Blocks]]:
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("points", "places", "boxes")), strict=True):
            for part, (points, places, boxes) in enumerate(zip(*row, strict=True)):
                yield part, Blocks.unpacked(points, places, boxes, dims[part])


def chunks(rows: DataFrame, dim: int, vec_col: str = "embedding") -> DataFrame:
    """``ids`` and ``labels`` of up to CHUNK rows with the sorted blocks of each part."""
    cut = bounds(dim)
    names = ["ids", "labels", "points", "places", "boxes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            held.clear()
            ids, labels, vectors = (c.combine_chunks() for c in table.columns)
            whole = integers(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            packed = [Blocks.build(np.ascontiguousarray(whole[:, a:z])).packed() for a, z in zip(cut, cut[1:], strict=False)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), c) for c in (ids, labels)]
            return pa.RecordBatch.from_arrays(lists + [pa.array([list(c)], pa.list_(pa.binary())) for c in zip(*packed, strict=True)], names)

        for b in batches:
            at = 0
            while at < b.num_rows:
                some = b.slice(at, CHUNK - sum(h.num_rows for h in held))
                at += some.num_rows
                held.append(some)
                if sum(h.num_rows for h in held) == CHUNK:
                    yield out()
        if held:
            yield out()

    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    schema = f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, points array<binary>, places array<binary>, boxes array<binary>"
    return rows.select("vec_id", "label", vec_col).mapInArrow(run, schema)


def _fine(vec_col: str):
    """The vector is there and all its components are numbers."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & ~bad


def start(rows: DataFrame, vec_col: str) -> list[np.ndarray]:
    """The first codebook of each part: that part of the rows with the smallest identifiers."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), vec_col).limit(ENTRIES).select(vec_col).collect()
    if not first:
        return []
    whole = integers(np.array([r[0] for r in first]))
    cut = bounds(whole.shape[1])
    return [np.ascontiguousarray(whole[:, a:z]) for a, z in zip(cut, cut[1:], strict=False)]


def improved(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round; entries without a part stay."""
    sums = blocks.mapInArrow(lambda b: _round(b, books), "part int, entry int, at int, total string, n bigint")
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    new = [b.copy() for b in books]
    # PARTS * ENTRIES codebook vectors, whatever the number of rows
    for r in sums.groupBy("part", "entry", "at").agg(total.alias("total"), F.sum("n").alias("n")).collect():
        new[r.part][r.entry][r.at] = int(r.total) // r.n
    return new


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for e in b for x in e).encode()).hexdigest()


def coded(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code, error of every vector, and the codebooks.

    Vectors that are null or empty or hold a null, a NaN or an infinity are left out, and so
    are vectors of another length than that of the smallest identifier (a null one is the
    largest). Rows with the same identifier are coded each for itself. Fewer rows than
    ENTRIES give smaller codebooks, an empty table no rows. Of a length that PARTS does not
    divide, parts differ by one component. Nearest entries are the same in exact
    arithmetic; ``error`` is null where it does not fit into 64 bits, components of 2^50
    or more raise an error. Other columns are not looked at.
    """
    rows = rows.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    kept = rows.where(_fine("vec"))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vec").select(F.size("vec")).first()
    dim = first[0] if first else 0
    kept = kept.where(F.size("vec") == dim)
    books = start(kept, "vec") if dim else []
    kinds = [rows.schema[c].dataType for c in ("vec_id", "label")]
    schema = f"vec_id {kinds[0].simpleString()}, label {kinds[1].simpleString()}, code string, error bigint"
    if not books:
        return rows.sparkSession.createDataFrame([], schema), []
    blocks = common.stored(chunks(kept, dim, "vec"), "vector-blocks")
    for _ in range(rounds):
        books = improved(blocks, books)
    return blocks.mapInArrow(lambda b: _codes(b, books), schema), books


def _codes(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    dims = [b.shape[1] for b in books]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids, labels = row.column("ids").flatten(), row.column("labels").flatten()
            codes = np.zeros((len(ids), len(books)), np.uint8)
            errors: np.ndarray = np.zeros(len(ids), object)
            for part, own in _blocks(iter([row]), dims):
                index, away, _ = own.nearest(books[part], True)
                codes[own.order, part] = index
                errors[own.order] += away
            text = codes.tobytes().hex()
            width = 2 * len(books)
            code = [text[k : k + width] for k in range(0, len(text), width)]
            error = pa.array([int(x) if x < 1 << 63 else None for x in errors], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code), error], ["vec_id", "label", "code", "error"])


def with_label_errors(rows: DataFrame) -> DataFrame:
    """The rows with ``label_error``, the errors of all rows of the same label; nulls are one label."""
    own = common.stored(rows.withColumn("no_label", F.col("label").isNull()).withColumn("of", F.coalesce(F.col("label").cast("string"), F.lit(""))), "vector-codes")
    sums = own.groupBy("no_label", "of").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error"), F.count("*").alias("size"))
    return common.attach(own, sums, ["no_label", "of"], "size").drop("no_label", "of", "size")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = coded(common.table(spark, sf_dir, "embeddings"))
    return with_label_errors(rows).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    steps = [
        f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding, len(embedding) // {PARTS} AS width FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (
  SELECT r, (i - 1) // width AS part, (i - 1) % width AS place, floor({SCALE} * embedding[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
), c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, place, x AS c FROM v WHERE r <= {ENTRIES})"""
    ]
    for t in range(ROUNDS + 1):
        steps.append(
            f"""a{t} AS MATERIALIZED (
  SELECT r, part, min_by(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d
  FROM (SELECT r, part, entry, sum((x - c) * (x - c)) AS d FROM v JOIN c{t} USING (part, place) GROUP BY r, part, entry) GROUP BY r, part
)"""
        )
        if t < ROUNDS:
            steps.append(
                f"""c{t + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, c) AS c
  FROM c{t} LEFT JOIN (SELECT part, entry, place, sum(x) AS s, count(*) AS n FROM a{t} JOIN v USING (r, part) GROUP BY part, entry, place) USING (part, entry, place)
)"""
            )
    last = f"""SELECT vec_id, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error,
  (sum(sum(d)) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM c{ROUNDS}) AS codebooks_sha256
FROM a{ROUNDS} JOIN kept USING (r) GROUP BY r, vec_id, label"""
    return ", ".join(steps) + "\n" + last


OP12_SQL = _sql()
