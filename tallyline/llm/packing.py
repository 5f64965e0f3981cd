"""Packing with a controlled mixture: deficit round robin over the queues of the sources.

Documents are tokenised once into a stored table. They are dealt to shards of about
SHARD_TOKENS tokens; each shard has one queue per source. In every window each source
gets its target share of WINDOW tokens as credit and gives out whole documents while
the credit lasts; what is left is its deficit and goes over to the next window. The
deficits a shard starts with are those that all shards before it leave: target share
of their tokens minus tokens of the source, from one small table of counts.

The stream of documents is cut every SEQUENCE tokens. The rest of a shard becomes
sequences whose lengths are powers of two, so nothing is padded.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm import common

SEQUENCE, END = 2048, 1
WINDOW, SHARD_TOKENS = 64 * SEQUENCE, 4_000_000
#: Words whose ids a task remembers.
MEMO = 1 << 19
_encoders: dict[str, Encoder] = {}


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of whole texts as unsigned 16-bit integers; equal to the tokenizer's own.

    The tokenizer drops white space and never joins what it separates, so the ids of a
    text are those of its words, which are remembered. Signs behind a word of Latin
    letters are a token of their own, and case is ignored. Such words need no further
    normalisation and end in one token with the end mark, so many of them are encoded in
    one string and told apart by their ends; all others by their places in the string.
    """

    #: Latin letters that lower case and composition leave alone, then signs.
    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?*#$%&)]*)\Z")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.lower = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.lower.normalizer = None
        size = self.tokenizer.get_vocab_size()
        if size > 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.memo: dict[str, bytes] = {"": b""}

    def _plain(self, words: list[str]) -> None:
        """Learns words of lower-case Latin letters."""
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            lines = [" ".join(some[k : k + 256]) for k in range(0, len(some), 256)]
            ids = np.concatenate([np.array(x.ids, "<u2") for x in self.lower.encode_batch_fast(lines, add_special_tokens=False)])
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 2
            raw, begin = ids.tobytes(), 0
            for w, end in zip(some, cuts.tolist(), strict=True):
                self.memo[w] = raw[begin:end]
                begin = end

    def _other(self, words: list[str]) -> None:
        """Learns words of any signs."""
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            got = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            starts = np.cumsum([0] + [len(w) + 1 for w in some])
            ids = np.array(got.ids, "<u2")
            cuts = np.searchsorted(np.array([a for a, _ in got.offsets], np.int64), starts)
            for w, a, b in zip(some, cuts, cuts[1:], strict=False):
                self.memo[w] = ids[a:b].tobytes()

    def _learn(self, words: set[str]) -> None:
        memo, later, plain, other = self.memo, [], set(), set()
        for w in words:
            m = self.PLAIN.match(w)
            if m is None:
                other.add(w)
                continue
            stem, tail = m[1].lower(), m[2]
            if stem not in memo:
                plain.add(stem)
            if tail not in memo:
                other.add(tail)
            if stem != w:
                later.append((w, stem, tail))
        self._plain(list(plain))
        self._other(list(other))
        memo.update((w, memo[stem] + memo[tail]) for w, stem, tail in later)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        words = set().union(*split)
        if len(self.memo) > MEMO:  # what this batch needs is likely to come again
            self.memo = {w: self.memo[w] for w in words if w in self.memo} | {"": b""}
        self._learn(words.difference(self.memo))
        return [b"".join(map(self.memo.__getitem__, x)) for x in split]


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, row, n, ids: the ids of each whole text and the closing id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([END], "<u2").tobytes()
        for b in batches:
            ids = [x + end for x in enc.encode_batch(b.column(3).to_pylist())]
            n = pa.array([len(x) // 2 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), n, pa.array(ids, pa.binary())], ["doc_id", "source", "row", "n", "ids"])

    common.small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.monotonically_increasing_id().alias("row"),
        common.text_or_empty(text_col).alias("t"),
    )
    return rows.mapInArrow(run, f"doc_id {kind}, source string, row bigint, n bigint, ids binary")


def round_robin(queues: dict[str, list[int]], shares: dict[str, float], deficits: dict[str, float], window: int = WINDOW) -> Iterator[tuple[str, int]]:
    """(source, place in its queue) in the order in which documents leave.

    ``queues`` holds token counts. A window's credit goes to the sources that still
    hold documents, in proportion to their shares.
    """
    at = dict.fromkeys(queues, 0)
    credit = {s: deficits.get(s, 0.0) for s in queues}
    active = sorted(s for s in queues if queues[s])
    while active:
        whole = sum(shares[s] for s in active)
        for s in active:
            credit[s] += window * shares[s] / whole
            while at[s] < len(queues[s]) and queues[s][at[s]] <= credit[s]:
                credit[s] -= queues[s][at[s]]
                yield s, at[s]
                at[s] += 1
        active = [s for s in active if at[s] < len(queues[s])]


def cuts(total: int, sequence: int = SEQUENCE) -> np.ndarray:
    """Ends of the sequences of a shard: full ones, then powers of two."""
    full = np.arange(1, total // sequence + 1) * sequence
    rest, at, ends = total % sequence, total - total % sequence, []
    while rest:
        part = 1 << (rest.bit_length() - 1)
        at, rest = at + part, rest - part
        ends.append(at)
    return np.concatenate([full, np.array(ends, np.int64)]).astype(np.int64)


def shard_pieces(shard: int, rows: Iterator[dict], ids: str = "<u2", window: int = WINDOW) -> Iterator[dict]:
    """Pieces of one shard; ``rows`` gives the deficits of its sources, then its documents by source."""
    shares, deficits, docs = {}, {}, {}
    for r in rows:
        if r["ids"] is None:
            shares[r["source"]], deficits[r["source"]] = r["share"], r["deficit"]
        else:
            docs.setdefault(r["source"], []).append(r)
    ends = cuts(sum(r["n"] for q in docs.values() for r in q))
    at, k = 0, 0
    for s, i in round_robin({s: [r["n"] for r in q] for s, q in docs.items()}, shares, deficits, window):
        doc = docs[s][i]
        start = 0
        while start < doc["n"]:
            begin = int(ends[k - 1]) if k else 0
            length = min(doc["n"] - start, int(ends[k]) - at)
            yield {
                "doc_id": doc["doc_id"], "start": start, "length": length, "doc_tokens": doc["n"],
                "sequence_id": (shard << 32) + k, "offset": at - begin, "source": s,
                "ids": np.frombuffer(doc["ids"], ids)[start : start + length].astype("<u4").tobytes(),
            }
            at, start = at + length, start + length
            k += at == ends[k]


def packed(docs: DataFrame, path: str, target: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, doc_tokens, sequence_id, offset, source, ids.

    ids are little-endian unsigned 32-bit integers. ``target`` gives the share of tokens
    of each source; by default the shares of the corpus, so that all queues end together.
    A source without a share comes behind the others. Null texts are empty texts of one
    closing id; a null source is the source ''. Repeated rows are packed each for itself;
    an empty table gives no pieces. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = common.stored(tokens(docs, path, id_col, text_col, source_col), "tokens")
    total = rows.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD_TOKENS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    counts = rows.groupBy("shard", "source").agg(F.sum("n").alias("n"))
    sums = counts.groupBy("source").agg(F.sum("n").alias("of_source"))
    if target is None:
        share = F.col("of_source") / F.lit(float(max(total, 1)))
    else:
        given = F.create_map(*[F.lit(x) for kv in target.items() for x in (kv[0], float(kv[1]))])
        share = F.coalesce(F.try_element_at(given, F.col("source")), F.lit(0.0))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    of_shard = counts.groupBy("shard").agg(F.sum("n").alias("here")).withColumn("all_before", F.coalesce(F.sum("here").over(before), F.lit(0)))
    own_before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    deficits = (
        counts.withColumn("before", F.coalesce(F.sum("n").over(own_before), F.lit(0)))
        .join(sums, "source")
        .join(of_shard, "shard")
        .select(
            "shard", "source", F.greatest(share, F.lit(1e-9)).alias("share"),
            (share * F.col("all_before") - F.col("before")).alias("deficit"),
        )
    )
    both = rows.unionByName(deficits, allowMissingColumns=True)
    dealt = both.repartition("shard").sortWithinPartitions("shard", F.col("ids").isNotNull(), "source", "doc_id", "row")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (r for b in batches for r in b.to_pylist())
        schema = pa.schema(
            [("doc_id", schema_of_id)] + [(n, pa.int64()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")] + [("source", pa.string()), ("ids", pa.binary())]
        )
        for shard, own in groupby(flat, itemgetter("shard")):
            some = []
            for piece in shard_pieces(shard, own):
                some.append(piece)
                if len(some) == 512:
                    yield pa.RecordBatch.from_pylist(some, schema)
                    some = []
            if some:
                yield pa.RecordBatch.from_pylist(some, schema)

    schema_of_id = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    common.small_batches(spark)
    return dealt.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string, ids binary")


def pieces(docs: DataFrame) -> DataFrame:
    """The packed pieces with a check sum in place of their ids."""
    return packed(docs, vocabulary()).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(common.table(spark, sf_dir, "documents"))
