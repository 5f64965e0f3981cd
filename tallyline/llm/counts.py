"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced.

Texts of up to HUGE signs are encoded whole. Of a longer one, chunks of CHUNK signs are
dealt over all tasks, each with OVERLAP signs of its neighbours on both sides, and encoded
with the places of the tokens. Two neighbours are spliced at a token that both begin at the
same sign, at a proven boundary: white space stands there, which neither the normaliser nor
the splitter nor a special token reaches over, so what stands before has no say in what
comes behind, and the other way round. The next tokens have to agree as well. The tokens
between two splices are those of the whole text.

Where an overlap has no such place, as inside a long run without white space, the part of
the text between the last and the next splice goes into another round, with chunks and
overlaps WIDER times as large, until it is spliced or is one chunk.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common, packing

HUGE, CHUNK, OVERLAP, WIDER = 1 << 16, 1 << 15, 256, 4
#: Tokens behind a splice that have to agree, and the limit that ``over_limit`` tells of.
AGREE, LIMIT = 4, 2048
#: White space to every part of a tokenizer.
BLANK = " \t\r\n"
_tokenizers: dict[str, Tokens] = {}


class Tokens:
    """A tokenizer file and where its tokens can be told apart for certain."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        pieces = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str("a b")]
        if pieces not in (["a", "b"], ["a", "Ġb"]) or any(set(BLANK) & set(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("the splitter of this tokenizer joins words over white space")
        #: Blanks are dropped, or are the beginning of the next word.
        self.drops = pieces[1] == "b"
        self.words = packing.encoder(path) if self.drops and self.tokenizer.get_vocab_size() <= 1 << 16 else None

    def counts(self, texts: list[str]) -> list[int]:
        if self.words is not None:  # each different word is encoded once
            return [len(x) // 2 for x in self.words.encode_batch(texts)]
        return [len(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def sure(self, text: str, at: int) -> bool:
        """A token may begin at ``at`` whatever stands before: white space divides them."""
        if self.drops:
            return at > 0 and text[at - 1] in BLANK
        return 0 < at < len(text) and text[at] in BLANK and not text[at - 1].isspace()

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[tuple[int, int]]]]:
        return [(x.ids, x.offsets) for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


def tokens(path: str) -> Tokens:
    """One tokenizer per worker process and file."""
    if path not in _tokenizers:
        _tokenizers[path] = Tokens(path)
    return _tokenizers[path]


def chunks(begin: int, end: int, size: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(from, joint before, joint behind, to) of the chunks of a part of a text."""
    n = max(1, -(-(end - begin) // size))
    joints = [begin + (end - begin) * i // n for i in range(n + 1)]
    return [(max(begin, a - overlap), a, z, min(end, z + overlap)) for a, z in zip(joints, joints[1:], strict=False)]


def _cut(batches: Iterator[pa.RecordBatch], size: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """row, part, k, joints, text: the chunks of the open parts of each text."""
    schema = pa.schema([("row", pa.int64()), ("part", pa.int64()), ("k", pa.int32())] + [(n, pa.int64()) for n in ("start", "left", "right", "stop", "part_end")] + [("text", pa.string())])
    for b in batches:
        for i in range(b.num_rows):
            row, text, parts = (c[i].as_py() for c in b.columns)
            for begin, end in (((0, len(text)),) if parts is None else ((p["begin"], p["end"]) for p in parts)):
                for k, (start, left, right, stop) in enumerate(chunks(begin, end, size, overlap)):
                    own = {"row": row, "part": begin, "k": k, "start": start, "left": left, "right": right, "stop": stop, "part_end": end, "text": text[start:stop]}
                    yield pa.RecordBatch.from_pylist([own], schema)


def _places(lexer: Tokens, text: str, ids: list[int], offsets: list[tuple[int, int]], start: int, low: int, high: int) -> bytes:
    """(place, tokens before it, sure, id, end) of the tokens that begin in [low, high)."""
    first = [not j or offsets[j - 1][0] != a for j, (a, _) in enumerate(offsets)]  # of several tokens of one sign
    found = [(start + a, j, first[j] and lexer.sure(text, a), ids[j], start + z) for j, (a, z) in enumerate(offsets) if low <= start + a < high]
    return np.array(found, np.int64).tobytes()


def _encoded(batches: Iterator[pa.RecordBatch], path: str, overlap: int) -> Iterator[pa.RecordBatch]:
    """Tokens of each chunk: how many, and those of the overlaps at both joints."""
    lexer = tokens(path)
    names = ["row", "part", "k", "left", "right", "part_end"]
    for b in batches:
        for i in range(b.num_rows):
            one = b.slice(i, 1)
            text, start, left, right = (one.column(n)[0].as_py() for n in ("text", "start", "left", "right"))
            ids, offsets = lexer.encode([text])[0]
            before = _places(lexer, text, ids, offsets, start, left - overlap, left + overlap)
            behind = _places(lexer, text, ids, offsets, start, right - overlap, right + overlap)
            yield pa.RecordBatch.from_arrays(
                [one.column(n) for n in names] + [pa.array([len(ids)], pa.int64()), pa.array([before], pa.binary()), pa.array([behind], pa.binary())], [*names, "n", "before", "behind"]
            )


def splice(behind: bytes, before: bytes) -> tuple[int, int, int] | None:
    """Place of a splice and the tokens before it in the left and in the right chunk.

    Of the places that both know for certain and behind which AGREE tokens are the same, the
    one in the middle; as many as there are behind it where the overlap ends earlier.
    """
    left, right = (np.frombuffer(x, np.int64).reshape(-1, 5) for x in (behind, before))
    at = {int(r[0]): j for j, r in enumerate(right) if r[2]}
    good = []
    for i in np.flatnonzero(left[:, 2]) if len(left) else ():
        j = at.get(int(left[i, 0]))
        if j is None:
            continue
        n = min(AGREE, len(left) - i, len(right) - j)
        same = left[i : i + n][:, [0, 3, 4]] == right[j : j + n][:, [0, 3, 4]]
        if n >= min(AGREE, 2) and same.all():
            good.append((int(left[i, 0]), int(left[i, 1]), int(right[j, 1])))
    return good[len(good) // 2] if good else None


def _spliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, part, k, n, place, in_left, in_right of each chunk and the joint behind it."""
    names = ["row", "part", "k", "part_end", "n"]
    for b in batches:
        got = [splice(x, y) if y is not None else None for x, y in zip(b.column("behind").to_pylist(), b.column("before_next").to_pylist(), strict=True)]
        cols = [pa.array([None if g is None else g[i] for g in got], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + cols, [*names, "place", "in_left", "in_right"])


def assembled(part: int, end: int, joints: list[dict]) -> tuple[int, list[dict]]:
    """Tokens between splices, and the parts between splices around a failed joint."""
    total, open_parts, begin, skip, whole = 0, [], part, 0, True
    for i, j in enumerate(joints):
        last = i == len(joints) - 1
        if not last and j["place"] is None:
            whole = False
            continue
        stop, own = (end, j["n"]) if last else (j["place"], j["in_left"])
        if whole:
            total += own - skip
        else:
            open_parts.append({"begin": begin, "end": stop})
        begin, skip, whole = stop, j["in_right"] or 0, True
    return total, open_parts


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row", pa.int64()), ("n", pa.int64()), ("parts", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])
    for b in batches:
        rows = []
        for r in b.to_pylist():
            total, parts = assembled(r["part"], r["part_end"], sorted(r["joints"], key=lambda j: j["k"]))
            rows.append({"row": r["row"], "n": total, "parts": parts})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def _huge(long: DataFrame, path: str, size: int, overlap: int) -> DataFrame:
    """row, n: tokens of the stored texts of ``long`` (row, text)."""
    todo, done = long.select("row", "text", F.lit(None).cast("array<struct<begin:bigint,end:bigint>>").alias("parts")), None
    while True:
        kinds = "row bigint, part bigint, k int, start bigint, left bigint, right bigint, stop bigint, part_end bigint, text string"
        cut = todo.mapInArrow(lambda b, s=size, o=overlap: _cut(b, s, o), kinds).repartition("row", "part", "k")
        kinds = "row bigint, part bigint, k int, left bigint, right bigint, part_end bigint, n bigint, before binary, behind binary"
        encoded = common.stored(cut.mapInArrow(lambda b, o=overlap: _encoded(b, path, o), kinds), "token-chunks")
        following = encoded.select("row", "part", (F.col("k") - 1).alias("k"), F.col("before").alias("before_next"))
        joints = (
            encoded.join(following, ["row", "part", "k"], "left")
            .select("row", "part", "k", "part_end", "n", "behind", "before_next")
            .mapInArrow(_spliced, "row bigint, part bigint, k int, part_end bigint, n bigint, place bigint, in_left bigint, in_right bigint")
        )
        # a small row per chunk of one text
        of_part = joints.groupBy("row", "part", "part_end").agg(F.collect_list(F.struct("k", "n", "place", "in_left", "in_right")).alias("joints"))
        round_ = common.stored(of_part.mapInArrow(_assembled, "row bigint, n bigint, parts array<struct<begin:bigint,end:bigint>>"), "token-sums")
        done = round_.select("row", "n") if done is None else done.unionByName(round_.select("row", "n"))
        left = round_.where(F.size("parts") > 0).groupBy("row").agg(F.flatten(F.collect_list("parts")).alias("parts"))
        if left.isEmpty():
            return done.groupBy("row").agg(F.sum("n").alias("n"))
        todo = long.join(left, "row").select("row", "text", "parts")
        size, overlap = size * WIDER, overlap * WIDER


def counted(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, huge: int = HUGE, size: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``.

    ``path`` is a tokenizer file of the tokenizers library whose splitter drops white space
    or puts it before the next word. No tokens are added, special strings inside texts are
    special tokens as by the library's default, nothing is truncated. Null texts count as
    empty; identifiers may be null, of any type or repeated, each row is counted for itself;
    an empty table gives no rows. Other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    long = F.char_length("text") > huge

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexer = tokens(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                n = pa.array(lexer.counts(b.column(2).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], ["doc_id", "n_bytes", "n_tokens"])

    n_bytes = F.octet_length("text").cast("bigint").alias("n_bytes")
    short = rows.where(~long).select("doc_id", n_bytes, "text").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    texts = common.stored(rows.where(long).select("doc_id", n_bytes, "text", F.monotonically_increasing_id().alias("row")), "huge-texts")
    out = short
    if not texts.isEmpty():
        spliced = _huge(texts.select("row", "text"), path, size, overlap)
        out = short.unionByName(texts.select("doc_id", "n_bytes", "row").join(spliced, "row").select("doc_id", "n_bytes", F.col("n").alias("n_tokens")))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(common.table(spark, sf_dir, "documents"), packing.vocabulary())
