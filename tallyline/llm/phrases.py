"""Collocations: phrases of 2 to 4 words that hold together, from sorted streams of counts.

The layout is that of external language-model estimation. Every word position gives one
window: the word and up to three that follow in its piece. The windows are dealt by range
and sorted, so all windows with a common beginning stand together and one pass gives the
counts of all phrases (``counted``). Phrases that are frequent enough are kept in two
orders, by their words and by their words from the last to the first. In the first a
phrase stands behind its beginnings, in the second behind its endings, so a walk over a
stream meets the counts of all first (last) parts on the way down and the counts of all
phrases longer by a word on the way up. Nothing is looked up by hash.

Keys are the language, then the words, joined by the byte 0, which sorts before all
others. No word holds a blank, so a zero byte inside a word is written as a blank.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm import common

WORDS, LEAST, TOP = 4, 30, 2_000
#: A phrase is absorbed by a longer one that has this share, in percent, of its occurrences.
ABSORBED = 80
SCORE = 2_000_000
#: Text characters that a task cuts, counts and sorts at once.
AT_ONCE = 2 << 20
#: The ranges are cut by windows of so many rows: every STEP-th, up to MOST_OF of a row, and
#: their first EDGE bytes. How even the ranges are depends on them, no result does.
SAMPLE, STEP, MOST_OF, EDGE = 8_192, 64, 1_000, 64

_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = bytes(range(0x61, 0x7B))
_TABLE[0x20], _TABLE[0x09], _TABLE[0x00] = 0, 0, 0x20
for _sign in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_sign] = 0x0A
_TABLE = bytes(_TABLE)


def _cut(texts: list[str], most: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the texts with a byte 0 behind each, where they begin and end, and the last word of each one's window."""
    data = np.frombuffer(b"\n".join(t.encode() for t in texts).translate(_TABLE) + b"\n", np.uint8)
    word = (data != 0) & (data != 0x0A)
    edges = np.diff(word.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    line_ends = np.flatnonzero(data == 0x0A)
    at = np.arange(len(starts))
    piece_ends = np.flatnonzero(np.append(np.diff(np.searchsorted(line_ends, starts)) > 0, True)[: len(at)])
    keep = word.copy()
    keep[ends] = True
    raw = np.where(word, data, 0)[keep].tobytes()
    stops = np.cumsum(ends - starts + 1) - 1
    until = np.minimum(at + most - 1, piece_ends[np.searchsorted(piece_ends, at)]) if len(at) else at
    return raw, stops - (ends - starts), stops, until


def windows(texts: list[str], most: int = WORDS) -> list[bytes]:
    """The window of every word of the texts, words joined by the byte 0."""
    raw, begins, stops, until = _cut(texts, most)
    return [raw[a:b] for a, b in zip(begins.tolist(), stops[until].tolist(), strict=True)]


def sorted_windows(texts: list[str], most: int = WORDS) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The different windows in the order of their bytes: the words, where each window begins and ends in them, its count.

    Words end at a byte that sorts before all others, so windows sort as the ranks of their
    words do, with 0 behind the last one. Only ranks are sorted, no window is a value of its own.
    """
    raw, begins, stops, until = _cut(texts, most)
    n = len(begins)
    if not n:
        return raw, begins, stops, begins
    sizes = np.concatenate([[0], np.cumsum(stops - begins)])
    words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(sizes), pa.py_buffer(raw.replace(b"\x00", b""))]).dictionary_encode()
    ranks = np.empty(len(words.dictionary), np.uint32)
    ranks[pc.sort_indices(words.dictionary).to_numpy()] = np.arange(1, len(ranks) + 1)
    rank = np.append(ranks[words.indices.to_numpy()], np.zeros(most, np.uint32))
    rows = np.arange(n)
    columns = [np.where(rows + k <= until, rank[k : k + n], 0) for k in range(most)]
    bits = len(ranks).bit_length()
    if bits * most <= 64:
        packed = columns[0].astype(np.uint64)
        for c in columns[1:]:
            packed = (packed << np.uint64(bits)) | c
        columns = [packed]
    order = np.lexsort(columns[::-1])
    new = np.flatnonzero(np.append(True, np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0)))
    first = order[new]
    return raw, begins[first], stops[until[first]], np.diff(np.append(new, n))


def _language(lang: str) -> bytes:
    return lang.encode().replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01")


def _counted_windows(batches: Iterator[pa.RecordBatch], most: int, cuts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """slot, key, f: windows in sorted runs, ``slot`` the range between two cuts."""

    def slices(text: str) -> Iterator[str]:
        """A text in parts that end at the end of a piece, or whole where it has none."""
        at = 0
        while len(text) - at > AT_ONCE:
            m = _PIECE_END.search(text, at + AT_ONCE)
            if m is None:
                break
            yield text[at : m.end()]
            at = m.end()
        yield text[at:]

    def run(lang: str, some: list[str]) -> Iterator[pa.RecordBatch]:
        head = _language(lang) + b"\x00"
        raw, begins, ends, counts = sorted_windows(some, most)
        n = len(begins)
        key = lambda i: raw[begins[i] : ends[i]]
        edges = [0, *(bisect_left(range(n), c[len(head) :], key=key) if c.startswith(head) else n * (c > head) for c in cuts), n]
        slots = np.repeat(np.arange(len(cuts) + 1, dtype=np.int32), np.diff(edges))
        for i in range(0, n, 1 << 15):
            part = slice(i, i + (1 << 15))
            keys = [head + raw[a:b] for a, b in zip(begins[part].tolist(), ends[part].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(slots[part]), pa.array(keys, pa.binary()), pa.array(counts[part], pa.int64())], ["slot", "key", "f"])

    of: dict[str, list[str]] = {}
    size = 0
    for b in batches:
        for lang, text in zip(b.column(0), b.column(1), strict=True):
            for part in slices(text.as_py()):
                of.setdefault(lang.as_py(), []).append(part)
                size += len(part)
                if size > AT_ONCE:
                    while of:
                        yield from run(*of.popitem())
                    size = 0
    while of:
        yield from run(*of.popitem())


_PIECE_END = re.compile("[.,;:!?\x0a-\x0d]")


def _beginnings(batches: Iterator[pa.RecordBatch], most: int, least: int) -> Iterator[pa.RecordBatch]:
    """Sums of all beginnings in sorted windows.

    The first and the last of a batch may go on in its neighbours, so these are given
    whatever their sum.
    """
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        keys = b.column(0).cast(pa.large_binary())
        offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset : keys.offset + n + 1]
        data = np.frombuffer(keys.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        counts = b.column(1).to_numpy(zero_copy_only=False)
        zeros = np.flatnonzero(data == 0)
        first = np.searchsorted(zeros, offsets[:-1])
        inside = np.searchsorted(zeros, offsets[1:]) - first
        for depth in range(most + 1):
            rows = np.flatnonzero(inside >= depth)
            if not len(rows):
                break
            ends = offsets[rows + 1].copy()
            more = inside[rows] > depth
            ends[more] = zeros[first[rows[more]] + depth]
            starts = offsets[rows]
            mark = np.zeros(len(data) + 1, np.int8)
            mark[starts] += 1
            mark[ends] -= 1
            heads = data[np.cumsum(mark[:-1], dtype=np.int8) > 0]
            at = np.concatenate([[0], np.cumsum(ends - starts)])
            parts = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(heads)])
            new = np.flatnonzero(np.concatenate([[True], pc.not_equal(parts.slice(1), parts.slice(0, len(rows) - 1)).to_numpy(zero_copy_only=False)]))
            sums = np.add.reduceat(counts[rows], new)
            give = sums >= least
            give[[0, -1]] = True
            yield pa.RecordBatch.from_arrays([parts.take(pa.array(new[give])).cast(pa.binary()), pa.array(sums[give])], ["key", "f"])


def edges(rows: DataFrame, n: int, most: int) -> list[bytes]:
    """Up to n - 1 keys that cut the windows of all rows into about equal ranges, from a bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some = []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = windows([text], most)
                some += [(_language(lang) + b"\x00" + w)[:EDGE] for w in found[crc32(text[:99].encode()) % STEP :: max(STEP, len(found) // MOST_OF)]]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], ["key"])

    total = rows.count()
    some = rows.sample(SAMPLE / total, seed=1) if total > SAMPLE else rows
    keys = sorted(r[0] for r in some.mapInArrow(run, "key binary").collect())
    return sorted({bytes(keys[len(keys) * i // n]) for i in range(1, n)}) if keys else []


def counted(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most: int = WORDS, least: int = LEAST) -> DataFrame:
    """key, f: counts of all phrases of up to ``most`` words that occur ``least`` times.

    The key of a language alone counts all its words.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), common.text_or_empty(text_col).alias("text"))
    cuts = edges(rows, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), most)
    found = rows.mapInArrow(lambda b: _counted_windows(b, most, cuts), "slot int, key binary, f bigint")
    dealt = found.repartitionById(len(cuts) + 1, "slot").select("key", "f").sortWithinPartitions("key")
    parts = dealt.mapInArrow(lambda b: _beginnings(b, most, least), "key binary, f bigint")
    return parts.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _turned(key: bytes) -> bytes:
    """The key with its words from the last to the first."""
    lang, *words = key.split(b"\x00")
    return b"\x00".join([lang, *reversed(words)])


def _above(key: bytes) -> list[bytes]:
    """All beginnings of a key, the language first."""
    parts = key.split(b"\x00")
    return [b"\x00".join(parts[:k]) for k in range(1, len(parts))]


def _walk(batches: Iterator[pa.RecordBatch], turned: bool) -> Iterator[pa.RecordBatch]:
    """key, own, above, longer of sorted key, f, own, slot.

    ``above`` holds the counts of all beginnings of the key, the language first;
    ``longer`` the largest count of a key longer by a word, 0 if there is none. ``turned`` keys
    come with their words from the last to the first and are given in the usual order.
    """
    schema = pa.schema([("key", pa.binary()), ("own", pa.bool_()), ("f", pa.int64()), ("above", pa.list_(pa.int64())), ("longer", pa.int64())])
    stack: list[list] = []  # slot, key, f, own, longer
    done: list[tuple] = []

    def close() -> None:
        _, key, f, own, longer = stack.pop()
        done.append((_turned(key) if turned else key, own, f, [x[2] for x in stack] if own else None, longer))
        if stack:
            stack[-1][4] = max(stack[-1][4], f)

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
        done.clear()
        return batch

    for b in batches:
        for slot, key, f, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
            while stack and (stack[-1][0] != slot or not key.startswith(stack[-1][1] + b"\x00")):
                close()
            stack.append([slot, key, f, own, 0])
        if done:
            yield out()
    while stack:
        close()
    if done:
        yield out()


def streamed(counts: DataFrame, turned: bool) -> DataFrame:
    """``_walk`` over all counts in the order of their words, or of their words from the last.

    Equal slots of the sorted keys are stored with their number. The beginnings of a slot's
    first key stand in slots before it: these few (a row per slot and word) go along.
    """

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_turned(k) for k in b.column(0).to_pylist()], pa.binary()), b.column(1)], ["key", "f"])

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some = [(s, k) for s, key in zip(*(c.to_pylist() for c in b.columns), strict=True) for k in _above(key)]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in some], pa.int32()), pa.array([k for _, k in some], pa.binary())], ["slot", "key"])

    rows = counts.mapInArrow(turn, "key binary, f bigint") if turned else counts
    slots = common.stored(
        rows.repartitionByRange("key").sortWithinPartitions("key").withColumn("slot", F.spark_partition_id()),
        "phrases-by-end" if turned else "phrases",
    )
    missing = slots.groupBy("slot").agg(F.min("key").alias("key")).mapInArrow(heads, "slot int, key binary")
    carried = missing.join(slots.select("key", "f"), "key").select("slot", "key", "f", F.lit(False).alias("own"))
    both = slots.select("slot", "key", "f", F.lit(True).alias("own")).unionByName(carried)
    dealt = both.repartition("slot").sortWithinPartitions("slot", "key")
    return dealt.mapInArrow(lambda b: _walk(b, turned), "key binary, own boolean, f bigint, above array<bigint>, longer bigint")


def _exchanged(c: Column) -> Column:
    """Zero bytes and blanks change places; a line end is in no word."""
    return F.replace(F.replace(F.replace(c, F.lit("\x00"), F.lit("\n")), F.lit(" "), F.lit("\x00")), F.lit("\n"), F.lit(" "))


def _whole(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most: int = WORDS, least: int = LEAST, absorbed: int = ABSORBED, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language.

    Texts are lower-cased in A-Z, cut into pieces at ``.,;:!?`` and line ends and into words
    at blanks and tabs. Phrases of 2 to ``most`` words with ``a >= least`` occurrences inside
    pieces count; the score is 2 a / (l + r) in millionths for the counts l, r of the two
    parts of the weakest cut. A phrase is left out if a longer one of these that holds it has
    ``absorbed`` percent of its occurrences. Null texts are empty, a null language is
    ``und``; repeated rows count each time; an empty table has no phrases. Ties rank by
    occurrences, then by the phrase's bytes. Other columns are not looked at.
    """
    counts = common.stored(counted(docs, lang_col, text_col, most, least), "phrase-counts")
    by_words = streamed(counts, False).select("key", "f", F.col("above").alias("firsts"), F.lit(None).cast("array<bigint>").alias("lasts"), "longer")
    by_ends = streamed(counts, True).select("key", "f", F.lit(None).cast("array<bigint>").alias("firsts"), F.col("above").alias("lasts"), "longer")
    # one row per order and phrase, more only for phrases at the edge of a slot
    rows = by_words.unionByName(by_ends).groupBy("key").agg(
        F.max("f").alias("a"), F.max("firsts").alias("firsts"), F.max("lasts").alias("lasts"), F.max("longer").alias("longer")
    )
    size = F.size("firsts")

    def cut(k: Column) -> Column:
        left, right = F.element_at("firsts", k + 1), F.element_at("lasts", size - k + 1)
        score = F.call_function("div", _whole(F.col("a")) * F.lit(SCORE), _whole(left) + _whole(right))
        return F.struct(score.cast("bigint").alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    key = F.col("key").cast("string")
    candidates = (
        rows.where((size >= 2) & (_whole(F.col("longer")) * 100 < _whole(F.col("a")) * absorbed))
        .withColumn("cut", F.array_min(F.transform(F.sequence(F.lit(1), size - 1), cut)))
        .select(
            F.replace(F.replace(F.substring_index(key, "\x00", 1), F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01")).alias("lang"),
            _exchanged(F.call_function("substring_index", key, F.lit("\x00"), -size)).alias("phrase"),
            "a", "cut.l", "cut.r", F.element_at("firsts", 1).alias("n"), "cut.score",
        )
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), grams AS (
  SELECT lang, unnest([w[i:i + k - 1] for i in range(1, len(w) - k + 2)]) AS p FROM words, (SELECT unnest(range(1, {WORDS + 1})) AS k)
), counts AS MATERIALIZED (
  SELECT lang, p, count(*) AS f FROM grams GROUP BY lang, p HAVING count(*) >= {LEAST}
), inside AS (
  SELECT lang, f, unnest(flatten([[p[i:i + k - 1] for i in range(1, len(p) - k + 2)] for k in range(2, len(p))])) AS p FROM counts WHERE len(p) > 2
), longest AS (
  SELECT lang, p, max(f) AS longer FROM inside GROUP BY lang, p
), cuts AS (
  SELECT c.lang, c.p, c.f AS a, unnest(range(1, len(c.p))) AS k FROM counts c LEFT JOIN longest USING (lang, p)
  WHERE len(c.p) > 1 AND 100 * coalesce(longer, 0)::HUGEINT < {ABSORBED} * c.f::HUGEINT
), scored AS (
  SELECT cuts.lang, cuts.p, a, k, l.f AS l, r.f AS r, (({SCORE} * a::HUGEINT) // (l.f::HUGEINT + r.f::HUGEINT))::BIGINT AS score
  FROM cuts JOIN counts l ON l.lang = cuts.lang AND l.p = cuts.p[1:k] JOIN counts r ON r.lang = cuts.lang AND r.p = cuts.p[k + 1:len(cuts.p)]
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
  array_to_string(p, ' ') AS phrase, a, l, r, n, score
FROM weakest JOIN sizes USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) <= {TOP}
"""
