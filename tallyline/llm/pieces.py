"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch that are not known yet are put into one text and indexed
by a suffix array. Every piece of the vocabulary is looked up in it by binary search,
which gives the range of its occurrences; each occurrence is an edge from its first to
its last character. Edges are sorted by position and relaxed from left to right, in all
words at once: a step takes the edges that begin at one position of any word.

The vocabulary is of the merging kind, so the relaxation does not add up scores: it
keeps, for each position, the one last piece with which merging would have ended there.
An edge is taken if its piece can stand behind the last piece at its start, that is, if
merging the two together would not have joined anything across their border.

Pieces hold a space mark at their start only, or space marks alone, so words can be
encoded each for itself. Characters without a piece become their UTF-8 bytes. The ids
equal those of the library for models without text normalisation, with a space put in
front and runs of spaces kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common

MARK = "▁"
#: Words whose ids a task remembers, in two generations; longer words are not remembered.
MEMO, MEMO_CHARS = 1 << 19, 48
#: Words up to this length are relaxed side by side, longer ones each for itself.
SIDE_BY_SIDE = 64
#: Answers of ``fits`` that a task remembers: one per slot.
SLOTS = 1 << 20
#: Characters packed into one number of the index: five of twelve bits.
PACK, BITS = 5, 12
START, UNKNOWN = -1, -2
_codecs: dict[str, Codec] = {}


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        if self.size > 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        normal = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.text = {i: model.id_to_piece(i) for i in normal}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.ids = {t: i for i, t in self.text.items()}
        spaces = {len(t): i for t, i in self.ids.items() if not t.strip(MARK)}
        self.most = max(spaces)
        self.runs = [[spaces[k] for k in self._joined(n, set(spaces))] for n in range(self.most + 1)]
        if any(MARK in t[1:] for t in self.ids if t.strip(MARK)) or len(self.runs[self.most]) > 1:
            raise ValueError("pieces of this vocabulary cross words")
        self.rank = {i: -model.get_score(i) if len(t) > 1 else -1.0 for i, t in self.text.items() if t.strip(MARK) or t == MARK}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self._split()
        self._tables()
        letters = sorted({c for i in self.rank for c in self.text[i]})
        if len(letters) + 2 > 1 << BITS:
            raise ValueError("too many characters for the index")
        self.code = np.zeros(0x110000, np.int64)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self._alone = np.zeros(len(letters) + 1, bool)
        self._alone[[int(self.code[ord(self.text[i])]) for i in self.rank if len(self.text[i]) == 1]] = True
        self.order = np.array([i for i in self.rank], np.int64)
        self.lengths = np.array([len(self.text[i]) for i in self.order])
        self.columns = -(-int(self.lengths.max()) // PACK)
        self.low, self.high = self._bounds()
        self.bytes = [b""] * self.size
        for i, t in self.text.items():
            self.bytes[i] = t.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        self.memo: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self._beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for i in self.rank:
            codes = self.code[[ord(c) for c in self.text[i]]]
            self._beside[codes[:-1], codes[1:]] = True

    # --- the vocabulary

    @staticmethod
    def _joined(n: int, lengths: set[int]) -> list[int]:
        """Lengths of the pieces of ``n`` space marks: equal merges, so the leftmost goes first."""
        parts = [1] * n
        while at := [i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in lengths]:
            parts[at[0] : at[0] + 2] = [parts[at[0]] + parts[at[0] + 1]]
        return parts

    def _split(self) -> None:
        """The last merge of every piece; pieces that merging never makes are left out."""
        for i in sorted((i for i in self.rank if self.rank[i] >= 0), key=self.rank.get):
            parts = [self.ids.get(c, UNKNOWN) for c in self.text[i]]
            while len(parts) > 2:
                joins = [self.rank.get(self.ids.get(self.text[a] + self.text[b], UNKNOWN), np.inf) if min(a, b) >= 0 else np.inf for a, b in zip(parts, parts[1:], strict=False)]
                at = int(np.argmin(joins))
                if joins[at] >= self.rank[i]:
                    break
                parts[at : at + 2] = [self.ids[self.text[parts[at]] + self.text[parts[at + 1]]]]
            if len(parts) == 2 and min(parts) >= 0:
                self.left[i], self.right[i] = parts
            else:
                del self.rank[i]

    def _bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Each piece as packed numbers, filled up with the lowest and the highest code."""
        wide = self.columns * PACK
        low = np.zeros((len(self.order), wide), np.int64)
        for row, i in enumerate(self.order):
            t = self.text[i]
            low[row, : len(t)] = self.code[[ord(c) for c in t]]
        beyond = np.arange(wide) >= self.lengths[:, None]
        high = np.where(beyond, (1 << BITS) - 1, low)
        pack = lambda m: sum(m[:, k::PACK] << (BITS * (PACK - 1 - k)) for k in range(PACK))
        return pack(low), pack(high)

    def _tables(self) -> None:
        """What ``fits`` asks for, by number: ranks, last merges, and the rank of each pair that makes a piece."""
        self._rank = np.full(self.size, np.inf)
        self._left, self._right = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        pairs = {}
        for i, rank in self.rank.items():
            self._rank[i] = rank
            if rank >= 0:
                self._left[i], self._right[i] = self.left[i], self.right[i]
            t = self.text[i]
            for k in range(1, len(t)):
                a, b = self.ids.get(t[:k]), self.ids.get(t[k:])
                if a in self.rank and b in self.rank:
                    pairs[a << 16 | b] = rank
        self._pairs = np.array(sorted(pairs), np.int64)
        self._pair_rank = np.array([pairs[k] for k in self._pairs.tolist()])
        self._asked, self._answers = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)

    def _fits(self, key: np.ndarray) -> np.ndarray:
        """Whether merging would leave the border of each pair ``a << 16 | b`` of pieces.

        Takes merges back, the latest first; a merge across the border must not have
        come before the ones that are still to be taken back.
        """
        out = np.ones(len(key), bool)
        row, x, y, limit = np.arange(len(key)), key >> 16, key & 0xFFFF, np.full(len(key), np.inf)
        while len(row):
            pair = x << 16 | y
            at = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
            joined = (self._pairs[at] == pair) & (self._pair_rank[at] < limit)
            out[row[joined]] = False
            rank_x, rank_y = self._rank[x], self._rank[y]
            of_x = rank_x > rank_y
            # the left one of equal merges goes first
            limit = np.where(of_x, rank_x, rank_y + 0.5)
            x, y = np.where(of_x, self._right[x], x), np.where(of_x, y, self._left[y])
            on = np.flatnonzero(~joined & (of_x | (rank_y >= 0)))
            row, x, y, limit = row[on], x[on], y[on], limit[on]
        return out

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_fits``, remembered; at the start and beside characters without a piece all fits."""
        out = np.ones(len(a), bool)
        asked = np.flatnonzero((a >= 0) & (b >= 0))
        key = a[asked] << 16 | b[asked]
        slot = (key * 0x9E3779B1 >> 12) & (SLOTS - 1)
        answer = self._answers[slot]
        new = np.flatnonzero(self._asked[slot] != key)
        if len(new):
            answer[new] = self._fits(key[new])
            # of keys that share a slot the last one stays, in both arrays
            self._asked[slot[new]], self._answers[slot[new]] = key[new], answer[new]
        out[asked] = answer
        return out

    # --- index, edges, relaxation

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, length, piece) of every occurrence."""
        code = self.code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        n = len(code)
        if not n:
            return (np.empty(0, np.int64),) * 3
        padded = np.concatenate([code, np.zeros(self.columns * PACK, np.int64)])
        first = sum(padded[k : k + n] << (BITS * (PACK - 1 - k)) for k in range(PACK))
        packs = [first] + [np.concatenate([first[k * PACK :], np.zeros(min(k * PACK, n), np.int64)])[:n] for k in range(1, self.columns)]
        # suffixes by their first PACK characters, then twice as many, and so on
        suffixes = np.argsort(first)
        rank, known = self._ranks(first, suffixes), PACK
        while known < self.columns * PACK:
            key = rank * (n + 1)
            key[: max(n - known, 0)] += rank[known:] + 1
            suffixes = np.argsort(key)
            rank, known = self._ranks(key, suffixes), known * 2
        begin = self._search(packs, suffixes, self.low, False)
        end = self._search(packs, suffixes, self.high, True)
        count = np.maximum(end - begin, 0)
        piece = np.repeat(np.arange(len(self.order)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        at = suffixes[place]
        bare = np.flatnonzero(~self._alone[code])
        at = np.concatenate([at, bare])
        length = np.concatenate([self.lengths[piece], np.ones(len(bare), np.int64)])
        ids = np.concatenate([self.order[piece], np.full(len(bare), UNKNOWN)])
        return at, length, ids

    @staticmethod
    def _ranks(key: np.ndarray, order: np.ndarray) -> np.ndarray:
        ranked = key[order]
        out = np.empty(len(key), np.int64)
        out[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        return out

    @staticmethod
    def _search(packs: list[np.ndarray], suffixes: np.ndarray, wanted: np.ndarray, behind: bool) -> np.ndarray:
        """Binary search of all pieces at once: first suffix not before (or behind) each.

        The first column alone bounds the range; the others are searched inside it.
        """
        leading = packs[0][suffixes]
        low, high = (np.searchsorted(leading, wanted[:, 0], side) for side in ("left", "right"))
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            at = suffixes[middle]
            less, same = np.zeros(len(open_), bool), np.ones(len(open_), bool)
            for k, pack in enumerate(packs[1:], 1):
                value, sought = pack[at], wanted[open_, k]
                less |= same & (value < sought)
                same &= value == sought
            right = less | same if behind else less
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
            open_ = open_[low[open_] < high[open_]]
        return low

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word or part of a word, its space mark included; one index for all of them.

        A word's state behind each of its characters is the last piece there, START where
        no piece ends. All words of one index are relaxed by ``_relaxed``.
        """
        text = "".join(words)
        sizes = np.array([len(w) for w in words], np.int64)
        begins = np.cumsum(sizes) - sizes
        at, length, ids = self.edges(text)
        last, come = self._relaxed(np.repeat(begins, sizes), np.repeat(sizes, sizes), at, length, ids)
        # back from the end of every word; characters on the way are ends of its pieces
        ends = np.zeros(len(last), bool)
        here = begins + sizes - 1
        first = begins
        while len(here):
            ends[here] = True
            here = come[here] - 1
            on = here >= first
            here, first = here[on], first[on]
        stops = np.flatnonzero(ends)
        found = last[stops]
        count = np.ones(len(stops), np.int64)
        bare = np.flatnonzero(found == UNKNOWN)
        if len(bare):
            signs = [[self.byte_ids[x] for x in text[stop].encode("utf-8")] for stop in stops[bare].tolist()]
            count[bare] = [len(x) for x in signs]
            found = np.repeat(found, count)
            found[found == UNKNOWN] = np.concatenate(signs)
        whole = found.astype("<u2").tobytes()
        upto = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(stops, begins + sizes)] * 2
        return [whole[a:b] for a, b in zip([0, *upto[:-1].tolist()], upto.tolist(), strict=True)] if words else []

    def _relaxed(self, begin: np.ndarray, size: np.ndarray, at: np.ndarray, length: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last piece, its start) behind every character.

        A step takes all edges that start at one position of a word: their starts are
        settled by the steps before, their ends differ. ``begin`` and ``size`` are those
        of each character's word.
        """
        last, come = np.full(len(begin), START, np.int64), np.zeros(len(begin), np.int64)
        position = at - begin[at]
        inside = position + length <= size[at]
        long = inside & (size[at] > SIDE_BY_SIDE)
        side = np.flatnonzero(inside & ~long)
        side = side[np.argsort(position[side].astype(np.int16), kind="stable")]
        steps = np.searchsorted(position[side], np.arange(SIDE_BY_SIDE + 1))
        for step, (i, j) in enumerate(zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True)):
            if i == j:
                continue
            edge = side[i:j]
            if step:
                before = last[at[edge] - 1]
                open_ = before != START
                edge, before = edge[open_], before[open_]
                edge = edge[self.fits(before, ids[edge])]
            stop = at[edge] + length[edge] - 1
            last[stop], come[stop] = ids[edge], at[edge]
        alone = np.flatnonzero(long)
        self._relaxed_alone(last, come, position, at, length, ids, alone[np.argsort(at[alone], kind="stable")])
        return last, come

    def _relaxed_alone(self, last: np.ndarray, come: np.ndarray, position: np.ndarray, at: np.ndarray, length: np.ndarray, ids: np.ndarray, edges: np.ndarray) -> None:
        """The same for long words, one edge after the other."""
        if not len(edges):
            return
        state, back, answers = {}, {}, {}
        for first, p, n, b in zip(at[edges].tolist(), position[edges].tolist(), length[edges].tolist(), ids[edges].tolist(), strict=True):
            if p:
                a = state.get(first - 1, START)
                if a == START:
                    continue
                if a >= 0 and b >= 0:
                    key = a << 16 | b
                    ok = answers.get(key)
                    if ok is None:
                        ok = answers[key] = bool(self.fits(np.array([a]), np.array([b]))[0])
                    if not ok:
                        continue
            state[first + n - 1], back[first + n - 1] = b, first
        stops = np.fromiter(state, np.int64, len(state))
        last[stops] = np.fromiter(state.values(), np.int64, len(state))
        come[stops] = np.fromiter(back.values(), np.int64, len(back))

    def _run(self, n: int) -> list[int]:
        """Pieces of space marks alone: as many of the longest as there are, then the rest."""
        return self.runs[self.most] * (n // self.most) + self.runs[n % self.most]

    def _learnt(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words not known yet.

        Words are cut between characters that stand side by side in no piece, since nothing
        is merged there; each different part goes through the index once.
        """
        if not words:
            return {}
        text = "".join([MARK + w for w in words])
        code = self.code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        begins = np.cumsum([0] + [len(w) + 1 for w in words])
        cut = ~self._beside[code[:-1], code[1:]]
        cut[begins[1:-1] - 1] = True
        cuts = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(text)]])
        ends = cuts.tolist()
        parts = [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        if len(self.parts) > MEMO // 2:
            self.parts = {}
        new = list(set(parts).difference(self.parts))
        self.parts.update(zip(new, self.words(new), strict=True))
        ids = list(map(self.parts.__getitem__, parts))
        upto = np.concatenate([[0], np.cumsum(list(map(len, ids)))])[np.searchsorted(cuts, begins)].tolist()
        whole = b"".join(ids)
        for part in new:
            if len(part) > MEMO_CHARS:
                del self.parts[part]
        return {w: whole[a:b] for w, a, b in zip(words, upto, upto[1:], strict=False)}

    def _recalled(self, words: set[str]) -> list[str]:
        """Makes the ids of all ``words`` known; those of the generation before move to this one.

        Gives the words that are too long to be remembered beyond the batch.
        """
        if len(self.memo) > MEMO // 2:
            self.before, self.memo = self.memo, {}
        missing = words.difference(self.memo)
        old = missing.intersection(self.before)
        self.memo.update((w, self.before[w]) for w in old)
        learnt = self._learnt(list(missing.difference(old)))
        self.memo.update(learnt)
        return [w for w in learnt if len(w) > MEMO_CHARS]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, unsigned 16-bit."""
        split = [t.replace(MARK, " ").split(" ") for t in texts]
        some = set().union(*split) - {""}
        long = self._recalled(some)
        lone = np.array([self.ids[MARK]], "<u2").tobytes()
        ids_of = self.memo.__getitem__
        out = []
        for t, words in zip(texts, split, strict=True):
            if not t:
                out.append(b"")
            elif "" not in words:
                out.append(b"".join(map(ids_of, words)))
            else:
                parts, waiting = [], 0
                for w in words:
                    if not w:
                        waiting += 1
                        continue
                    x = ids_of(w)
                    if waiting:  # a space mark that joined nothing behind it joins the run before it
                        alone = x[:2] == lone
                        parts.append(np.array(self._run(waiting + alone), "<u2").tobytes())
                        x = x[2:] if alone else x
                        waiting = 0
                    parts.append(x)
                parts.append(np.array(self._run(waiting), "<u2").tobytes())
                out.append(b"".join(parts))
        for w in long:
            del self.memo[w]
        return [np.frombuffer(x, "<u2") for x in out]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become the replacement character."""
        whole = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return whole.removeprefix(" ")


def codec(path: str) -> Codec:
    """One codec per worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, decoded_sha256, round_trip: one row per row of ``docs``.

    Null texts count as empty and have no ids. ``round_trip`` says whether decoding gives
    the text again; it does unless the text holds the space mark itself. Repeated rows
    stay repeated; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            ids = c.encode_batch(texts)
            back = [c.decode(x) for x in ids]
            offsets = np.cumsum([0] + [len(x) for x in ids], dtype=np.int32)
            values = np.concatenate([np.empty(0, "<u2"), *ids]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                    pa.array([x == t for x, t in zip(back, texts, strict=True)], pa.bool_()),
                ],
                ["doc_id", "ids", "decoded_sha256", "round_trip"],
            )

    common.small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_or_empty(text_col).alias("t"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded_sha256 string, round_trip boolean")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encoded(common.table(spark, sf_dir, "documents"), vocabulary())
    return found.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "decoded_sha256", "round_trip")
