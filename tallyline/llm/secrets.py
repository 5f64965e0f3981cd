"""Secret scans: base patterns and an assignment-aware lexer.

Base spans follow three fixed patterns. The lexer reads ``name = literal`` pairs of
source and configuration syntax (``=``, ``:``, ``:=``, ``=>``; quoted, bare and
concatenated literals; ``<name>text</name>``), lets constants stand for their literals wherever
a name is set to them, before or behind the constant itself, and scores each literal by the
words of the names it ends up in and by its own look. Literals at or over THRESHOLD are further
spans of the kind ``literal``. Names of more than 128 signs are not read by the lexer.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: Runs of these characters are maximal, so asking for the length is the same as dropping short ones.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Any of these must be in the lower-cased text before ASSIGN can match.
NAMED = ("passw", "secret", "token", "apikey", "api_key")
KINDS = {"assign": 0, "access": 1, "hex": 2, "literal": 3}
ASSIGN_LENGTH = 6

QUOTED = r"""(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')"""
PAIR = re.compile(
    rf"""(?P<name>(?<![A-Za-z0-9_])[A-Za-z_][A-Za-z0-9_.\-]{{0,127}})["'\]]{{0,2}}[ \t]*(?::=|=>|=|:)[ \t]*"""
    rf"""(?:(?P<quoted>{QUOTED}(?:[ \t]*\+[ \t]*{QUOTED})*)|(?P<bare>[A-Za-z0-9+/_.=\-]+))"""
)
ONE_QUOTED = re.compile(QUOTED)
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")
#: How strongly a word of a name says that its value is secret.
WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.9, "private": 0.6, "signing": 0.6,
    "access": 0.4, "client": 0.2, "key": 0.5, "api": 0.4, "salt": 0.5, "dsn": 0.6, "pin": 0.4,
}
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.\-]{0,127})(?:\s[^<>]*)?>(?P<text>[^<>\n]+)</(?P=name)>")
#: Whole values that stand in for a secret: references, and one sign over and over.
REFERENCE = re.compile(r"<[^<>]*>|\$\{[^}]*\}|\$\([^)]*\)|\{\{.*\}\}|%\w+%|(.)\1*", re.S)
#: Words of which a stand-in consists wholly, beside those of WEIGHTS and short numbers.
STAND_INS = frozenset(
    "a an change changeme dummy enter example false fill foo bar here in insert it me my none null of placeholder "
    "please put replace sample some string test testing the this to todo true undefined value with xxx you your".split()
)
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
THRESHOLD, LITERAL_LENGTH = 1.3, 6


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base patterns, leftmost and not overlapping per kind."""
    spans = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    low = text.lower()
    # lower() may turn letters outside ASCII into ASCII ones; the pattern itself decides
    if any(w in low for w in NAMED):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    return spans


def name_score(name: str) -> float:
    words = [w.lower() for w in WORDS.findall(name)]
    return min(1.5, sum(WEIGHTS.get(w, 0.0) for w in set(words) | ({"apikey"} if "apikey" in name.lower() else set())))


def stands_in(value: str) -> bool:
    """Whether the value as a whole, or each of its words, only stands in for a secret."""
    if REFERENCE.fullmatch(value):
        return True
    return all(w in STAND_INS or w in WEIGHTS or (w.isdigit() and len(w) <= 4) for w in map(str.lower, WORDS.findall(value)))


def look_score(value: str) -> float:
    """0 for stand-ins and plain words, up to 1 for long mixed values.

    A value with blanks or signs outside ASCII looks like prose unless it holds a digit.
    """
    n = len(value)
    if n < LITERAL_LENGTH or stands_in(value) or ((not value.isascii() or " " in value) and not any(map(str.isdigit, value))):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit)) + (not value.isalnum())
    return min(1.0, 0.12 * entropy + 0.15 * kinds + min(n, 32) / 128)


def pairs(text: str) -> Iterator[tuple[str, list[tuple[int, int]], str, bool]]:
    """(name, spans of the literal's parts, value, whether it may be another name)."""
    for m in PAIR.finditer(text):
        if m["quoted"] is not None:
            at = m.start("quoted")
            parts = [(at + q.start() + 1, at + q.end() - 1) for q in ONE_QUOTED.finditer(m["quoted"])]
            yield m["name"], parts, "".join(text[a:b] for a, b in parts), False
        else:
            value = m["bare"]
            yield m["name"], [m.span("bare")], value, bool(IDENTIFIER.match(value))


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of literals that a sensitive name holds, itself or through constants.

    A name set to a constant takes the constant's last literal before it, or its first
    behind it if there is none before. A bare word that nothing in the text sets is a literal.
    """
    found: set[tuple[int, int]] = set()

    def said(name: str, parts: list[tuple[int, int]], value: str) -> None:
        named = name_score(name)
        if named and (look := look_score(value)) and named + look >= THRESHOLD:
            found.update(parts)

    def arrived(name: str, waiting: dict[str, list[str]], parts: list[tuple[int, int]], value: str) -> None:
        # a wait ends once, so all of them take a step per pair of the text at most
        reached = waiting.pop(name, [])
        while reached:
            other = reached.pop()
            said(other, parts, value)
            reached += waiting.pop(other, [])

    if "</" in text:
        for m in ELEMENT.finditer(text):
            said(m["name"], [m.span("text")], m["text"])
    if "=" in text or ":" in text:
        constants: dict[str, tuple[list[tuple[int, int]], str]] = {}
        waiting: defaultdict[str, list[str]] = defaultdict(list)
        for name, parts, value, maybe_name in pairs(text):
            if maybe_name and value in constants:
                parts, value = constants[value]
                maybe_name = False
            constants[name] = parts, value
            said(name, parts, value)
            if maybe_name and value != name:
                waiting[value].append(name)
            else:
                arrived(name, waiting, parts, value)
        for name in [n for n in waiting if n in constants]:
            arrived(name, waiting, *constants[name])
    return [(a, b, "literal") for a, b in found if b > a]


def spans_of(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans; a literal adds one unless a base span holds all of it."""
    order = lambda s: (s[0], KINDS[s[2]], s[1])
    base = sorted(base_spans(text), key=order)
    starts, ends = [b[0] for b in base], [0, *accumulate((b[1] for b in base), max)]
    more = [s for s in literal_spans(text) if ends[bisect_right(starts, s[0])] < s[1]]
    return base, sorted(base + more, key=order)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span, overlapping ones joined, replaced by ``[SECRET]``."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _said(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


FOUND = "n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string, masked string"


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc, found): each whole row of ``docs`` as a struct and what the scan says of its text.

    found: counts of the base kinds, base and all spans as ``kind:start:end`` (code
    points, end exclusive), and the masked text (null if there is no span). Null text
    counts as empty and has no spans. The row itself is passed on as it is, so columns
    of any name are safe, and repeated rows stay repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(n, pa.int64()) for n in ("n_assign", "n_access", "n_hex")] + [(n, pa.string()) for n in ("base_spans", "spans", "masked")])
        for b in batches:
            out = []
            for t in b.column(1):
                text = t.as_py()
                base, spans = spans_of(text)
                n = Counter(k for _, _, k in base)
                out.append({"n_assign": n["assign"], "n_access": n["access"], "n_hex": n["hex"], "base_spans": _said(base), "spans": _said(spans), "masked": masked(text, spans) if spans else None})
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], ["doc", "found"])

    common.small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), common.text_or_empty(text_col).alias("t"))
    return rows.mapInArrow(run, f"doc {docs.schema.simpleString()}, found struct<{FOUND.replace(' ', ':').replace(',:', ',')}>")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc.doc_id", "found.n_assign", "found.n_access", "found.n_hex", F.sha2("found.base_spans", 256).alias("base_sha256"), "found.spans")


