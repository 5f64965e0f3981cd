"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tallyline.llm import phrases


def plain(rows, least=3, absorbed=80, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = tuple(re.findall("[^\x20\x09]+", piece))
            n[lang] += len(w)
            counts[lang].update(w[i : i + k] for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        cand = {p: f for p, f in c.items() if len(p) > 1 and f >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * f >= absorbed * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, f in cand.items()):
                continue
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = ["a", "B", "c\x01", "c", "dé", "e\x00", "e", "日本", " ", "c-d", "zz\x1f", "<|x|>", "'s"]
    made = [(r.choice(["en", "de", None, "und", "x\x00\x01", ""]), "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ""]) for _ in range(120))) for _ in range(60)]
    return made + [("en", None), ("en", ""), ("fr", "le le le le le le le"), ("en", "one of a kind " * 40), ("en", "One Of. a kind; " * 9), ("fr", "x" * 5000 + " y")]


@pytest.mark.parametrize("slots", ["1", "7"])
def test_collocations(spark, rows, slots):
    docs = spark.createDataFrame([(la, t, "k", 1) for la, t in rows], "lang string, text string, key string, f int").repartition(3)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", slots)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = phrases.collocations(docs, least=3).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    assert sorted(tuple(r) for r in got) == plain(rows)


def test_few_of_each_language_and_none(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(docs, least=3, top=2).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, top=2)
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_long_texts_in_parts(monkeypatch, spark, rows):
    monkeypatch.setattr(phrases, "AT_ONCE", 50)
    text = "one of a kind, " * 30 + "b " * 100
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    got = Counter()
    cuts = [b"en\x00b", b"en\x00kind\x00z", b"zz"]
    for b in phrases._counted_windows(iter([batch]), 4, cuts):
        got.update(dict(zip(b.column(1).to_pylist(), b.column(2).to_pylist())))
        assert all(s == sum(k >= c for c in cuts) for s, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    assert got == Counter(b"en\x00" + w for w in phrases.windows([text]))
    assert sum(got.values()) == 220


def test_a_task_holds_only_what_it_cuts_at_once(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(phrases, "AT_ONCE", 1 << 15)
    texts = [" ".join(f"{i * 200 + k:x}" for k in range(200)) for i in range(600)]
    batches = [pa.RecordBatch.from_pydict({"lang": ["en"], "text": [t]}) for t in texts]
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in phrases._counted_windows(iter(batches), 4, [b"en\x00c"]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 120_000
    assert peak < 8 << 20


@pytest.mark.parametrize("most", [1, 4, 40])
def test_sorted_windows_are_the_counts_of_all(rows, most):
    for texts in ([t or "" for _, t in rows], [""], [" .\n"], ["b a\x00 b a b"]):
        raw, begins, ends, counts = phrases.sorted_windows(texts, most)
        keys = [raw[a:b] for a, b in zip(begins, ends)]
        want = Counter(phrases.windows(texts, most))
        assert keys == sorted(want) and counts.tolist() == [want[k] for k in keys]
