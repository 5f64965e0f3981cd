"""Token counts against the libraries' own encoders, for texts cut and widened at small sizes."""

import random

import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tallyline.llm import counts, packing, queries


@pytest.fixture(scope="module")
def odd():
    r = random.Random(5)
    words = ["the", "Émile", "o'clock", "don't", "12345", "<|endoftext|>", "x" * 300, "ﬁ", "́a", "日本語", "\t", "\n\n", "😀😀", ".,!"]
    rows = [(i, " ".join(r.choice(words) for _ in range(n))) for i, n in enumerate([0, 1, 50, 400, 900])]
    rows += [(10, "ab" * 3000), (11, "word " * 500 + "q" * 4000 + " word" * 700), (12, None), (None, " x" * 3000), (12, "\n" * 5000), (13, "a\n\n\n  b\t" * 900)]
    return rows + [(14, "".join(r.choice("ab1 '́é\t") for _ in range(9000))), (14, "a\x1cb c " * 400)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("size,overlap", [(500, 20), (1000, 100), (64, 8)])
def test_spliced_counts_are_those_of_whole_texts(spark, odd, name, size, overlap):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    want = [(str(i), len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False).ids)) for i, t in odd]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in odd], "doc_id long, text string, row int, n_tokens int")
    got = counts.counted(docs, path, limit=1000, huge=600, size=size, overlap=overlap).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted(want)
    assert all(r.over_limit == (r.n_tokens > 1000) for r in got)


def test_text_identifiers_and_empty_tables(spark):
    docs = spark.createDataFrame([("a", "x " * 2000), ("b", "y")], "doc_id string, text string")
    got = counts.counted(docs, packing.vocabulary(), huge=600, size=500, overlap=20).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [("a", 2000), ("b", 1)]
    assert counts.counted(docs.limit(0), packing.vocabulary()).count() == 0


def test_other_tokenizers_are_refused(tmp_path):
    from tokenizers import models, pre_tokenizers

    joined = Tokenizer(models.BPE())
    joined.pre_tokenizer = pre_tokenizers.Punctuation()
    joined.save(f"{tmp_path}/joined.json")
    with pytest.raises(ValueError):
        counts.Tokens(f"{tmp_path}/joined.json")


def test_failed_joints_open_what_lies_between_splices():
    ok = {"n": 10, "place": 100, "in_left": 8, "in_right": 2}
    bad = {"n": 10, "place": None, "in_left": None, "in_right": None}
    assert counts.assembled(0, 400, [ok, bad, ok | {"place": 300}, bad]) == (8 + 10 - 2, [{"begin": 100, "end": 300}])
    assert counts.assembled(0, 400, [bad, bad]) == (0, [{"begin": 0, "end": 400}])
    assert counts.assembled(7, 9, [bad]) == (10, [])


def test_all_documents(spark, folder):
    import duckdb

    whole = Tokenizer.from_file(packing.vocabulary())
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    want = [(i, len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    got = queries.QUERIES["op11_token_counts"](spark, folder).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == sorted(want)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
