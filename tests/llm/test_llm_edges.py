"""Null, empty, long, tied and repeated rows, empty tables and clashing columns, per operator."""

import pytest
from pyspark.sql import functions as F

from tallyline.llm import archive, digest, exact, licenses, packing, pieces, pseudonyms, quality, secrets, simhash

LONG = "Long words again and again. " * 20_000
ROWS = [(1, "Same text here now"), (2, "same TEXT here now"), (3, None), (4, ""), (5, LONG), (6, "x"), (7, "password = hunter2hunter2 x"), (7, "password = hunter2hunter2 x"), (None, "No identifier, 4929348385146306")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i == 6 else "s", len(t or ""), 0.5, "kept", "fp") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, fp string")


RUNS = {
    "exact": exact.exact_groups,
    "simhash": simhash.components,
    "secrets": lambda d: secrets.scan(d).select("doc.*", "found.*"),
    "digest": digest.with_next,
    "pieces": lambda d: pieces.encoded(d, pieces.vocabulary()),
    "pseudonyms": pseudonyms.pseudonymised,
    "licenses": licenses.scan,
    "quality": lambda d: quality.scored(d, quality.fitted([], quality.np.array([]))).select("doc.doc_id", F.col("score").alias("s")),
}


@pytest.mark.parametrize("name", RUNS)
def test_one_row_per_row(docs, name):
    out = RUNS[name](docs)
    assert sorted(str(r[0]) for r in out.select("doc_id").collect()) == sorted(str(i) for i, _ in ROWS)


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(docs, name):
    assert RUNS[name](docs.limit(0)).count() == 0


def test_exact_rows(docs):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(docs).collect()}
    assert {(1, 2, 2, False), (2, 2, 2, True), (3, 4, 2, False), (4, 4, 2, True), (7, 7, 2, True), (None, None, 1, True)} <= got


def test_exact_tree_of_any_size(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("T"), (F.col("id") % 17).cast("string")).alias("text"))
    for fan, levels in ((2, 1), (2, 5), (4, 3)):
        got = exact.merged(exact.digests(rows), fan, levels)
        assert sorted((r.keep_id, r.group_size) for r in got.collect()) == sorted((max(range(k, 3000, 17)), len(range(k, 3000, 17))) for k in range(17))


def test_exact_rounds_follow_the_partitions(spark):
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = []
        for n in ("2", "256", "257", "4097"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(exact.rounds(spark))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert got == [2, 2, 3, 4]


def test_pieces_of_packing(docs):
    out = packing.packed(docs, packing.vocabulary()).collect()
    assert sum(r.length for r in out if r.doc_id == 5) == next(r.doc_tokens for r in out if r.doc_id == 5) > 2048
    assert [(r.length, r.doc_tokens) for r in out if r.doc_id == 3] == [(1, 1)]
    assert packing.packed(docs.limit(0), packing.vocabulary()).count() == 0


def test_pages(spark, tmp_path):
    rows = [(1, "http://a b/ü", "<p>é\r\n\r\nx\r\n"), (2, None, None), (3, "u", ""), (4, "u", "<p>é\r\n\r\nx\r\n"), (4, "u", "<p>é\r\n\r\nx\r\n"), (5, "u", "\n" * 50_000 + "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("z"))
    archive.write_arc(pages.repartition(2), f"{tmp_path}/arc")
    archive.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    back = archive.read_warc(spark, f"{tmp_path}/warc").where("record_type <> 'warcinfo'").collect()
    assert all(r.sound for r in back)
    kept = {1: ("revisit", 4), 2: ("revisit", 3), 3: ("response", None), 5: ("response", None)}
    for r in back:
        html = dict((i, h or "") for i, _, h in rows)[r.page_id].encode()
        assert r.payload_bytes == len(html) and r.payload_digest == archive.sha1_base32(html)
        assert r.payload is None or r.payload == html
        if r.page_id in kept:
            assert (r.record_type, r.refers_to) == kept[r.page_id]
    assert sorted(r.record_type for r in back if r.page_id == 4) == ["response", "revisit"]
    archive.write_arc(pages.limit(0), f"{tmp_path}/none")
    archive.convert(spark, f"{tmp_path}/none", f"{tmp_path}/none-warc")
    assert archive.read_warc(spark, f"{tmp_path}/none-warc").where("record_type <> 'warcinfo'").count() == 0


def test_arc_versions_and_damage():
    v1 = [b"filedesc://a 0.0.0.0 20240101000000 text/plain 4", b"1 0", b"", b"junk", b"http://x/ 1.2.3.4 20010203040506 text/html 3", b"abc"]
    got = list(archive.arc_records(iter(v1), "a"))
    assert [(r["type"], r["uri"], r["date"]) for r in got] == [("warcinfo", "filedesc://a", "2024-01-01T00:00:00Z"), ("resource", "http://x/", "2001-02-03T04:05:06Z")]
    v2 = [b"filedesc://a 0.0.0.0 20240101000000 text/plain 200 - - 0 a 4", b"2 0", b"", b"http://x/ 1.2.3.4 20010203040506 text/html 200 - - 0 a 3", b"a", b"c"]
    assert [r["block"] for r in archive.arc_records(iter(v2), "a")][1] == b"a\nc"
