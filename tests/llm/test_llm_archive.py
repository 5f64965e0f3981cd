from tallyline.llm import archive

LONG = 1 << 63


def test_page_ids_of_all_longs(spark, tmp_path):
    ids = [LONG - 1, -LONG, 10**18, 10**18 - 1, -(10**18), 7]
    pages = spark.createDataFrame([(i, "u", f"<p>{n % 2}") for n, i in enumerate(ids)], "page_id long, url string, html string")
    archive.write_arc(pages.repartition(2), f"{tmp_path}/arc")
    archive.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    got = {r.page_id: r.refers_to for r in archive.read_warc(spark, f"{tmp_path}/warc").where("record_type <> 'warcinfo'").collect()}
    best = [max(ids[n % 2 :: 2]) for n in range(6)]
    assert got == {i: None if i == k else k for i, k in zip(ids, best, strict=True)}
    assert [archive.page_key(str(i)) for i in (LONG, -LONG - 1, 10**19)] == [None] * 3


def test_pages_with_the_address_of_a_version_block(spark, tmp_path):
    pages = spark.createDataFrame([(1, "filedesc://x", "<p>2"), (2, "filedesc://y", "2"), (3, "u", "<p>")], "page_id long, url string, html string")
    for version in (1, 2):
        home = f"{tmp_path}/{version}"
        archive.write_arc(pages.coalesce(1), f"{home}/arc", (version,))
        archive.convert(spark, f"{home}/arc", f"{home}/warc")
        back = archive.read_warc(spark, f"{home}/warc").where("record_type <> 'warcinfo'").collect()
        assert sorted((r.page_id, r.uri, r.record_type, bytes(r.payload)) for r in back) == [
            (1, "filedesc://x", "response", b"<p>2"), (2, "filedesc://y", "response", b"2"), (3, "u", "response", b"<p>"),
        ]
