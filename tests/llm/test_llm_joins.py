"""Tables that grow with the input are not sent to the driver because Spark sizes them too low."""

import pytest

import corpus_pipeline
from tallyline.llm import common, links, simhash


@pytest.fixture
def plans(monkeypatch):
    """Name and final plan of each table that is stored, under Spark's own broadcast limit."""
    found, stored = [], common.stored

    def seen(df, name):
        df.collect()
        found.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(common, "stored", seen)
    return found


def test_variants_are_not_broadcast(spark, plans):
    """A handful of points is small, their 64 variants each are not counted by Spark (F2)."""
    points = common.stored(spark.createDataFrame([(0, 1), (1, 2), (3, 3), (1 << 40, 4), (0x5555 << 30, 5)], "fp long, label long"), "points")
    for distance in (1, 2, 4):
        pairs = common.stored(simhash.new_links(points, distance), "links")
        assert {(r.low, r.high) for r in pairs.collect()} >= {(1, 2), (2, 3), (1, 4)}
    made = [p for name, p in plans if name == "links"]
    assert len(made) == 3 and all("SortMergeJoin" in p and "Broadcast" not in p for p in made)


def test_links_are_not_broadcast_in_the_pipeline(spark, plans):
    """Near copies by the stage of the pipeline: no table of links goes to the driver on the way (F1)."""
    words = [f"w{i}" for i in range(400)]
    texts = {k: [f"{w}{k % 3}" for w in words] for k in range(12)}
    for k in range(3, 12):
        texts[k][7 * k] = "other"
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")
    kept = corpus_pipeline.simhash_dedup(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]
    made = {name: [p for n, p in plans if n == name] for name in ("links", "star")}
    assert made["links"] and len(made["star"]) > 1
    assert all("SortMergeJoin" in p for p in made["links"])
    assert not [p for own in made.values() for p in own if "Broadcast" in p]


def test_stars_are_not_broadcast(spark, plans):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (1, 4), (7, 9), (8, 9)], "low long, high long")
    got = {r.node: r.root for r in links.smallest_labels(common.stored(pairs, "links")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7}
    made = [p for name, p in plans if name == "star"][1:]
    assert made and all("SortMergeJoin" in p and "Broadcast" not in p for p in made)
