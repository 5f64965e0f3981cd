"""Two-phase batches and current tables."""

import itertools
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sources import changes, sinks
from tallyline.sources.commits import CommittedBatches

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_batch_lost_between_staging_and_commit_is_never_read(spark, tmp_path):
    out = str(tmp_path / "t")
    store = CommittedBatches(out, every=3)
    store(spark.range(2), 0)

    def lost(*_):
        raise RuntimeError("killed")

    broken = CommittedBatches(out, every=3)
    broken.commit = lost
    with pytest.raises(RuntimeError):
        broken(spark.range(50, 60), 1)
    staged = len(list(Path(out, "data").iterdir()))
    assert staged == 2 and ids(sinks.read_batches(spark, out)) == [0, 1]
    store(spark.range(5, 7), 1)  # the replay
    store(spark.range(5, 7), 1)  # and one more
    assert ids(sinks.read_batches(spark, out)) == [0, 1, 5, 6]
    for k in range(2, 9):
        store(spark.range(10 * k, 10 * k + 1), k)
    assert ids(sinks.read_batches(spark, out)) == [0, 1, 5, 6, *range(20, 90, 10)]
    # the lost folder is gone with the batches that the last segment but one covers
    kinds = sorted(p.name.split("-")[0] for p in Path(out, "data").iterdir())
    assert kinds == ["batch"] * 3 + ["segment"] * 3


def test_a_half_written_segment_is_not_read_and_is_made_again(spark, tmp_path):
    out = str(tmp_path / "t")
    store = CommittedBatches(out, every=2)
    store(spark.range(1), 0)
    failing = CommittedBatches(out, every=2)
    kinds = []

    def commit(session, kind, upto, where):
        kinds.append(kind)
        if kind == "segment":
            raise RuntimeError("killed")
        CommittedBatches.commit(failing, session, kind, upto, where)

    failing.commit = commit
    with pytest.raises(RuntimeError):
        failing(spark.range(1, 2), 1)
    assert kinds == ["batch", "segment"] and ids(sinks.read_batches(spark, out)) == [0, 1]
    store(spark.range(1, 2), 1)
    assert [p.name.split(".")[0] for p in Path(out, "log").iterdir() if p.name.startswith("seg")] == ["segment"]
    assert ids(sinks.read_batches(spark, out)) == [0, 1]


def test_nothing_committed(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.read_batches(spark, str(tmp_path / "none"))
    assert sinks.read_batches(spark, str(tmp_path / "none"), ROW).count() == 0


def test_last_of_each_key_over_snapshots(spark, tmp_path):
    out = str(tmp_path / "t")
    store = sinks.keyed_batches(out, ["id"], every=2)
    for k in range(7):
        store(spark.range(k, k + 2).withColumn("n", F.lit(k)), k)
        got = {r.id: r.n for r in sinks.read_latest(spark, out, ["id"]).collect()}
        assert got == {i: min(i, k) for i in range(k + 2)}
    assert len(store.live(spark)) == 2


def envelope(op, key, name, position):
    source = {"db": "d", "schema": "s", "table": "t"}
    row = {"id": key, "name": name}
    gone = op == "d"
    return json.dumps({"before": row if gone else None, "after": None if gone else row, "source": source, "op": op, "position": position})


HISTORY = [("r", 1, "a", None), ("u", 1, "b", 5), ("d", 1, "b", 9), ("c", 1, "c", 12), ("r", 2, "x", None), ("d", 2, "x", 7), ("c", 3, "y", 3)]


@pytest.mark.parametrize("order", [0, 17, 2000, 5039])
def test_current_table_in_any_order_of_arrival(spark, tmp_path, order):
    arrived = list(itertools.islice(itertools.permutations(HISTORY), order, order + 1))[0]
    out = str(tmp_path / "t")
    store = changes.current_table(out, ["id"], every=2)
    for k, change in enumerate(arrived):
        text = spark.createDataFrame([(envelope(*change),), ("not json",), (None,)], "value string")
        store(changes.keyed_changes(text, ROW, ["id"], "d.s.t"), k)
    want = [(1, "c"), (3, "y")]
    assert sorted(map(tuple, changes.read_current(spark, out, ["id"]).collect())) == want
    text = spark.createDataFrame([(envelope(*c),) for c in arrived], "value string")
    rows = changes.keyed_changes(text, ROW, ["id"], "d.s.t")
    assert sorted(map(tuple, changes.current_rows(rows.withColumn("_batch", F.lit(0)), ["id"]).collect())) == want


def test_deletes_leave_the_snapshots(spark, tmp_path):
    out = str(tmp_path / "t")
    store = changes.current_table(out, ["id"], every=2, late=0)
    for k in range(8):
        some = [envelope("c", k, "n", 10 * k)] + ([envelope("d", k - 1, "n", 10 * k + 1)] if k else [])
        text = spark.createDataFrame([(t,) for t in some], "value string")
        store(changes.keyed_changes(text, ROW, ["id"], "d.s.t"), k)
        store(changes.keyed_changes(text, ROW, ["id"], "d.s.t"), k)
        assert [r.id for r in changes.read_current(spark, out, ["id"]).collect()] == [k]
    # rows: the last one, and the deletes of the last two batches
    assert store.rows(spark).count() <= 3


def test_changes_without_keys_and_of_other_tables(spark):
    other = envelope("c", 9, "z", 1).replace('"t"', '"u"')
    text = spark.createDataFrame([(t,) for t in (other, envelope("c", None, "z", 1), envelope("c", "seven", "z", 1), envelope("d", 4, "q", 2))], "value string")
    got = changes.keyed_changes(text, ROW, ["id"], "d.s.t").collect()
    assert [tuple(r) for r in got] == [(4, None, "d", 2)]
