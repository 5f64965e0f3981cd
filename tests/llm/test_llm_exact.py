import hashlib
from collections import defaultdict

from tallyline.llm import exact


def test_runs_are_sorted_and_merged_at_every_level(spark):
    docs = spark.createDataFrame([(i, str(i % 7)) for i in range(50)], "doc_id long, text string")
    rows = exact.merged(exact.digests(docs), 4, 2)
    plan = rows._jdf.queryExecution().sparkPlan().toString() + rows._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan
    initial = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # the runs and the two rounds: each a sort under neighbours that are joined
    assert initial.count("SortAggregate") >= 3 and initial.count("Sort [slot") >= 3
    assert sorted((r.keep_id, r.group_size) for r in rows.collect()) == [(k, 8 if k == 49 else 7) for k in range(43, 50)]


def test_groups_on_odd_rows(spark):
    data = [(3, "Ab"), (1, "aB"), (None, "ab"), (None, "only"), (None, "only"), (5, None), (4, ""), (7, "Ä"), (8, "ä"), (9, "x" * 300_000), (9, "X" * 300_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    groups = defaultdict(list)
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for i, t in data:
        groups[low(t)].append(i)
    want = []
    for i, t in data:
        own = groups[low(t)]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256(low(t).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in exact.exact_groups(docs).collect())
