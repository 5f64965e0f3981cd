"""Digests of paths and mergeable sketches: against plain counts, and bounded in size."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyline.operators import clicks, paths
from tallyline.sources import sinks
from tallyline.sources.commits import CommittedBatches
from tallyline.streaming import clicks as stream_clicks

START = 1_761_500_000_000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def _logs(spark, rows):
    return spark.createDataFrame(rows, "log_id string, user_id string, log_type string, ts string, formatted_time string, keywords string")


def test_digests_over_any_seconds(spark):
    """One sequence has one digest, however its steps fall on seconds; other ones have others."""
    draw, rows, want = random.Random(3), [], Counter()
    sequences = [["home", "search"], ["search", "home"], ["home", "home"], ["home", "search", "home"], ["cart"] * 40, ["cart"] * 41, ["home"]]
    sequences += [draw.choices(["home", "search", "payment", "cart"], k=60) for _ in range(4)]
    for user in range(120):
        path = sequences[user % len(sequences)]
        at = START
        for i, page in enumerate(path):
            at += draw.choice([0, 0, 1, 300, 5000])
            rows.append((f"{i:05}", f"u{user}", page, str(at), None, None))
        if len(path) > 1:
            want["->".join(path)] += 1
    logs = _logs(spark, rows)
    digests = paths.pattern_digests(logs).collect()
    assert Counter({(r.path_length, r.cnt): 1 for r in digests}) == Counter({(len(p.split("->")), c): 1 for p, c in want.items()})
    assert len(digests) == len(want) == len({r.digest.d0 for r in digests}) == len({r.digest.d1 for r in digests})
    assert {r.pattern: r.cnt for r in paths.path_patterns(logs, part_steps=7).collect()} == want
    top = sorted(want.items(), key=lambda e: (-e[1], e[0]))[:5]
    assert [(r.pattern, r.cnt) for r in paths.top_path_patterns(logs).collect()] == top


def test_digests_read_the_source_once(spark):
    n = F.col("id").cast("string")
    logs = spark.range(10).select(
        n.alias("log_id"), n.alias("user_id"), F.when(F.col("id") > 3, "home").otherwise("cart").alias("log_type"),
        (F.col("id") + START).cast("string").alias("ts"),
    )
    plan = _plan(paths.pattern_lengths(paths.pattern_digests(logs)))
    # rows by second, seconds by path, paths by digest, and the one row of the means
    assert plan.count("Range (") == 1 and plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan


def test_digest_of_a_long_way(spark):
    """The power by bits is the power."""
    for m, b in paths.DIGESTS:
        for n in (0, 1, 15, 16, 1_000_003, 2**40 - 1):
            assert spark.range(1).select(F.lit(n).cast("bigint").alias("n")).selectExpr(paths._power(b, m, "n") + " AS p").first().p == pow(b, n, m)


@pytest.fixture(scope="module")
def visits(spark):
    draw = random.Random(5)
    rows = []
    for i in range(6000):
        user = None if i % 50 == 0 else f"u{draw.randrange(900)}"
        rows.append((str(i), user, draw.choice(["home", "cart", None]), str(START), draw.choice([f"2025-10-{d:02} 10:00:00" for d in range(1, 29)] + [None, "bad"]), None))
    return rows


def _brute_users(rows, days):
    """(page, day) -> views, users, users who were there in the period before."""
    at = defaultdict(list)
    for _, user, page, _, time, _ in rows:
        if page and time and time[:4] == "2025":
            at[page].append((int(time[8:10]), user))
    out = {}
    for page, entries in at.items():
        for day in {d for d, _ in entries}:
            now = [u for d, u in entries if day - days < d <= day]
            before = {u for d, u in entries if day - 2 * days < d <= day - days and u}
            out[page, day] = len(now), len({u for u in now if u}), len({u for u in now if u in before})
    return out


@pytest.mark.parametrize("days", [1, 7])
def test_users_of_periods(spark, visits, days, tmp_path):
    sketches = clicks.user_sketches(_logs(spark, visits))
    sketches.write.parquet(f"{tmp_path}/s")
    got = clicks.users_of_periods(spark.read.parquet(f"{tmp_path}/s"), days).collect()
    assert {(r.page, r.date.day): (r.pv, r.users, r.returning) for r in got} == _brute_users(visits, days)


def test_error_and_size_of_small_user_sketches(spark, visits):
    """With 2^8 users kept, 900 are estimated within four standard errors, in at most so many bytes."""
    sketches = clicks.user_sketches(_logs(spark, visits), size=8)
    assert sketches.agg(F.max(F.octet_length("users"))).first()[0] <= 8 * 2 ** 9 + 64
    for r in clicks.users_of_periods(sketches, 28, size=8).where("date = '2025-10-28'").collect():
        exact = _brute_users(visits, 28)[r.page, 28][1]
        assert exact > 256 and abs(r.users - exact) <= 4 / 16 * exact


def test_sketches_of_no_rows(spark):
    none = _logs(spark, [])
    assert clicks.users_of_periods(clicks.user_sketches(none), 7).collect() == []
    assert clicks.frequent_words(clicks.word_sketch(none)).collect() == []
    assert paths.top_path_patterns(none).collect() == [] and paths.path_patterns(none).collect() == []


@pytest.mark.parametrize("rare", [500, 20_000])
def test_word_sketches_of_a_stream_are_bounded(spark, tmp_path, rare):
    """Frequent words are found with the stated error, in the same space for any number of words."""
    tracked, files = 256, 6
    frequent = {f"w{k}": 3000 - 100 * k for k in range(10)}
    words = [w for w, n in frequent.items() for _ in range(n)] + [f"rare{i}" for i in range(rare)]
    random.Random(1).shuffle(words)
    for k in range(files):
        part = words[k::files]
        _logs(spark, [(str(i), "u", "search", str(START), None, ",".join(part[i : i + 50])) for i in range(0, len(part), 50)]).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    schema = spark.read.parquet(f"{tmp_path}/in/0").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    sinks.start_batches(stream, stream_clicks.word_batches(f"{tmp_path}/out", tracked, every=2), f"{tmp_path}/ck").awaitTermination()
    store = CommittedBatches(f"{tmp_path}/out")
    assert len(store.live(spark)) == 1
    stored = store.rows(spark)
    assert stored.agg(F.max(F.octet_length("words.sketch"))).first()[0] <= 40 * tracked
    got = {r.word: r.cnt for r in clicks.frequent_words(stored, 10, tracked).collect()}
    assert set(got) == set(frequent)
    assert all(abs(got[w] - n) <= 3.5 * len(words) / tracked for w, n in frequent.items())
