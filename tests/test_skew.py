"""Hot keys must change how rows are spread, never the rows."""

import random

import pytest
from pyspark.sql import functions as F

from scorecard.operators import skew
from scorecard.operators.latest import latest_per_key
from scorecard.operators.neighbours import with_neighbour
from scorecard.operators.skew import NO_HOT_KEYS, HotKeys, find_hot_keys, lookup_join

SCHEMA = "k string, a int, b int, v string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    keys = ["hot"] * 400 + [None] * 300 + [f"k{i}" for i in range(300)]
    return [
        (
            k,
            rng.choice([None, *range(20)]),
            i,
            rng.choice([None, "x", "y", "z"]),
        )
        for i, k in enumerate(keys)
    ]


def brute(rows, ahead):
    """Neighbour values in plain Python: nulls last, or the exact reverse."""
    def place(r):
        return (r[1] is None, r[1] or 0, r[2])

    groups, out = {}, {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for g in groups.values():
        g.sort(key=place, reverse=ahead)
        for i, r in enumerate(g):
            out[r[2]] = g[i - 1][3] if i else None
    return out


@pytest.mark.parametrize("ahead", [False, True])
@pytest.mark.parametrize("split", [False, True])
def test_neighbour_equals_brute_force(spark, rows, ahead, split):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    hot = HotKeys({"hot": 0.4}, 0.3) if split else NO_HOT_KEYS
    got = with_neighbour(df, "k", ["a", "b"], {"near": "v"}, ahead=ahead, hot=hot)
    assert got.columns == ["k", "a", "b", "v", "near"]
    found = got.collect()
    assert len(found) == len(rows)
    assert {r["b"]: r["near"] for r in found} == brute(rows, ahead)


def test_a_hot_history_is_spread_over_tasks(spark, rows):
    """No piece of the hot key holds the whole key."""
    from scorecard.operators import neighbours

    pieces = []
    original = neighbours.stage

    def spy(df, label):
        staged = original(df, label)
        pieces.append(staged)
        return staged

    neighbours.stage = spy
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        with_neighbour(df, "k", ["a", "b"], {"near": "v"}, hot=HotKeys({"hot": 0.9}, 0.0)).count()
    finally:
        neighbours.stage = original
    sizes = [r["count"] for r in pieces[0].groupBy("_piece").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 400


def test_find_hot_keys(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    hot = find_hot_keys(df, "k", factor=0.5)
    assert set(hot.shares) == {"hot"}
    assert hot.shares["hot"] == pytest.approx(0.4)
    assert hot.null_share == pytest.approx(0.3)
    even = spark.range(100).select((F.col("id") % 50).cast("string").alias("k"))
    assert not find_hot_keys(even, "k").any


def test_lookup_join_keeps_every_row(spark, rows):
    left = spark.createDataFrame(rows, SCHEMA)
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("other", 3)], "k string, w int")
    hot = HotKeys({"hot": 0.4}, 0.3)
    for how in ("left", "inner"):
        plain = lookup_join(left, right, "k", NO_HOT_KEYS, how)
        spread = lookup_join(left, right, "k", hot, how)
        assert spread.columns == plain.columns
        assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    plan = lookup_join(left, right, "k", hot)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_latest_per_key_prunes_before_the_shuffle(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    newest = latest_per_key(df, ["k"], ["a"], ["b"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    best = {}
    for r in rows:
        place = (r[1] is None, r[1] or 0, r[2])
        if r[0] not in best or place > best[r[0]][0]:
            best[r[0]] = (place, r)
    assert {r["k"]: r["b"] for r in newest.collect()} == {k: v[1][2] for k, v in best.items()}


def test_more_hot_keys_than_any_fixed_limit(spark):
    df = spark.range(60_000).select((F.col("id") % 1500).cast("string").alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "12000")
    try:
        assert len(find_hot_keys(df, "k").shares) == 1500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_sketch_of_many_keys_is_small_and_exact_enough(spark, monkeypatch):
    asked, plain = [], skew.F.expr
    monkeypatch.setattr(skew.F, "expr", lambda text: asked.append(text) or plain(text))
    # A third of the rows, above one of four fair shares; the others come once.
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
    )
    found = find_hot_keys(rows, "k", factor=1)
    assert set(found.shares) == {"hot"}
    assert abs(found.shares["hot"] - 1 / 3) < 0.001
    counters = [int(text.rstrip(")").split(",")[-1]) for text in asked]
    assert counters and max(counters) <= 10_000
