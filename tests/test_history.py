import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marlstone.operators import history
from marlstone.operators.history import (
    END, START, current_versions, point_in_time_join, scd2_versions, unsequenced, version_start_at,
)

DAY = datetime(2024, 1, 1)


def day(n, **more):
    return DAY + timedelta(days=n, **more)


@pytest.fixture()
def everything_is_hot(monkeypatch):
    monkeypatch.setattr(history, "HOT_SHARE", 1_000_000)
    return 1


def test_intervals_follow_the_sequence_not_the_arrival(spark):
    log = spark.createDataFrame(
        [("a", day(5), "late"), ("a", day(1), "first"), ("a", day(1), "first"), ("b", day(2), "only"),
         ("c", None, "undated")], "k string, ts timestamp, city string")
    rows = {(r.k, r[START]): (r.city, r[END]) for r in scd2_versions(log, ["k"], "ts").collect()}
    assert rows == {
        ("a", day(1)): ("first", day(5)), ("a", day(5)): ("late", None), ("b", day(2)): ("only", None),
    }
    assert [r.k for r in unsequenced(log, "ts").collect()] == ["c"]
    assert {(r.k, r.city) for r in current_versions(log, ["k"], "ts").collect()} == {("a", "late"), ("b", "only")}


def _random_log(seed, keys=6, rows=400):
    rng = random.Random(seed)
    log = []
    for _ in range(rows):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(keys)}"
        # Many rows within one slice, many slices, and exact repeats of a moment.
        moment = day(rng.choice([0, 0, 1, 40]), seconds=rng.randrange(300), microseconds=rng.randrange(3))
        log.append((key, moment, f"c{rng.randrange(3)}"))
    return log


def _brute_versions(log):
    expected = []
    for key in {k for k, _, _ in log}:
        winners = {}
        for k, ts, city in log:
            if k == key:
                winners[ts] = min(city, winners.get(ts, city))
        moments = sorted(winners)
        expected += [(key, winners[t], t, n) for t, n in zip(moments, moments[1:] + [None])]
    return sorted(expected, key=str)


@pytest.mark.parametrize("hot_rows", [10 ** 9, 20, 0])
def test_history_equals_brute_force(spark, hot_rows, everything_is_hot):
    log = _random_log(hot_rows % 97)
    df = spark.createDataFrame(log, "k string, ts timestamp, city string").repartition(5)
    got = scd2_versions(df, ["k"], "ts", hot_rows=hot_rows).select("k", "city", START, END).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute_versions(log)


@pytest.mark.parametrize("hot_rows", [10 ** 9, 0])
def test_tracked_columns_merge_repeats(spark, hot_rows, everything_is_hot):
    log = _random_log(5)
    df = spark.createDataFrame(log, "k string, ts timestamp, city string")
    got = scd2_versions(df, ["k"], "ts", track=["city"], hot_rows=hot_rows).select("k", "city", START, END)
    expected, by_key = [], {}
    for k, city, start, _ in sorted(_brute_versions(log), key=lambda r: (r[0], r[2])):
        runs = by_key.setdefault(k, [])
        if not runs or runs[-1][0] != city:
            runs.append((city, start))
    for k, runs in by_key.items():
        for (city, start), nxt in zip(runs, runs[1:] + [None]):
            expected.append((k, city, start, nxt[1] if nxt else None))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(expected, key=str)


def test_integer_and_date_sequences(spark):
    numbers = spark.createDataFrame([(1, 10), (1, 5_000_000), (1, 20)], "k int, seq long")
    rows = {r.seq: r[END] for r in scd2_versions(numbers, ["k"], "seq", hot_rows=0).collect()}
    assert rows == {10: 20, 20: 5_000_000, 5_000_000: None}
    days = numbers.select("k", F.date_add(F.lit("2024-01-01"), (F.col("seq") % 100).cast("int")).alias("seq"))
    assert scd2_versions(days, ["k"], "seq").where(F.col(END).isNull()).count() == 1
    with pytest.raises(TypeError):
        scd2_versions(numbers.withColumn("seq", F.col("seq").cast("string")), ["k"], "seq")


@pytest.mark.parametrize("hot_rows", [10 ** 9, 30, 0])
def test_point_in_time_equals_range_join(spark, hot_rows, everything_is_hot):
    log = _random_log(11, rows=300)
    versions = [(k, city, start, end) for k, city, start, end in _brute_versions(log)]
    dimension = spark.createDataFrame(versions, "k string, city string, valid_from timestamp, valid_to timestamp")
    rng = random.Random(3)
    facts = [(i, rng.choice(["hot", "k0", "k1", "nobody", None]),
              None if rng.random() < 0.05 else day(rng.choice([-1, 0, 1, 2, 41]), seconds=rng.randrange(300)))
             for i in range(400)]
    facts += [(1000 + i, k, start) for i, (k, _, start, _) in enumerate(versions)]
    rows = spark.createDataFrame(facts, "id int, k string, t timestamp").repartition(4)
    got = point_in_time_join(rows, dimension, "k", "t", ["city", "valid_from"], hot_rows=hot_rows)

    def lookup(k, t):
        for key, city, start, end in versions:
            if key == k and t is not None and start <= t and (end is None or t < end):
                return city, start
        return None, None

    expected = sorted(
        ((i, k, t, *lookup(k, t)) for i, k, t in facts), key=lambda r: r[0])
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == expected


def test_hot_keys_are_few_by_construction(spark, monkeypatch):
    monkeypatch.setattr(history, "HOT_SHARE", 10)
    df = spark.range(1000).select((F.col("id") % 7).alias("k")).unionByName(
        spark.range(1000).select((F.col("id") + 100).alias("k")))
    hot = history.hot_keys(df, ["k"], hot_rows=1)
    assert len(hot) < 10 and {r.k for r in hot} <= set(range(7))
    assert len(history.hot_keys(df.where("k < 3"), ["k"], hot_rows=1)) == 3


def test_start_is_inclusive_and_end_exclusive(spark):
    dimension = spark.createDataFrame([("a", day(1)), ("a", day(2))], "k string, valid_from timestamp")
    rows = spark.createDataFrame([("a", day(0)), ("a", day(1)), ("a", day(2)), ("a", day(9))], "k string, t timestamp")
    found = version_start_at(rows, dimension, ["k"], "t", "valid_from", "v").orderBy("t").collect()
    assert [r.v for r in found] == [None, day(1), day(2), day(2)]


def test_sketch_misses_no_hot_key(spark):
    """Many keys of one row, some with many: exact counts decide, and no others are counted."""
    df = spark.range(0, 300_000, 1, 6).select(
        F.when(F.col("id") % 10 == 0, F.lit(-1)).when(F.col("id") % 100 == 1, F.lit(-2)).otherwise(F.col("id")).alias("k"))
    assert {(r.k, r["_rows"]) for r in history.hot_keys(df, ["k"], hot_rows=2_000)} == {(-1, 30_000), (-2, 3_000)}
    assert history.frequent_hashes(df.limit(0), ["k"], 1) == []
    assert len(history.frequent_hashes(df, ["k"], 1_000)) == 2


def test_no_key_is_shuffled_when_none_is_hot(spark):
    """Without hot keys history and lookup move rows once, by key, and read every input once."""
    log = spark.createDataFrame(_random_log(1), "k string, ts timestamp, city string")
    plan = scd2_versions(log, ["k"], "ts", track=["city"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    dimension = scd2_versions(log, ["k"], "ts").withColumnRenamed(START, "valid_from")
    rows = log.select("k", F.col("ts").alias("t"))
    looked_up = point_in_time_join(rows, dimension, "k", "t", ["city"])
    plan = looked_up._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 2 and "Join" not in plan


@pytest.mark.parametrize("hot_rows", [10 ** 9, 5])
def test_a_null_key_is_a_key_in_the_history(spark, hot_rows, everything_is_hot):
    log = [(None, day(i % 50), f"c{i % 3}") for i in range(60)] + [("a", day(1), "x")]
    df = spark.createDataFrame(log, "k string, ts timestamp, city string")
    got = scd2_versions(df, ["k"], "ts", hot_rows=hot_rows).select("k", "city", START, END).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute_versions(log)


def test_rows_of_one_crowded_moment_are_spread(spark, everything_is_hot):
    rows = spark.createDataFrame([("a", day(3), i) for i in range(400)] + [(None, day(3), -1)], "k string, t timestamp, i int")
    dimension = spark.createDataFrame([("a", day(1), "old"), ("a", day(2), "new"), ("a", None, "never")],
                                      "k string, valid_from timestamp, city string")
    got = point_in_time_join(rows, dimension, "k", "t", ["city"], hot_rows=20)
    assert {(r.k, r.city) for r in got.collect()} == {("a", "new"), (None, None)} and got.count() == 401
