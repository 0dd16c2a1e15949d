"""Histories and views kept up to date by batches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marlstone.operators.history import END, START, scd2_versions
from marlstone.sources.buckets import BucketedTable
from marlstone.sources.tables import TableStore
from marlstone.streaming.history import apply_changes, history_schema, refresh_history

SCHEMA = "k string, ts timestamp, city string"
DAY = datetime(2024, 1, 1)


def changes(spark, rows):
    return spark.createDataFrame([(k, None if d is None else DAY + timedelta(days=d), c) for k, d, c in rows], SCHEMA)


def random_rows(seed, n):
    draw = random.Random(seed)
    return [(draw.choice(["hot", f"k{draw.randrange(40)}", None]), draw.choice([None, *range(60)]), f"c{draw.randrange(3)}")
            for _ in range(n)]


@pytest.fixture()
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def feed(store, df, batch_id):
    if not store.stream_version("silver", "changes"):
        store.open_stream_version("silver", "changes")
        store.store_schema("silver", "changes", df.schema)
    store.append(df, "silver", "changes", batch_id)


@pytest.mark.parametrize("track", [None, ["city"]])
def test_batches_in_any_order_give_the_full_history(spark, store, track):
    rows = random_rows(7, 600)
    drops = [rows[:200], rows[150:400], rows[400:]]  # the middle one repeats changes of the first
    for n, drop in enumerate(drops):
        feed(store, changes(spark, drop), n)
        refresh_history(store, ("silver", "changes"), ("gold", "h"), ["k"], "ts", track, buckets=8)
        so_far = changes(spark, sum(drops[:n + 1], []))
        expected = scd2_versions(so_far, ["k"], "ts", track)
        got = store.read("gold", "h")
        assert got.columns == expected.columns
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    before = store.commit_log("gold", "h").last()
    refresh_history(store, ("silver", "changes"), ("gold", "h"), ["k"], "ts", track, buckets=8)
    assert store.commit_log("gold", "h").last() == before


def test_a_late_change_parts_versions_that_were_merged(spark, store):
    feed(store, changes(spark, [("a", 1, "x"), ("a", 9, "x")]), 0)
    refresh_history(store, ("silver", "changes"), ("gold", "h"), ["k"], "ts", ["city"])
    assert store.read("gold", "h").count() == 1
    feed(store, changes(spark, [("a", 5, "y")]), 1)
    refresh_history(store, ("silver", "changes"), ("gold", "h"), ["k"], "ts", ["city"])
    found = [(r.city, r[START].day, r[END] and r[END].day) for r in store.read("gold", "h").orderBy("ts").collect()]
    assert found == [("x", 2, 6), ("y", 6, 10), ("x", 10, None)]


def test_untouched_buckets_are_neither_read_nor_written(spark, store):
    feed(store, changes(spark, [(f"k{i}", 1, "x") for i in range(50)]), 0)
    table = refresh_history(store, ("silver", "changes"), ("gold", "h"), ["k"], "ts", buckets=16)
    schema = history_schema(changes(spark, []).schema, "ts")
    late = changes(spark, [("k3", 5, "y")])
    (bucket,) = [r[0] for r in late.select(table.bucket_of()).collect()]
    seen = []

    def looking(rows, read):
        held = read("data", schema)
        seen.extend(held.inputFiles())
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1
        return {"data": scd2_versions(held.drop(START, END).unionByName(rows), ["k"], "ts")}

    table.merge(late, 1, looking)
    assert seen and all(f"_bucket={bucket}/" in f for f in seen)
    parts = dict(store.commit_log("gold", "h").commits())
    assert set(parts[1]) == {f"data/{bucket}"} and len(parts[0]) > 1
    assert store.read("gold", "h").count() == 51


def test_a_repeated_or_stopped_batch(spark, store, monkeypatch):
    table = BucketedTable.open(store, "gold", "h", ["k"], 4)
    schema = history_schema(changes(spark, []).schema, "ts")
    store.store_schema("gold", "h", schema)
    apply_changes(table, changes(spark, [("a", 1, "x")]), 0, "ts")
    apply_changes(table, changes(spark, [("a", 2, "never")]), 0, "ts")
    assert [r.city for r in store.read("gold", "h").collect()] == ["x"]

    def stop(*args, **kwargs):
        raise RuntimeError

    commit = TableStore.commit
    monkeypatch.setattr(TableStore, "commit", stop)
    with pytest.raises(RuntimeError):
        apply_changes(table, changes(spark, [("a", 2, "y")]), 1, "ts")
    assert store.read("gold", "h").count() == 1
    reader = store.read("gold", "h")
    monkeypatch.setattr(TableStore, "commit", commit)
    apply_changes(table, changes(spark, [("a", 2, "y")]), 1, "ts")
    assert store.read("gold", "h").count() == 2 and reader.count() == 1, "a running reader keeps what it planned with"


def test_the_number_of_buckets_stays(spark, store):
    assert BucketedTable.open(store, "gold", "h", ["k"], 4).buckets == 4
    assert BucketedTable.open(store, "gold", "h", ["k"], 9).buckets == 4


def test_a_source_opened_anew_starts_the_history_anew(spark, store):
    feed(store, changes(spark, [("a", 1, "x")]), 0)
    refresh_history(store, ("silver", "changes"), ("gold", "h"), ["k"], "ts")
    store.open_stream_version("silver", "changes")
    store.store_schema("silver", "changes", changes(spark, []).schema)
    feed(store, changes(spark, [("b", 1, "x")]), 0)
    refresh_history(store, ("silver", "changes"), ("gold", "h"), ["k"], "ts")
    assert [r.k for r in store.read("gold", "h").collect()] == ["b"]
    assert store.stream_version("gold", "h") == 2


def test_a_hot_bucket_is_written_by_several_tasks(spark, store):
    """One key holds nearly all rows: rebalancing splits its bucket among tasks."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "8",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(20_000).select(
            F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
            F.timestamp_seconds(F.col("id")).alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("city"))
        table = BucketedTable.open(store, "gold", "h", ["k"], 2)
        schema = history_schema(rows.schema, "ts")
        store.store_schema("gold", "h", schema)
        apply_changes(table, rows, 0, "ts")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    written = [f for r in store.commit_log("gold", "h").entries().collect() for f in r["files"]]
    assert len(written) > 4 and store.read("gold", "h").count() == 20_000


def test_views_with_the_same_inputs_are_left_alone(spark, store):
    store.publish(spark.range(3), "gold", "a")
    store.open_stream_version("silver", "s")
    store.store_schema("silver", "s", spark.range(1).schema)
    inputs = [("gold", "a"), ("silver", "s")]

    def build():
        return store.read("gold", "a").unionByName(store.read("silver", "s"))

    assert store.refresh_view("gold", "v", inputs, build) and not store.refresh_view("gold", "v", inputs, build)
    store.append(spark.range(1), "silver", "s", 0)
    assert store.refresh_view("gold", "v", inputs, build) and store.read("gold", "v").count() == 4
    store.publish(spark.range(5), "gold", "a")
    assert store.refresh_view("gold", "v", inputs, build) and not store.refresh_view("gold", "v", inputs, build)
    assert store.refresh_view("gold", "v", inputs, build, "other bounds") and store.finished_version("gold", "v") == 4
