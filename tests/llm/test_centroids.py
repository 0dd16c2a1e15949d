import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm.centroids import (
    ShardedLloyd, cluster_vectors, column_blocks, packed, partial_distances, sums_by_cluster, unpacked,
)

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_lloyd(rows, clusters, rounds, scale=64, seed=1):
    """Whole vectors, Python integers, one process."""
    vectors = [(i, [int(np.floor(scale * float(c))) for c in v]) for i, v in rows]
    ordered = sorted(vectors, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in ordered[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, v in vectors:
            members.setdefault(nearest(v)[1], []).append(v)
        for k, own in members.items():
            centres[k] = [sum(column) // len(own) for column in zip(*own)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in vectors), key=str), centres


def vectors_of(seed, n, dims):
    draw = random.Random(seed)
    return [(i, [float(np.float32(draw.gauss(0, 0.3))) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_equals_plain_lloyd(spark, shards):
    rows = vectors_of(shards, 120, 8)
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(3)
    flat, centres = cluster_vectors(df, clusters=5, dims=8, rounds=4, shards=shards, group_rows=7)
    expected, plain = plain_lloyd(rows, 5, 4)
    assert sorted((tuple(r) for r in flat.collect()), key=str) == expected
    assert centres == plain


def test_incomplete_vectors_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.5]), (2, None), (3, [0.5]), (4, [0.5, None]), (5, [nan, 0.0]), (6, [inf, 0.0]),
            (7, []), (8, [-0.5, 0.25]), (None, [0.1, 0.1])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).select(
        "*", *[F.lit(1).alias(c) for c in ("_x", "_v", "grp", "shard", "ids", "data", "cluster", "distance")])
    flat, _ = cluster_vectors(df, clusters=2, dims=2, rounds=2)
    expected, _ = plain_lloyd([r for r in rows if r[0] in (1, 8, None)], 2, 2)
    assert sorted(map(str, map(tuple, flat.collect()))) == sorted(map(str, expected))


def test_repeated_rows_and_ties(spark):
    rows = [(1, [0.0, 0.0])] * 4 + [(2, [1.0, 0.0]), (3, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    flat, centres = cluster_vectors(df, clusters=16, dims=2, rounds=3)
    assert len(centres) == 6, "with fewer vectors than clusters each one starts a cluster"
    got = sorted((tuple(r) for r in flat.collect()), key=str)
    assert got == plain_lloyd(rows, 16, 3)[0]
    assert len({c for i, c, _ in got if i == 1}) == 1, "equal distances go to the smaller number"


def test_empty(spark):
    flat, centres = cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert flat.collect() == [] and centres == []


def test_large_components_raise(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0], 0)], SCHEMA)
    with pytest.raises(Exception, match="after scaling"):
        cluster_vectors(df, dims=2)[0].collect()


def test_empty_cluster_keeps_its_centroid(spark):
    vectors = spark.createDataFrame([(1, [10, 10]), (2, [12, 10])], "vec_id long, _x array<long>")
    blocks = column_blocks(vectors, "vec_id", 2, 2, 4)
    lloyd = ShardedLloyd(blocks, np.array([[0, 0], [11, 11], [-500, -500]], np.int64), 2)
    lloyd.step()
    assert lloyd.centroids.tolist() == [[0, 0], [11, 10], [-500, -500]]


def test_floor_of_negative_means(spark):
    vectors = spark.createDataFrame([(1, [-1]), (2, [-2])], "vec_id long, _x array<long>")
    lloyd = ShardedLloyd(column_blocks(vectors, "vec_id", 1, 1, 4), np.array([[0]], np.int64), 1)
    lloyd.step()
    assert lloyd.centroids.tolist() == [[-2]]


@pytest.mark.parametrize("largest", [3, 200, 40_000, 1 << 26])
def test_partial_distances_are_exact(largest):
    draw = np.random.default_rng(largest)
    block = draw.integers(-largest, largest, (50, 6))
    slice_ = draw.integers(-largest, largest, (4, 6))
    plain = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)) for c in slice_] for x in block]
    assert partial_distances(block, slice_).tolist() == plain
    assert (unpacked(packed(block), 6) == block).all()


def test_sums_by_cluster():
    labels = np.array([2, 0, 2, 2], np.uint32)
    block = np.array([[1, 2], [3, 4], [5, 6], [-7, 8]], np.int64)
    sums, sizes = sums_by_cluster(labels, block, 4)
    assert sums.tolist() == [[3, 4], [0, 0], [-1, 16], [0, 0]] and sizes.tolist() == [1, 0, 3, 0]


def test_blocks_are_not_shuffled_again(spark):
    """Rounds move distances and labels; the union of labels and blocks keeps the blocks' places."""
    rows = vectors_of(5, 60, 4)
    vectors = spark.createDataFrame([(i, [int(64 * c) for c in v]) for i, v in rows], "vec_id long, _x array<long>")
    lloyd = ShardedLloyd(column_blocks(vectors, "vec_id", 4, 2, 5), np.array([[0] * 4, [9] * 4], np.int64), 2)
    labels = lloyd.assigned().flatMap(lambda r: [((s, r[0]), r[1][0]) for s in range(2)]).partitionBy(lloyd.tasks, lloyd.dealt)
    together = labels.union(lloyd.blocks)
    assert together.getNumPartitions() == lloyd.tasks, "partitions of both are joined place by place"
    for cells in together.glom().collect():
        kinds = [isinstance(v, np.ndarray) for _, v in cells]
        assert kinds == sorted(kinds, reverse=True), "labels come before blocks"
        assert len({shard for (shard, _), _ in cells}) <= 1, "a task holds blocks of one column shard"
