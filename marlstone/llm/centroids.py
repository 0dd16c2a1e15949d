"""Exact Lloyd clustering, sharded by dimension.

Vectors of integers are cut into row groups and column blocks.  One task holds blocks of one
column shard only.  In a round it computes, for its blocks, the exact partial squared distances to
its slice of the centroids; ``reduceByKey`` adds the blocks of a row group, and the sum's smallest
entry is the assignment.  The assignments go back to the column shards, each of which sums its own
components by cluster and so makes its slice of the next centroids.

The blocks are dealt once, by (shard, row group); they stay where they are for all rounds, and only
partial distances and assignments move.  Centroids are k x dimensions integers on the driver; nothing
there grows with the rows.  Each round starts from the dealt blocks, so the lineage does not grow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import map_batches, stored, table

CLUSTERS, DIMS, ROUNDS, SCALE, SEED = 16, 64, 3, 64, 1
SHARDS = 4
GROUP_ROWS = 4096
# Partial distances below this bound are exact in 64-bit integers for up to 2**7 dimensions a shard.
LARGEST = 1 << 27
# What the driver and every task may hold of the centroids.
CENTROID_BYTES = 256 << 20


def integer_vector(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double."""
    def whole(x):
        scaled = F.floor(F.lit(float(scale)) * x.cast("double"))
        too_large = F.raise_error(F.lit(f"a component is {LARGEST} or more after scaling; distances would not fit a long"))
        # The planner may ask this of vectors that are left out later: their components must not raise.
        return F.when(~(F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(None)).when(
            F.abs(scaled) >= LARGEST, too_large).otherwise(scaled)

    return F.transform(vector, whole)


def complete(vector: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, none null, NaN or infinite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == dims) & finite, F.lit(False))


def bounds(dims: int, shards: int) -> list[int]:
    return [dims * s // shards for s in range(shards + 1)]


def packed(matrix: np.ndarray) -> bytes:
    """Integers in the narrowest signed width that holds them, the width first."""
    most = int(np.abs(matrix).max()) if matrix.size else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return bytes([width]) + np.ascontiguousarray(matrix, f"<i{width}").tobytes()


def unpacked(data: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).reshape(-1, columns).astype(np.int64)


def partial_distances(block: np.ndarray, slice_: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids over the columns of one shard."""
    most = max(np.abs(block).max(initial=0), np.abs(slice_).max(initial=0))
    if most < 1 << 20 and block.shape[1] <= 1 << 10:
        # All sums stay below 2**52: the products are exact in doubles, and much faster.
        rows, centres = block.astype(float), slice_.astype(float)
        found = (rows * rows).sum(1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(1)
    else:
        found = (block * block).sum(1)[:, None] - 2 * block @ slice_.T + (slice_ * slice_).sum(1)
    most = found.max(initial=0)
    return found.astype("<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<i8")


def sums_by_cluster(labels: np.ndarray, block: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(labels, kind="stable")
    found, first, counts = np.unique(labels[order], return_index=True, return_counts=True)
    sums, sizes = np.zeros((clusters, block.shape[1]), np.int64), np.zeros(clusters, np.int64)
    if len(found):
        sums[found] = np.add.reduceat(block[order], first, axis=0)
        sizes[found] = counts
    return sums, sizes


def column_blocks(vectors: DataFrame, ident: str, dims: int, shards: int, group_rows: int) -> DataFrame:
    """Rows (grp, shard, data) per column block, and (grp, -1, ids) per row group; written once."""
    cuts = bounds(dims, shards)
    kind = vectors.schema[ident].dataType.simpleString()

    def make():
        number = TaskContext.get().partitionId() << 32

        def work(batch):
            nonlocal number
            idents, flat = batch.column(0), batch.column(1).flatten().to_numpy(zero_copy_only=False)
            matrix = flat.astype(np.int64).reshape(-1, dims)
            grp, shard, ids, data = [], [], [], []
            for at in range(0, len(matrix), group_rows):
                part = matrix[at:at + group_rows]
                grp += [number] * (shards + 1)
                shard += range(-1, shards)
                ids += [idents.slice(at, group_rows).to_pylist(), *[None] * shards]
                data += [None, *[packed(part[:, a:b]) for a, b in zip(cuts, cuts[1:])]]
                number += 1
            return {"grp": grp, "shard": shard, "data": data,
                    "ids": pa.array(ids, pa.list_(batch.schema.field(0).type))}

        return work

    return stored(map_batches(
        vectors.select(ident, "_x"), f"grp long, shard int, ids array<{kind}>, data binary", make), "blocks")


class ShardedLloyd:
    """Rounds over dealt column blocks; ``centroids`` are k rows of Python-exact integers."""

    def __init__(self, blocks: DataFrame, centroids: np.ndarray, shards: int, tasks: int | None = None):
        self.spark, self.centroids, self.shards = blocks.sparkSession, centroids, shards
        self.cuts = bounds(centroids.shape[1], shards)
        partitions = tasks or max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        self.per_shard = per_shard = max(1, partitions // shards)

        def dealt(key: tuple[int, int]) -> int:
            shard, group = key
            return shard * per_shard + ((group >> 32) * 31 + (group & 0xFFFFFFFF)) % per_shard

        self.dealt, self.tasks = dealt, per_shard * shards
        cells = blocks.where("shard >= 0").select("shard", "grp", "data").rdd
        self.blocks: RDD = cells.map(lambda r: ((r[0], r[1]), bytes(r[2]))).partitionBy(self.tasks, dealt)

    def distances(self) -> RDD:
        """(row group, exact distances to every centroid): blocks added by ``reduceByKey``."""
        cuts, centroids = self.cuts, self.centroids

        def partial(cell):
            (shard, group), data = cell
            a, b = cuts[shard], cuts[shard + 1]
            return group, partial_distances(unpacked(data, b - a), centroids[:, a:b])

        return self.blocks.map(partial).reduceByKey(lambda x, y: x.astype(np.int64) + y, self.per_shard)

    def assigned(self) -> RDD:
        """(row group, (cluster, distance) of its rows); the smaller number wins a tie."""
        def nearest(total):
            total = total.astype(np.int64, copy=False)
            labels = total.argmin(axis=1)
            return labels.astype(np.uint32), total[np.arange(len(labels)), labels]

        return self.distances().mapValues(nearest)

    def step(self) -> None:
        """One round: every shard sums its own columns by cluster and moves its own slice."""
        cuts, clusters, shards = self.cuts, len(self.centroids), self.shards

        def to_shards(row):
            group, (labels, _) = row
            return [((s, group), labels) for s in range(shards)]

        def own_sums(cells: Iterable) -> Iterator:
            # The labels of a partition come first, then its blocks: both are dealt alike.
            labels, total = {}, {}
            for (shard, group), value in cells:
                if isinstance(value, np.ndarray):
                    labels[group] = value
                    continue
                block = unpacked(value, cuts[shard + 1] - cuts[shard])
                sums, sizes = sums_by_cluster(labels[group], block, clusters)
                if shard in total:
                    sums, sizes = sums + total[shard][0], sizes + total[shard][1]
                total[shard] = sums, sizes
            for shard, (sums, sizes) in total.items():
                yield shard, (sums.astype(object), sizes.astype(object))

        labels = self.assigned().flatMap(to_shards).partitionBy(self.tasks, self.dealt)
        sums = labels.union(self.blocks).mapPartitions(own_sums).reduceByKey(
            lambda x, y: (x[0] + y[0], x[1] + y[1]), self.shards)
        old = self.centroids

        def moved(item):
            shard, (sums, sizes) = item
            slice_ = old[:, cuts[shard]:cuts[shard + 1]].copy()
            for c, size in enumerate(sizes):
                if size:
                    slice_[c] = [s // size for s in sums[c]]
            return shard, slice_

        slices = dict(sums.map(moved).collect())
        self.centroids = np.concatenate([slices[s] for s in range(shards)], axis=1)


def first_centroids(vectors: DataFrame, ident: str, clusters: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest hash of seed and identifier; equal hashes by the vector itself."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(ident).cast("string"), F.lit(""))), 256)
    rows = vectors.select(hashed.alias("_hash"), "_x").orderBy("_hash", "_x").limit(clusters).collect()
    return [r["_x"] for r in rows]


def cluster_vectors(
    vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, dims: int = DIMS,
    rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED, shards: int = SHARDS, group_rows: int = GROUP_ROWS,
) -> tuple[DataFrame, list[list[int]]]:
    """Assignments (``ident``, cluster, distance) and the final centroids.

    Vectors that are null, have another length than ``dims`` or hold a null or non-finite component
    are left out.  With fewer vectors than ``clusters`` each one starts a cluster; with none the result is
    empty.  Repeated rows are vectors of their own, null identifiers hash as empty text, ties go
    to the smaller cluster number, other columns are not read.  Components of 2**27 or more after
    scaling raise an error.
    """
    spark = vectors.sparkSession
    if clusters * dims * 8 > CENTROID_BYTES:
        raise ValueError("the centroids are too large to be held by every task")
    kept = vectors.select(F.col(ident), F.col(vector).alias("_v")).where(complete(F.col("_v"), dims))
    kept = kept.select(ident, integer_vector(F.col("_v"), scale).alias("_x"))
    shards = min(shards, dims)
    start = first_centroids(kept, ident, clusters, seed)
    kind = vectors.schema[ident].dataType.simpleString()
    if not start:
        return spark.createDataFrame([], f"`{ident}` {kind}, cluster int, distance long"), []
    blocks = column_blocks(kept, ident, dims, shards, group_rows)
    lloyd = ShardedLloyd(blocks, np.array(start, np.int64), shards)
    for _ in range(rounds):
        lloyd.step()
    rows = lloyd.assigned().map(lambda r: (r[0], r[1][0].tolist(), r[1][1].tolist()))
    assigned = stored(spark.createDataFrame(
        rows, "grp long, clusters array<int>, distances array<long>", verifySchema=False), "assigned")
    ids = blocks.where("shard = -1").select("grp", "ids")
    flat = ids.join(assigned, "grp").select(
        F.inline(F.arrays_zip("ids", "clusters", "distances")).alias(ident, "cluster", "distance"))
    return flat, [[int(x) for x in c] for c in lloyd.centroids]


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    inertia = flat.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    digests = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids)]
    # One row per cluster: at most as many as the parameter says.
    final = spark.createDataFrame(digests, "cluster int, centroid_sha256 string").join(inertia, "cluster")
    final = final.withColumn("inertia", inertia.agg(F.sum("cluster_inertia")).scalar())
    return flat.join(F.broadcast(final), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle_sql() -> str:
    """The rounds written out, one row per vector and component."""
    parts = [f"""
WITH cells AS (
  SELECT vec_id, unnest(range({DIMS})) AS i, unnest(embedding) AS c FROM embeddings WHERE len(embedding) = {DIMS}),
complete AS (
  SELECT vec_id FROM cells GROUP BY vec_id
  HAVING count(c) = {DIMS} AND bool_and(c IS NOT NULL AND isfinite(c))),
v AS (
  SELECT vec_id, i, CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) AS x FROM cells SEMI JOIN complete USING (vec_id)),
first AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS cluster FROM complete),
c0 AS (
  SELECT cluster, i, x FROM v JOIN first USING (vec_id) WHERE cluster < {CLUSTERS})"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""
d{r} AS (
  SELECT vec_id, cluster, CAST(sum((v.x - c{r}.x) * (v.x - c{r}.x)) AS BIGINT) AS distance
  FROM v JOIN c{r} USING (i) GROUP BY vec_id, cluster),
a{r} AS (
  SELECT vec_id, cluster, distance FROM d{r}
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if r < ROUNDS:
            parts.append(f"""
m{r} AS (
  SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{r} USING (vec_id) GROUP BY cluster, i),
c{r + 1} AS (
  SELECT cluster, i, CAST(CASE WHEN n IS NULL THEN x ELSE (s - (s % n + n) % n) // n END AS BIGINT) AS x
  FROM c{r} LEFT JOIN m{r} USING (cluster, i))""")
    return ",".join(parts) + f""",
digests AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN digests USING (cluster)"""


ORACLE_SQL = _oracle_sql()
