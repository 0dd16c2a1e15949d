import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlstone.llm.whitening import exact_offsets, identity_error, rows_of_blocks, squared_lengths, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def table_of(spark, rows, extra=()):
    return spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).select("*", *[F.lit(1).alias(c) for c in extra])


def vectors_of(seed, n, dims):
    draw = np.random.default_rng(seed)
    mixed = draw.normal(size=(n, dims)) @ draw.normal(size=(dims, dims)) * 0.2 + draw.normal(size=dims)
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)]


def plain_whitening(rows, components):
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    offsets = n * x - sums
    centred = (offsets / n).astype(float)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    return ((offsets ** 2).sum(axis=1).tolist(), centred @ vectors[:, order] / np.sqrt(values[order]),
            values[order] / np.trace(covariance))


@pytest.mark.parametrize(("rows_per_block", "columns_per_block"), [(16, 1024), (64, 5), (1024, 12)])
def test_equals_plain_whitening(spark, rows_per_block, columns_per_block):
    rows = vectors_of(1, 150, 12)
    flat, n, shares = whiten(
        table_of(spark, rows).repartition(5), rows_per_block=rows_per_block, columns_per_block=columns_per_block)
    deviations, z, expected_shares = plain_whitening(rows, 8)
    got = {r["vec_id"]: r for r in flat.collect()}
    assert n == len(got) == 150
    assert [got[i]["deviation"] for i, _ in rows] == deviations
    found = np.array([got[i]["z"] for i, _ in rows])
    signs = np.sign((found * z).sum(axis=0))
    assert np.abs(found * signs - z).max() < 1e-9
    assert np.allclose(shares, expected_shares, rtol=1e-12)
    assert identity_error(flat, 8) < 1e-9


def test_incomplete_vectors_and_other_lengths(spark):
    nan, inf = float("nan"), float("inf")
    good = vectors_of(2, 20, 3)
    bad = [(100, None), (101, [nan, 0.0, 0.0]), (102, [0.0, inf, 0.0]), (103, [0.0, None, 0.0]), (104, []), (105, [1.0, 2.0])]
    extra = ("_x", "_v", "ids", "deviations", "part", "seq", "subMatrix", "blockRowIndex", "dims", "n", "z", "deviation")
    flat, n, _ = whiten(table_of(spark, good + bad, extra))
    assert n == 20 and sorted(r["vec_id"] for r in flat.collect()) == [i for i, _ in good]


def test_repeated_rows_and_null_identifiers(spark):
    rows = vectors_of(3, 10, 2)
    again = rows + rows[:1] + [(None, rows[1][1])]
    flat, n, _ = whiten(table_of(spark, again))
    deviations, _, _ = plain_whitening(again, 2)
    assert n == 12
    assert sorted(r["deviation"] for r in flat.collect()) == sorted(deviations)
    assert sum(r["vec_id"] is None for r in flat.collect()) == 1


def test_directions_without_variance_are_left_out(spark):
    rows = [(i, [float(i), float(i), 1.0]) for i in range(8)]
    flat, _, shares = whiten(table_of(spark, rows))
    assert shares == pytest.approx([1.0]) and all(len(r["z"]) == 1 for r in flat.collect())
    flat, n, shares = whiten(table_of(spark, [(i, [1.0, 2.0]) for i in range(3)]))
    assert shares == [] and n == 3
    assert sorted((r["vec_id"], r["deviation"], r["z"]) for r in flat.collect()) == [(0, 0, []), (1, 0, []), (2, 0, [])]


def test_empty(spark):
    flat, n, shares = whiten(spark.createDataFrame([], SCHEMA))
    assert flat.collect() == [] and n == 0 and shares == []


def test_one_row(spark):
    flat, n, shares = whiten(table_of(spark, [(7, [0.5, 0.25])]))
    assert [tuple(r) for r in flat.collect()] == [(7, 0, [])] and n == 1


def test_offsets_and_squares_stay_exact():
    draw = random.Random(4)
    for size in (10, 1 << 31, 1 << 39):
        x = np.array([[draw.randint(-size, size) for _ in range(5)] for _ in range(6)], np.int64)
        sums = [int(s) for s in x.astype(object).sum(axis=0)]
        offsets = exact_offsets(x, 10**9, sums)
        plain = [[10**9 * int(v) - s for v, s in zip(row, sums)] for row in x]
        assert [[int(v) for v in row] for row in offsets] == plain
        exact = [sum(v * v for v in row) for row in plain]
        assert squared_lengths(offsets) == [v if v < 1 << 63 else None for v in exact]


def test_large_entries_raise(spark):
    with pytest.raises(Exception, match="after scaling"):
        whiten(table_of(spark, [(1, [1e30]), (2, [0.0])]))[0].collect()


def test_a_worker_that_has_not_loaded_compute(monkeypatch):
    batch = pa.RecordBatch.from_pydict({
        "ids": pa.array([[7, None], [3]], pa.list_(pa.int64())), "deviations": pa.array([[1, 2], [3]], pa.list_(pa.int64())),
        "projected": [{"values": [1.0, 2.0, 10.0, 20.0]}, {"values": [3.0, 0.0, 30.0, 0.0]}]})
    # Until something imports the submodule, the package has no such attribute.
    monkeypatch.delattr(pa, "compute", raising=False)
    found = rows_of_blocks(batch, "vec_id", 2)
    assert found["vec_id"].to_pylist() == [7, None, 3] and found["deviation"].to_pylist() == [1, 2, 3]
    assert found["z"].to_pylist() == [[1.0, 10.0], [2.0, 20.0], [3.0, 30.0]]
