"""Embedding whitening (12): exact sums, components and edge cases against a plain computation."""

import math
from fractions import Fraction

import numpy as np
import pytest

from qualia.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, component string, whitened string"


def frame(spark, tmp_path, vectors, parts=3):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "x", "y", "z") for i, v in vectors]
    path = str(tmp_path / "vectors")
    spark.createDataFrame(rows, SCHEMA).repartition(parts).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def ints(v):
    return tuple(math.floor(256 * float(np.float32(c))) for c in v)


def brute_force(vectors):
    """ids and integer vectors of usable rows, n, sums and the exact covariance of the distinct ones."""
    usable = [(i, ints(v)) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in usable})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dim)]
    z = [[n * x[d] - sums[d] for d in range(dim)] for x in fit]
    cov = [[Fraction(sum(r[i] * r[j] for r in z), n**3) for j in range(dim)] for i in range(dim)]
    return usable, fit, n, sums, cov


def sample(rng, n=300, dim=6):
    mixing = rng.normal(size=(dim, dim)) * np.array([3.0, 2, 1, 0.5, 0.2, 0.1])[:dim]
    return [(i, (rng.normal(size=dim) @ mixing + 0.3).tolist()) for i in range(n)]


def test_covariance_is_exact_and_rows_are_whitened(spark, tmp_path):
    vectors = sample(np.random.default_rng(2))
    vectors += [(1000, vectors[0][1]), (1000, vectors[0][1]), (None, vectors[1][1]), (1001, None), (1002, [1.0, None, 1, 1, 1, 1]),
                (1003, [math.nan] + [0.0] * 5), (1004, [math.inf] + [0.0] * 5), (1005, [])]
    usable, fit, n, sums, cov = brute_force([v for v in vectors if v[0] != 1005])
    df = frame(spark, tmp_path, vectors)
    model = whitening.fit(df)
    assert model.n == n and model.sums == sums
    assert np.array_equal(model.covariance, np.array([[float(c) for c in row] for row in cov]))
    values, basis = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    found = whitening.whiten(df, model).collect()
    assert len(found) == 4 * len(usable)
    assert sorted(((r.vec_id is None, r.vec_id, r.component) for r in found), key=str) == sorted(
        ((i is None, i, k) for i, _ in usable for k in range(1, 5)), key=str)
    of = {i: x for i, x in usable}
    trace = float(sum(cov[d][d] for d in range(6)))
    signs = {}
    for r in found:
        x = of[r.vec_id]
        e, u = values[-r.component], basis[:, -r.component]
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert r.explained == pytest.approx(e / trace, rel=1e-9)
        expected = float((np.array(x) - np.array(sums) / n) @ u / math.sqrt(e))
        assert abs(r.whitened) == pytest.approx(abs(expected), abs=1e-7)
        if abs(expected) > 1e-3:
            signs.setdefault(r.component, set()).add(r.whitened * expected > 0)
        assert 0 <= r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


@pytest.mark.parametrize("scale", [1, 1 << 20, 1 << 44])
def test_sums_of_any_size_are_exact(scale):
    y = np.random.default_rng(4).integers(-200, 200, size=(50, 5)) * scale + 3
    plain = [[int(v) for v in row] for row in y]
    assert whitening.exact_sums(y) == [sum(r[d] for r in plain) for d in range(5)]
    expected = []
    for i in range(5):
        for j in range(i, 5):
            expected.append(sum((r[i] if i == j else r[i] + r[j]) ** 2 for r in plain))
    assert whitening.polarised_squares(y) == expected


def test_packed_vectors_come_back(spark):
    import pyarrow as pa

    x = np.array([[0, 1, -32768], [32767, 0, 5], [1 << 20, 2, -3], [1 << 50, 0, 1], [0, 0, 0]])
    packed = whitening._packed(x)
    assert [len(p) for p in packed] == [12, 6, 12, 24, 6]
    assert np.array_equal(whitening._unpacked(pa.array(packed, pa.binary()), 3), x)


def test_huge_entries_are_dropped_and_large_ones_kept(spark, tmp_path):
    vectors = [(1, [1e30, 0]), (2, [1e12, 1]), (3, [-1e12, 2]), (4, [5.0, 4])]
    df = frame(spark, tmp_path, vectors)
    usable, _, n, sums, cov = brute_force(vectors[1:])
    model = whitening.fit(df)
    assert (model.n, model.sums) == (n, sums)
    assert np.allclose(model.covariance, np.array([[float(c) for c in r] for r in cov]), rtol=1e-15)
    found = whitening.whiten(df, model).collect()
    assert {r.vec_id for r in found} == {2, 3, 4}
    deviations = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in usable}
    assert all(r.deviation == (deviations[r.vec_id] if deviations[r.vec_id] < 2**63 else None) for r in found)


def test_defined_results_of_odd_tables(spark, tmp_path):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]):
        df = spark.createDataFrame(rows, schema)
        found = whitening.whiten(df, whitening.fit(df))
        assert found.collect() == [] and found.columns[0] == "vec_id"
    # the most common dimension; a direction without spread has no component
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0]), (4, [1.0]), (5, [7.0])], schema)
    found = whitening.whiten(df, whitening.fit(df)).collect()
    assert sorted((r.vec_id, r.component) for r in found) == [(1, 1), (2, 1), (3, 1)]
    assert all(abs(r.explained - 1) < 1e-12 for r in found)
