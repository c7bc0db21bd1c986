"""Whitening against numpy's own eigenvalues and exact whole-number arithmetic."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slumberline.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>"


def plain(vectors):
    """x, n, sums, covariance and deviations of usable vectors, with Python's whole numbers."""
    x = [[math.floor(64 * c) + 1_000_000 for c in map(float, v)] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return centred, centred.T @ centred / n, deviations


def test_whole_table(spark):
    rows = queries.table(spark, SF_DIR, "embeddings").orderBy("vec_id").collect()
    centred, v, deviations = plain([r["embedding"] for r in rows])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    result = queries.op12_whitening(spark, SF_DIR)
    assert result.columns == whitening.RESULT
    got = result.orderBy("vec_id", "component").collect()
    assert len(got) == len(rows) * 32
    assert [r["vec_id"] for r in got[::32]] == [r["vec_id"] for r in rows]
    assert [r["component"] for r in got[:32]] == list(range(1, 33))
    assert {r["n"] for r in got} == {len(rows)}
    assert [r["deviation"] for r in got[::32]] == deviations
    white = np.array([r["whitened"] for r in got]).reshape(len(rows), 32)
    expected = centred @ vectors / np.sqrt(values)
    sign = np.sign((white * expected).sum(axis=0))
    assert np.abs(white - expected * sign).max() < 1e-9
    explained = np.array([r["explained"] for r in got[:32]])
    assert np.allclose(explained, values / np.trace(v), rtol=1e-12)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10
    assert np.abs(white.T @ white / len(rows) - np.eye(32)).max() < 1e-10


def test_rows_left_out_and_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [0.5, 0.25, 1.0]), (2, None), (3, [0.5, None, 1.0]), (4, [nan, 0.0, 0.0]), (5, [0.0, -inf, 0.0]), (6, []),
        (7, [1.0, 2.0]), (None, [0.25, -0.75, 0.125]), (9, [0.5, 0.25, 1.0]), (9, [-0.3, 0.1, 0.9]), (10, [0.0, 0.0, 0.0]),
    ]
    rows = spark.createDataFrame(vectors, SCHEMA).withColumn("component", F.lit("x")).withColumn("n", F.lit(None))
    got = whitening.whiten(rows.repartition(4)).collect()
    used = [v for i, v in vectors if v is not None and len(v) == 3 and all(c is not None and math.isfinite(c) for c in v)]
    centred, v, deviations = plain(np.array(used, dtype=np.float32))
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(deviations)
    assert {r["vec_id"] for r in got} == {1, None, 9, 10} and {r["component"] for r in got} == {1, 2, 3}
    assert {r["n"] for r in got} == {5} and got[0]["identity_error"] < 1e-8
    total = {r["component"]: r["explained"] for r in got}
    assert total[1] >= total[2] >= total[3] and abs(sum(total.values()) - 1) < 1e-12


@pytest.mark.parametrize(
    "vectors", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [3.0, 4.0]) for i in range(5)], [(1, [float("nan")])]]
)
def test_nothing_to_whiten(spark, vectors):
    got = whitening.whiten(spark.createDataFrame(vectors, SCHEMA))
    assert got.columns == whitening.RESULT and got.count() == 0


def test_huge_entries_do_not_end_the_job(spark):
    vectors = [(1, [1e38, 1.0]), (2, [-1e38, 2.0]), (3, [0.0, 5.0])]
    got = whitening.whiten(spark.createDataFrame(vectors, SCHEMA)).collect()
    assert {r["vec_id"]: r["deviation"] for r in got} == {1: None, 2: None, 3: (3 * 320 - 512) ** 2}


def test_rank_and_repeats(spark):
    """Repeated vectors and fewer of them than dimensions: as many components as there are directions."""
    rng = np.random.default_rng(2)
    some = rng.standard_normal((4, 16)).astype(np.float32).tolist()
    rows = [(i, some[i % 4] if i % 3 else some[0]) for i in range(60)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2, 3} and got[0]["identity_error"] < 1e-9


def matrix(kind, d, rng):
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {
        "close": 1 + np.arange(d) * 1e-9,
        "equal": np.repeat([5.0, 3.0, 2.0, 1.0], d // 4),
        "falling": 2.0 ** -np.arange(d),
        "plain": rng.random(d) + 0.1,
    }[kind]
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("kind", ["close", "equal", "falling", "plain"])
@pytest.mark.parametrize("d", [4, 36, 64])
def test_spectrum_slicing(kind, d):
    a = matrix(kind, d, np.random.default_rng(d))
    found = whitening.leading(a)
    n = len(found.values)
    exact = np.linalg.eigvalsh(a)[::-1][:n]
    assert n == min(d, 32)
    assert np.abs(found.values - exact).max() < 1e-13 * exact[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(n)).max() < 1e-13
    assert np.abs(a @ found.vectors - found.vectors * found.values).max() < 1e-12 * exact[0]


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(4)
    for d in (1, 2, 5, 20):
        a = rng.standard_normal((d, d))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in (*rng.standard_normal(20) * 3, 0.0):
            assert whitening.inertia(a, shift) == (values > shift).sum()
    # A zero diagonal needs pivots of two rows.
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_certificate_finds_a_wrong_number():
    a = np.diag([4.0, 3.0, 2.0, 1.0])
    whitening.certify(a, np.array([4.0, 3.0]), 1e-12)
    with pytest.raises(ArithmeticError):
        whitening.certify(a, np.array([4.0, 2.0]), 1e-12)


def test_layout_does_not_change_the_covariance(spark):
    rows = queries.table(spark, SF_DIR, "embeddings").select("vec_id", "embedding")
    made = []
    for parts in (1, 7):
        some = rows.repartition(parts)
        made.append(whitening.covariance(some, "embedding", whitening.moments(some, "embedding")))
    assert np.array_equal(*made)
