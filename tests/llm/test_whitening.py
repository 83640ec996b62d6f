import math

import duckdb
import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, component string, v int, n int"


def brute(rows, wanted=8):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} by dense linear algebra."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    covariance = y.T @ y / n
    e, w = np.linalg.eigh(covariance)
    e, w = e[::-1], w[:, ::-1]
    out = {}
    for (i, _), row, centred in zip(kept, x.tolist(), y, strict=True):
        deviation = sum((n * a - int(b)) ** 2 for a, b in zip(row, s))
        for c in range(min(wanted, len(e))):
            if e[c] > 1e-9 * e[0]:
                out[i, c + 1] = (n, deviation, abs(centred @ w[:, c]) / e[c] ** 0.5, e[c] / np.trace(covariance))
    return out


def check(frame, rows):
    got = frame.collect()
    expected = brute(rows)
    assert {(r["vec_id"], r["component"]) for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        n, deviation, whitened, explained = expected[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"], int(r["deviation_exact"])) == (n, deviation, deviation)
        assert abs(r["whitened"]) == pytest.approx(whitened, abs=1e-7)
        assert r["explained"] == pytest.approx(explained, rel=1e-9)
        assert r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in got}) == 1


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], SCHEMA)


def test_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(12) * np.arange(1, 13)).tolist()) for i in range(200)]
    odd = [(300, None), (301, [None] + [1.0] * 11), (302, [float("nan")] + [1.0] * 11), (303, [float("inf")] * 12), (304, [])]
    check(whitening.whiten(whitening.scaled(frame_of(spark, rows + odd).repartition(5))), rows)


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(i // 2, rng.standard_normal(3).tolist()) for i in range(40)] + [(None, [1.0, 2.0, 3.0])]
    got = whitening.whiten(whitening.scaled(frame_of(spark, rows))).collect()
    assert len(got) == 41 * 3 and sum(r["vec_id"] is None for r in got) == 3
    # rank 1, copies of one vector, one vector
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]
    check(whitening.whiten(whitening.scaled(frame_of(spark, line))), line)
    for rows in ([(1, [1.0, 2.0])] * 5, [(1, [1.0, 2.0])], [(1, None)], [(1, [])], []):
        assert whitening.whiten(whitening.scaled(frame_of(spark, rows))).collect() == []


def test_several_lengths(spark):
    with pytest.raises(Exception, match="entries as the others"):
        whitening.whiten(whitening.scaled(frame_of(spark, [(1, [1.0]), (2, [1.0, 2.0])]))).collect()


def test_large_deviations():
    x = np.array([[1 << 40, 5], [7, 1 << 39]])
    n, sums = 1 << 30, [3, -4]
    assert whitening.deviations(x, n, sums) == [(n * (1 << 40) - 3) ** 2 + (5 * n + 4) ** 2, (7 * n - 3) ** 2 + (n * (1 << 39) + 4) ** 2]
    assert whitening.deviations(np.array([[3, 4]]), 2, [1, 1]) == [25 + 49]


def spectra():
    rng = np.random.default_rng(5)
    yield np.arange(1.0, 41)
    yield np.concatenate([np.full(5, 3.0), np.linspace(0.1, 1, 20)])
    yield np.array([1.0, 1 - 1e-9, 1 - 2e-9, 0.5, 0.5, 0.2])
    yield 10.0 ** -np.arange(12)
    yield np.concatenate([[1e6], rng.random(60)])
    yield np.full(9, 4.0)
    yield np.array([2.0])
    yield np.concatenate([np.linspace(1, 1.001, 30), [5.0, 5.0]])


@pytest.mark.parametrize("values", list(spectra()), ids=str)
def test_components_of_known_spectra(spark, values):
    rng = np.random.default_rng(len(values))
    w = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    matrix = (w * values) @ w.T
    matrix = (matrix + matrix.T) / 2
    expected = sorted(values, reverse=True)[:8]
    for bound in (0.3, 0.9999, 2.7):
        assert whitening.above(matrix, bound) == (values > bound).sum()
    found, vectors = whitening.components(spark, matrix, 8)
    assert found == pytest.approx([x for x in expected if x > 1e-11 * len(values)], rel=1e-6) and (found[:-1] >= found[1:]).all()
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12 * max(values)


def test_inertia_of_indefinite_matrices():
    rng = np.random.default_rng(6)
    for n in range(1, 30):
        a = rng.standard_normal((n, n)) * (rng.random((n, n)) < 0.5)
        a = a + a.T
        np.fill_diagonal(a, 0 if n % 2 else 1)
        e = np.linalg.eigvalsh(a)
        if np.abs(e).min() > 1e-9:
            assert whitening.positive_pivots(a) == (e > 0).sum()
    assert whitening.positive_pivots(np.zeros((4, 4))) == 0
    assert whitening.positive_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1


def test_query_against_dense_algebra(spark):
    folder = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet'").fetchall()
    check(QUERIES["op11_whitening"](spark, folder), rows)
