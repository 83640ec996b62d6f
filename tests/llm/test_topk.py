import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank string, score int, v int"


def brute(rows, k=5):
    """All (query, rank, id, score), every row against every other."""
    kept = [
        (i, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for a, (i, q) in enumerate(kept):
        if i is None or i % 50:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v)), j is None, j) for b, (j, v) in enumerate(kept) if a != b]
        out += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(sorted(scores, key=lambda r: (r[0], r[1], r[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def result(spark, rows, k=5):
    frame = spark.createDataFrame([(i, v, "r", 1, 2) for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, topk.search(topk.scaled(frame), F.col("vec_id") % 50 == 0, k).collect()), key=str)


def made(rng, n, d, scale=0.1):
    return [(i, (rng.standard_normal(d) * scale).tolist()) for i in range(n)]


@pytest.mark.parametrize("d,scale", [(1, 1.0), (3, 0.01), (16, 0.1), (64, 0.125)])
def test_against_all_pairs(spark, monkeypatch, d, scale):
    monkeypatch.setattr(topk, "LEAST_ROWS", 100)
    rows = made(np.random.default_rng(d), 600, d, scale)
    assert result(spark, rows) == brute(rows)


def test_clusters_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 64)
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((5, 8))
    rows = [(i, (centres[i % 5] + rng.standard_normal(8) * 0.01).tolist()) for i in range(300)]
    rows += [(300 + i, rows[50][1]) for i in range(60)]  # more ties than answers
    rows += [(100, rows[100][1]), (100, rows[7][1]), (None, rows[50][1]), (None, None), (400, None), (-50, [-1.0] * 8)]
    rows += [(401, [None] * 8), (402, [float("nan")] * 8), (403, [float("-inf")] * 8), (450, [0.0] * 8), (500, [])]
    assert result(spark, rows) == brute(rows)


def test_few_rows(spark):
    for rows in ([], [(1, [1.0])], [(50, [1.0])], [(0, [1.0]), (50, [-1.0]), (7, [2.0, 1.0])], [(0, None), (50, None)]):
        assert result(spark, rows) == brute(rows)


def test_scores_that_do_not_fit(spark):
    with pytest.raises(ValueError, match="62 bits"):
        result(spark, [(0, [1e9]), (1, [1e9])])


def test_stops_on_proof_before_all_segments(spark):
    """A query with near copies is answered exactly from a part of its segments."""
    rng = np.random.default_rng(3)
    rows = rng.integers(-30, 30, (4000, 32))
    rows[10:20] = rows[5] * 4 + rng.integers(-1, 2, (10, 32))
    shard, query = topk.Shard(rows), rows[5] * 4
    taken = []
    alive_of = shard._alive
    shard._alive = lambda *a: taken.append(a[-1]) or alive_of(*a)
    alive, scores = shard.best(query, 5, own=5)
    exact = rows @ query
    exact[5] = -(1 << 40)
    assert sorted(scores)[-5:] == sorted(exact)[-5:] and set(np.argsort(exact)[-5:]) <= set(alive)
    assert len(taken) < len(topk.LOOKS) and taken[-1] > 0
    assert all(b >= a for a, b in zip(taken[1:], taken))


def test_impacts_fall_and_cover_all_entries():
    rng = np.random.default_rng(4)
    rows = rng.integers(-100, 100, (500, 6))
    shard = topk.Shard(rows)
    for j in range(6):
        mine = shard.dims == j
        parts = [shard.postings[a:b] for a, b in zip(shard.starts[mine], shard.ends[mine])]
        assert sorted(np.concatenate(parts)) == list(range(500))
        for part, low, high in zip(parts, shard.lows[mine], shard.highs[mine]):
            assert rows[part, j].min() == low and rows[part, j].max() == high
    _, impact, left = shard.segments(rows[0])
    assert (impact[1:] <= impact[:-1]).all() and left[-1] == 0 and (left[1:] <= left[:-1]).all()
