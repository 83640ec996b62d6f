import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tidemark.llm import periodic_runs
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, rid int, words string, start int"


def brute_runs(words, least=periodic_runs.LEAST):
    """Every maximal stretch of every period; of one stretch the smallest period stays."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        s = 0
        while s + p < n:
            if words[s] != words[s + p]:
                s += 1
                continue
            e = s
            while e + p < n and words[e] == words[e + p]:
                e += 1
            if e + p - s >= max(least, 2 * p):
                found.setdefault((s, e + p - s), p)
            s = e
    return sorted((s, length, p) for (s, length), p in found.items()), n


def brute(doc_id, text, fold):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if fold and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(brute_runs(words)[0], key=lambda r: (r[0], r[2]))
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id,
        len(found),
        *best,
        1000 * best[1] // best[2] if found else None,
        sha("".join(f"{s},{length},{p}\n" for s, length, p in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def squares(n, rng):
    """Words over few letters, repeated in parts of many lengths: dense in runs."""
    out = []
    while len(out) < n:
        part = [rng.choice("ab" if rng.random() < 0.6 else "abcd") for _ in range(rng.randrange(1, 30))]
        part *= rng.randrange(1, 6)
        out += part + (part[: rng.randrange(len(part))] if rng.random() < 0.5 else [])
        if rng.random() < 0.3 and len(out) > 40:
            a = rng.randrange(len(out) - 20)
            out += out[a : a + rng.randrange(80)]
    return out[:n]


def fibonacci(n):
    a, b = ["x"], ["x", "y"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("seed", range(12))
def test_runs_against_all_periods(seed):
    rng = random.Random(seed)
    texts = [squares(rng.randrange(1, 320), rng) for _ in range(25)]
    texts += [["w"] * 200, ["a", "b"] * 90, fibonacci(300), ["a"] * 11, ["a"] * 12, [], ["a", "b"] * 30 + ["a"] + ["a", "b"] * 30]
    rng.shuffle(texts)
    symbols, starts = periodic_runs.numbered(texts)
    found = periodic_runs.runs(symbols).tolist()
    expected = [[s + at, length, p] for words, at in zip(texts, starts) for s, length, p in brute_runs(words)[0]]
    assert sorted(found) == sorted(expected)


def test_wavelet_tree():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 64, 65, 500):
        values = rng.permutation(n)
        tree = periodic_runs.WaveletTree(values)
        left = rng.integers(0, n, 200)
        right = left + 1 + rng.integers(0, n, 200) % (n - left)
        bound = rng.integers(0, n + 2, 200)
        k = rng.integers(0, n, 200) % (right - left)
        parts = [np.sort(values[a:b]) for a, b in zip(left, right)]
        assert tree.below(left, right, bound).tolist() == [int((p < x).sum()) for p, x in zip(parts, bound)]
        assert tree.nth(left, right, k).tolist() == [int(p[x]) for p, x in zip(parts, k)]


@pytest.mark.parametrize("fold", [False, True])
def test_rows(spark, fold):
    rng = random.Random(3)
    rows = [(i, " ".join(squares(rng.randrange(1, 200), rng))) for i in range(60)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, "a b " * 20), (None, None), (61, ""), (62, None), (63, " \t\n\v\f\r ")]
    rows += [(-4, "é x " * 30), (64, " ".join("ab" * 20)), (65, "w" * 100_000), (66, "a\tb\n\na  b\ra b" * 10)]
    frame = spark.createDataFrame([(i, t, 1, "w", 2) for i, t in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in periodic_runs.periodic_runs(frame, fold=fold).collect()]
    assert sorted(got, key=str) == sorted((brute(i, t, fold) for i, t in rows), key=str)


def test_small_batches_and_long_text(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 50)
    text = " ".join(["x", "y", "z"] * 40_000)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10][:2]
    out = periodic_runs._of_texts(ids, [text.encode().split(), b"p q".split() * 6])
    assert [r[1:6] for r in out] == [(1, 0, 120_000, 3, 40_000_000), (1, 0, 12, 2, 6_000)]


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_against_all_periods(spark):
    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' WHERE length(text) < 6000").fetchall()
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, folder).collect()}
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{folder}/documents.parquet'").fetchall()[0][0]
    assert [got[i] for i, _ in rows] == [brute(i, t, True) for i, t in rows]
