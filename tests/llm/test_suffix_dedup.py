import hashlib
import random
from collections import Counter

import duckdb
import pytest

from tidemark.llm import suffix_dedup

SCHEMA = "doc_id long, text string, rid int, data string, first int"


def brute(rows):
    """doc_id, n_bytes, n_removed, n_spans, kept hash: counts of all strings."""
    size, texts = suffix_dedup.LENGTH, [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(hash(d[s : s + size]) for _, d in texts for s in range(len(d) - size + 1))
    out = []
    for i, d in texts:
        gone = bytearray(len(d))
        for s in range(len(d) - size + 1):
            if seen[hash(d[s : s + size])] > 1:
                gone[s : s + size] = b"\1" * size
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def made():
    random.seed(9)
    words = ["".join(random.choices("abcdeé", k=6)) for _ in range(400)]
    prose = lambda n: " ".join(random.choices(words, k=n))
    passage, texts = prose(90), []
    for i in range(60):
        text = prose(random.randrange(150))
        if i % 3 == 0:
            a = random.randrange(200)
            text += passage[a : a + random.randrange(380, 560)] + prose(30)
        if i % 5 == 0:
            text += prose(60) + text[-500:]
        texts.append(text)
    texts += [texts[3], texts[3], texts[7] + "x", "y" + texts[7], "a" * 399, "a" * 401, "ab" * 700, "q" * 400, None, "", passage[:400], passage[1:401]]
    return [(i, t, 1, "x", 2) for i, t in enumerate(texts)] + [(None, passage, 1, "x", None), (2, texts[2], 1, "x", 2)]


@pytest.mark.parametrize("most", [5000, 1])
def test_against_counts_of_all_strings(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "SORTED_PIECES", most)
    rows = made()
    assert result(suffix_dedup.dedup(spark.createDataFrame(rows, SCHEMA))) == brute([r[:2] for r in rows])


def test_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    got = result(suffix_dedup.dedup(spark.read.parquet(f"{folder}/documents.parquet")))
    assert got == brute(rows) and any(r[2] for r in got)


def test_kept_bytes_and_empty_table(spark):
    docs = spark.createDataFrame(made()[:8], SCHEMA)
    row = suffix_dedup.dedup(docs, keep_bytes=True).where("doc_id = 1").first()
    assert hashlib.sha256(row.kept).hexdigest() == row.kept_sha256
    assert suffix_dedup.dedup(docs.limit(0)).count() == 0


def test_suffix_order():
    random.seed(1)
    for _ in range(200):
        strings = [bytes(random.choices(b"ab", k=60)) for _ in range(random.randrange(1, 30))]
        strings += [s[:40] + bytes(random.choices(b"ab", k=20)) for s in strings]
        order = suffix_dedup.suffix_order(strings)
        assert [strings[g[0]] for g in order] == sorted(set(strings))
        assert all(strings[i] == strings[g[0]] for g in order for i in g) and sum(map(len, order)) == len(strings)


def test_long_texts_are_scanned_in_parts(monkeypatch):
    random.seed(2)
    data = bytes(random.choices(b"abcd", k=9000))
    whole = [tuple(map(int, x)) for part in suffix_dedup.anchors(data) for x in zip(*part)]
    monkeypatch.setattr(suffix_dedup, "_SCAN", 1500)
    starts = {}
    for part in suffix_dedup.anchors(data):
        for h, place, first, last in zip(*part):
            starts |= {s: (int(h), int(place)) for s in range(first, last + 1)}
    assert starts == {s: (h, place) for h, place, first, last in whole for s in range(first, last + 1)}
