import random
import time
from collections import defaultdict

import duckdb
import numpy as np

from tidemark.llm import near_dedup
from tidemark.llm.texts import words_of

SCHEMA = "doc_id long, text string, node int, label string, class_id string"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance():
    random.seed(2)
    for _ in range(600):
        a = random.choices("abc", k=random.randrange(9))
        b = a[:] if random.random() < 0.5 else random.choices("abc", k=random.randrange(9))
        for _ in range(random.randrange(3)):
            b[random.randrange(len(b) + 1) : random.randrange(len(b) + 1)] = random.choices("abc", k=1)
        most, true = random.randrange(9), levenshtein(a, b)
        assert near_dedup.edit_distance(a, b, most) == (true if true <= most else None)


def test_alignment_of_very_long_texts():
    """100,000 words, a fifth of them replaced, within seconds; texts that differ more are given up early."""
    rng = random.Random(2)
    a = [str(rng.randrange(50_000)) for _ in range(100_000)]
    b = list(a)
    for i in rng.sample(range(len(a)), 19_000):
        b[i] = f"x{i}"
    begin = time.process_time()
    assert near_dedup.edit_distance(a, b, 20_000) == 19_000
    assert near_dedup.edit_distance(a, b, 18_000) is None
    rng.shuffle(b)
    assert near_dedup.edit_distance(a, b, 20_000) is None
    assert time.process_time() - begin < 30


def shingled(text):
    w = words_of(text or "")
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_shingle_pairs_of_the_tables_share_a_class(spark):
    folder = "/root/testdata/sf0.1"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall())
    got = {r.doc_id: r for r in near_dedup.near_classes(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    assert got.keys() == texts.keys()
    sets, where = {i: shingled(t) for i, t in texts.items()}, defaultdict(list)
    for i, s in sets.items():
        for x in sorted(s)[:: max(1, len(s) // 40)] + sorted(s)[:3]:
            where[x].append(i)
    pairs = {(a, b) for v in where.values() if len(v) < 200 for a in v for b in v if a < b}
    near = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(near) > 500 and all(got[a].class_id == got[b].class_id for a, b in near)
    # Classes hold only texts that are near to another member.
    members = defaultdict(list)
    for i, r in got.items():
        members[r.class_id].append(i)
    for class_id, ids in members.items():
        assert class_id == min(ids) and all(got[i].class_size == len(ids) for i in ids)
        if len(ids) <= 12:
            seqs = {i: words_of(texts[i]) for i in ids}
            for i in ids:
                others = [seqs[j] for j in ids if j != i]
                close = lambda a, b: a == b or (x := max(len(a), len(b))) and near_dedup.edit_distance(a, b, int(0.2 * x + 1e-9)) is not None
                assert not others or any(close(seqs[i], o) for o in others)


def test_odd_rows(spark):
    random.seed(4)
    body = random.choices([f"w{i}" for i in range(500)], k=120)
    near = body[:50] + ["new"] + body[51:]
    rows = [
        (5, " ".join(body), 1, "", ""), (4, " ".join(near).upper() + "!", 1, "", ""), (9, " ".join(body), 1, None, ""),
        (9, " ".join(body), 1, None, ""), (1, None, 1, "", ""), (2, "", 1, "", ""), (3, "--", 1, "", ""), (6, "--", None, "", ""),
        (7, "one", 1, "", ""), (8, "One.", 1, "", ""), (None, "two words", 1, "", ""), (11, "w " * 60_000, 1, "", ""),
        (10, "w " * 60_000 + "x", 1, "", ""), (12, " ".join(reversed(body)), 1, "", ""),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id or 0, r.class_id, r.class_size, r.kept) for r in near_dedup.near_classes(docs).collect())
    assert got == [
        (0, None, 1, True), (1, 1, 2, True), (2, 1, 2, False), (3, 3, 2, True), (4, 4, 4, True), (5, 4, 4, False),
        (6, 3, 2, False), (7, 7, 2, True), (8, 7, 2, False), (9, 4, 4, False), (9, 4, 4, False), (10, 10, 2, True),
        (11, 10, 2, False), (12, 12, 1, True),
    ]
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 7, 10, 12]
    assert near_dedup.near_classes(docs.limit(0)).count() == 0


def test_a_large_group_makes_few_pairs(spark):
    random.seed(6)
    body = random.choices([f"w{i}" for i in range(900)], k=80)
    rows = []
    for i in range(1500):
        own = body[:]
        own[random.randrange(80)] = f"own{i}"
        rows.append((i, " ".join(own), 1, "", ""))
    docs = spark.createDataFrame(rows, SCHEMA)
    sketched = near_dedup._sketched(near_dedup._rows(docs, "doc_id", "text"))
    members = near_dedup._members(sketched)
    assert near_dedup._candidates(members, near_dedup._heads(members)).count() < 40 * len(rows)
    assert {(r.class_id, r.class_size) for r in near_dedup.near_classes(docs).collect()} == {(0, 1500)}



def test_links_through_crowded_buckets(spark, monkeypatch):
    """Pairs of 80 words, 60 of them a passage that all texts share: 14 replaced words keep a pair together,
    and texts of different pairs apart."""
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(60)]
    rows, pairs = [], 250
    for i in range(pairs):
        text = passage + [f"w{rng.randrange(10**6)}" for _ in range(20)]
        rows += [(2 * i, " ".join(text), 1, "", ""), (2 * i + 1, " ".join(replaced(rng, text, 14)), 1, "", "")]
    made, plain = [], near_dedup._links
    monkeypatch.setattr(near_dedup, "_links", lambda texts, found, s: (made.append(found.count()), plain(texts, found, s))[1])
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    true = [i for i in range(pairs) if near_dedup.similar(rows[2 * i][1], rows[2 * i + 1][1]) is not None]
    assert len(true) == pairs
    assert sum(got[2 * i] == got[2 * i + 1] for i in true) >= 0.97 * pairs
    assert sum(made) < 100 * len(rows)


def test_every_pair_of_a_crowded_bucket(spark, monkeypatch):
    """Pairs that share little more than the passage that all texts share: they meet only where all meet."""
    rng = random.Random(14)
    passage = [f"p{i}" for i in range(60)]
    rows, pairs = [], 60
    for i in range(pairs):
        own = [f"w{rng.randrange(10**6)}" for _ in range(20)]
        rows += [(2 * i, " ".join(passage + own), 1, "", ""), (2 * i + 1, " ".join(passage + replaced(rng, own, 16)), 1, "", "")]
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: i // 2 * 2 for i in range(2 * pairs)}


def test_two_large_classes_of_the_same_words_make_few_rows(spark, monkeypatch):
    """Every text of one class holds the words of every text of the other but for two, 20 edits apart in 80 words."""
    rng = random.Random(16)
    body = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(800):
        own = body[:] if i < 400 else body[10:] + body[:10]
        own[rng.randrange(20, 60)] = f"own{i}"
        rows.append((i, " ".join(own), 1, "", ""))
    written, plain = {}, near_dedup.settle
    monkeypatch.setattr(near_dedup, "settle", lambda df, label: (out := plain(df, label), written.update({label: max(out.count(), written.get(label, 0))}))[0])
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: i // 400 * 400 for i in range(800)}
    assert max(written.values()) < 100 * len(rows)


def test_bags_keep_every_similar_pair():
    rng = random.Random(15)
    texts = []
    for _ in range(40):
        a = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 120))] + ["often"] * rng.choice((0, 0, 700))
        texts += [a, replaced(rng, a, len(a) // 5), a[: len(a) - len(a) // 5], a + replaced(rng, a[: len(a) // 4], len(a) // 8)]
    lengths, bags = np.array([len(t) for t in texts]), np.array([near_dedup.bag(t) for t in texts])
    half = len(texts) // 2
    left, right = np.arange(half), np.arange(half // 2, len(texts))
    for similarity in (0.8, 0.9):
        found = set(zip(*(x.tolist() for x in near_dedup.near_bags(left, right, lengths, np.arange(len(texts)), bags, similarity)), strict=True))
        every = {(i, j) for i in left.tolist() for j in right.tolist() if i != j}
        near = {(i, j) for i, j in every if near_dedup.similar(" ".join(texts[i]), " ".join(texts[j]), similarity) is not None}
        assert len(near) > 20 and near <= found < every


def test_common_kmers_take_no_part():
    rng = random.Random(13)
    a = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    h = near_dedup.kmers(a)
    first = near_dedup.sketches(a).tolist()
    named = near_dedup.sketched_kmers(a, first[:5])
    assert 2 <= len(named) <= 10 and set(named.tolist()) <= set(h.tolist())
    assert len(near_dedup.sketched_kmers(a, [])) == 0
    more = near_dedup.sketches(a, named)
    assert len(more) == near_dedup.SKETCHES and not set(more.tolist()) & set(first)
    # what was named does not matter to them
    assert set(more.tolist()) == set(near_dedup.sketches(a, np.append(named, np.uint64(5))).tolist())
    assert len(near_dedup.sketches(a, h[1:])) == 0 and len(near_dedup.sketches(a, h[2:])) == near_dedup.SKETCHES


def replaced(rng, words, n):
    out = words[:]
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**9)}"
    return out


def recall(rng, length, similarity, pairs):
    """Share of pairs with scattered replaced words that agree in a sketch."""
    met = 0
    for _ in range(pairs):
        a = [f"w{rng.randrange(5000)}" for _ in range(length)]
        b = replaced(rng, a, int((1 - similarity) * length + 1e-9))
        met += bool(set(near_dedup.sketches(a)) & set(near_dedup.sketches(b)))
    return met / pairs


def test_pairs_of_the_least_similarity_are_candidates():
    rng = random.Random(9)
    for length in (5, 8, 11, 16, 20, 25, 30, 100):
        for similarity, least in ((0.8, 0.9), (0.85, 0.95), (0.9, 0.98)):
            assert recall(rng, length, similarity, 200) >= least, (length, similarity)


def test_short_texts_and_a_chain_of_versions(spark):
    rng = random.Random(10)
    rows = []
    for i in range(300):
        a = rng.choices([f"w{j}" for j in range(5000)], k=5 + i % 16)
        rows += [(2 * i, " ".join(a), 1, "", ""), (2 * i + 1, " ".join(a[: len(a) // 2] + [f"own{i}"] + a[len(a) // 2 + 1 :]), 1, "", "")]
    now = rng.choices([f"w{j}" for j in range(5000)], k=200)
    for i in range(1000, 1100):
        rows.append((i, " ".join(now), 1, "", ""))
        now = replaced(rng, now, 20)
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(300)) >= 294
    assert len({got[i] for i in range(1000, 1100)}) <= 3


def test_components(spark):
    path = [(bytes([i]), bytes([i + 1])) for i in range(1, 60)] + [(bytes([100]), bytes([90]))]
    links = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in path], "node binary, other binary")
    got = {bytes(r.node)[0]: bytes(r.label)[0] for r in near_dedup.components(links).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {90: 90, 100: 90}
