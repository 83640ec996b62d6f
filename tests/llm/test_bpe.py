import hashlib
import json
import random

import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ALPHABET = "ab '\n\t　éßжあ1２²Ⅷ😀\x1c\x85\xa0ǅʰ!.s"


def texts():
    random.seed(7)
    made = ["".join(random.choices(ALPHABET, k=random.randrange(60))) for _ in range(400)]
    fixed = ["", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "a" * 5000, " " * 700, "it's they'll'S", "aaa" * 99]
    return [*made, *fixed, "thonationea ererlyst " * 20_000]


def test_ids_and_counts_equal_the_library():
    machine, counter = bpe.automaton(bpe.load_source(PATH)), token_counts.counter(bpe.load_source(PATH))
    rows = texts()
    want = [e.ids for e in LIBRARY.encode_batch(rows, add_special_tokens=False)]
    assert [machine.encode(t).tolist() for t in rows] == want
    assert counter.totals(rows) == [len(ids) for ids in want]
    assert [machine.decode(ids) for ids in want] == rows
    broken = want[0][:1] + [machine.ids[b"\xe3"], machine.ids[b"a"]]
    assert machine.decode(broken) == LIBRARY.decode(broken, skip_special_tokens=False)


def brute(word, merges):
    """Merge the lowest-ranked pair, leftmost first, until none is left."""
    rank = {(a, b): (k, c) for k, (a, b, c) in enumerate(merges)}
    while True:
        found = [(rank[p], i) for i, p in enumerate(zip(word, word[1:])) if p in rank]
        if not found:
            return word
        (_, joined), i = min(found)
        word = word[:i] + [joined] + word[i + 2 :]


def test_random_vocabularies():
    for seed in range(60):
        random.seed(seed)
        letters = "abc"
        tokens, merges = list(letters), []
        while len(merges) < 12:
            a, b = random.choice(tokens), random.choice(tokens)
            if a + b not in tokens:
                tokens.append(a + b)
                merges.append([a, b])
        source = json.dumps({"model": {"vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges}})
        vocab = bpe.Vocabulary(source)
        machine, counter = bpe.Automaton(vocab), token_counts.Counter(vocab)
        words = {"".join(random.choices(letters, k=random.randrange(1, 14))) for _ in range(200)}
        for w in words:
            want = brute([vocab.ids[c.encode()] for c in w], vocab.merges)
            assert counter.count([w.encode()]).tolist() == [len(want)]
            assert machine.path(w.encode()) == want, (merges, w)


def test_queries(spark):
    rows = [(i, t, i) for i, t in enumerate(texts())] + [(None, None, 1), (3, texts()[3], 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want_ids = [e.ids for e in LIBRARY.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]
    got = sorted(map(tuple, bpe.encode_decode(docs, PATH).collect()), key=str)
    decoded = LIBRARY.decode_batch(want_ids, skip_special_tokens=False)
    want = [(r[0], len(i), sha(",".join(map(str, i))), sha(d)) for r, i, d in zip(rows, want_ids, decoded)]
    assert got == sorted(want, key=str)
    got = sorted(map(tuple, token_counts.token_counts(docs, PATH).collect()), key=str)
    want = [(r[0], len((r[1] or "").encode()), len(i), len(i) > 512) for r, i in zip(rows, want_ids)]
    assert got == sorted(want, key=str)
    assert bpe.encode(docs, PATH).where("doc_id = 402").first().ids == LIBRARY.encode(rows[402][1]).ids
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert back[402] == rows[402][1] and back[None] == "" and len(back) == len(rows) - 1
    empty = docs.limit(0)
    assert bpe.encode_decode(empty, PATH).count() == token_counts.token_counts(empty, PATH).count() == 0
