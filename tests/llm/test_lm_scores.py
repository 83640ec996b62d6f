import math
import random
from collections import Counter

import numpy as np

from tidemark.llm import lm_scores
from tidemark.llm.texts import words_of

SCHEMA = "doc_id long, text string, word int, n string, seen string"


def sample(spark, sf="sf0.01"):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text, 1, "x", "y") for r in rows]


def by_hand(text, frequent, network):
    """Word by word, in plain Python."""
    embed, bias, outs, bases, out_in, base_in = (p.astype(float).tolist() for p in network.parts)
    classes = lm_scores.WordClasses(frequent)
    seq, total = [classes[w] for w in words_of(text)], 0.0
    for i, target in enumerate(seq):
        hidden = list(bias)
        for k, offset in enumerate((-2, -1, 1, 2)):
            c = seq[i + offset] if 0 <= i + offset < len(seq) else lm_scores.EDGE
            hidden = [h + e for h, e in zip(hidden, embed[k][c])]
        hidden = [math.tanh(h) for h in hidden]
        group, member = divmod(target, lm_scores.GROUP)
        for out, base, goal in ((outs, bases, group), (out_in[group], base_in[group], member)):
            logits = [base[c] + sum(h * out[j][c] for j, h in enumerate(hidden)) for c in range(len(base))]
            top = max(logits)
            total += logits[goal] - top - math.log(sum(math.exp(x - top) for x in logits))
    return total


def test_scores(spark):
    rows = sample(spark)
    docs = spark.createDataFrame(rows, SCHEMA)
    counts = {r.word: r.n for r in lm_scores.word_counts(docs).collect()}
    assert counts == Counter(w for r in rows for w in words_of(r[1]))
    model = lm_scores.fit(docs)
    assert model[0] == sorted(counts, key=lambda w: (-counts[w], w))[: lm_scores.FREQUENT]
    got = {r.doc_id: r for r in lm_scores.score(docs, model).collect()}
    for i, text, *_ in rows[:12]:
        want = by_hand(text[:1500], *model)
        one = lm_scores.score(spark.createDataFrame([(i, text[:1500], 1, "", "")], SCHEMA), model).first()
        assert abs(one.log_likelihood - want) < 1e-3 * abs(want) + 1e-3
    # Training helps: better than word shares alone, and words out of order score lower.
    fresh = lm_scores.Network.fresh(lm_scores._class_counts(model[0], counts))
    fresh.parts[2][:] = 0
    fresh.parts[4][:] = 0
    mean = lambda m, d: sum(r.log_likelihood for r in lm_scores.score(d, m).collect())
    random.seed(1)
    mixed = spark.createDataFrame([(i, " ".join(random.sample(w := words_of(t), len(w))), 1, "", "") for i, t, *_ in rows], SCHEMA)
    assert mean(model, docs) > mean((model[0], fresh), docs)
    assert mean(model, mixed) < sum(r.log_likelihood for r in got.values())



def test_each_word_has_a_share_of_its_class(spark):
    rows = sample(spark, "sf0.001")
    docs = spark.createDataFrame(rows, SCHEMA)
    counts, model = lm_scores.word_counts(docs), lm_scores.fit(docs)
    n = {r.word: r.n for r in counts.collect()}
    classes = lm_scores.WordClasses(model[0])
    totals = Counter()
    for word in n:
        totals[classes[word]] += n[word]

    def share(word):
        if word in model[0]:
            return 0
        seen = math.log(n[word]) if word in n else -(len(word.encode()) + 1) * math.log(257)
        return seen - math.log(totals[classes[word]] + 1)

    texts = rows[:40] + [(9000, "qzing xyzing of \u00e9 y", 1, "", ""), (9001, None, 1, "", "")]
    some = spark.createDataFrame(texts, SCHEMA)
    plain = {r.doc_id: r.log_likelihood for r in lm_scores.score(some, model).collect()}
    for listed in (lm_scores.LISTED, 1000):  # few words, and most words, are joined
        lm_scores.LISTED, before = listed, lm_scores.LISTED
        try:
            got = {r.doc_id: r for r in lm_scores.score(some, model, counts=counts).collect()}
        finally:
            lm_scores.LISTED = before
        for i, text, *_ in texts:
            words = words_of(text or "")
            want = plain[i] + sum(map(share, words))
            assert abs(got[i].log_likelihood - want) < 1e-6 * abs(want) + 1e-6
            assert got[i].mean_log_likelihood == (got[i].log_likelihood / len(words) if words else None)
    # What is learned from the rows scores words too, so a text of other words with known endings scores lower.
    own = {r.doc_id: r.log_likelihood for r in lm_scores.score(docs).collect()}
    assert all(own[i] < plain[i] - 1 for i, text, *_ in rows[:40] if len(words_of(text)) > 20)
    word = max((w for w in n if w not in model[0]), key=n.get)
    pair = spark.createDataFrame([(1, word, 1, "", ""), (2, "q" * len(word) + word[-2:], 1, "", "")], SCHEMA)
    known, invented = sorted(lm_scores.score(pair, model, counts=counts).collect())
    assert known.log_likelihood > invented.log_likelihood + 10



def test_every_word_is_a_training_target(spark, monkeypatch):
    trained, parts = lm_scores._trained, []

    def noted(encoded, network, part):
        parts.append(part)
        return trained(encoded, network, part)

    monkeypatch.setattr(lm_scores, "_trained", noted)
    docs = spark.createDataFrame([(1, "a b c d e f g h i", 1, "", "")], SCHEMA)
    lm_scores.fit(docs)
    texts = [bytes(range(i, i + n)) for i, n in ((0, 7), (9, 0), (20, 1), (30, 200))]
    contexts, targets = lm_scores.contexts_of(texts)
    assert targets.tolist() == [w for text in texts for w in text]
    masked = [lm_scores.contexts_of(texts, part) for part in parts]
    rows = sorted(tuple([*c, t]) for cs, ts in masked for c, t in zip(cs.tolist(), ts.tolist()))
    assert rows == sorted(tuple([*c, t]) for c, t in zip(contexts.tolist(), targets.tolist()))
    edge = lm_scores.EDGE
    assert contexts[0].tolist() == [edge, edge, 1, 2] and contexts[6].tolist() == [4, 5, edge, edge]
    assert contexts[7].tolist() == [edge] * 4  # a text of one word


def test_probabilities_sum_to_one_and_gradients_are_true():
    rng = np.random.default_rng(8)
    network = lm_scores.Network.fresh(rng.integers(1, 50, lm_scores.CLASSES))
    contexts = rng.integers(0, lm_scores.CLASSES + 1, (6, 4))
    every = np.repeat(contexts, lm_scores.CLASSES, axis=0)
    logs = network.log_probabilities(every, np.tile(np.arange(lm_scores.CLASSES), 6))
    assert np.abs(np.exp(logs).reshape(6, -1).sum(axis=1) - 1).max() < 1e-5
    # a step without rate adaptation shows its gradient: compare with differences of the loss
    targets = rng.integers(0, lm_scores.CLASSES, 6)
    network.parts = [p.astype(np.float64) for p in network.parts]
    squares = [np.zeros_like(p) for p in network.parts]
    before = [p.copy() for p in network.parts]
    network.step(contexts, targets, squares)
    gradients = [np.sqrt(q) * np.sign(b - p) for q, b, p in zip(squares, before, network.parts)]
    loss = lambda: -network.log_probabilities(contexts, targets).mean()
    for i, part in enumerate(before):
        network.parts = [p.copy() for p in before]
        places = [tuple(x) for x in np.argwhere(np.abs(gradients[i]) > 1e-3)[:5]] + [tuple(rng.integers(0, s) for s in part.shape)]
        for place in places:
            sides = []
            for shift in (1e-5, -1e-5):
                network.parts[i][place] = before[i][place] + shift
                sides.append(loss())
            network.parts[i][place] = before[i][place]
            assert abs((sides[0] - sides[1]) / 2e-5 - gradients[i][place]) < 1e-6


def test_gradient():
    rng = np.random.default_rng(3)
    contexts = rng.integers(0, lm_scores.CLASSES + 1, (50, 4))
    targets = rng.integers(0, lm_scores.CLASSES, 50)
    network = lm_scores.Network.fresh(np.ones(lm_scores.CLASSES))
    before = network.log_probabilities(contexts, targets).mean()
    squares = [np.zeros_like(p) for p in network.parts]
    for _ in range(30):
        network.step(contexts, targets, squares)
    assert network.log_probabilities(contexts, targets).mean() > before + 1


def test_odd_rows(spark):
    rows = [*sample(spark, "sf0.001"), (9001, None, 1, "", ""), (9002, "", 1, "", ""), (9003, "--", None, None, ""), (None, "of the", 1, "", "")]
    rows += [(9004, "the of and " * 100_000, 1, "", ""), rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = lm_scores.score(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].n_words == 0 and by_id[i].log_likelihood == 0 and by_id[i].mean_log_likelihood is None for i in (9001, 9002, 9003))
    assert by_id[9004].n_words == 300_000 and by_id[None].n_words == 2
    assert len({r.log_likelihood for r in got if r.doc_id == rows[0][0]}) == 1
    assert lm_scores.score(docs.limit(0)).count() == 0
    assert lm_scores.score(docs.where("doc_id = 9001")).first().n_words == 0
