"""Document scores by masked pseudo-likelihood.

A small network in numpy predicts the class of each word from the words on both of its sides, first the
group of the class, then the class inside it, and the counts of the whole corpus give the share of the word in
its class: P(group) x P(class | group) x P(word | class). The sum of the logarithms over the words of a
text is the score. Every word of the corpus counts with a share of
its own; the counts are a Spark table that grows with the corpus. Training runs where the texts are:
each task descends on its texts, masking a part of their words a round, and Spark averages the weights
of the tasks.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import map_texts, settle, words_of

#: Words with a class of their own; all others share classes by their last letters.
FREQUENT, SHARED = 224, 32
CLASSES = FREQUENT + SHARED
#: Classes come in GROUPS groups of GROUP, so that a word needs as many outputs as both together.
GROUPS = GROUP = 16
EDGE = CLASSES  # stands beyond either end of a text
#: Words on each side, size of the hidden layer.
SIDE, HIDDEN = 2, 16
OFFSETS = (*range(-SIDE, 0), *range(1, SIDE + 1))
#: One word in MASKED is predicted per training round, another one in each round: after all rounds, every word.
MASKED = ROUNDS = 2
BATCH, RATE = 2048, 0.1
#: Words that are scored at a time.
SCORED = 8 * BATCH
_REMEMBERED = 400_000
#: Tasks hold the shares of words that are at least one in LISTED of the corpus (fewer than LISTED words);
#: all others are joined to the counts. Both give the same result.
LISTED = 1 << 20
#: Unit of summed shares: whole numbers add up alike in any order.
UNIT = 1 << 32
#: Embeddings, hidden bias, outputs and bases of the groups, those of the classes inside each group.
_SHAPES = (
    (len(OFFSETS), CLASSES + 1, HIDDEN),
    (HIDDEN,),
    (HIDDEN, GROUPS),
    (GROUPS,),
    (GROUPS, HIDDEN, GROUP),
    (GROUPS, GROUP),
)


class WordClasses(dict):
    def __init__(self, frequent: list[str]):
        super().__init__({word: i for i, word in enumerate(frequent)})

    def __missing__(self, word: str) -> int:
        found = FREQUENT + zlib.crc32(word[-2:].encode()) % SHARED
        if len(self) < _REMEMBERED:
            self[word] = found
        return found

    def sequence(self, text: str) -> bytes:
        """One byte per word."""
        return bytes(map(self.__getitem__, words_of(text)))


class Network:
    """Embeddings per place, a tanh layer, a softmax over groups of classes and one inside each group."""

    def __init__(self, flat: np.ndarray):
        self.parts, at = [], 0
        for shape in _SHAPES:
            size = math.prod(shape)
            self.parts.append(flat[at : at + size].reshape(shape).astype(np.float32))
            at += size

    @classmethod
    def fresh(cls, class_counts: np.ndarray) -> Network:
        rng = np.random.default_rng(0)
        flat = [rng.normal(0, 0.2, math.prod(shape)) for shape in _SHAPES]
        flat[1][:] = 0
        shares = ((class_counts + 1) / (class_counts.sum() + len(class_counts))).reshape(GROUPS, GROUP)
        of_groups = shares.sum(axis=1)
        flat[3], flat[5] = np.log(of_groups), np.log(shares / of_groups[:, None]).ravel()
        return cls(np.concatenate(flat))

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self.parts])

    def _hidden(self, contexts: np.ndarray) -> np.ndarray:
        """The hidden layer, a column per word."""
        embed, bias = self.parts[:2]
        hidden = bias + embed[0][contexts[:, 0]]
        for k in range(1, len(OFFSETS)):
            hidden += embed[k][contexts[:, k]]
        hidden = np.ascontiguousarray(hidden.T)
        return np.tanh(hidden, out=hidden)

    def _by_group(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order that brings words of a group together, and where each group begins in it."""
        order = np.argsort(targets // GROUP, kind="stable")
        return order, np.searchsorted(targets[order] // GROUP, np.arange(GROUPS + 1))

    def log_probabilities(self, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
        outs, bases, out_in, base_in = self.parts[2:]
        result = np.empty(len(targets), dtype=np.float64)
        for at in range(0, len(targets), SCORED):
            order, begin = self._by_group(targets[at : at + SCORED])
            goal, hidden = targets[at + order], self._hidden(contexts[at + order])
            found = _log_softmax(outs.T @ hidden + bases[:, None], goal // GROUP)
            for g in np.flatnonzero(np.diff(begin)):
                some = slice(begin[g], begin[g + 1])
                found[some] += _log_softmax(out_in[g].T @ hidden[:, some] + base_in[g][:, None], goal[some] % GROUP)
            result[at + order] = found
        return result

    def step(self, contexts: np.ndarray, targets: np.ndarray, squares: list[np.ndarray]) -> None:
        """One step of gradient descent with rates adapted per weight."""
        n, (outs, bases, out_in, base_in) = len(targets), self.parts[2:]
        order, begin = self._by_group(targets)
        contexts, targets = contexts[order], targets[order]
        hidden = self._hidden(contexts)
        wrong = _wrong(outs.T @ hidden + bases[:, None], targets // GROUP, n)
        back = outs @ wrong
        out_change, base_change = np.zeros_like(out_in), np.zeros_like(base_in)
        for g in np.flatnonzero(np.diff(begin)):
            some = slice(begin[g], begin[g + 1])
            inside = _wrong(out_in[g].T @ hidden[:, some] + base_in[g][:, None], targets[some] % GROUP, n)
            back[:, some] += out_in[g] @ inside
            out_change[g], base_change[g] = hidden[:, some] @ inside.T, inside.sum(axis=1)
        back *= 1 - hidden * hidden
        by_word = np.ascontiguousarray(back.T)
        embed = np.zeros_like(self.parts[0])
        for k in range(len(OFFSETS)):
            words = contexts[:, k]
            by = np.argsort(words, kind="stable")
            words = words[by]
            first = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
            embed[k, words[first]] = np.add.reduceat(by_word[by], first, axis=0)
        gradients = (embed, back.sum(axis=1), hidden @ wrong.T, wrong.sum(axis=1), out_change, base_change)
        for part, square, gradient in zip(self.parts, squares, gradients, strict=True):
            square += gradient * gradient
            part -= RATE * gradient / np.sqrt(square + 1e-8)


def _log_softmax(logits: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Of a column of logits per word, what its target gets."""
    logits -= logits.max(axis=0)
    reached = logits[targets, np.arange(len(targets))]
    return reached - np.log(np.exp(logits, out=logits).sum(axis=0))


def _wrong(logits: np.ndarray, targets: np.ndarray, n: int) -> np.ndarray:
    """Gradient of the mean loss over n words by the logits, a column per word."""
    logits -= logits.max(axis=0)
    wrong = np.exp(logits, out=logits)
    wrong /= wrong.sum(axis=0) * n
    wrong[targets, np.arange(len(targets))] -= 1 / n
    return wrong


def contexts_of(sequences: list[bytes], part: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Contexts (a row per word) and targets of texts behind each other; none reaches into another text.
    With `part`, those of the words that a training round masks: one in MASKED of each text, from that word on."""
    sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
    begin = np.cumsum(sizes + SIDE) - sizes
    joined = np.full(int(sizes.sum() + SIDE * (len(sizes) + 1)), EDGE, dtype=np.int16)
    words = np.frombuffer(b"".join(sequences), dtype=np.uint8)
    places = np.arange(len(words)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
    joined[places] = words
    if part is not None:
        places = places[(places - np.repeat(begin, sizes)) % MASKED == part]
    return np.stack([joined[places + offset] for offset in OFFSETS], axis=1), joined[places]


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n over the whole corpus: counted per batch, then added up by Spark."""

    def rows(batches: Iterator) -> Iterator:
        for _, texts in batches:
            counts: Counter = Counter()
            for text in texts:
                counts.update(words_of(text))
            yield [list(counts), list(counts.values())]

    return map_texts(docs, [], text_col, "word string, n long", rows).groupBy("word").agg(F.sum("n").alias("n"))


class Shares:
    """Shares of the words of a corpus in their classes.

    A word seen n times in a class of N words has n / (N + 1). Words that the corpus lacks divide the
    rest, 1 / (N + 1), spelled byte by byte. A frequent word is its class.
    """

    def __init__(self, counts: DataFrame, frequent: list[str]):
        number = F.crc32(F.encode(F.right("word", F.lit(2)), "UTF-8")) % SHARED
        shared = counts.where(~F.col("word").isin(frequent)).withColumn("shared", number)
        sums = {row["shared"]: row["n"] for row in shared.groupBy("shared").agg(F.sum("n").alias("n")).collect()}
        every = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.totals = [sums.get(i, 0) + 1 for i in range(SHARED)]
        self.rare = shared.where(F.col("n") * LISTED < every).select("word", "n")
        known = shared.where(F.col("n") * LISTED >= every).select("word", self._share("n").alias("share")).collect()
        self.listed = dict.fromkeys(frequent, 0) | {row["word"]: row["share"] for row in known}

    def _share(self, n: str) -> Column:
        """log P(word | class) in units of 1 / UNIT."""
        number = F.crc32(F.encode(F.right("word", F.lit(2)), "UTF-8")) % SHARED
        total = F.element_at(F.array(*[F.lit(float(t)) for t in self.totals]), (number + 1).cast("int"))
        spelled = -(F.octet_length("word") + 1) * F.lit(math.log(257))
        return F.round((F.coalesce(F.log(F.col(n)), spelled) - F.log(total)) * UNIT).cast("long")

    def of_rest(self, encoded: DataFrame) -> DataFrame:
        """row, share: summed over the words that tasks don't hold."""
        words = encoded.select("row", F.explode("rest").alias("word"))
        return words.join(self.rare, "word", "left").groupBy("row").agg(F.sum(self._share("n")).alias("share"))


def _encoded(docs: DataFrame, frequent: list[str], id_col: str, text_col: str, shares: Shares | None = None) -> DataFrame:
    """doc_id, sequence (a byte per word): written once, read by all training rounds and the scoring.

    With shares also row (a number of its own), listed (their sum over listed words) and rest (the other words).
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequent, shares and shares.listed))

    def rows(batches: Iterator) -> Iterator:
        frequent, listed = shared.value
        classes = WordClasses(frequent)
        row = TaskContext.get().partitionId() << 40
        for keys, texts in batches:
            if listed is None:
                yield [*keys, [classes.sequence(text) for text in texts]]
                continue
            sequences, sums, rest = [], [], []
            for text in texts:
                words = words_of(text)
                sequences.append(bytes(map(classes.__getitem__, words)))
                sums.append(sum(map(listed.get, words, repeat(0))))
                rest.append([word for word in words if word not in listed])
            yield [*keys, sequences, list(range(row, row + len(texts))), sums, rest]
            row += len(texts)

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, sequence binary"
    schema += ", row long, listed long, rest array<string>" if shares else ""
    return settle(map_texts(docs, [id_col], text_col, schema, rows), "word-classes")


def _class_counts(frequent: list, totals: dict[str, int]) -> np.ndarray:
    counts = np.zeros(CLASSES)
    for i, word in enumerate(frequent):
        counts[i] = totals[word]
    return counts


def _trained(encoded: DataFrame, network: Network, part: int) -> Network:
    """One round: every task trains on its texts, and the weights are averaged by words seen."""
    shared = encoded.sparkSession.sparkContext.broadcast(network.flat())

    def rows(batches: Iterator) -> Iterator:
        own = Network(shared.value)
        squares = [np.zeros_like(p) for p in own.parts]
        held = np.zeros((0, len(OFFSETS)), np.int16), np.zeros(0, np.int16)
        texts: list[bytes] = []
        waiting = seen = 0

        def learn(rest: bool) -> None:
            nonlocal held, waiting, seen
            new = contexts_of(texts, part)
            seen += len(new[1])
            contexts, targets = (np.concatenate(x) for x in zip(held, new, strict=True))
            upto = len(targets) if rest else len(targets) // BATCH * BATCH
            for at in range(0, upto, BATCH):
                own.step(contexts[at : min(at + BATCH, upto)], targets[at : min(at + BATCH, upto)], squares)
            held, waiting = (contexts[upto:], targets[upto:]), 0
            texts.clear()

        for _, sequences in batches:
            for sequence in sequences:
                texts.append(sequence)
                waiting += len(sequence)
                if waiting >= 16 * BATCH:
                    learn(False)
        learn(True)
        if seen:
            yield [[seen], [own.flat().tolist()]]

    found = (
        map_texts(encoded, [], "sequence", "seen long, weights array<float>", rows, decode=False)
        .select("seen", F.posexplode("weights").alias("i", "weight"))
        .groupBy("i")
        .agg((F.sum(F.col("weight") * F.col("seen")) / F.sum("seen")).alias("weight"))
        .collect()
    )
    flat = network.flat()
    for row in found:
        flat[row["i"]] = row["weight"]
    # Sums come in any order; rounding makes them the same each time.
    return Network(np.round(flat, 5))


def _vocabulary(counts: DataFrame) -> tuple[list[str], Network]:
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = [row["word"] for row in top]
    return frequent, Network.fresh(_class_counts(frequent, {row["word"]: row["n"] for row in top}))


def _fitted(encoded: DataFrame, network: Network) -> Network:
    for part in range(ROUNDS):
        network = _trained(encoded, network, part)
    return network


def fit(docs: DataFrame, text_col: str = "text") -> tuple[list[str], Network]:
    """Words with a class of their own and the network of a corpus. All texts are read each round,
    and each word is predicted in one of them.

    To the driver come FREQUENT words and the averaged weights; the vocabulary with its counts is the
    table that `word_counts` gives. The weights depend on how the texts are dealt to tasks.
    """
    frequent, network = _vocabulary(word_counts(docs, text_col))
    texts = docs.select(F.lit(0).alias("doc_id"), text_col)
    return frequent, _fitted(_encoded(texts, frequent, "doc_id", text_col), network)


def score(
    docs: DataFrame,
    model: tuple[list[str], Network] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Per row: doc_id, n_words, log_likelihood (sum), mean_log_likelihood (per word).

    Whole texts, NULL counting as empty. A text without words has a sum of 0 and no mean. Each row is
    scored by itself, so repeated rows score alike and ties need no rule. An empty table gives no rows.

    Without a model it learns one from the rows. `counts` (word, n) are those of the corpus of a given
    model; a model given without counts can only score the classes of the words.
    """
    if not model:
        counts = settle(word_counts(docs, text_col), "word-counts")
    frequent, network = model or _vocabulary(counts)
    shares = Shares(counts, frequent) if counts is not None else None
    encoded = _encoded(docs, frequent, id_col, text_col, shares)
    network = network if model else _fitted(encoded, network)
    shared = docs.sparkSession.sparkContext.broadcast(network.flat())

    def rows(batches: Iterator) -> Iterator:
        own = Network(shared.value)
        for keys, sequences in batches:
            sizes, sums = [len(s) for s in sequences], []
            at = 0
            while at < len(sequences):
                group: list[bytes] = []
                total = 0
                while at < len(sequences) and total < 16 * BATCH:
                    group.append(sequences[at])
                    total += len(group[-1])
                    at += 1
                values = own.log_probabilities(*contexts_of(group))
                owner = np.repeat(np.arange(len(group)), [len(s) for s in group])
                sums += np.bincount(owner, weights=values, minlength=len(group)).tolist()
            yield [*keys, sizes, sums]

    keys = ["doc_id", "row", "listed"] if shares else ["doc_id"]
    schema = ", ".join(f"{key} {encoded.schema[key].dataType.simpleString()}" for key in keys)
    scored = map_texts(encoded, keys, "sequence", f"{schema}, n_words long, log_likelihood double", rows, decode=False)
    if shares:
        both = F.col("log_likelihood") + (F.col("listed") + F.coalesce("share", F.lit(0))) / UNIT
        scored = scored.join(shares.of_rest(encoded), "row", "left").withColumn("log_likelihood", both)
    mean = F.expr("IF(n_words > 0, log_likelihood / n_words, NULL)")
    return scored.select("doc_id", "n_words", "log_likelihood", mean.alias("mean_log_likelihood"))
