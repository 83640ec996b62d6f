"""Token counts by rank-synchronous merging of ragged arrays.

The words of a batch lie behind each other in one array of symbols. Each round looks up the rank of
every adjacent pair, takes the lowest rank of each word, and merges all its occurrences at once. When
no word has a pair left, the surviving symbols are its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.bpe import REMEMBERED, Vocabulary, load_source, vocabulary
from tidemark.llm.texts import map_texts

NO_RANK = np.iinfo(np.int64).max
#: Bytes of words that are merged together.
CHUNK_BYTES = 4 << 20


class Counter:
    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        size = max(vocab.labels, default=0) + 1
        self.byte = np.array([vocab.ids.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        left, right, joined = np.array(vocab.merges or np.zeros((0, 3)), dtype=np.int64).T
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.size, self.keys, self.ranks, self.joined = size, keys[order], order, joined
        self.known: dict[str, int] = dict.fromkeys(vocab.special, 1)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        if not len(self.keys):
            return np.full(len(wanted), NO_RANK)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word; no word is empty."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        symbols = self.byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        counts = lengths.copy()
        while len(symbols) > 1:
            ranks = np.where(word[:-1] == word[1:], self.rank(symbols[:-1], symbols[1:]), NO_RANK)
            ranks = np.append(ranks, NO_RANK)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(ranks, first)
            sizes = np.diff(np.append(first, len(symbols)))
            merges = (ranks == np.repeat(lowest, sizes)) & (ranks < NO_RANK)
            at = np.flatnonzero(merges)
            if not len(at):
                break
            # Overlaps are runs like aaa: of consecutive positions every second one merges.
            new_run = np.append(True, np.diff(at) != 1)
            run_start = np.repeat(np.flatnonzero(new_run), np.diff(np.append(np.flatnonzero(new_run), len(at))))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            np.subtract.at(counts, word[at], 1)
            symbols[at] = self.joined[ranks[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            # Words without a pair left are done.
            keep &= np.repeat(lowest < NO_RANK, sizes)
            symbols, word = symbols[keep], word[keep]
        return counts

    def learn(self, pieces: set[str]) -> None:
        """Count the pieces not known yet. A full memory is emptied first, so it stays bounded."""
        if len(self.known) + len(pieces) > REMEMBERED:
            self.known = dict.fromkeys(self.vocab.special, 1)
        new = [p for p in pieces if p not in self.known]
        start = 0
        while start < len(new):
            chunk, size = [], 0
            while start < len(new) and (not chunk or size < CHUNK_BYTES):
                chunk.append(new[start])
                size += len(new[start])
                start += 1
            self.known.update(zip(chunk, self.count([p.encode() for p in chunk]).tolist(), strict=True))

    def totals(self, texts: list[str]) -> list[int]:
        split = [self.vocab.pieces(text) for text in texts]
        self.learn(set().union(*split))
        return [sum(map(self.known.__getitem__, pieces)) for pieces in split]


@lru_cache(maxsize=2)
def counter(source: str) -> Counter:
    return Counter(vocabulary(source))


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about CHUNK_BYTES; a longer text comes alone."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > CHUNK_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def token_counts(
    docs: DataFrame, vocabulary_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    NULL counts as empty: no bytes, no tokens. Rows are counted on their own, so repeated rows and ties
    need no rule, and there is no shuffle. An empty table gives no rows.
    """
    source = docs.sparkSession.sparkContext.broadcast(load_source(vocabulary_path))

    def rows(batches: Iterator) -> Iterator:
        machine = counter(source.value)
        for keys, texts in batches:
            totals: list[int] = []
            for part in _parts(texts):
                totals += machine.totals(part)
            yield [*keys, [len(t.encode()) for t in texts], totals, [n > limit for n in totals]]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col], text_col, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", rows)
