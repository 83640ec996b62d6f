"""Periodic runs of words, found by internal pattern matching.

A run of period q holds, among its first q words, a whole block of 2**k words that begins at a multiple
of 2**k, and that block occurs again q words on. So each such block is looked up in the windows that
follow it: equal blocks are neighbours in the suffix array, and a wavelet tree over the array gives the
next occurrences from a place on. In a window of less than two blocks' length the occurrences are one
arithmetic progression, of which three numbers are enough. Its members are candidate periods; how far
each one holds to both sides is read from the ranks of the factors of 2**k words.

Spark deals out whole texts. Inside a task many short texts are joined to one array of numbers, in
which no two texts share a number, and handled at once.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.texts import map_texts, sha256

#: Words of the shortest run.
LEAST = 12
#: Texts are joined until they hold this many words; a longer text is an array of its own.
BATCH_WORDS = 1 << 16


def words_of(data: bytes) -> list[bytes]:
    """Words are what stands between space, tab, newline, vertical tab, form feed and return."""
    return data.split()


def folded(words: list[bytes], doc_id: object) -> list[bytes]:
    """The words of a document; where the hash of its id says so, its tail repeats itself.

    A NULL id has no hash, so its words stay.
    """
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, equal for equal words of one text only, and where each text begins."""
    out, starts, taken = [], [0], 0
    for words in texts:
        known: dict[bytes, int] = {}
        out.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) + taken)
        taken += len(known)
        starts.append(starts[-1] + len(words))
    return np.concatenate(out), np.array(starts)


class Factors:
    """Suffix array of an array of numbers, with the ranks of all factors of 2**k numbers.

    `rank[k][i]` is the first place in the array of the factors equal to the one at `i`, `size[k][i]`
    how many there are. The last level tells all positions apart.
    """

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        rank, size = np.full(n + 1, -1, np.int32), np.zeros(n, np.int32)
        everywhere = np.arange(n)
        self._regroup(symbols[order], order, everywhere, rank, size)
        self.rank, self.size = [rank], [size]
        reach = 1
        while True:
            tied = everywhere[size[order] > 1]
            if not len(tied):
                break
            at = order[tied]
            key = rank[at] * np.int64(n + 1) + rank[np.minimum(at + reach, n)] + 1
            by = np.argsort(key, kind="stable")
            at = order[tied] = at[by]
            rank, size = rank.copy(), size.copy()
            self._regroup(key[by], at, tied, rank, size)
            self.rank.append(rank)
            self.size.append(size)
            reach *= 2
        self.order = order

    @staticmethod
    def _regroup(keys: np.ndarray, at: np.ndarray, places: np.ndarray, rank: np.ndarray, size: np.ndarray) -> None:
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        sizes = np.diff(np.append(first, len(keys)))
        rank[at] = np.repeat(places[first], sizes)
        size[at] = np.repeat(sizes, sizes)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers from i and j on agree, i < j."""
        same = np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 2, -1, -1):
            rank, b = self.rank[k], j + same
            same += (rank[np.minimum(i + same, self.n)] == rank[np.minimum(b, self.n)]) * (b < self.n) << k
        return same

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers before i and j agree, i < j."""
        same = np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 2, -1, -1):
            rank, a = self.rank[k], i - same - (1 << k)
            same += (rank[np.maximum(a, 0)] == rank[np.maximum(a + (j - i), 0)]) * (a >= 0) << k
        return same


class WaveletTree:
    """Order queries on slices of an array that holds 0 .. n-1 in any order."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = range(max(1, (self.n - 1).bit_length()) - 1, -1, -1)
        self.zeros = []
        for bit in self.bits:
            low = (values >> bit & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(low)]))
            values = np.concatenate([values[low], values[~low]])

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each slice are smaller than its bound."""
        count, whole, beyond = np.zeros(len(left), np.int64), right - left, bound >= self.n
        for bit, zeros in zip(self.bits, self.zeros, strict=True):
            one, a, b = (bound >> bit & 1) == 1, zeros[left], zeros[right]
            count += np.where(one, b - a, 0)
            left, right = np.where(one, zeros[-1] + left - a, a), np.where(one, zeros[-1] + right - b, b)
        return np.where(beyond, whole, count)

    def nth(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of each slice, counted from 0."""
        value = np.zeros(len(left), np.int64)
        for bit, zeros in zip(self.bits, self.zeros, strict=True):
            a, b = zeros[left], zeros[right]
            one = k >= b - a
            value |= one.astype(np.int64) << bit
            k = np.where(one, k - (b - a), k)
            left, right = np.where(one, zeros[-1] + left - a, a), np.where(one, zeros[-1] + right - b, b)
        return value


def windows(n: int) -> list[tuple[int, int, int]]:
    """(k, low, high): blocks of 2**k words are looked up low..high words on.

    A run of period q in low..high has a whole block among its first q words; for the short periods the
    LEAST words of a run leave room for a longer block.
    """
    out = [(2, 1, 5), (1, 6, 6)]
    k = 2
    while (2 << k) - 1 <= n // 2:
        out += [(k, (2 << k) - 1, (3 << k) - 2), (k, (3 << k) - 1, (4 << k) - 2)]
        k += 1
    return out


def candidates(factors: Factors) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that cover every run: the words at the place occur again a period on."""
    tree, places, periods = WaveletTree(factors.order), [], []
    for k, low, high in windows(factors.n):
        if k >= len(factors.rank):
            continue
        i = np.arange(0, factors.n - (1 << k) + 1, 1 << k)
        i = i[factors.size[k][i] > 1]
        left = factors.rank[k][i].astype(np.int64)
        right = left + factors.size[k][i]
        before = tree.below(left, right, i + low)
        count = tree.below(left, right, i + high + 1) - before
        found = count > 0
        i, left, right, before, count = i[found], left[found], right[found], before[found], count[found]
        first = tree.nth(left, right, before)
        places.append(i)
        periods.append(first - i)
        more = count > 1
        i, first, count = i[more], first[more], count[more]
        step = tree.nth(left[more], right[more], before[more] + 1) - first
        two = count == 2
        places.append(i[two])
        periods.append((first + step - i)[two])
        for a, p in _of_progressions(factors, i[~two], first[~two], step[~two], count[~two]):
            places.append(a)
            periods.append(p)
    return np.concatenate(places), np.concatenate(periods)


def _of_progressions(factors: Factors, i: np.ndarray, first: np.ndarray, step: np.ndarray, count: np.ndarray):
    """Candidates of blocks at `i` that occur `count` > 2 times, `step` apart from `first` on.

    Such a block has period `step`. Where it and its occurrences lie in one stretch of that period, longer
    periods tell nothing new. Between two stretches a period either puts their ends on one another or
    is short enough for both.
    """
    begin, end = i - factors.behind(i, i + step), i + step + factors.ahead(i, i + step)
    begin2, end2 = first - factors.behind(first, first + step), first + step + factors.ahead(first, first + step)
    apart = begin != begin2
    i, first, step, count = i[apart], first[apart], step[apart], count[apart]
    begin, end, begin2, end2 = begin[apart], end[apart], begin2[apart], end2[apart]
    last = first + (count - 1) * step - i
    for period in (begin2 - begin, end2 - end):
        member = (period >= first - i) & (period <= last) & ((period - first + i) % step == 0)
        yield i[member], period[member]
    most = np.minimum.reduce([end - begin, end2 - begin2, (end2 - begin) // 2, last])
    members = np.where(end >= begin2, (most - first + i) // step + 1, 0).clip(0)
    nth = np.arange(members.sum()) - np.repeat(np.cumsum(members) - members, members)
    yield np.repeat(i, members), np.repeat(first - i, members) + nth * np.repeat(step, members)


def runs(symbols: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period."""
    if len(symbols) < LEAST:
        return np.zeros((0, 3), np.int64)
    factors = Factors(symbols)
    i, period = candidates(factors)
    start = i - factors.behind(i, i + period)
    end = i + period + factors.ahead(i, i + period)
    whole = end - start >= np.maximum(LEAST, 2 * period)
    start, end, period = start[whole], end[whole], period[whole]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    # of one stretch only the smallest period is a run's
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)]
    start, end, period = start[new], end[new], period[new]
    by = np.lexsort((period, start))
    return np.stack([start, end - start, period], axis=1)[by]


def _digests(doc_id: object, words: list[bytes], found: np.ndarray) -> tuple:
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found.tolist()).encode()
    kept = words
    if len(found):
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, found[:, 0] + found[:, 2], 1)
        np.add.at(edges, found[:, 0] + found[:, 1], -1)
        kept = [w for w, gone in zip(words, np.cumsum(edges).tolist(), strict=False) if not gone]
        start, length, period = found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[0]].tolist()
        best = (start, length, period, 1000 * length // period)
    else:
        best = (None, None, None, None)
    return (doc_id, len(found), *best, sha256(lines), sha256(b" ".join(kept)))


def _of_texts(ids: list, texts: list[list[bytes]]) -> list[tuple]:
    symbols, starts = numbered(texts)
    found = runs(symbols)
    cuts = np.searchsorted(found[:, 0], starts)
    out = []
    for doc_id, words, begin, a, b in zip(ids, texts, starts[:-1], cuts[:-1], cuts[1:], strict=True):
        out.append(_digests(doc_id, words, found[a:b] - [begin, 0, 0]))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: bool = False) -> DataFrame:
    """Per row: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256.

    A run is a stretch of words with smallest period q, of at least LEAST and 2q words, that no
    neighbouring word extends. The four numbers are those of the longest run (ties: smallest start, then
    period), NULL where there is none. The hashes are of all runs and of the words that no run contains after
    its first q ones. With `fold`, the tails of some texts, chosen by a hash of the id, first repeat themselves.

    NULL and empty texts have no words: no run, and hashes of nothing. Repeated rows and ids, also NULL
    ones, give a row each; an empty table gives none. Only the two named columns are read. A text is
    handled whole in one task and takes some 300 bytes of memory a word.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )

    def rows(batches):
        for (column,), texts in batches:
            ids, held, size, out = [], [], 0, []
            for doc_id, data in zip(column.to_pylist(), texts, strict=True):
                words = words_of(data)
                ids.append(doc_id)
                held.append(folded(words, doc_id) if fold else words)
                size += len(words)
                if size >= BATCH_WORDS:
                    out += _of_texts(ids, held)
                    ids, held, size = [], [], 0
            if ids:
                out += _of_texts(ids, held)
            if out:
                yield [list(column) for column in zip(*out, strict=True)]

    return map_texts(docs, [id_col], text_col, schema, rows, decode=False)
