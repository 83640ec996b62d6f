"""Byte-level BPE by an automaton over tokens.

The automaton starts as one state with an arc for each byte. Each merge (u, v) -> uv adds a gadget: u
now leads to a copy of its state without the arc v, and wherever u may stand, uv may stand too and
leads where v led. What remains is deterministic and accepts, for each string, the one token
sequence that BPE produces.

The copies that u leads to form a run: each lacks one more arc than the copy before. Before u's first
gadget it shared the run of its right part, as it was when u was made. So a state is a token and an
age, and the tables hold per gadget (u, v) its age, and per token its age and its two parts.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.texts import map_texts, sha256

#: Fixed value: the split pattern of the byte-level tokenizer family.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Below U+0250: letters, numbers, white space. Most texts need no more, and `re` is faster there.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_NARROW = re.compile(rf" ?[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_WIDE = regex.compile(SPLIT)
_BEYOND = re.compile("[^\x00-ɏ]")

#: A vocabulary file is broadcast; larger ones are refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Words whose tokens a task remembers; others are encoded each time.
REMEMBERED = 600_000


def split_words(text: str) -> list[str]:
    return (_WIDE if _BEYOND.search(text) else _NARROW).findall(text)


def byte_of_char() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else the next free one."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, merges as id triples in rank order, special strings."""

    def __init__(self, source: str):
        data = json.loads(source)
        model, byte = data["model"], byte_of_char()
        raw = lambda token: bytes(byte[c] for c in token)
        self.ids = {raw(token): i for token, i in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in (map(raw, pair) for pair in pairs)]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.labels = {i: token for token, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        texts = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, texts)) + ")") if texts else None

    def pieces(self, text: str) -> list[str]:
        """Pre-split words; a special string is a piece of its own."""
        if self._special is None or not self._special.search(text):
            return split_words(text)
        parts = self._special.split(text)
        return list(chain.from_iterable([p] if p in self.special else split_words(p) for p in parts))


@lru_cache(maxsize=4)
def vocabulary(source: str) -> Vocabulary:
    return Vocabulary(source)


def load_source(path: str) -> str:
    """The vocabulary file, read once by the driver."""
    if Path(path).stat().st_size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return Path(path).read_text(encoding="utf-8")


class _Words(dict):
    """Ids of a piece as bytes, computed when first asked for."""

    def __init__(self, machine: Automaton):
        self.machine = machine

    def __missing__(self, piece: str) -> bytes:
        special = self.machine.vocab.special.get(piece)
        tokens = self.machine.path(piece.encode()) if special is None else [special]
        found = array("i", tokens).tobytes()
        if len(self) < REMEMBERED:
            self[piece] = found
        return found


class Automaton:
    """The tables, encoding by walking them, decoding by emitting the labels of a path."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.ids, self.labels = vocab.ids, vocab.labels
        self.longest = max(map(len, self.ids), default=1)
        size = max(self.labels, default=0) + 1
        self.made = [-1] * size  # age: the merge that made a token; -1 for bytes
        self.left, self.right = [-1] * size, [-1] * size
        self.gadgets: dict[int, int] = {}  # u * size + v -> age
        self.size = size
        for age, (u, v, joined) in enumerate(vocab.merges):
            self._add_gadget(age, u, v, joined)
        #: Only tokens that some path can hold.
        self.arcs = {t: i for t, i in self.ids.items() if self.left[i] >= 0 or len(t) == 1}
        self._known: dict[int, bool] = {}
        self._words = _Words(self)

    def _add_gadget(self, age: int, u: int, v: int, joined: int) -> None:
        # Parts that no path holds, or that cannot follow each other any more, never merge.
        if all(self.left[t] >= 0 or len(self.labels[t]) == 1 for t in (u, v)) and self.has_arc(u, v):
            self.gadgets[u * self.size + v] = age
            self.made[joined], self.left[joined], self.right[joined] = age, u, v

    def has_arc(self, u: int, token: int) -> bool:
        """Whether the state that u leads to has an arc for the token."""
        gadgets, made, size = self.gadgets, self.made, self.size
        before = len(self.vocab.merges)  # only copies of u older than this belong to the state
        while True:
            age = gadgets.get(u * size + token)
            if age is not None and age < before:
                return False
            if made[token] > made[u]:
                # The token is younger than the run: it stands where its left part could when it was made.
                before = min(before, made[token] + 1)
                token = self.left[token]
            elif self.left[u] < 0:
                return True
            else:
                before = min(before, made[u])
                u = self.right[u]

    def path(self, word: bytes) -> list[int]:
        """The tokens of the one accepting path.

        Depth first, longest arc first. Each prefix has one accepted sequence, so a position that led
        to no end once never will.
        """
        arcs, known, size, longest = self.arcs, self._known, self.size, self.longest
        whole = arcs.get(word)
        if whole is not None:
            return [whole]
        end = len(word)
        tokens, starts, dead = [], [], set()
        at, stop, last = 0, min(end, longest), -1
        while True:
            while stop > at:
                token = arcs.get(word[at:stop])
                if token is not None and stop not in dead:
                    if last < 0:
                        break
                    key = last * size + token
                    may = known.get(key)
                    if may is None:
                        may = self.has_arc(last, token)
                        if len(known) < 2 * REMEMBERED:
                            known[key] = may
                    if may:
                        break
                stop -= 1
            if stop > at:
                tokens.append(token)
                if stop == end:
                    return tokens
                starts.append(at)
                at, last = stop, token
                stop = end if end - at < longest else at + longest
            else:
                dead.add(at)
                tokens.pop()
                at, stop = starts.pop(), at - 1
                last = tokens[-1] if tokens else -1

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self._words.__getitem__, self.vocab.pieces(text))), dtype=np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def automaton(source: str) -> Automaton:
    """Built once per Python worker and kept between its tasks."""
    return Automaton(vocabulary(source))


def encode_decode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256.

    NULL counts as empty; an empty text has no tokens. Each row is encoded on its own, so repeated
    rows and ties need no rule, and there is no shuffle. An empty table gives no rows.
    """
    source = docs.sparkSession.sparkContext.broadcast(load_source(vocabulary_path))

    def rows(batches: Iterator) -> Iterator:
        machine = automaton(source.value)
        decimals = [str(i) for i in range(machine.size)]
        for keys, texts in batches:
            counts, encoded, decoded = [], [], []
            for text in texts:
                ids = machine.encode(text).tolist()
                counts.append(len(ids))
                encoded.append(sha256(",".join(map(decimals.__getitem__, ids)).encode()))
                decoded.append(sha256(machine.decode(ids).encode()))
            yield [*keys, counts, encoded, decoded]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col], text_col, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", rows)


def encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids (array of int), decoded_sha256 (of the text that the ids give back)."""
    source = docs.sparkSession.sparkContext.broadcast(load_source(vocabulary_path))

    def rows(batches: Iterator) -> Iterator:
        machine = automaton(source.value)
        for keys, texts in batches:
            encoded = [machine.encode(text) for text in texts]
            ends = np.cumsum([0, *map(len, encoded)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*encoded, np.zeros(0, np.int32)])))
            yield [*keys, np.diff(ends).tolist(), ids, [sha256(machine.decode(e.tolist()).encode()) for e in encoded]]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col], text_col, f"doc_id {kind}, n_tokens long, ids array<int>, decoded_sha256 string", rows)


def decode(encoded: DataFrame, vocabulary_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id, text. NULL ids give an empty text; an id outside the vocabulary is an error."""
    source = encoded.sparkSession.sparkContext.broadcast(load_source(vocabulary_path))
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(source.value)
        for batch in batches:
            texts = [machine.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"doc_id {kind}, text string")
