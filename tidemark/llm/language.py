"""Language identification in two steps: the family first, then the languages within it.

A text becomes the hashed counts of its letter pairs and triples. One-versus-one linear support
vector machines choose the family; those of that family separate its languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import map_texts, text_or_empty

#: Families by language code; a language that is not listed is its own family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}
#: Rows per language that training takes, chosen evenly by a hash of their id. The only sample here.
TRAINING_ROWS = 600
PAIRS, TRIPLES = 1024, 2048
#: Margins are scaled by this before they become scores.
STEEPNESS = 4.0
UNKNOWN = "und"
#: Documents below this score are rejected. A score is a product of the winner's duels, each at least 0.5, so
#: with two families of two languages none is below 0.25 and only texts without a letter go.
LEAST_SCORE = 0.1

_LETTER = re.compile(r"[^\W\d_]")
_SPACES = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def has_letter(text: str) -> bool:
    return any(match.group().isalpha() for match in _LETTER.finditer(text))


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed letter pairs and triples, unit length."""
    words = text.lower().encode("utf-8").translate(_SPACES).split()
    a = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
    pairs = a[:-1] * np.uint32(0x9E3779B1) + a[1:] * np.uint32(0x85EBCA77)
    triples = pairs[:-1] * np.uint32(31) + a[2:] * np.uint32(0xC2B2AE3D)
    vector = np.concatenate(
        [
            np.bincount((pairs ^ (pairs >> np.uint32(15))) % np.uint32(PAIRS), minlength=PAIRS),
            np.bincount((triples ^ (triples >> np.uint32(13))) % np.uint32(TRIPLES), minlength=TRIPLES),
        ]
    ).astype(np.float32)
    return np.sqrt(vector / max(1.0, float(vector.sum())))


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, passes: int = 12) -> np.ndarray:
    """Linear SVM (squared hinge, bias as a last feature) by dual coordinate descent; y is -1 or 1.

    Each class weighs as much as the other.
    """
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)]).astype(np.float64)
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    diagonal = share / cost  # 1 / (2 C_i), C_i = cost / (2 share)
    norms = (x * x).sum(axis=1) + diagonal
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(0)
    for _ in range(passes):
        for i in order.permutation(len(x)):
            gradient = y[i] * (w @ x[i]) - 1 + diagonal[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / norms[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w.astype(np.float32)


class Duels:
    """One-versus-one machines over some classes; the class with most wins, then the largest margins."""

    def __init__(self, x: np.ndarray, labels: np.ndarray):
        self.classes = sorted(set(labels))
        self.pairs = list(combinations(range(len(self.classes)), 2))
        weights = []
        for a, b in self.pairs:
            rows = np.isin(labels, [self.classes[a], self.classes[b]])
            weights.append(train_svm(x[rows], np.where(labels[rows] == self.classes[a], 1, -1)))
        self.weights = np.array(weights, dtype=np.float32).reshape(len(self.pairs), x.shape[1] + 1)

    def predict(self, vector: np.ndarray) -> tuple[str, float]:
        margins = self.weights[:, :-1] @ vector + self.weights[:, -1]
        wins, sums = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        for (a, b), margin in zip(self.pairs, margins, strict=True):
            wins[a if margin > 0 else b] += 1
            sums[a] += margin
            sums[b] -= margin
        best = max(range(len(self.classes)), key=lambda k: (wins[k], sums[k], -k))
        own = [m if a == best else -m for (a, b), m in zip(self.pairs, margins, strict=True) if best in (a, b)]
        return self.classes[best], float(np.prod(1 / (1 + np.exp(-STEEPNESS * np.array(own)))))


class LanguageModel:
    def __init__(self, x: np.ndarray, languages: np.ndarray, families: dict[str, tuple[str, ...]]):
        family_of = {code: name for name, codes in families.items() for code in codes}
        groups = np.array([family_of.get(code, code) for code in languages])
        self.families = Duels(x, groups)
        self.within = {g: Duels(x[groups == g], languages[groups == g]) for g in self.families.classes}

    def predict(self, text: str) -> tuple[str, float]:
        if not self.within or not has_letter(text):
            return UNKNOWN, 0.0
        vector = features(text)
        family, sure = self.families.predict(vector)
        language, within = self.within[family].predict(vector)
        return language, sure * within


def held_out(id_col: str) -> Column:
    """Rows that training never sees; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from at most about TRAINING_ROWS labelled rows a language outside the held-out part.

    Languages are counted over all rows; each then takes the same share of its rows by a hash of the
    id. Tasks turn the texts into vectors of fixed size, and only those reach the driver. Rows without
    a letter teach nothing; without labelled rows every prediction is `und`.
    """
    labelled = docs.select(
        F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where(~held_out("doc_id") & F.col("lang").isNotNull())
    counts = labelled.groupBy("lang").count().collect()
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], F.lit(TRAINING_ROWS / row["count"])).otherwise(share)
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share * (1 << 20))

    def rows(batches: Iterator) -> Iterator:
        for (lang,), texts in batches:
            good = [has_letter(t) for t in texts]
            yield [
                [code for code, g in zip(lang.to_pylist(), good, strict=True) if g],
                [features(t).astype(np.float32).tobytes() for t, g in zip(texts, good, strict=True) if g],
            ]

    found = map_texts(chosen, ["lang"], "text", "lang string, vector binary", rows).collect()
    found.sort(key=lambda row: (row["lang"], row["vector"]))
    x = np.array([np.frombuffer(row["vector"], dtype=np.float32) for row in found]).reshape(len(found), PAIRS + TRIPLES)
    return LanguageModel(x, np.array([row["lang"] for row in found], dtype=object), FAMILIES)


def identify(
    docs: DataFrame, model: LanguageModel | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (0 to 1).

    Each whole text is judged by itself, without a shuffle; its language, source and id are no inputs.
    NULL texts and texts without a letter are `und` with score 0. Repeated rows get equal answers,
    ties go to the first language in order. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, id_col, text_col, lang_col))

    def rows(batches: Iterator) -> Iterator:
        for keys, texts in batches:
            found = [shared.value.predict(t) for t in texts]
            yield [*keys, [lang for lang, _ in found], [score for _, score in found]]

    narrow = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(
        narrow, ["doc_id", "held_out"], "text", f"doc_id {kind}, held_out boolean, lang_pred string, score double", rows
    )


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose language can be told, with all their columns.

    Rejected are texts without a letter and scores below LEAST_SCORE, which few duels can't reach. Rows pass or not where
    they are read, each by itself: no text is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, lang_col))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((value or b"").decode("utf-8", "replace") for value in batch.column(place).cast(pa.binary()).to_pylist())
            found = map(shared.value.predict, texts)
            yield batch.filter(pa.array([lang != UNKNOWN and score >= LEAST_SCORE for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
