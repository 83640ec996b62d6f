"""Near-duplicates by Order MinHash.

A text is a sequence of words, and its k-mers are runs of three words (single words in short texts),
each labelled with its occurrence number. A sketch takes the few k-mers with the smallest hashes and keeps them in text
order, so it agrees for texts that share k-mers in the same order, as texts of small edit distance
do. Texts that agree in any of the sketches are candidates, and a banded alignment decides.

The members of a crowded bucket first meet a few representatives, which puts near copies into one class. All
pairs of such a bucket that are left in different classes are then compared: their lengths and bags of words
rule most of them out, and the rest is aligned, two blocks of members at a time. What leaves such blocks is a link for
two classes that join, so the rows grow with the members and not with their pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import map_texts, settle, text_or_empty

K = 3
SIMILARITY = 0.8
#: Sketches per text, and k-mers per sketch. Texts that share a part p of all their k-mers agree in one
#: sketch with chance p ** SAMPLED. A part e of replaced words leaves about (1 - e) ** K of the k-mers of
#: either text, so p is 0.34 at edit similarity 0.8 and 0.57 at 0.9.
SKETCHES, SAMPLED = 32, 2
#: Texts of at most SHORT words have sketches of SAMPLED_WORDS single words, those of SIMILARITY * SHORT
#: words or more the sketches above; between, both, so that two texts of enough similarity share a kind.
SHORT, SAMPLED_WORDS = 20, 3
#: Members of a bucket first meet this many of its representatives. That is all pairs of a bucket with one
#: member more; a larger one is crowded, and its other pairs come after.
REPRESENTATIVES = 2

#: Members of a block, and bytes of their texts (but for chance, and for a single text that is larger): all pairs of
#: a crowded bucket are formed from two blocks at a time.
BLOCK, BLOCK_BYTES = 512, 8 << 20
#: Counters of a bag of words.
_BAG = 512

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Seeds of the sketches, and of those without common k-mers.
_SEEDS, _MORE_SEEDS = (np.arange(first, first + SKETCHES, dtype=np.uint64) * _STEP for first in (1, SKETCHES + 1))
_REMEMBERED = 400_000
_MATRIX = 1 << 20
#: k-mers that a task sends on at a time.
_KMERS = 1 << 17


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case, joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < _REMEMBERED:
            self[word] = found
        return found


_HASHES = _WordHashes()


def kmers(tokens: list[str], k: int = K) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers in text order; fewer than k words are one k-mer."""
    h = np.fromiter(map(_HASHES.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    k = min(k, len(h))
    total = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        total = _mixed(total + h[i : len(h) - k + 1 + i] + _STEP)
    order = np.argsort(total, kind="stable")
    ordered = total[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    if not new.all():
        starts = np.flatnonzero(new)
        number = np.arange(len(total)) - np.repeat(starts, np.diff(np.append(starts, len(total))))
        occurrence = np.empty(len(total), dtype=np.uint64)
        occurrence[order] = number.astype(np.uint64)
        total = np.where(occurrence > 0, _mixed(total + occurrence * _STEP), total)
    return total


def kinds(words: int) -> list[tuple[int, int]]:
    """(length of a k-mer, k-mers in a sketch) of the kinds of sketches that a text of so many words has."""
    return [(1, SAMPLED_WORDS)] * (0 < words <= SHORT) + [(K, SAMPLED)] * (words >= SIMILARITY * SHORT)


def sketches(tokens: list[str], without: np.ndarray | None = None) -> np.ndarray:
    """One hash per sketch: of its smallest k-mers in text order, and its number.

    `without` are k-mers that take no part, under seeds of their own; a text with too few others has no such sketches.
    """
    found = [np.zeros(0, dtype=np.int64)]
    for k, sampled in kinds(len(tokens)):
        h = kmers(tokens, k)
        if without is None:
            found.append(_least(h, sampled)[0])
        elif (keep := ~np.isin(h, without)).sum() >= sampled:
            found.append(_least(h[keep], sampled, _MORE_SEEDS)[0])
    return np.concatenate(found)


def sketched_kmers(tokens: list[str], buckets: list[int]) -> np.ndarray:
    """The k-mers of those sketches of a text whose hashes are among `buckets`."""
    found = [np.zeros(0, dtype=np.uint64)]
    for k, sampled in kinds(len(tokens)):
        h = kmers(tokens, k)
        hashes, places = _least(h, sampled)
        found.append(h[places[np.isin(hashes, buckets)]].ravel())
    return np.unique(np.concatenate(found))


def _least(h: np.ndarray, sampled: int, all_seeds: np.ndarray = _SEEDS) -> tuple[np.ndarray, np.ndarray]:
    """Per seed the hash of the sketch, and the places of its k-mers."""
    size, rows = min(sampled, len(h)), max(1, _MATRIX // len(h))
    out, places = [], []
    for at in range(0, SKETCHES, rows):
        seeds = all_seeds[at : at + rows, None]
        values = _mixed(h[None, :] ^ seeds)
        least = np.argpartition(values, size - 1, axis=1)[:, :size] if size < len(h) else np.tile(np.arange(size), (len(seeds), 1))
        least.sort(axis=1)
        total = seeds[:, 0].copy()
        for column in range(size):
            total = _mixed(total + h[least[:, column]])
        out.append(total)
        places.append(least)
    return np.concatenate(out).view(np.int64), np.concatenate(places)


def edit_distance(a: list[str], b: list[str], most: int) -> int | None:
    """Word edits (insert, delete, replace) from a to b, or None if more than `most`.

    Words that both begin or end with are no edits. Between them only the diagonals that can lie on a path of
    `most` edits are aligned, all at once: for each word of b, whole numbers hold the band's cells as
    bits, where a row of the alignment rises or falls (bit-parallel, as in Myers 1999 and Hyyro 2003). The last
    diagonal never falls, so the alignment stops once it has passed `most`.
    """
    begin = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        begin += 1
    end = 0
    for x, y in zip(reversed(a[begin:]), reversed(b[begin:]), strict=False):
        if x != y:
            break
        end += 1
    a, b = a[begin : len(a) - end], b[begin : len(b) - end]
    last = len(a) - len(b)
    if abs(last) > most:
        return None
    # Each edit changes at most one word of the bag.
    if max(len(a), len(b)) - sum((Counter(a) & Counter(b)).values()) > most:
        return None
    # bit k of the band is the cell `low` diagonals above the main one, plus k; `goal` is the diagonal of the end
    low = (most - last) // 2
    width = low + (most + last) // 2 + 1
    band, goal = (1 << width) - 1, last + low
    where: dict[str, int] = {}
    for i, word in enumerate(a):
        where[word] = where.get(word, 0) | 1 << i
    rises, falls, edits = band >> low << low, 0, max(last, 0)
    for j, word in enumerate(b):
        found = where.get(word, 0)
        equal = (found >> j - low if j >= low else found << low - j) & band
        level = ((((equal & rises) + rises) ^ rises) | equal | falls) & band
        across = falls | (band & ~(level | rises))
        down = level & rises
        edits += not level >> goal & 1
        if edits > most:
            return None
        level >>= 1
        rises, falls = down | (band & ~(level | across)), level & across
    return edits


def similar(a: str, b: str, similarity: float = SIMILARITY) -> float | None:
    """1 - edits / words of the longer text, or None below `similarity`."""
    x, y = a.split(" "), b.split(" ")
    longer = max(len(x), len(y))
    found = edit_distance(x, y, int((1 - similarity) * longer + 1e-9))
    return None if found is None else 1 - found / longer


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, node (hash of the words; of the text where it has none), sequence."""
    text = text_or_empty(text_col)
    frame = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), words(text).alias("sequence"))
    return frame.select("doc_id", F.unhex(F.md5(F.when(F.col("sequence") != "", F.col("sequence")).otherwise(F.concat(F.lit("\n"), "text")))).alias("node"), "sequence")


def _sketched(rows: DataFrame) -> DataFrame:
    """doc_id, node, sketches."""

    def run(batches: Iterator) -> Iterator:
        for keys, texts in batches:
            yield [*keys, [sketches(t.split(" ") if t else []).tolist() for t in texts]]

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, ["doc_id", "node"], "sequence", f"doc_id {kind}, node binary, sketches array<bigint>", run)


_CROWDED = f"n > {REPRESENTATIVES + 1}"


def _members(nodes: DataFrame) -> DataFrame:
    return nodes.select("node", F.explode("sketches").alias("bucket"))


def _heads(members: DataFrame) -> DataFrame:
    """bucket, n, others: the representatives of each bucket of two members or more.

    Representatives are the smallest members in fixed orders, found with partial aggregation. The
    orders are the same in all buckets, so a group of near copies meets the same few texts everywhere
    and the pairs grow with the number of members, not with its square.
    """
    order = lambda r: F.struct(F.xxhash64(F.lit(r), F.col("node")).alias("o"), F.col("node"))
    heads = (
        members.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), *[F.min(order(r)).alias(f"r{r}") for r in range(REPRESENTATIVES)])
        .where("n > 1")
        .select("bucket", "n", F.array_distinct(F.array(*[F.col(f"r{r}.node") for r in range(REPRESENTATIVES)])).alias("others"))
    )
    # Written out, so that joins to it are plain: adaptive execution splits a bucket of many members.
    return settle(heads, "bucket-heads")


def _candidates(members: DataFrame, heads: DataFrame) -> DataFrame:
    """Pairs (node, other, n): each member of a bucket with the representatives of the bucket; n counts
    the buckets in which they meet."""
    return (
        members.join(heads.drop("n"), "bucket")
        .select("node", F.explode("others").alias("other"))
        .where("node <> other")
        .groupBy("node", "other")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bag(tokens: list[str]) -> np.ndarray:
    """Words counted by a hash, up to 255. An edit adds one word at most and takes one at most, so two texts are
    at least as many edits apart as either side's surplus over the other."""
    h = np.fromiter(map(_HASHES.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    return np.minimum(np.bincount((h % np.uint64(_BAG)).astype(np.int64), minlength=_BAG), 255).astype(np.uint8)


def near_bags(
    left: np.ndarray, right: np.ndarray, lengths: np.ndarray, labels: np.ndarray, bags: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of a left and a right row, of different labels, that their lengths and bags leave possible."""
    right = right[np.argsort(lengths[right], kind="stable")]
    ordered, signed = lengths[right], bags[right].astype(np.int16)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for i in left:
        # the shorter text has at least `similarity` times the words of the longer
        low = np.searchsorted(ordered, int(similarity * lengths[i]) - 1)
        high = np.searchsorted(ordered, int(lengths[i] / similarity) + 1, "right")
        at = low + np.flatnonzero(labels[right[low:high]] != labels[i])
        most = ((1 - similarity) * np.maximum(ordered[at], lengths[i]) + 1e-9).astype(np.int64)
        apart = signed[at] - bags[i].astype(np.int16)
        more, less = np.maximum(apart, 0).sum(1), np.maximum(-apart, 0).sum(1)
        others = right[at[np.maximum(more, less) <= most]]
        found.append((np.full(len(others), i), others))
    return np.concatenate([f for f, _ in found]), np.concatenate([o for _, o in found])


_GROUP = ["bucket", "low", "high"]


def _crowded_links(texts: DataFrame, members: DataFrame, heads: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """node, other: labels that links between members of crowded buckets join to each other.

    Every member meets every other of its bucket, block by block, so that no task holds more than two blocks
    of a bucket; a pair counts in the first bucket that it shares. Texts move only to blocks where lengths and bags of
    words leave a pair of theirs possible. Pairs are formed and aligned inside a block and do not leave it:
    of the links, those go out that join labels not joined yet.
    """
    members = members.join(heads.where(_CROWDED).select("bucket"), "bucket").join(labels, "node", "left")
    members = settle(members.select("bucket", "node", F.coalesce("label", "node").alias("label")), "crowded-members")
    opened = members.groupBy("bucket").agg(F.min("label").alias("first"), F.max("label").alias("last")).where("first <> last")
    members = members.join(settle(opened.select("bucket"), "open-buckets"), "bucket")
    asked = settle(members.groupBy("node", "label").agg(F.collect_list("bucket").alias("buckets")), "open-nodes")

    def bagged(batches: Iterator) -> Iterator:
        for (*keys, size), found in batches:
            tokens = [t.split(" ") for t in found]
            yield [*keys, size, [len(t) for t in tokens], [bag(t).tobytes() for t in tokens]]

    sized = texts.join(asked, "node").withColumn("size", F.octet_length("sequence").cast("long"))
    schema = "node binary, label binary, buckets array<bigint>, size long, words long, bag binary"
    bags = settle(map_texts(sized, ["node", "label", "buckets", "size"], "sequence", schema, bagged), "bags")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_BYTES)).alias("blocks")
    blocks = settle(bags.select("size", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(blocks), "blocks")
    met = bags.select("node", "label", "buckets", "words", "bag", F.explode("buckets").alias("bucket")).join(blocks, "bucket")
    earlier = F.filter("buckets", lambda other: other < F.col("bucket")).alias("earlier")
    block = F.pmod(F.xxhash64("node"), "blocks").alias("block")
    met = met.select(
        "bucket", "node", "label", earlier, "words", "bag", block, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with")
    )
    met = met.select(
        "bucket", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "node", "label", "earlier", "words", "bag"
    )

    def possible(key: tuple, table: pa.Table) -> tuple[pa.Table, list[tuple[int, int]]]:
        """The rows of a block, and its pairs that may be similar and share no earlier bucket."""
        table = table.combine_chunks()
        block, lengths = table["block"].to_numpy(), table["words"].to_numpy()
        bags = np.frombuffer(b"".join(table["bag"].to_pylist()), np.uint8).reshape(-1, _BAG)
        number = np.unique(np.array([x.hex() for x in table["label"].to_pylist()]), return_inverse=True)[1]
        earlier = [frozenset(e) for e in table["earlier"].to_pylist()]
        left, right = (np.flatnonzero(block == k.as_py()) for k in key[1:])
        places = near_bags(left, right, lengths, number, bags, similarity)
        found = zip(*(x.tolist() for x in places), strict=True)
        # inside one block a pair is found from both sides
        return table, [(i, j) for i, j in found if (key[1] != key[2] or i < j) and earlier[i].isdisjoint(earlier[j])]

    def involved(key: tuple, table: pa.Table) -> pa.Table:
        table, found = possible(key, table)
        return table.take(pa.array(sorted({i for pair in found for i in pair}), pa.int64()))

    def linked(key: tuple, table: pa.Table) -> pa.Table:
        table, found = possible(key, table)
        sequence = [value.decode("utf-8", "replace") for value in table["sequence"].to_pylist()]
        label = table["label"].to_pylist()
        root = {x: x for x in label}

        def top(x: bytes) -> bytes:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        joined = []
        for i, j in found:
            mine, theirs = top(label[i]), top(label[j])
            if mine != theirs and similar(sequence[i], sequence[j], similarity) is not None:
                root[max(mine, theirs)] = min(mine, theirs)
                joined.append((min(label[i], label[j]), max(label[i], label[j])))
        return pa.table([pa.array([x[side] for x in joined], pa.binary()) for side in (0, 1)], names=["node", "other"])

    near = settle(met.groupBy(*_GROUP).applyInArrow(involved, met.schema), "crowded-near")
    both = near.join(texts.select("node", F.col("sequence").cast("binary").alias("sequence")), "node")
    return both.groupBy(*_GROUP).applyInArrow(linked, "node binary, other binary").distinct()


def _texts(rows: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """node, sequence of all members. One row's text stands for all rows of a node."""
    involved = settle(members.select("node").distinct(), "near-nodes")
    chosen = involved.join(nodes, "node").select(F.col("node").alias("_node"), "first_id")
    return (
        rows.join(chosen, (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("node", "sequence")
        .dropDuplicates(["node"])
    )


def _links(texts: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose alignment reaches the similarity."""
    theirs = texts.select(F.col("node").alias("other"), F.col("sequence").alias("other_sequence"))
    both = pairs.select("node", "other").join(texts, "node").join(theirs, "other")

    def run(batches: Iterator) -> Iterator:
        for (node, other, theirs), texts in batches:
            found = [similar(a, b, similarity) for a, b in zip(texts, theirs.to_pylist(), strict=True)]
            keep = [value is not None for value in found]
            yield [node.filter(_mask(keep)), other.filter(_mask(keep)), [v for v in found if v is not None]]

    return map_texts(both, ["node", "other", "other_sequence"], "sequence", "node binary, other binary, similarity double", run)


def _labels(texts: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """node, label of all nodes that a link joins to another.

    Each node is first aligned with the representative that it meets most often. Of the other pairs,
    those that this already put into one component need no alignment; the rest is aligned, and joins
    components to each other.
    """
    best = pairs.groupBy("node").agg(F.max(F.struct("n", "other")).alias("best")).select("node", "best.other")
    best = settle(best, "best-pairs")
    first = settle(components(settle(_links(texts, best, similarity), "links")), "labels")
    mine = first.select("node", F.col("label").alias("mine"))
    theirs = first.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
    rest = (
        pairs.join(best, ["node", "other"], "left_anti")
        .join(mine, "node", "left")
        .join(theirs, "other", "left")
        .select("node", "other", F.coalesce("mine", "node").alias("mine"), F.coalesce("theirs", "other").alias("theirs"))
        .where("mine <> theirs")
    )
    return _joined(texts, first, settle(rest, "open-pairs"), similarity)


def _joined(texts: DataFrame, labels: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """node, label after the links among the pairs (node, other, mine, theirs) joined components to each other."""
    links = _links(texts, pairs, similarity).join(pairs, ["node", "other"])
    return _merged(labels, links.select(F.col("mine").alias("node"), F.col("theirs").alias("other")).distinct())


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """node, label after links between labels (node, other) joined their components."""
    joined = components(settle(links, "links"))
    alone = joined.select("node", F.col("node").alias("label")).join(labels, "node", "left_anti")
    final = joined.select(F.col("node").alias("label"), F.col("label").alias("last"))
    return labels.unionByName(alone).join(final, "label", "left").select("node", F.coalesce("last", "label").alias("label"))


def _mask(keep: list[bool]) -> pa.Array:
    return pa.array(keep, pa.bool_())


def components(links: DataFrame) -> DataFrame:
    """node, label of all linked nodes: the smallest node of its connected component.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    paths shorten fast. Labels are aggregated per task before they move; every round is written out.
    """
    edges = settle(
        links.select("node", "other").unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other"))), "edges"
    )
    labels = settle(edges.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        )
        lower = settle(labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was")), "lower")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = settle(lower.join(jump, "label").select("node", "was", F.col("next").alias("label")), "labels")
        if after.where("label <> was").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, class_id, class_size (rows), kept.

    Rows are linked if the edit similarity of their words reaches `similarity`, and a class is a
    connected component of links; class_id is its smallest doc_id, whose row is kept (rows that repeat
    that id all are; NULL ids rank last). Equal word sequences always share a class. Texts without
    words (NULL, empty, only signs) share a class only with equal texts, NULL counting as empty. An
    empty table gives no rows.

    Only hashes are shuffled for all rows; texts move only where a candidate needs them.
    """
    rows = _rows(docs, id_col, text_col)
    sketched = settle(_sketched(rows), "sketches")
    nodes = sketched.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("sketches").alias("sketches")
    )
    nodes = settle(nodes, "nodes")
    ids, members = nodes.select("node", "first_id"), _members(nodes)
    heads = _heads(members)
    # most buckets have one member: the others move on alone
    members = settle(members.join(heads.select("bucket"), "bucket"), "shared-members")
    texts = settle(_texts(rows, ids, members), "near-texts")
    pairs = settle(_candidates(members, heads), "pairs")
    labels = settle(_labels(texts, pairs, similarity), "star-labels")
    labels = _merged(labels, _crowded_links(texts, members, heads, labels, similarity))
    labelled = nodes.select("node", "first_id", "copies").join(labels, "node", "left")
    labelled = settle(labelled.withColumn("label", F.coalesce("label", "node")), "labelled")
    classes = labelled.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    by_node = labelled.select("node", "label").join(settle(classes, "classes"), "label").select("node", "class_id", "class_size")
    by_node = settle(by_node, "node-classes")
    return (
        sketched.select("doc_id", "node")
        .join(by_node, "node")
        .select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
    )


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, with all its columns."""
    kept = near_classes(docs, similarity, id_col, text_col).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept_id"]), "left_semi")
