"""Removal of repeated byte strings, by suffix sorting.

Every string of LENGTH bytes holds a gram of GRAM bytes whose hash is smallest in it, its anchor. Equal
strings have equal anchors at equal distances, so the starts of all strings are dealt out by anchor
and distance, in pieces of neighbouring starts. What cannot repeat is dropped first, by counts: anchors
that occur once, and pieces whose common core occurs once. Identical pieces are counted, not moved.
The pieces that remain, where repeated text begins and ends, are suffix-sorted group by group,
deep-shallow: multikey quicksort orders the first bytes, blind tries order what they leave equal.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import _typed, settle, sha256, text_or_empty
from tidemark.session import work_dir

LENGTH = 400
GRAM = 32
#: Neighbouring starts in a piece.
PIECE = 64
#: Groups of more distinct pieces than this are cut into single starts, which need counts only.
SORTED_PIECES = 5_000
#: Multikey quicksort orders this many bytes, as whole words of WORD bytes.
SHALLOW, WORD = 24, 8
#: Bytes of one text that are scanned at a time.
_SCAN = 1 << 21
_PLACE = np.uint64((1 << 22) - 1)
_ODD = [np.uint64(k * 2 + 1) for k in (0x4F2162926E40C299, 0x6C62272E07BB0142, 0x51EB851EB851EB85, 0x3C6EF372FE94F82B, 0x2545F4914F6CDD1D)]
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (hash, place, first, last): the starts first..last share the anchor at `place`.

    `gram` is a power of two. Of equal hashes in a string the leftmost is its anchor.
    """
    step = _SCAN - length + 1
    for offset in range(0, max(0, len(data) - length + 1), step):
        h = np.frombuffer(data, dtype=np.uint8, count=min(_SCAN, len(data) - offset), offset=offset).astype(np.uint64) + np.uint64(1)
        size = 1
        for odd in _ODD[: gram.bit_length() - 1]:
            h = h[:-size] * odd + h[size:]
            h ^= h >> np.uint64(29)
            size *= 2
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h ^= h >> np.uint64(32)
        places = (_smallest((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        last = np.append(first[1:], len(places)) - 1
        at = places[first]
        yield h[at].view(np.int64), at + offset, first + offset, last + offset


def pieces(data: bytes, spans: list[tuple[int, int, int]], piece: int, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple]:
    """(core, hull, first, last) of the pieces of spans (place, first, last).

    A piece holds the starts whose distance to the anchor lies in one cell of a fixed grid. `core`
    identifies the bytes that all strings of the cell share, `hull` all bytes of the piece.
    """
    widest = length - gram
    for place, first, last in spans:
        for cell in range((place - last) // piece, (place - first) // piece + 1):
            near, far = cell * piece, min(cell * piece + piece - 1, widest)
            low, high = max(first, place - far), min(last, place - near)
            core = hashlib.blake2b(data[place - near : place - far + length], digest_size=16, salt=cell.to_bytes(4, "big"))
            shape = (place - low).to_bytes(4, "big") + (high - low).to_bytes(4, "big")
            hull = hashlib.blake2b(data[low : high + length], digest_size=16, salt=shape)
            yield core.digest(), hull.digest(), low, high


def suffix_order(strings: list[bytes]) -> list[list[int]]:
    """Indices of the strings in sorted order, equal ones together: deep-shallow sorting."""
    out: list[list[int]] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) == 1:
            out.append(rows)
        elif depth >= SHALLOW:
            out.extend(_blind_trie(strings, rows))
        else:
            keys = {i: strings[i][depth : depth + WORD] for i in rows}
            pivot = sorted(keys[i] for i in (rows[0], rows[len(rows) // 2], rows[-1]))[1]
            parts: tuple[list[int], ...] = ([], [], [])
            for i in rows:
                key = keys[i]
                parts[(key >= pivot) + (key > pivot)].append(i)
            for part, below in ((parts[2], depth), (parts[1], depth + WORD), (parts[0], depth)):
                if part:
                    stack.append((part, below))
    return out


def _blind_trie(strings: list[bytes], rows: list[int]) -> list[list[int]]:
    """Order strings of one length by a blind trie: inner nodes keep only how many bytes agree below them.

    A string walks down by the bytes at those depths alone, is compared with one leaf it ends at, and
    hangs in where it first differs.
    """
    root: list = [None, [rows[0]]]  # [depth, leaf] or [depth, {byte: node}]
    for i in rows[1:]:
        new, node = strings[i], root
        while node[0] is not None:
            node = node[1].get(new[node[0]]) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        if new == other:
            node[1].append(i)
            continue
        bits = (int.from_bytes(new, "big") ^ int.from_bytes(other, "big")).bit_length()
        depth, node = len(new) - (bits + 7) // 8, root
        while node[0] is not None and node[0] < depth:
            node = node[1][new[node[0]]]
        if node[0] == depth:
            node[1][new[depth]] = [None, [i]]
        else:
            node[:] = [depth, {other[depth]: node[:], new[depth]: [None, [i]]}]
    out, stack = [], [root]
    while stack:
        depth, below = stack.pop()
        if depth is None:
            out.append(below)
        else:
            stack.extend(below[byte] for byte in sorted(below, reverse=True))
    return out


def repeated_starts(hulls: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per hull: whether the string at each start also starts elsewhere in the group."""
    where = [(i, s) for i, hull in enumerate(hulls) for s in range(len(hull) - length + 1)]
    marks = [np.zeros(len(hull) - length + 1, dtype=bool) for hull in hulls]
    for equal in suffix_order([hulls[i][s : s + length] for i, s in where]):
        if len(equal) > 1:
            for k in equal:
                i, s = where[k]
                marks[i][s] = True
    return marks


def ranges_of(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """rid, doc_id, data, written once and bucketed by rid: later joins by rid leave the texts in place."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    (
        docs.select(
            F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), text_or_empty(text_col).cast("binary").alias("data")
        )
        .repartition(buckets, "rid")
        .write.bucketBy(buckets, "rid")
        .option("compression", "zstd")
        .option("path", work_dir(spark, "texts"))
        .saveAsTable(name)
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay for the frame
    return table


def _map(frame: DataFrame, schema: str, rows) -> DataFrame:
    """Rows to rows in Arrow batches; `rows` gets dicts batch by batch and yields lists of tuples."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def run(batches):
        for found in rows(batch.to_pylist() for batch in batches):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)] if found else [pa.nulls(0)] * len(names), names)

    return frame.mapInArrow(_typed(run, schema), schema)


def _all_anchors(table: DataFrame) -> DataFrame:
    schema = "h long, rid long, place int, first int, last int"

    def run(batches):
        for batch in batches:
            for rid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for h, place, first, last in anchors(data):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(np.full(len(h), rid)), pa.array(place), pa.array(first), pa.array(last)],
                        ["h", "rid", "place", "first", "last"],
                    )

    return table.where(F.octet_length("data") >= LENGTH).select("rid", "data").mapInArrow(_typed(_gathered(run), schema), schema)


def _gathered(run, rows: int = 50_000):
    """Join small batches: one text gives few rows."""

    def gathered(batches):
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return gathered


def _pieces_of(table: DataFrame, spans: DataFrame, piece: int) -> DataFrame:
    """core, hull, rid, place, first, last for spans (rid, place, first, last)."""
    per_text = spans.groupBy("rid").agg(F.collect_list(F.struct("place", "first", "last")).alias("spans"))

    def rows(batches):
        for batch in batches:
            found = []
            for row in batch:
                for place, first, last in ((s["place"], s["first"], s["last"]) for s in row["spans"]):
                    found += [(core, hull, row["rid"], place, a, b) for core, hull, a, b in pieces(row["data"], [(place, first, last)], piece)]
            yield found

    joined = table.select("rid", "data").join(per_text, "rid").select("rid", "data", "spans")
    return _map(joined, "core binary, hull binary, rid long, place int, first int, last int", rows)


def _sorted_groups(table: DataFrame, work: DataFrame) -> DataFrame:
    """Suffix-sort groups of pieces; rid, first, last of the repeated starts of pieces that occur once.

    `work` has core, copies, rid, first, last. Groups are dealt out by core and hold at most
    SORTED_PIECES pieces.
    """
    located = work.groupBy("rid").agg(F.collect_list(F.struct("core", "copies", "first", "last")).alias("parts"))

    def cut(batches):
        for batch in batches:
            yield [
                (p["core"], p["copies"], row["rid"], p["first"], row["data"][p["first"] : p["last"] + LENGTH])
                for row in batch
                for p in row["parts"]
            ]

    hulls = _map(table.select("rid", "data").join(located, "rid"), "core binary, copies long, rid long, first int, hull binary", cut)

    def order(batches):
        core, group = None, []
        for batch in batches:
            found = []
            for row in batch:
                if row["core"] != core:
                    found += _group_ranges(group)
                    core, group = row["core"], []
                group.append(row)
            yield found
        yield _group_ranges(group)

    buckets = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _map(hulls.repartition(buckets, "core").sortWithinPartitions("core"), "rid long, first int, last int", order)


def _group_ranges(group: list[dict]) -> list[tuple[int, int, int]]:
    marks = repeated_starts([row["hull"] for row in group]) if group else []
    return [
        (row["rid"], row["first"] + a, row["first"] + b)
        for row, mark in zip(group, marks, strict=True)
        if row["copies"] == 1
        for a, b in ranges_of(mark)
    ]


def repeated_ranges(table: DataFrame) -> DataFrame:
    """rid, first, last: all starts of strings of LENGTH bytes that also start anywhere else."""
    found = settle(_all_anchors(table), "anchors")
    # written out before they are joined, so that a hot anchor or core is one side of a plain join, which can be split
    often = settle(found.groupBy("h").count().where("count > 1").select("h"), "often")
    spans = found.join(often, "h").select("rid", "place", "first", "last")
    parts = settle(_pieces_of(table, spans, PIECE), "pieces")
    hulls = settle(
        parts.groupBy("core", "hull").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "place", "first", "last")).alias("at")
        ),
        "hulls",
    )
    cores = hulls.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("copies").alias("least")).where("n > 1 AND least = 1")
    work = settle(hulls.join(settle(cores, "cores"), "core").select("core", "copies", "n", "at.*"), "work")
    ordered = _sorted_groups(table, work.where(F.col("n") <= SORTED_PIECES))
    large = work.where(F.col("n") > SORTED_PIECES)
    single = settle(_pieces_of(table, large.select("rid", "place", "first", "last"), 1), "single-starts")
    weights = single.join(large.select("rid", "copies", F.col("place"), F.explode(F.expr("sequence(first, last)")).alias("first")), ["rid", "place", "first"])
    weights = settle(weights, "weights")
    repeats = settle(weights.groupBy("core").agg(F.sum("copies").alias("total")).where("total > 1").select("core"), "repeats")
    fine = weights.where("copies = 1").join(repeats, "core").select("rid", "first", F.col("first").alias("last"))
    whole = parts.join(hulls.where("copies > 1").select("core", "hull"), ["core", "hull"]).select("rid", "first", "last")
    return whole.unionByName(ordered).unionByName(fine)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes, on request).

    Removed is each byte of a LENGTH-byte string that also starts anywhere else, in the same text too;
    strings are judged on the input and never cross texts. NULL counts as empty. Texts shorter than
    LENGTH stay as they are. Rows are told apart by their place in the input, so repeated rows and ids
    are repeated texts, and none of their bytes stay. An empty table gives no rows.
    """
    table = _table(docs, id_col, text_col)
    found = repeated_ranges(table).groupBy("rid").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            out = []
            for row in batch:
                data, runs = row["data"], []
                for first, last in sorted((r["first"], r["last"] + LENGTH) for r in row["found"] or ()):
                    if runs and first <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], last)
                    else:
                        runs.append([first, last])
                at = [0, *(edge for run in runs for edge in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(at[::2], at[1::2], strict=True))
                result = (row["doc_id"], len(data), len(data) - len(kept), len(runs), sha256(kept))
                out.append((*result, kept) if keep_bytes else result)
            yield out

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return _map(table.join(found, "rid", "left"), schema, rows)
