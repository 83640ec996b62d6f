"""Exact top-k search by inner product, over impact-ordered posting segments.

All vectors are dealt out to shards. A shard keeps, for each dimension, its rows in segments of nearly equal
entries. A query takes the segments of all dimensions score at a time: by falling impact, which is the
most that an entry of the segment can add. Sums of those impacts, and the most that the segments still
to come could add, bound each row's score from above. Rows whose bound is below the k-th best score known
exactly are out for certain; the shard is done when few others are left, and those are scored
exactly. Segments that could only lower a score are never read.

Every shard meets every query, since nothing less is exact; queries stream through a shard in batches,
and only their k best rows leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import vectors
from tidemark.llm.texts import _typed, settle

# Fixed value: how entries become whole numbers.
FACTOR = 256
#: Rows of a shard: what a task holds. There are more shards than this asks for while cores would idle.
SHARD_ROWS, LEAST_ROWS = 1 << 17, 1 << 10
#: Segments of a dimension, for entries of one sign.
LEVELS = 8
#: Bounds are looked at after these shares of a query's segments; the search stops when at most one row in FEW is left.
LOOKS, FEW = (0.25, 0.5, 0.75, 1.0), 64


def scaled(frame: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    return vectors.scaled(frame, FACTOR, 0, id_col, vector_col)


class Shard:
    """Posting segments of some rows: `rows` is a matrix of whole numbers."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        n, d = rows.shape
        step = max(1, -(-int(np.abs(rows).max(initial=0)) // LEVELS))
        postings, dims, starts, lows, highs = [], [], [], [], []
        for j in range(d):
            column = rows[:, j]
            order = np.argsort(column, kind="stable").astype(np.int32)
            sorted_column = column[order]
            level = np.sign(sorted_column) * -(-np.abs(sorted_column) // step)
            first = np.flatnonzero(np.append(True, level[1:] != level[:-1])[:n])
            postings.append(order)
            dims.append(np.full(len(first), j))
            starts.append(first + j * n)
            lows.append(sorted_column[first])
            highs.append(sorted_column[np.append(first[1:], n)[: len(first)] - 1])
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.postings, self.dims, self.starts = join(postings), join(dims), join(starts)
        self.ends = np.append(self.starts[1:], len(self.postings))[: len(self.starts)]
        self.lows, self.highs = join(lows), join(highs)

    def segments(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segments that can raise a score, by falling impact; their impacts; and the most that a row
        can still gain before the first of them, after the first, after the second and so on."""
        weight = query[self.dims]
        impact = weight * np.where(weight > 0, self.highs, self.lows)
        useful = np.flatnonzero(impact > 0)
        impact = impact[useful]
        # of each dimension only what comes next counts: a row has one entry in it
        by = np.lexsort((-impact, self.dims[useful]))
        same = np.append(self.dims[useful][by][1:] == self.dims[useful][by][:-1], False)[: len(by)]
        drop = np.empty_like(impact)
        drop[by] = impact[by] - np.where(same, np.append(impact[by][1:], 0)[: len(by)], 0)
        order = np.argsort(-impact, kind="stable")
        left = drop.sum() - np.concatenate([[0], np.cumsum(drop[order])])
        return useful[order], impact[order], left

    def best(self, query: np.ndarray, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may be among the k best, all ties with the k-th included, and their exact scores.
        The row `own` takes no part."""
        n = len(self.rows)
        chosen, impact, left = self.segments(query)
        small = n and left[0] < 1 << 31
        total, begin = np.zeros(n, np.int32 if small else np.int64), 0
        starts, ends, postings = self.starts[chosen].tolist(), self.ends[chosen].tolist(), self.postings
        steps = impact.tolist()
        for share in LOOKS:
            end = ceil(share * len(chosen))
            for t in range(begin, end):
                total[postings[starts[t] : ends[t]]] += steps[t]
            begin = end
            alive = self._alive(query, k, own, total, int(left[end]))
            if len(alive) <= n // FEW:
                break
        return alive, self.rows[alive] @ query

    def _alive(self, query: np.ndarray, k: int, own: int, total: np.ndarray, left: int) -> np.ndarray:
        """Rows whose bound reaches the k-th best of some exact scores; with fewer rows than that, all."""
        n, ahead = len(total), k + 1 + 2 * k
        if n > ahead:
            some = np.argpartition(total, n - ahead)[n - ahead :]
            exact = np.sort((self.rows[some[some != own]] @ query))
            alive = np.flatnonzero(total.astype(np.int64) + left >= exact[-k])
        else:
            alive = np.arange(n)
        return alive[alive != own]


def _answers(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[list]:
    """Rows of shards, each followed by the queries: (query_rid, query_id, vec_id, score) of each query's k best rows."""
    held: list[pa.RecordBatch] = []
    current, shard = None, None
    rids = ids = None
    for batch in batches:
        numbers, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
            part = batch.slice(a, b - a)
            if not part.num_rows:
                continue
            if numbers[a] != current:
                current, held, shard = numbers[a], [], None
            if kinds[a] == 0:
                held.append(part)
                continue
            if shard is None:
                width = max((int(p.column(4).value_lengths().to_numpy().max()) for p in held), default=0)
                rows = [vectors.padded(p.column(4), width) for p in held]
                shard = Shard(np.concatenate(rows) if rows else np.zeros((0, 0), np.int64))
                rids = np.concatenate([p.column(2).to_numpy() for p in held] or [np.zeros(0, np.int64)])
                ids = [x for p in held for x in p.column(3).to_pylist()]
                place = np.argsort(rids)
                held = []
            yield _of_queries(part, k, shard, rids, ids, place)


def _of_queries(part: pa.RecordBatch, k: int, shard: Shard, rids: np.ndarray, ids: list, place: np.ndarray) -> list:
    out: tuple[list, ...] = ([], [], [], [])
    width = shard.rows.shape[1]
    for rid, query_id, query in zip(
        part.column(2).to_pylist(), part.column(3).to_pylist(), vectors.padded(part.column(4), width), strict=True
    ):
        at = np.searchsorted(rids, rid, sorter=place)
        own = int(place[at]) if at < len(rids) and rids[place[at]] == rid else -1
        alive, scores = shard.best(query[:width], k, own)
        if len(alive) > k:
            # ties with the k-th best go by id, so all of them stay until ids are compared
            near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            alive, scores = alive[near], scores[near]
        ranked = sorted((-s, ids[i] is None, ids[i], s) for i, s in zip(alive.tolist(), scores.tolist(), strict=True))[:k]
        out[0].extend([rid] * len(ranked))
        out[1].extend([query_id] * len(ranked))
        out[2].extend(r[2] for r in ranked)
        out[3].extend(r[3] for r in ranked)
    return list(out)


def search(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id") -> DataFrame:
    """Per query its k best rows: query_id, rank (from 1), vec_id, score.

    `rows` has id_col and `v`, whole numbers; rows for which `is_query` holds are the queries, and all rows but
    the query's own are candidates. Score is the inner product, exact; a query has fewer than k rows only where
    there are fewer others. Ties go to the smaller id, rows without id last. A shorter vector counts as
    ended by zeros, an empty one as all zeros. Repeated ids and copies of a vector are rows of their own: copies
    of a query are candidates for it, and each query row has its answers. Entries must be so small that a score
    fits 62 bits; others raise an error. An empty table, or one without queries, gives no rows.
    """
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    table = settle(
        rows.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(id_col).alias("id"),
            "v",
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ),
        "vectors",
    )
    size = F.array_max(F.transform("v", lambda x: F.abs(x)))
    total, largest, width = table.agg(F.count(F.lit(1)), F.max(size), F.max(F.size("v"))).first()
    if (largest or 0) ** 2 * max(width or 0, 1) >= 1 << 62:
        raise ValueError("scores of these vectors do not fit 62 bits")
    cores = spark.sparkContext.defaultParallelism
    shards = max(1, ceil(total / SHARD_ROWS), min(cores, ceil(total / LEAST_ROWS)))
    number = F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int").alias("shard")
    members = table.select(number, F.lit(0).alias("kind"), "rid", "id", "v")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asked = table.where("asks").select(everywhere, F.lit(1).alias("kind"), "rid", "id", "v")
    dealt = members.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions("shard", "kind")
    schema = f"query_rid long, query_id {kind}, vec_id {kind}, score long"
    names = ["query_rid", "query_id", "vec_id", "score"]

    def run(batches):
        for columns in _answers(batches, k):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    best = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (
        dealt.mapInArrow(_typed(run, schema), schema)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
