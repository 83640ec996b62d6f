"""Whitening of embeddings by their leading components, found by FEAST contour integration.

Spark sums up the covariance in two scans. Its spectrum is cut into intervals of a few eigenvalues by
inertia counts: by Sylvester's law the signs of an LDL' factorisation of V - sI tell how many eigenvalues lie
above s. For each interval a task integrates the resolvent along a circle around it, by
quadrature of solves with complex shifts, which projects onto the eigenvectors inside; Rayleigh-Ritz extracts
them, and they must be as many as the inertia counted. One more Rayleigh-Ritz step over all
intervals puts them in order. Whatever depends on the number of vectors stays in Spark; what the driver holds
has the size of the covariance, which is that of the dimensions squared.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import vectors
from tidemark.llm.texts import _typed

# How entries become whole numbers.
FACTOR, OFFSET = 1024, 100_000
#: Components of less than this share of the largest variance have no direction that doubles can tell.
SMALLEST = 1e-11
#: Eigenvalues of an interval, unless they lie closer than CLOSE of the norm.
MOST, CLOSE = 3, 1e-6
#: Nodes on the upper half of the circle; those below are their mirror images.
NODES = 8
ROUNDS = 60
#: Where a stretch is cut in two; no simple fraction, so that cuts fall beside eigenvalues.
_CUT = 0.48713592


def scaled(frame: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    return vectors.scaled(frame, FACTOR, OFFSET, id_col, vector_col)


def positive_pivots(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are positive, by an LDL' factorisation with Bunch-Kaufman pivots."""
    a, n, k, positive = matrix.copy(), len(matrix), 0, 0
    alpha = (1 + 17**0.5) / 8
    while k < n:
        below = np.abs(a[k + 1 :, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        largest, pivot, pair = (below[r - k - 1] if len(below) else 0.0), abs(a[k, k]), False
        if max(largest, pivot) == 0:
            k += 1
            continue
        if pivot < alpha * largest:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            if pivot * row.max() < alpha * largest**2:
                pair = abs(a[r, r]) < alpha * row.max()
                j = k + pair
                a[[j, r]] = a[[r, j]]
                a[:, [j, r]] = a[:, [r, j]]
        if pair:
            # such a pair of rows has one eigenvalue of each sign
            positive += 1
            left = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= left @ np.linalg.solve(a[k : k + 2, k : k + 2], left.T)
            k += 2
        else:
            positive += bool(a[k, k] > 0)
            left = a[k + 1 :, k]
            a[k + 1 :, k + 1 :] -= np.outer(left, left / a[k, k])
            k += 1
    return positive


def above(matrix: np.ndarray, bound: float) -> int:
    return positive_pivots(matrix - bound * np.eye(len(matrix)))


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of disjoint intervals that hold the `wanted` largest eigenvalues."""
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    low, high = norm * SMALLEST, norm * (1 + 1e-6)
    at_low = above(matrix, low) if norm else 0
    wanted = min(wanted, at_low)
    if not wanted:
        return []
    end = high
    while at_low > wanted and end - low > CLOSE * norm:
        middle = low + _CUT * (end - low)
        found = above(matrix, middle)
        if found >= wanted:
            low, at_low = middle, found
        else:
            end = middle
    todo, out = [(low, high, at_low, 0)], []
    while todo:
        a, b, at_a, at_b = todo.pop()
        if at_a == at_b:
            continue
        # halves without eigenvalues are cut off also where few are left, so that the circle is a close one
        few, middle = at_a - at_b <= MOST, a + _CUT * (b - a)
        at_middle = above(matrix, middle) if b - a > (1e-3 * b if few else CLOSE * norm) else None
        if at_middle is None or few and at_a != at_middle != at_b:
            out.append((a, b, at_a - at_b))
        else:
            todo += [(a, middle, at_a, at_middle), (middle, b, at_middle, at_b)]
    return sorted(out)


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors (as columns) of the interval, which holds `count` of them."""
    d = len(matrix)
    norm = np.abs(matrix).sum(axis=1).max()
    angle = np.pi * (np.arange(NODES) + 0.5) / NODES
    arms = (high - low) / 2 * np.exp(1j * angle)
    space = np.random.default_rng(d).standard_normal((d, min(d, 2 * count + 6)))
    last, settled = np.inf, False
    for _ in range(ROUNDS):
        projected = sum((np.linalg.solve(((low + high) / 2 + arm) * np.eye(d) - matrix, space) * arm).real for arm in arms)
        basis = np.linalg.qr(projected / NODES)[0]
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        space = basis @ turn
        error = np.linalg.norm(matrix @ space - space * values, axis=0) / norm
        # a chance mixture of eigenvectors on both sides may have a value inside, but a large error
        inside = (values > low) & (values <= high) & (error < 1e-9)
        if inside.sum() == count:
            worst = error[inside].max()
            if settled or worst > last / 2:
                return values[inside], space[:, inside]
            settled, last = worst <= 2 * d * np.finfo(float).eps, worst
    raise ArithmeticError(f"{inside.sum()} eigenvalues found in {low}..{high}, {count} counted")


def components(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and their unit eigenvectors as columns; an interval is a task's."""
    parts = intervals(matrix, wanted)
    if not parts:
        return np.zeros(0), np.zeros((len(matrix), 0))
    schema = "value double, vector array<double>"

    def run(batches):
        for batch in batches:
            for part in batch.to_pylist():
                values, found = feast(matrix, part["low"], part["high"], part["count"])
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(found.T.tolist())], ["value", "vector"])

    dealt = spark.createDataFrame(parts, "low double, high double, count int").repartition(len(parts), "low")
    found = sorted(dealt.mapInArrow(_typed(run, schema), schema).collect(), reverse=True)
    if len(found) != sum(count for _, _, count in parts):
        raise ArithmeticError("not every interval gave its components")
    basis = np.linalg.qr(np.array([row["vector"] for row in found]).T)[0]
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1][:wanted], (basis @ turn)[:, ::-1][:, :wanted]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over the entries of (n * x - S)**2, exact: in 64 bits where that holds, else in Python's numbers."""
    top = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if top**2 * x.shape[1] < 1 << 63:
        return ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
    return [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]


def whiten(rows: DataFrame, count: int = 8, id_col: str = "vec_id") -> DataFrame:
    """Per row (id_col, v) and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    `v` holds whole numbers x of up to 2**40. With the n vectors' sums S and covariance V (divisor n), `component`
    numbers the unit eigenvectors of V by falling eigenvalue e; `deviation` is the sum of (n*x-S)**2, exact,
    NULL where 64 bits do not hold it (`deviation_exact` holds 38 digits); `whitened` is x-S/n projected on
    the component over sqrt(e); `explained` is e over the trace; `identity_error` is the largest entry by which the
    covariance of all whitened rows differs from the identity.

    Components without variance (SMALLEST) can't be whitened and are left out, so that one vector, or copies
    of one, give no rows; nor do empty vectors or an empty table. Vectors of several lengths raise an
    error. Repeated rows and ids count each, rows without id too. Equal eigenvalues have no order of their
    own: any orthonormal vectors of their space may stand for them, the same for all rows.
    """
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double, deviation_exact decimal(38,0)"
    )
    rows = rows.where(F.size("v") > 0)
    first = rows.select(F.size("v").alias("size")).first()
    if first is None:
        return spark.createDataFrame([], schema)
    d = first["size"]
    totals = vectors.add_up(rows, lambda v: np.append(vectors.matrix(v, d).sum(axis=0), len(v)), "long").tolist()
    sums, n = totals[:-1], totals[-1]
    # whole numbers around a whole centre: their products add up without rounding, in any order
    centre = np.array([s // n for s in sums])
    rest = np.array([(s % n) / n for s in sums])

    def moved(v: pa.ListArray) -> np.ndarray:
        return (vectors.matrix(v, d) - centre).astype(np.float64)

    def products(v: pa.ListArray) -> np.ndarray:
        y = moved(v)
        return (y.T @ y)[upper]

    upper = np.triu_indices(d)
    covariance = np.zeros((d, d))
    covariance[upper] = vectors.add_up(rows, products, "double") / n
    covariance = covariance + np.triu(covariance, 1).T - np.outer(rest, rest)
    values, found = components(spark, covariance, count)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    explained, directions = values / np.trace(covariance), found / np.sqrt(values)

    def whitened(v: pa.ListArray) -> np.ndarray:
        return (moved(v) - rest) @ directions

    def whitened_products(v: pa.ListArray) -> np.ndarray:
        w = whitened(v)
        return (w.T @ w).ravel()

    spread = vectors.add_up(rows, whitened_products, "double").reshape(k, k) / n
    error = float(np.abs(spread - np.eye(k)).max())

    def run(batches):
        for batch in batches:
            m, v = batch.num_rows, batch.column(1)
            exact = deviations(vectors.matrix(v, d), n, sums)
            longs = pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())
            wide = longs if not longs.null_count else pa.array([Decimal(x) for x in exact])
            each = pa.array(np.repeat(np.arange(m), k))
            columns = [
                batch.column(0).take(each),
                pa.array(np.tile(np.arange(1, k + 1), m)),
                pa.array(np.full(m * k, n)),
                longs.take(each),
                pa.array(whitened(v).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
                wide.cast(pa.decimal128(38, 0)).take(each),
            ]
            yield pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])

    return rows.select(id_col, "v").mapInArrow(_typed(run, schema), schema)
