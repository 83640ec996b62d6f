"""Vectors as whole numbers: scaling in the JVM, Arrow batches as arrays, sums over all rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import _typed


def scaled(frame: DataFrame, factor: int, offset: int = 0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns (id_col, v): each entry c, as double, becomes the whole number floor(factor * c) + offset.

    Rows whose vector is NULL or holds a NULL or an entry that is not finite are left out.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vector = F.col(vector_col).cast("array<double>")
    whole = F.transform(vector, lambda x: F.floor(x * F.lit(float(factor))) + F.lit(offset).cast("long"))
    return frame.where(vector.isNotNull() & F.forall(vector, finite)).select(id_col, whole.alias("v"))


def padded(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """A list column as a matrix; shorter rows end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(int(sizes.max(initial=0)), width or 0)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """A list column as a matrix of rows of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (column.value_lengths().to_numpy(zero_copy_only=False) != width).any():
        raise ValueError(f"a vector has not {width} entries as the others")
    return flat.reshape(len(column), width)


def add_up(rows: DataFrame, measure: Callable[[pa.ListArray], np.ndarray], kind: str) -> np.ndarray:
    """Element-wise sum, over all Arrow batches of `v`, of the array that `measure` gives for one.

    A task adds up its batches, Spark adds up the tasks; only the sum reaches the driver.
    """
    schema = f"part array<{kind}>"

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = measure(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["part"])

    parts = rows.select("v").mapInArrow(_typed(run, schema), schema)
    sums = parts.select(F.posexplode("part").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    return np.array([x for _, x in sorted(sums.collect())])
