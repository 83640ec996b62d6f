"""Projection, required-key filter and reproducible key dedupe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.columns import to_int


def project(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Named, ordered projection in one Project node."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def longs_to_ints(df: DataFrame) -> DataFrame:
    """Narrow every bigint column to int, in one projection."""
    return df.select(
        *[
            to_int(f.name).alias(f.name) if isinstance(f.dataType, T.LongType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all present. Plain IS NOT NULL tests, unlike dropna, reach the
    Parquet scan."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, the first in `order` (default: all other columns, values before NULLs).

    The `row_number = 1` filter becomes a WindowGroupLimit on both sides of the
    shuffle: each map task passes on at most one row per key, so a key holding a
    large part of the rows never meets in one task.
    """
    if order is None:
        order = [F.col(c).asc_nulls_last() for c in df.columns if c not in set(keys)]
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def latest_per(df: DataFrame, key: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """Values of the newest row per key; equal times resolve to the greatest values."""
    newest = F.max(F.struct(F.col(ts), *[F.col(v) for v in values])).alias("_newest")
    return df.groupBy(*key).agg(newest).select(*key, F.col(f"_newest.{ts}").alias(ts), *[
        F.col(f"_newest.{v}").alias(v) for v in values
    ])


def with_typed_null(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """Placeholder column for a side input that is missing."""
    return df.withColumn(name, F.lit(None).cast(dtype))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing on one side become NULL."""
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined
