"""Integrity joins. Sides are never forced to broadcast: Catalyst decides by size,
and adaptive execution splits the skewed partitions of sort-merge joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def new_keys(candidates: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidate rows whose key is not present yet."""
    return candidates.join(existing.select(*keys), on=list(keys), how="left_anti")


def enforce_fks(
    df: DataFrame,
    references: Mapping[str, DataFrame],
    observations: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """Keep rows whose every foreign key exists in its reference table.

    `references` maps the key column (same name on both sides) to the reference.
    With `observations`, the rows left after each key are counted by the same job, and all rows
    under the key "".
    """
    kept = df
    if observations and "" in observations:
        kept = kept.observe(observations[""], F.count(F.lit(1)).alias("rows"))
    for key, reference in references.items():
        kept = kept.join(reference.select(key), on=key, how="left_semi")
        if observations and key in observations:
            kept = kept.observe(observations[key], F.count(F.lit(1)).alias("rows"))
    return kept


def orphans(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose key is missing in the reference, NULL keys included."""
    return df.join(reference.select(key), on=key, how="left_anti")


def orphan_keys(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Distinct missing keys; the distinct runs first so that copies never reach the join."""
    return orphans(distinct_keys(df, [key]), reference, key)


def enrich(df: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join against a side that holds one row per key."""
    return df.join(side, on=list(keys), how="left")


def update_from(
    df: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    assignments: Mapping[str, Column],
    condition: Column,
    flag: str | None = None,
) -> DataFrame:
    """Rewrite columns of rows that match `source` (one row per key) and meet `condition`.

    Source columns other than the keys are visible to both expressions under a
    `new_` prefix. Column order and row count are kept; `flag` adds a column that marks
    the rewritten rows.
    """
    renamed = source.select(
        *keys,
        *[F.col(c).alias(f"new_{c}") for c in source.columns if c not in set(keys)],
        F.lit(True).alias("_matched"),
    )
    hit = F.col("_matched").isNotNull() & condition
    joined = df.join(renamed, on=list(keys), how="left")
    return joined.select(
        *[
            F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
            for c in df.columns
        ],
        *([F.coalesce(hit, F.lit(False)).alias(flag)] if flag else []),
    )
