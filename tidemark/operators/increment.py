"""Which keys, snapshots and tables need work. All answers stay distributed frames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.operators.clean import latest_per
from tidemark.operators.joins import distinct_keys
from tidemark.operators.ordered import chunked


def key_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, change) with change 'added' or 'removed'; empty when both sets are equal."""
    before = distinct_keys(old, [key]).withColumn("was", F.lit(True))
    after = distinct_keys(new, [key]).withColumn("now", F.lit(True))
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed")
    both = before.join(after, on=key, how="full").select(key, change.alias("change"))
    return both.where("change IS NOT NULL")


def change_summary(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row: added, removed, changed."""
    counts = key_changes(old, new, key).agg(
        F.count_if(F.col("change") == "added").alias("added"),
        F.count_if(F.col("change") == "removed").alias("removed"),
    )
    return counts.withColumn("changed", (F.col("added") + F.col("removed")) > 0)


def is_full_scan(today: date, next_full_scan: date | None) -> bool:
    """The first run and every run from the planned day on scan everything."""
    return next_full_scan is None or today >= next_full_scan


def ids_to_fetch(available: DataFrame, known: DataFrame | None, key: str, full_scan: bool = False) -> DataFrame:
    """Available ids that are not known yet; all of them on a first run or a full scan."""
    wanted = distinct_keys(available, [key])
    if known is None or full_scan:
        return wanted
    return wanted.join(known.select(key), on=key, how="left_anti")


def active_set(asked: DataFrame, responses: DataFrame, key: str, full_scan: bool, previous: DataFrame) -> DataFrame:
    """Ids to ask next time. `responses` has (key, has_data).

    A full scan keeps every asked id that returned data. A partial scan keeps the
    previous ids except those that were asked and returned none.
    """
    with_data = distinct_keys(responses.where("has_data"), [key])
    if full_scan:
        return distinct_keys(asked, [key]).join(with_data, on=key, how="left_semi")
    failed = distinct_keys(asked, [key]).join(with_data, on=key, how="left_anti")
    return distinct_keys(previous, [key]).join(failed, on=key, how="left_anti")


def reconcile(expected: DataFrame, parsed: DataFrame, key: str) -> DataFrame:
    """One row: expected and parsed counts, ids missing from parsed, and whether to refresh."""
    asked = distinct_keys(expected, [key]).withColumn("asked", F.lit(True))
    got = distinct_keys(parsed, [key]).withColumn("got", F.lit(True))
    counts = asked.join(got, on=key, how="full").agg(
        F.count("asked").alias("expected_count"),
        F.count("got").alias("parsed_count"),
        F.count_if(F.col("got").isNull()).alias("missing_count"),
    )
    return counts.withColumn("needs_refresh", F.col("expected_count") != F.col("parsed_count"))


def request_chunks(ids: DataFrame, key: str, size: int) -> DataFrame:
    """(chunk_id, id_count, id_list): the comma-joined ids of each request of `size`."""
    numbered = chunked(distinct_keys(ids, [key]), [F.col(key).asc()], size)
    return numbered.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("id_count"), F.array_join(F.sort_array(F.collect_list(key)), ",").alias("id_list")
    )


# run ledger ----------------------------------------------------------------


def last_entries(ledger: DataFrame, key: str, order: str) -> DataFrame:
    """The last ledger entry of every table."""
    rest = [c for c in ledger.columns if c not in (key, order)]
    return latest_per(ledger, [key], order, rest).select(*ledger.columns)


def is_newer(daily: Column) -> Column:
    """Whether `snapshot_ts` is newer than `last_ended_at`, by day or by time (UTC session).

    An unreadable snapshot time, and a table without a run, count as fresh.
    """
    at, ended = F.col("snapshot_ts"), F.col("last_ended_at")
    return F.coalesce(F.when(daily, F.to_date(at) > F.to_date(ended)).otherwise(at > ended), F.lit(True))


def fresh_snapshots(
    snapshots: DataFrame, runs: DataFrame, key: str, daily: bool = True, force: bool = False
) -> DataFrame:
    """Add `should_transform` to (key, snapshot_ts): newer than the last run of that table."""
    ended = runs.groupBy(key).agg(F.max("ended_at").alias("last_ended_at"))
    decision = F.lit(True) if force else is_newer(F.lit(daily))
    return snapshots.join(ended, on=key, how="left").withColumn("should_transform", decision)


def load_decisions(transforms: DataFrame, loads: DataFrame, key: str) -> DataFrame:
    """(key, should_load) for every table of either ledger.

    transforms: key, status, current_status, ended_at. loads: key, ended_at, transformation_ended_at.
    Never loaded: load. Never transformed: skip. Otherwise load a successful
    transformation that is not the one loaded last.
    """
    done = last_entries(transforms.select(key, "ended_at", "status", "current_status"), key, "ended_at")
    done = done.withColumnRenamed("ended_at", "transformed_at")
    loaded = last_entries(loads.select(key, "ended_at", "transformation_ended_at"), key, "ended_at")
    loaded = loaded.withColumnRenamed("ended_at", "loaded_at")
    both = done.join(loaded, on=key, how="full")
    pending = (
        (F.col("status") == "success")
        & (F.col("current_status") == "transformed")
        & ~F.col("transformed_at").eqNullSafe(F.col("transformation_ended_at"))
    )
    decision = (
        F.when(F.col("loaded_at").isNull(), True)
        .when(F.col("transformed_at").isNull(), False)
        .otherwise(F.coalesce(pending, F.lit(False)))
    )
    return both.select(key, decision.alias("should_load"))


def not_initialised(tables: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Tables whose one-time history run has not happened."""
    return distinct_keys(tables, [key]).join(ledger.where("status = 'success'").select(key), on=key, how="left_anti")


# profiles ------------------------------------------------------------------


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a by-product of whatever action runs on the returned frame."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def frame_profile(df: DataFrame) -> DataFrame:
    """One row: row count and schema text."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("schema_text", F.lit(df.schema.simpleString()))
