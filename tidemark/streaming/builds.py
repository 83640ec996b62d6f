"""Builds fed by streams: the file log of each bronze folder's stream says what is new.

One stream per folder reads every file once. Its micro-batch is scanned once for all tables that are
built from the folder; where other steps need the folder's newest snapshot beside their own
(exchange details beside wallets), that snapshot is kept as a table of its own, so that no step goes
back to bronze.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans.steps import STEPS, Build, Source, builds_for, folder_schema, phase_of
from tidemark.sources.snapshots import exists, snapshot_suffix, snapshot_time
from tidemark.sources.store import Store, last_entry

#: Tables that hold the newest snapshot of a folder are named after it.
NEWEST = "newest_"


@dataclass(frozen=True)
class Feed:
    """A bronze folder, the steps it drives and whether other steps read its newest snapshot."""

    folder: str
    steps: tuple[str, ...]
    beside: bool


def feeds(names: Sequence[str]) -> list[Feed]:
    """Folders of the given steps; one that is read beside others comes before them."""
    order: dict[str, None] = {}

    def visit(folder: str) -> None:
        if folder not in order:
            for name in names:
                if STEPS[name].sources[0].folder == folder:
                    for other in STEPS[name].sources[1:]:
                        visit(other.folder)
            order[folder] = None

    for name in names:
        visit(STEPS[name].sources[0].folder)
    beside = {source.folder for name in names for source in STEPS[name].sources[1:]}
    driven = {f: tuple(n for n in names if STEPS[n].sources[0].folder == f) for f in order}
    return [Feed(folder, driven[folder], folder in beside) for folder in order]


def _columns(df: DataFrame, source: Source) -> DataFrame:
    return df.select(*spark_schema_names(df.sparkSession, source.schema))


def spark_schema_names(spark: SparkSession, schema: str) -> list[str]:
    return spark.createDataFrame([], schema).columns


def _newest_of(silver: Store, source: Source) -> DataFrame | None:
    table = NEWEST + source.folder
    return _columns(silver.read(table), source) if silver.committed(table) else None


def _publish(silver: Store, df: DataFrame, table: str, phase: str, batch: str, read_upto: datetime | None) -> None:
    """Publish under the version that an earlier attempt of the same batch took, else the next one."""
    entry = last_entry([e for e in silver.history(table)[table] if e["detail"] == batch], (phase,))
    version = entry["version"] if entry else None
    silver.publish(df, table, version, phase=phase, read_upto=read_upto, detail=batch)


def _is_once_done(silver: Store, step: Build, batch: str) -> bool:
    done = last_entry(silver.history(step.table)[step.table], (phase_of(step),))
    return step.once and done is not None and done["detail"] != batch


def build_batch(silver: Store, feed: Feed, rows: DataFrame, batch: str) -> dict[str, str]:
    """Build every table of a feed from one micro-batch: step -> outcome.

    `rows` has the folder's columns and `_file`. Rows that go to several tables are scanned once and
    held until the last one is written. A repeated batch replaces what its first attempt wrote.
    """
    if len(feed.steps) + feed.beside > 1:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # a path is matched once a file, not once a row
        found = rows.select("_file").distinct().select(
            "_file",
            snapshot_suffix(F.col("_file")).alias("suffix"),
            F.unix_seconds(snapshot_time(F.col("_file"))).alias("at"),
        ).collect()
        if not found:
            return {}
        newest = max((f["suffix"] for f in found if f["suffix"] is not None), default=None)
        at = max((f["at"] for f in found if f["at"] is not None), default=None)
        upto = datetime.fromtimestamp(at, timezone.utc) if at is not None else None
        chosen = [f["_file"] for f in found if f["suffix"] == newest]
        last = rows if newest is None or len(chosen) == len(found) else rows.where(F.col("_file").isin(chosen))
        outcome = {}
        if feed.beside:
            _publish(silver, last.drop("_file"), NEWEST + feed.folder, "newest", batch, upto)
        for name in feed.steps:
            step = STEPS[name]
            if _is_once_done(silver, step, batch):
                outcome[name] = "up to date"
                continue
            own = _columns(last if step.once else rows, step.sources[0])
            others = [_newest_of(silver, source) for source in step.sources[1:]]
            _publish(silver, step.make(own, *others), step.table, phase_of(step), batch, upto)
            outcome[name] = "success"
        return outcome
    finally:
        rows.unpersist()


def run_stream_builds(
    spark: SparkSession,
    bronze_root: str,
    silver: Store,
    checkpoint_root: str,
    frequency: str = "all",
    archive_root: str | None = None,
) -> dict[str, str]:
    """Build from every file that came since the last call: step -> 'success', 'up to date' or 'no folder'.

    A call is one micro-batch per folder, so that a snapshot of several files stays whole. Which files
    were read is in the checkpoint, and nothing is read or built twice, also after a failure.
    With `archive_root`, the files of a call move there when a later call finds new ones, so that a
    folder holds, and a call lists, no more than the newest two calls' files.
    """
    outcome: dict[str, str] = {}
    for feed in feeds(builds_for(frequency)):
        path = f"{bronze_root}/{feed.folder}"
        if not exists(spark, path):
            outcome |= dict.fromkeys(feed.steps, "no folder")
            continue
        reader = spark.readStream.schema(folder_schema(spark, feed.folder)).option("recursiveFileLookup", "true")
        if archive_root:
            reader = reader.options(cleanSource="archive", sourceArchiveDir=f"{archive_root}/{feed.folder}")
        stream = reader.parquet(path).withColumn("_file", F.col("_metadata.file_path"))
        built: dict[str, str] = {}

        def build(rows: DataFrame, number: int, feed: Feed = feed, built: dict[str, str] = built) -> None:
            built.update(build_batch(silver, feed, rows, f"stream {feed.folder} {number}"))

        query = (
            stream.writeStream.foreachBatch(build)
            .option("checkpointLocation", f"{checkpoint_root}/{feed.folder}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        outcome |= {name: built.get(name, "up to date") for name in feed.steps}
    return outcome
