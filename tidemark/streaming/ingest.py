"""Incremental ingestion: every new snapshot file once, with replayable publishing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.clean import keep_first, require_keys
from tidemark.operators.joins import enforce_fks, new_keys


def snapshot_stream(
    spark: SparkSession, schema: str | StructType, folder: str, files_per_batch: int = 1000
) -> DataFrame:
    """Stream of a folder's snapshot files; `files_per_batch` bounds a micro-batch, not the result."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .parquet(folder)
    )


def drain(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append all files that are new since the last call to a Parquet folder, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def drain_batches(stream: DataFrame, publish: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _batch_path(target: str, batch_id: int) -> str:
    return f"{target}/batch_id={batch_id}"


def _published(spark: SparkSession, target: str, batch_id: int, schema: StructType, columns: Sequence[str]):
    """Rows of earlier batches. A replayed batch does not see its own first attempt."""
    if batch_id == 0:
        return None
    return (
        spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())]))
        .parquet(target)
        .where(F.col("batch_id") < batch_id)
        .select(*columns)
    )


def publish_new_keys(
    target: str,
    keys: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    prune_by: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Stable-table sink: each key is written once, by the first batch that brings it.

    Copies inside a batch are reduced by `keep_first` (map-side) and copies across
    batches by an anti join, so late copies are found however late they come.
    A batch is overwritten under its id, so a replay gives the same folder.

    `prune_by` names a key column such as the snapshot time: earlier rows outside the
    batch's range of it cannot match, and Parquet statistics skip their row groups.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        # both the key range and the write read the reduced batch; it is computed once
        rows = reduced = keep_first(require_keys(prepare(batch), keys), keys).persist()
        schema = rows.schema
        known = _published(batch.sparkSession, target, batch_id, schema, keys)
        if known is not None and prune_by is not None:
            low, high = rows.agg(F.min(prune_by), F.max(prune_by)).first()
            if low is not None:
                known = known.where(F.col(prune_by).between(F.lit(low), F.lit(high)))
        if known is not None:
            rows = new_keys(rows, known, keys).select(*schema.names)
        rows.write.mode("overwrite").parquet(_batch_path(target, batch_id))
        reduced.unpersist()

    return publish


def publish_fact(
    target: str, references: dict[str, DataFrame], prepare: Callable[[DataFrame], DataFrame] = lambda df: df
) -> Callable[[DataFrame, int], None]:
    """Fact sink: every row with valid foreign keys, overwritten under its batch id."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        enforce_fks(prepare(batch), references).write.mode("overwrite").parquet(_batch_path(target, batch_id))

    return publish


# Fixed settings: keys in RocksDB, of which each batch uploads what it changed.
KEY_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def key_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, so that it may outgrow memory."""
    before = {name: spark.conf.get(name, None) for name in KEY_STATE}
    for name, value in KEY_STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def drain_first_rows(stream: DataFrame, keys: Sequence[str], target: str, checkpoint: str) -> StreamingQuery:
    """Publish the first row of each key, each once, without reading what was published before.

    The keys seen so far are the stream's state, dealt out by their hash over as many stores as there are
    shuffle partitions at the first start. A batch looks up its own keys only, so its work does
    not grow with the history, and copies are found however late they come. Rows without a key are left out. Of
    copies in one micro-batch any one stays; where the choice matters, use `publish_new_keys`. State and file
    log commit together: a replayed batch gives the same rows once. Returns the finished query.
    """
    first = require_keys(stream, keys).dropDuplicates(list(keys))
    with key_state(stream.sparkSession):
        query = (
            first.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(target)
        )
    query.awaitTermination()
    return query


def read_published(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("batch_id")


def dedupe_within(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Streaming dedupe with bounded state, for copies that arrive within `delay` of each other.

    A key is forgotten once the watermark, the newest time of earlier batches less `delay`, has passed
    its time by `delay`. Rows that are not newer than the watermark of the batch before are dropped, also
    those that never came before: where none may be lost, use `drain_first_rows` or `publish_new_keys`.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
