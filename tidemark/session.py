"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: str | None = None

#: Bytes of files that a task may scan. Sorts and hash tables beside a scan hold its rows, of which these small
#: columns have some twenty times as many bytes; larger scans took over 1 GB a task, or spilled.
SCAN_BYTES = 16 << 20
_SCANS = "spark.sql.files.maxPartitionBytes"

#: Compressed bytes that adaptive execution leaves a task after a shuffle, and the partitions it starts from. It only
#: merges partitions, so with few of them, as spark.sql.shuffle.partitions may ask for, a task grows with the input.
#: Beyond 200 (spark.shuffle.sort.bypassMergeThreshold) map tasks hold what they write, which doubled their memory.
SHUFFLE_BYTES = 16 << 20
SHUFFLE_PARTITIONS = 200
_SHUFFLES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

#: Adaptive execution drops what lies beside an empty side of a join, with the counts that `observe` takes there: reading
#: one then fails. With this rule left out they are kept.
_LEFT_OUT = "spark.sql.adaptive.optimizer.excludedRules"
KEPT_COUNTS = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return pin(builder.getOrCreate())


def pin(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results and memory depend on, on a session somebody else made.

    Scans and shuffles that the session already cuts smaller stay so.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if _bytes(spark, spark.conf.get(_SCANS)) > SCAN_BYTES:
        spark.conf.set(_SCANS, SCAN_BYTES)
    if _bytes(spark, spark.conf.get(_SHUFFLES)) > SHUFFLE_BYTES:
        spark.conf.set(_SHUFFLES, SHUFFLE_BYTES)
    if int(spark.conf.get(_PARTITIONS, None) or 0) < SHUFFLE_PARTITIONS:
        spark.conf.set(_PARTITIONS, SHUFFLE_PARTITIONS)
    left_out = [rule for rule in (spark.conf.get(_LEFT_OUT, None) or "").split(",") if rule]
    if KEPT_COUNTS not in left_out:
        spark.conf.set(_LEFT_OUT, ",".join([*left_out, KEPT_COUNTS]))
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    """A size in Spark's notation (128m, 134217728b) in bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def work_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session without that setting falls back to a machine-local folder;
    on a cluster the missing setting is an error, because executors could not see it.
    """
    global _local_root
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidemark-")
    return _local_root


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{work_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
