"""Bronze snapshots: files or folders named `<name>-YYYY-MM-DD_HH-MM-SS.parquet`."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

# Fixed format: the time suffix of a snapshot name (a `key=` folder prefix is not part of the name).
SUFFIX = r"([^/=]+)-(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})\.parquet"
SUFFIX_TIME = "yyyy-MM-dd_HH-mm-ss"


def read_strict(spark: SparkSession, schema: str | StructType, *paths: str) -> DataFrame:
    """Declared columns only; a column missing in a file reads as NULL."""
    return spark.read.schema(schema).parquet(*paths)


def snapshot_name(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, SUFFIX, 1), F.lit(""))


def snapshot_suffix(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, SUFFIX, 2), F.lit(""))


def snapshot_time(path: Column) -> Column:
    """Snapshot time from a path; NULL when the name has no valid suffix."""
    return F.try_to_timestamp(snapshot_suffix(path), F.lit(SUFFIX_TIME))


def list_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """One row per snapshot of a folder: (name, suffix, snapshot_ts, path, files, bytes).

    Only file metadata is read. A snapshot written by Spark is a folder of part files
    and counts once; names without a time suffix are left out.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select("path", "length")
    )
    root = F.regexp_extract("path", r"^(.*?" + SUFFIX + ")", 1)
    return (
        listing.select(root.alias("path"), "length")
        .where("path <> ''")
        .groupBy("path")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .select(
            snapshot_name(F.col("path")).alias("name"),
            snapshot_suffix(F.col("path")).alias("suffix"),
            snapshot_time(F.col("path")).alias("snapshot_ts"),
            "path",
            "files",
            "bytes",
        )
    )


def latest_snapshots(spark: SparkSession, folder: str, limit: int = 1) -> DataFrame:
    """The newest `limit` snapshots by name, newest first."""
    return list_snapshots(spark, folder).orderBy(F.desc("suffix"), F.desc("path")).limit(limit)


def batches(spark: SparkSession, folder: str, expected: int = 5) -> DataFrame:
    """Snapshots sharing one suffix form a batch: (suffix, snapshot_ts, members, is_complete)."""
    return (
        list_snapshots(spark, folder)
        .groupBy("suffix", "snapshot_ts")
        .agg(F.count(F.lit(1)).alias("members"))
        .withColumn("is_complete", F.col("members") >= expected)
    )


def latest_batch(spark: SparkSession, folder: str, expected: int = 5, complete_only: bool = False) -> DataFrame:
    """The newest batch. An incomplete one is returned, flagged, unless only complete ones count."""
    found = batches(spark, folder, expected)
    if complete_only:
        found = found.where("is_complete")
    return found.orderBy(F.desc("suffix")).limit(1)


def read_batch(spark: SparkSession, schema: str | StructType, folder: str, *suffixes: str) -> DataFrame:
    """Every member of the batches as a single scan; other snapshots are pruned by name."""
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .parquet(*[f"{folder}/*-{suffix}.parquet" for suffix in suffixes])
    )


def read_latest_batch(
    spark: SparkSession,
    schema: str | StructType,
    folder: str,
    expected: int = 5,
    complete_only: bool = False,
) -> DataFrame | None:
    """Rows of the newest (complete) batch, or None when there is none."""
    newest = latest_batch(spark, folder, expected, complete_only).first()
    return newest and read_batch(spark, schema, folder, newest["suffix"])


def snapshot_path(folder: str, name: str, taken_at: datetime) -> str:
    return f"{folder}/{name}-{taken_at:%Y-%m-%d_%H-%M-%S}.parquet"


def write_snapshot(df: DataFrame, folder: str, name: str, taken_at: datetime) -> str | None:
    """Write one snapshot by one run of the frame; an empty one leaves nothing.

    Rows go to an attempt folder, which no reader sees, and take the snapshot's name once they are
    there and counted.
    """
    spark, path, attempt = df.sparkSession, snapshot_path(folder, name, taken_at), attempt_path(folder)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(attempt)
    if seen.get.get("rows"):
        return move(spark, attempt, path)
    discard(spark, attempt)
    return None


def attempt_path(folder: str) -> str:
    """A fresh folder below one whose name hides it from listings and streams."""
    return f"{folder}/_attempts/{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def move(spark: SparkSession, source: str, target: str, replace: bool = False) -> str:
    """Rename a written folder to its place; what is there stays, and raises, unless it is to be replaced."""
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    files = as_path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(as_path(target)) and not (replace and files.delete(as_path(target), True)):
        raise FileExistsError(target)
    files.mkdirs(as_path(target).getParent())
    if not files.rename(as_path(source), as_path(target)):
        raise OSError(f"{source} could not be renamed to {target}")
    return target


def discard(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def numbered_latest(listing: DataFrame, limit: int) -> DataFrame:
    """The newest `limit` snapshots of every name in a listing that spans many names."""
    place = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("suffix"), F.desc("path")))
    return listing.withColumn("age", place).where(F.col("age") <= limit)
