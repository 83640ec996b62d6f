"""Exact deduplication with DataFrame functions alone.

Rows are grouped by a 128-bit hash of the normalised text; inside a group the texts themselves are
compared, so two texts that share a hash stay apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import settle, text_or_empty


def normalised(text: str) -> Column:
    """Each run of ASCII white space becomes one space; NULL counts as empty."""
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


def hash_128(digest: Column) -> Column:
    """The first 128 bits of a SHA-256 in hex."""
    return F.unhex(F.substring(digest, 1, 32))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash: Callable[[Column], Column] = hash_128
) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the smallest id stays; NULL ids rank last, and rows that repeat that id all stay.
    The grouping key holds the hash and the text, and Spark counts per task before it shuffles, so
    copies of one text leave each task as one row however many there are. Only narrow rows
    (id, hashes) meet their group again, which is written out before: a large group there is one
    skewed side of a plain join, which adaptive execution splits. Rows find their text by hash and full digest: should two different
    texts ever share even the full SHA-256, the job stops and does not merge them.
    An empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("text"))
    rows = base.withColumn("text_sha256", F.sha2("text", 256)).withColumn("h", content_hash(F.col("text_sha256")))
    texts = rows.groupBy("h", "text").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = (
        texts.select("h", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
        .groupBy("h", "text_sha256")
        .agg(
            F.min("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
            F.count(F.lit(1)).alias("n_texts"),
        )
        .select(
            "h",
            "text_sha256",
            "keep_id",
            F.when(F.col("n_texts") == 1, F.col("group_size"))
            .otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("long"))
            .alias("group_size"),
        )
    )
    return (
        rows.select("doc_id", "h", "text_sha256")
        .join(settle(groups, "text-groups"), ["h", "text_sha256"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_sha")
    )
    same = docs[id_col].eqNullSafe(kept["_keep_id"]) & (F.sha2(normalised(text_col), 256) == kept["_keep_sha"])
    return docs.join(kept, same, "left_semi")
