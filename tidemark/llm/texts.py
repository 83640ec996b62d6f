"""What the operators share: reading texts inside Python tasks, words, written intermediate tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_dir

#: A word is a run of letters and digits, compared in lower case.
WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def map_texts(
    frame: DataFrame,
    keys: list[str],
    text: str,
    schema: str,
    rows: Callable[[Iterator[tuple[list, list]]], Iterable[list[list]]],
    decode: bool = True,
) -> DataFrame:
    """Run `rows` over Arrow batches. It gets (key columns, texts) and yields whole result columns.

    Only the named columns are read, so extra columns of any name do no harm. NULL texts arrive as "".
    Texts travel as bytes: a text that is not valid UTF-8 gets replacement characters, and without
    `decode`, which a binary column needs, `rows` gets the bytes.
    """
    narrow = frame.select(*keys, F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_text"))
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def inputs():
            for batch in batches:
                values = batch.column(len(keys)).to_pylist()
                texts = [value.decode("utf-8", "replace") for value in values] if decode else values
                yield [batch.column(i) for i in range(len(keys))], texts

        for columns in rows(inputs()):
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, list) else c for c in columns], names)

    return narrow.mapInArrow(_typed(run, schema), schema)


def _typed(run: Callable, schema: str) -> Callable:
    """Cast what `run` yields to the declared types, also where a batch has only NULLs."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def typed(batches):
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(
                [column.cast(field.type) for column, field in zip(batch.columns, target, strict=True)], schema=target
            )

    return typed


def settle(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there and survives lost executors."""
    spark: SparkSession = frame.sparkSession
    path = work_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
