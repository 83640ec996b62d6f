"""Compare a Spark result with a DuckDB result: column names, row count and values."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

from tidemark.bindings.inputs import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in value.items())
    return value


def rows_of(table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, Counter(map(repr, zip(*columns)))


def kinds_of(table) -> dict[str, str]:
    def kind(t) -> str:
        text = str(t)
        for head in ("timestamp", "list", "large_list", "struct"):
            if text.startswith(head):
                return head.removeprefix("large_")
        return text.removeprefix("large_")

    return {f.name: kind(f.type) for f in table.schema}


def differences(spark_df, con, sql: str) -> str | None:
    """None when both agree, else a short description."""
    ours = spark_df.toArrow()
    result = con.execute(sql)
    theirs = result.to_arrow_table() if hasattr(result, "to_arrow_table") else result.fetch_arrow_table()
    our_names, our_rows = rows_of(ours)
    their_names, their_rows = rows_of(theirs)
    if our_names != their_names:
        return f"columns {our_names} != {their_names}"
    if kinds_of(ours) != kinds_of(theirs):
        a, b = kinds_of(ours), kinds_of(theirs)
        return "types " + str({n: (a[n], b[n]) for n in a if a[n] != b[n]})
    if our_rows != their_rows:
        extra, missing = our_rows - their_rows, their_rows - our_rows
        return (
            f"{ours.num_rows} vs {theirs.num_rows} rows; columns {our_names}; "
            f"only here {list(extra.items())[:2]}; only there {list(missing.items())[:2]}"
        )
    return None
