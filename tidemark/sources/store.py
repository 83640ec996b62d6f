"""Versioned Parquet tables plus an append-only run ledger under one root folder.

Each attempt to write a table version goes to a folder of its own, and the version counts once
the ledger has a row that names the folder. A failed or repeated write leaves what was committed
before as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType

from tidemark.operators.clean import union_all

LEDGER_COLUMNS = {
    "table_name": "string",
    "phase": "string",
    "status": "string",
    "version": "bigint",
    "rows": "bigint",
    "started_at": "timestamp",
    "ended_at": "timestamp",
    "source_version": "bigint",
    "detail": "string",
    "schema_json": "string",
    "path": "string",
    "dropped": "string",
    "read_upto": "timestamp",
    "derived": "string",
}
LEDGER = ", ".join(f"{name} {kind}" for name, kind in LEDGER_COLUMNS.items())

#: A ledger row: column -> value.
Entry = Mapping[str, Any]

REPLACES = "replaces "

#: Folder of one attempt to write a version.
ATTEMPT = "attempt"


def _entry(**values) -> list[Column]:
    return [F.lit(values.get(name)).cast(kind).alias(name) for name, kind in LEDGER_COLUMNS.items()]


#: Phases that bring new rows to a silver table; compaction and repair only rewrite what is there.
BUILD_PHASES = ("transform", "init")


def last_entry(entries: Sequence[Entry], phases: Sequence[str] = (), status: str | None = "success") -> Entry | None:
    """Last of a table's entries with one of the phases (none: any) and the given status."""
    found = [e for e in entries if (not phases or e["phase"] in phases) and status in (None, e["status"])]
    return found[-1] if found else None


def committed_versions(entries: Sequence[Entry], phases: Sequence[str] = ()) -> list[int]:
    """Numbers of the committed versions, those of the given phases only if any are given."""
    done = [e for e in entries if e["status"] == "success" and e["version"] is not None]
    return sorted({e["version"] for e in done if not phases or e["phase"] in phases})


def live_versions(entries: Sequence[Entry]) -> list[int]:
    """Committed versions that no later one has replaced."""
    notes = [e["detail"] for e in entries if e["status"] == "success" and (e["detail"] or "").startswith(REPLACES)]
    replaced = {int(v) for note in notes for v in note.removeprefix(REPLACES).split(",")}
    return [v for v in committed_versions(entries) if v not in replaced]


def merged_schema(entries: Sequence[Entry], versions: Sequence[int]) -> StructType:
    """Columns of the given versions in order of appearance; one name must keep its type."""
    latest = {e["version"]: e["schema_json"] for e in entries if e["status"] == "success" and e["schema_json"]}
    fields: dict[str, StructField] = {}
    for version in sorted(versions):
        for field in StructType.fromJson(json.loads(latest[version])).fields:
            known = fields.setdefault(field.name, field)
            if known.dataType != field.dataType:
                raise TypeError(f"{field.name} changed from {known.dataType} to {field.dataType}")
    return StructType(list(fields.values()))


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ledger_path = f"{self.root}/ledger"
        # an empty ledger where there is none yet
        spark.range(0).select(*_entry()).write.mode("ignore").parquet(self.ledger_path)

    def path(self, table: str, version: int) -> str:
        return f"{self.root}/tables/{table}/version={version}"

    # ledger -------------------------------------------------------------

    def ledger(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.ledger_path)

    def record(
        self,
        table: str,
        phase: str,
        status: str,
        version: int | None = None,
        rows: int | None = None,
        started_at: datetime | None = None,
        source_version: int | None = None,
        detail: str | None = None,
        schema: StructType | None = None,
        path: str | None = None,
        dropped: Mapping[str, int] | None = None,
        read_upto: datetime | None = None,
        derived: Mapping[str, str] | None = None,
    ) -> None:
        now = datetime.now(timezone.utc)
        entry = _entry(
            table_name=table,
            phase=phase,
            status=status,
            version=version,
            rows=rows,
            started_at=started_at or now,
            ended_at=now,
            source_version=source_version,
            detail=detail,
            schema_json=schema and schema.json(),
            path=path,
            dropped=json.dumps(dropped) if dropped is not None else None,
            read_upto=read_upto,
            derived=json.dumps(derived) if derived else None,
        )
        self.spark.range(1).coalesce(1).select(*entry).write.mode("append").parquet(self.ledger_path)

    def history(self, *tables: str) -> dict[str, list[Entry]]:
        """Ledger entries per table, oldest first; all tables when none is named.

        This is run metadata, a few short rows per run: Spark groups them by schema text, so that a
        text comes to the driver once and not with every version that has it.
        """
        entries = self.ledger()
        if tables:
            entries = entries.where(F.col("table_name").isin(*tables))
        rest = [name for name in LEDGER_COLUMNS if name not in ("table_name", "schema_json")]
        grouped = entries.groupBy("table_name", "schema_json").agg(F.collect_list(F.struct(*rest)).alias("entries"))
        found: dict[str, list[Entry]] = {table: [] for table in tables}
        for group in grouped.collect():
            same = {"table_name": group["table_name"], "schema_json": group["schema_json"]}
            found.setdefault(group["table_name"], []).extend(same | e.asDict() for e in group["entries"])
        return {table: sorted(es, key=lambda e: (e["ended_at"], e["version"] or 0)) for table, es in found.items()}

    def last(self, table: str, *phases: str, status: str | None = "success") -> Entry | None:
        return last_entry(self.history(table)[table], phases, status)

    def committed(self, table: str) -> list[int]:
        return committed_versions(self.history(table)[table])

    def live(self, table: str) -> list[int]:
        return live_versions(self.history(table)[table])

    # tables -------------------------------------------------------------

    def publish(
        self,
        df: DataFrame,
        table: str,
        version: int | None = None,
        partition_by: Sequence[str] = (),
        phase: str = "transform",
        source_version: int | None = None,
        skip_empty: bool = False,
        replaces: Sequence[int] = (),
        dropped: Callable[[], Mapping[str, int]] | None = None,
        read_upto: datetime | None = None,
        derived: Mapping[str, Column] | None = None,
        detail: str | None = None,
    ) -> tuple[int, int]:
        """Write `df` as one version and commit it; returns (version, rows).

        Rows are counted by the write itself. Writing the same version again replaces it once the
        write has succeeded. `dropped` is asked after the write for counts to keep in the ledger;
        `read_upto` is the time of the newest snapshot the rows come from.
        With `skip_empty`, a version without rows is recorded as skipped, not committed.
        `replaces` names versions of an appended table that this one stands in for.
        `derived` are further partition columns, computed for the folders only: they are no columns of
        the table, but `prune` of the readers sees them.
        """
        started = datetime.now(timezone.utc)
        if version is None:
            version = max(self.committed(table), default=0) + 1
        seen, schema, folders = Observation(), df.schema, [*partition_by, *(derived or {})]
        if derived:
            df = df.withColumns(dict(derived))
        kinds = {name: df.schema[name].dataType.simpleString() for name in derived or {}}
        if folders:
            # even files per partition value; a value holding most rows is split
            df = df.hint("rebalance", *folders)
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
        if folders:
            writer = writer.partitionBy(*folders)
        path = f"{self.path(table, version)}/{ATTEMPT}={uuid.uuid4().hex}"
        writer.parquet(path)
        rows = seen.get["rows"]
        status = "skipped" if skip_empty and rows == 0 else "success"
        detail = REPLACES + ",".join(map(str, replaces)) if replaces else detail
        counts = dropped() if dropped else None
        self.record(
            table, phase, status, version, rows, started, source_version, detail, schema, path, counts, read_upto, kinds
        )
        return version, rows

    def read(self, table: str, version: int | None = None, columns: Sequence[str] = ()) -> DataFrame:
        """Latest committed version, or the given one."""
        entries = self.history(table)[table]
        known = committed_versions(entries)
        chosen = max(known, default=None) if version is None else version
        if chosen is None or chosen not in known:
            raise LookupError(f"{table} has no committed version {version if version is not None else ''}".rstrip())
        df = self.read_versions(table, [chosen], entries)
        return df.select(*columns) if columns else df

    def read_all(
        self,
        table: str,
        columns: Sequence[str] = (),
        with_version: bool = False,
        prune: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame | None:
        """All live versions together (an appended table), or None before the first."""
        entries = self.history(table)[table]
        live = live_versions(entries)
        if not live:
            return None
        df = self.read_versions(table, live, entries, with_version, prune)
        return df.select(*columns) if columns else df

    def read_versions(
        self,
        table: str,
        versions: Sequence[int],
        entries: Sequence[Entry],
        with_version: bool = False,
        prune: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Several versions as one scan, optionally with their number in `version`.

        The schema is the union of the schemas in the ledger, so no file footer is read
        to plan the scan and a column added later is NULL in older versions. `prune` may filter
        or join the scan by derived partition columns before they are dropped. Versions written with
        other folders are a scan of their own.
        """
        schema = merged_schema(entries, versions)
        written = {e["version"]: e for e in entries if e["status"] == "success" and e["path"]}
        layouts: dict[tuple[str | None, bool], list[str]] = {}
        for v in versions:
            entry = written[v]
            layouts.setdefault((entry["derived"], f"/{ATTEMPT}=" in entry["path"]), []).append(entry["path"])
        scans = []
        for (derived, attempts), paths in layouts.items():
            fields = [StructField("version", LongType())] if "version" not in schema.names else []
            fields += [StructField(ATTEMPT, StringType())] if attempts else []
            fields += StructType.fromDDL(", ".join(f"{n} {k}" for n, k in json.loads(derived or "{}").items())).fields
            reader = self.spark.read.schema(StructType([*schema.fields, *fields]))
            df = reader.option("basePath", f"{self.root}/tables/{table}").parquet(*paths)
            df = prune(df) if prune else df
            scans.append(df.select(*schema.names, *(["version"] if with_version else [])))
        return union_all(scans)

    def compact(
        self,
        table: str,
        appended: bool = False,
        partition_by: Sequence[str] = (),
        derived: Mapping[str, Column] | None = None,
    ) -> tuple[int, int]:
        """Rewrite a table in evenly sized files as its next version: the latest version,
        or all live versions of an appended table. It brings no new rows, so no load follows from it."""
        entries = self.history(table)[table]
        old = live_versions(entries) if appended else []
        df = self.read_all(table) if appended else self.read(table)
        sources = [e["source_version"] for e in entries if e["source_version"] is not None]
        return self.publish(
            df if partition_by or derived else df.hint("rebalance"),
            table,
            partition_by=partition_by,
            derived=derived,
            phase="compact",
            source_version=max(sources, default=None),
            replaces=old,
        )


def export_csv(df: DataFrame, path: str) -> None:
    """CSV has no nested values: arrays, structs and maps are written as JSON text."""
    nested = (ArrayType, StructType, MapType)
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    df.select(*flat).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_payloads(df: DataFrame, path: str) -> None:
    """Keep raw payload rows as JSON lines, so that parsing can be replayed."""
    df.write.mode("overwrite").json(path)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("endpoint string, request_id string, fetched_at string, body string").json(path)
