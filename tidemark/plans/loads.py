"""Loads: which rows of a built table go into the warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.operators.clean import keep_first
from tidemark.operators.joins import enforce_fks, new_keys
from tidemark.operators.repair import repair_exchange_map, repair_spot_volume
from tidemark.plans import days
from tidemark.sources.store import BUILD_PHASES, Entry, Store, committed_versions, last_entry, live_versions


@dataclass(frozen=True)
class Load:
    """`key` is set for stable tables, which take only new keys; facts take every row."""

    key: tuple[str, ...] = ()
    fks: tuple[tuple[str, str], ...] = ()  # (column, referenced table)


CRYPTO, EXCHANGE, CATEGORY = (
    ("crypto_id", "dim_crypto_id"),
    ("exchange_id", "dim_exchange_id"),
    ("category_id", "dim_crypto_category"),
)

#: Rows of a table whose keys the driver and each executor may hold for a join. Catalyst goes by the size of files, of
#: which a column of numbers has a byte or two a row; it takes some 50 bytes a row once it is broadcast.
HELD_KEYS = 250_000

# referenced tables come before the tables that refer to them
LOADS: dict[str, Load] = {
    "dim_crypto_id": Load(key=("crypto_id",)),
    "dim_exchange_id": Load(key=("exchange_id",)),
    "dim_crypto_category": Load(key=("category_id",)),
    "dim_crypto_info": Load(key=("crypto_id",), fks=(CRYPTO,)),
    "dim_exchange_info": Load(key=("exchange_id",), fks=(EXCHANGE,)),
    "crypto_category_link": Load(key=("category_id", "crypto_id"), fks=(CATEGORY, CRYPTO)),
    "dim_crypto_map": Load(fks=(CRYPTO,)),
    "dim_exchange_map": Load(fks=(EXCHANGE,)),
    "fact_crypto_market": Load(fks=(CRYPTO,)),
    "fact_crypto_category": Load(fks=(CATEGORY,)),
    "fact_exchange_assets": Load(fks=(CRYPTO, EXCHANGE)),
    "fact_market_sentiment": Load(),
    "fact_global_market": Load(),
}

FREQUENCIES: dict[str, tuple[str, ...]] = {
    "10x": ("dim_crypto_category", "fact_crypto_category", "fact_global_market", "fact_market_sentiment"),
    "5x": ("fact_crypto_market",),
    "daily": (
        "dim_crypto_id",
        "dim_exchange_id",
        "dim_exchange_info",
        "crypto_category_link",
        "dim_crypto_map",
        "dim_exchange_map",
        "fact_exchange_assets",
    ),
    "weekly": ("dim_crypto_info",),
}


def rows_to_load(
    name: str,
    built: DataFrame,
    existing: DataFrame | None,
    references: Mapping[str, DataFrame],
    observations: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """Rows of `built` the load appends: new keys (stable tables), then valid foreign keys."""
    spec = LOADS[name]
    rows = built
    if spec.key and existing is not None:
        rows = new_keys(rows, existing, spec.key)
    return enforce_fks(rows, {column: references[table] for column, table in spec.fks}, observations)


def key_side(store: Store, table: str, versions: Sequence[int], entries: Sequence[Entry]) -> DataFrame:
    """Versions of a table as the key side of a join: never broadcast if the ledger counts more rows than may be held."""
    rows = {e["version"]: e["rows"] or 0 for e in entries if e["status"] == "success"}
    df = store.read_versions(table, versions, entries)
    return df.hint("merge") if sum(rows[v] for v in versions) > HELD_KEYS else df


def load(store: Store, name: str, built: DataFrame, version: int, source_version: int | None = None) -> int:
    """Append to the warehouse table under `version`; repeating a version replaces it.

    Returns the appended row count; a stable table without new keys is recorded as skipped. The
    ledger keeps how many rows each foreign key dropped.
    """
    spec = LOADS[name]
    history = store.history(name, *[table for _, table in spec.fks])
    live = {table: live_versions(entries) for table, entries in history.items()}
    existing = None
    others = [v for v in live[name] if v != version]
    if spec.key and others:
        existing = key_side(store, name, others, history[name]).select(*spec.key)
    for _, table in spec.fks:
        if not live[table]:
            raise LookupError(f"{name} refers to {table}, which is not loaded yet")
    references = {table: key_side(store, table, live[table], history[table]) for _, table in spec.fks}
    seen = {key: Observation() for key in ("", *[column for column, _ in spec.fks])} if spec.fks else {}
    rows = rows_to_load(name, built, existing, references, seen)

    def dropped() -> dict[str, int]:
        left = [observation.get.get("rows") or 0 for observation in seen.values()]
        return {key: before - after for key, before, after in zip(list(seen)[1:], left, left[1:], strict=False)}

    return store.publish(
        rows,
        name,
        version,
        phase="load",
        source_version=source_version,
        skip_empty=bool(spec.key),
        dropped=dropped if seen else None,
        derived=days.layout(name, rows),
    )[1]


def unmet_references(name: str, entries: Mapping[str, list]) -> list[str]:
    """Tables that a load refers to and that hold no version yet."""
    return [table for _, table in LOADS[name].fks if not live_versions(entries.get(table, []))]


def load_order(frequencies: tuple[str, ...] = ("10x", "daily", "5x", "weekly")) -> list[str]:
    """Tables of the given frequency groups, referenced tables first."""
    wanted = {t for f in frequencies for t in FREQUENCIES[f]}
    return [name for name in LOADS if name in wanted]


def run_loads(
    silver: Store, warehouse: Store, frequencies: tuple[str, ...] = tuple(FREQUENCIES), force: bool = False
) -> dict[str, int | str]:
    """Load what has changed: table -> appended rows, or why nothing was appended.

    A table is loaded when it never was, or when its last build is not the one loaded
    last. All builds since the last load are taken, so that no snapshot is passed over; of a
    stable key the newest build counts. With `force`, facts take their newest build only. A
    table whose references are not loaded yet is recorded as skipped, and the others go on.
    """
    outcome: dict[str, int | str] = {}
    built_entries, loaded_entries = silver.history(), warehouse.history()
    for name in load_order(frequencies):
        entries = built_entries.get(name, [])
        built = last_entry(entries, BUILD_PHASES)
        done = [e for e in loaded_entries.get(name, []) if e["source_version"] is not None]
        loaded = last_entry(done, ("load",), status=None)
        if built is None:
            outcome[name] = "not built"
        elif loaded is not None and loaded["source_version"] == built["version"] and not force:
            outcome[name] = "up to date"
        else:
            missing = unmet_references(name, loaded_entries)
            if missing:
                outcome[name] = f"{', '.join(missing)} not loaded yet"
                warehouse.record(name, "load", "skipped", detail=outcome[name])
                continue
            newest, key = built["version"], LOADS[name].key
            after = loaded["source_version"] if loaded is not None and not force else None
            pending = [v for v in committed_versions(entries, BUILD_PHASES) if after is None or after < v]
            if key:
                rows = silver.read_versions(name, pending, entries, with_version=True)
                rows = keep_first(rows, key, [F.desc("version")]).drop("version")
            else:
                rows = silver.read_versions(name, [newest] if force else pending, entries)
            version = max(committed_versions(loaded_entries.get(name, [])), default=0) + 1
            outcome[name] = load(warehouse, name, rows, version, newest)
            loaded_entries |= warehouse.history(name)
    return outcome


def run_repairs(warehouse: Store) -> dict[str, int]:
    """Repair gaps in the warehouse: table -> repaired rows.

    Only the loads that hold repaired rows are rewritten; the new version stands in for them.
    """
    outcome = {}
    for name, fix in (("dim_exchange_map", repair_exchange_map), ("fact_exchange_assets", repair_spot_volume)):
        rows = warehouse.read_all(name, with_version=True)
        if rows is None:
            continue
        fixed = fix(rows, flag="_repaired")
        per_version = fixed.where("_repaired").groupBy("version").agg(F.count(F.lit(1)).alias("n")).collect()
        touched = sorted(r["version"] for r in per_version)
        if touched:
            changed = fixed.where(F.col("version").isin(touched)).drop("version", "_repaired")
            warehouse.publish(changed, name, phase="repair", replaces=touched, derived=days.layout(name, changed))
        outcome[name] = sum(r["n"] for r in per_version)
    return outcome
