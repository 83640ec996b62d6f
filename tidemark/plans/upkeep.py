"""Repairs and checks that read what was loaded since their last run, and a state carried between runs.

A state is a table of the warehouse. It is published before anything follows from it, under the newest load
it has seen, so that a run that broke off is finished or repeated by the next one with the same result.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from tidemark.operators.clean import union_all
from tidemark.operators.ordered import materialize, previous_known
from tidemark.operators.repair import REPAIRS, Repair
from tidemark.plans import days
from tidemark.plans.checks import CHECKS, ForeignKeyRule, UniqueRule
from tidemark.sources.store import REPLACES, Entry, Store, committed_versions, last_entry, live_versions


def unseen_loads(entries: Sequence[Entry], seen: int | None) -> list[int]:
    """Loads after the newest one that a state has seen; all live versions where there is no state yet."""
    if seen is None:
        return live_versions(entries)
    return [v for v in committed_versions(entries, ("load",)) if v > seen]


def where_now(entries: Sequence[Entry], versions: Sequence[int]) -> list[int]:
    """Live versions that hold the rows of the given ones, which repairs or compactions may have replaced."""
    moved = {}
    for e in entries:
        if e["status"] == "success" and (e["detail"] or "").startswith(REPLACES):
            moved |= {int(v): e["version"] for v in e["detail"].removeprefix(REPLACES).split(",")}
    found = set()
    for v in versions:
        while v in moved and moved[v] != v:
            v = moved[v]
        found.add(v)
    return sorted(found)


# repairs ----------------------------------------------------------------------------
#
# State rows of a repair, by `kind`: 'tick', the last known values of an entity; 'gap', a time with missing
# rows, the versions that hold them and the last known values before it; 'fill', a gap that this run closes.


def _state_of(spec: Repair, kind: str, df: DataFrame, versions: Column, donor: Column) -> DataFrame:
    return df.select(
        F.lit(kind).alias("kind"), spec.entity, spec.ts, versions.cast("array<bigint>").alias("versions"), donor.alias("donor")
    )


def _ticks(spec: Repair, rows: DataFrame) -> DataFrame:
    """Known values per entity and time, as `donor`; rows of one time resolve to the greatest values."""
    point = F.struct(F.col(spec.ts), *[F.col(v) for v in spec.values])
    return rows.where(spec.known()).groupBy(spec.entity, spec.ts).agg(F.max(point).alias("donor"))


def _earlier_ticks(store: Store, name: str, spec: Repair, late: DataFrame, versions: Sequence[int]) -> DataFrame | None:
    """Ticks of history for gaps that are older than what the state knows, bounded by their entities and days."""
    newest = late.agg(F.max(spec.ts)).first()[0]
    if newest is None or not versions:
        return None
    bound = late.groupBy(spec.entity).agg(F.max(spec.ts).alias("_bound"))

    def prune(df: DataFrame) -> DataFrame:
        return df.where(F.col(days.DAY) <= F.to_date(F.lit(newest))) if days.DAY in df.columns else df

    rows = store.read_versions(name, versions, store.history(name)[name], prune=prune)
    rows = rows.select(spec.entity, spec.ts, *spec.values).where(F.col(spec.ts) < F.lit(newest))
    return _ticks(spec, rows.join(bound, spec.entity).where(F.col(spec.ts) < F.col("_bound")))


def repair_state(store: Store, name: str, spec: Repair, state: DataFrame | None, new: Sequence[int]) -> DataFrame:
    """The next state of a repair, from the last one and the loads that are new."""
    key, entries = [spec.entity, spec.ts], store.history(name)[name]
    rows = store.read_versions(name, new or live_versions(entries)[:1], entries, with_version=True)
    rows = rows.select(*key, *spec.values, "version")
    if not new:
        rows = rows.where("false")
    gaps = rows.where(spec.missing()).groupBy(*key).agg(F.collect_set("version").alias("versions"))
    gaps = gaps.where(F.col(spec.entity).isNotNull() & F.col(spec.ts).isNotNull())
    gaps = materialize(gaps, "gaps")
    ticks = materialize(_ticks(spec, rows), "ticks")
    known = [ticks]
    if state is not None:
        last = state.where("kind = 'tick'").select(*key, "donor")
        late = gaps.join(last.select(spec.entity, F.col(spec.ts).alias("_last")), spec.entity).where(F.col("_last") >= F.col(spec.ts))
        earlier = _earlier_ticks(store, name, spec, late, [v for v in live_versions(entries) if v not in new])
        open_gaps = state.where("kind = 'gap'").select(*key, "versions", "donor")
        carried = open_gaps.where("donor IS NOT NULL").select(spec.entity, F.col(f"donor.{spec.ts}").alias(spec.ts), "donor")
        known += [last, carried, *([earlier] if earlier is not None else [])]
        gaps = gaps.unionByName(open_gaps.drop("donor"))
        gaps = gaps.groupBy(*key).agg(F.array_distinct(F.flatten(F.collect_list("versions"))).alias("versions"))
    points = union_all(known).select(*key, *[F.col(f"donor.{v}").alias(v) for v in spec.values])
    found = previous_known(points.unionByName(gaps.select(*key), allowMissingColumns=True), [spec.entity], spec.ts, spec.values)
    before = F.col(f"prev_{spec.ts}")
    donor = F.struct(before.alias(spec.ts), *[F.col(f"prev_{v}").alias(v) for v in spec.values])
    found = found.select(*key, F.when(before.isNotNull(), donor).alias("donor"))
    newest = F.max(spec.ts).over(Window.partitionBy(spec.entity))
    closes = (F.col(spec.ts) == F.col("_newest")) & F.col("donor").isNotNull()
    filled = materialize(gaps.join(found, key, "left").withColumn("_newest", newest).withColumn("closes", closes), "filled")
    at_gap = F.struct(F.col(spec.ts), *[F.col(f"donor.{v}").alias(v) for v in spec.values])
    closed = filled.where("closes")
    after = union_all([*known[:2], closed.select(*key, at_gap.alias("donor"))] if state is not None else [ticks, closed.select(*key, at_gap.alias("donor"))])
    latest = after.groupBy(spec.entity).agg(F.max("donor").alias("donor")).where(F.col(spec.entity).isNotNull())
    latest = latest.withColumn(spec.ts, F.col(f"donor.{spec.ts}"))
    none = F.lit(None).cast("array<bigint>")
    return union_all(
        [
            _state_of(spec, "tick", latest, none, F.col("donor")),
            _state_of(spec, "gap", filled.where("NOT coalesce(closes, false)"), F.col("versions"), F.col("donor")),
            _state_of(spec, "fill", closed, F.col("versions"), F.col("donor")),
        ]
    )


def _apply_fills(store: Store, name: str, spec: Repair, version: int) -> int:
    """Rewrite the versions that hold the gaps a state closes; returns the repaired rows."""
    fills = store.read(f"repair_{name}", version).where("kind = 'fill'")
    touched = [r["v"] for r in fills.select(F.explode("versions").alias("v")).distinct().collect()]
    entries = store.history(name)[name]
    touched = where_now(entries, touched)
    if not touched:
        return 0
    found = fills.select(spec.entity, spec.ts, *[F.col(f"donor.{v}").alias(v) for v in spec.values])
    seen = Observation()
    fixed = spec.apply(store.read_versions(name, touched, entries), found, "_repaired")
    fixed = fixed.observe(seen, F.count_if("_repaired").alias("rows")).drop("_repaired")
    store.publish(
        fixed, name, phase="repair", replaces=touched, source_version=version, derived=days.layout(name, fixed)
    )
    return seen.get.get("rows") or 0


def run_repairs(store: Store) -> dict[str, int]:
    """Repair the newest gap of each entity as a full repair would, from new loads and carried state.

    A run reads the loads since the last one. History is read only for gaps that came late, older than
    values already seen, and then only days before them. Each run closes the newest open gap of an
    entity that has known values before it.
    """
    outcome = {}
    for name, spec in REPAIRS.items():
        table = f"repair_{name}"
        history = store.history(name, table)
        if not live_versions(history[name]):
            continue
        last, repaired = last_entry(history[table]), 0
        if last is not None and json.loads(last["dropped"])["fills"]:
            if not any(e["phase"] == "repair" and e["source_version"] == last["version"] for e in history[name]):
                repaired += _apply_fills(store, name, spec, last["version"])  # the last run broke off
        seen = last["source_version"] if last is not None else None
        new = unseen_loads(store.history(name)[name], seen)
        state = store.read(table) if last is not None else None
        counted = Observation()
        rows = repair_state(store, name, spec, state, new).observe(counted, F.count_if(F.col("kind") == "fill").alias("fills"))
        fills = lambda: {"fills": counted.get.get("fills") or 0}  # noqa: B023, E731
        version, _ = store.publish(rows, table, phase="state", source_version=max([*new, seen or 0]), dropped=fills)
        if fills()["fills"]:
            repaired += _apply_fills(store, name, spec, version)
        outcome[name] = repaired
    return outcome


# checks -------------------------------------------------------------------------------

_NO_DAY = "1900-01-01"
#: Longer lists of days are given to a scan as their range.
_LISTED_DAYS = 400


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on keys of which NULLs count as equal."""
    named = right.select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(named, on, how)


def _by_day(keys: Sequence[str]) -> dict[str, Column]:
    return {days.DAY: F.coalesce(F.to_date(days.AT), F.to_date(F.lit(_NO_DAY)))} if days.AT in keys else {}


def check_unique(store: Store, state: Store, name: str) -> DataFrame:
    """Repeated keys (and `cnt`) of a table after its newest loads, from key counts by load.

    Key counts of a load are kept by day where the key has a time, so that a load is held only
    against the counts of its own days.
    """
    rule = CHECKS[name]
    assert isinstance(rule, UniqueRule)
    keys, counts, found = list(rule.keys), f"counts_{name}", f"found_{name}"
    entries, held = store.history(rule.table)[rule.table], state.history(counts, found)
    last = last_entry(held[found])
    seen = last["source_version"] if last is not None else None
    new = unseen_loads(entries, seen)
    before = state.read(found) if last is not None else None
    if not new:
        return before
    rows = store.read_versions(rule.table, new, entries).select(*keys)
    version = max(new)
    added = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    state.publish(added, counts, version, phase="counts", derived=_by_day(keys))
    held = state.history(counts)[counts]
    added = state.read_versions(counts, [version], held)
    merged = added
    older = [v for v in live_versions(held) if seen is not None and v <= seen]
    if older:
        # the days of a load are few; as literals they prune folders when the scan is planned
        day = next(iter(_by_day(keys).values()), None)
        touched = [] if day is None else sorted(r[0] for r in added.select(day).distinct().collect())

        def prune(df: DataFrame) -> DataFrame:
            if not touched:
                return df
            inside = F.col(days.DAY).between(touched[0], touched[-1])
            return df.where(inside & F.col(days.DAY).isin(touched) if len(touched) <= _LISTED_DAYS else inside)

        earlier = _same(state.read_versions(counts, older, held, prune=prune), added, keys, "left_semi")
        merged = added.unionByName(earlier).groupBy(*keys).agg(F.sum("cnt").alias("cnt"))
    repeated = merged.where("cnt > 1")
    if before is not None:
        repeated = repeated.unionByName(_same(before, added, keys, "left_anti"))
    state.publish(repeated, found, version, phase="found", source_version=version)
    return state.read(found)


def check_references(store: Store, state: Store, name: str) -> DataFrame:
    """Key values without a match (and `cnt`, their rows) after the newest loads.

    New rows are held against the whole reference, earlier finds against it again: a key that came
    late clears them.
    """
    rule = CHECKS[name]
    assert isinstance(rule, ForeignKeyRule)
    found = f"found_{name}"
    entries, last = store.history(rule.table)[rule.table], last_entry(state.history(found)[found])
    seen = last["source_version"] if last is not None else None
    new = unseen_loads(entries, seen)
    parts = [state.read(found)] if last is not None else []
    if new:
        rows = store.read_versions(rule.table, new, entries)
        parts.append(rows.groupBy(rule.key).agg(F.count(F.lit(1)).alias("cnt")))
    both = union_all(parts).groupBy(rule.key).agg(F.sum("cnt").alias("cnt"))
    known = store.read_all(rule.reference, [rule.key])
    missing = both if known is None else both.join(known, rule.key, "left_anti")
    state.publish(missing, found, phase="found", source_version=max([*new, seen or 0]))
    return state.read(found)


def run_checks(store: Store, state: Store) -> dict[str, int]:
    """Violations of all key and reference checks whose tables are loaded, from new loads and carried state."""
    counts = {}
    for name, rule in CHECKS.items():
        if not isinstance(rule, (UniqueRule, ForeignKeyRule)) or not store.committed(rule.table):
            continue
        if isinstance(rule, UniqueRule):
            counts[name] = check_unique(store, state, name).count()
        else:
            found = check_references(store, state, name)
            counts[name] = found.count() if rule.distinct else found.agg(F.coalesce(F.sum("cnt"), F.lit(0))).first()[0]
    return counts
