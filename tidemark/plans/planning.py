"""What to request next: a state of ids, advanced by one join a day.

The state holds every id ever listed: whether it is listed now, whether it was asked in the last plan and whether it
is active, that is, answered with data when it was last asked. Every `rescan_days` all listed ids are
asked; between those days the active ones and those that are new.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.operators.increment import is_full_scan, request_chunks
from tidemark.operators.joins import distinct_keys
from tidemark.sources.store import Store, last_entry

# Days between full scans, ids in a request.
RESCAN_DAYS, REQUEST_IDS = 30, 200


@dataclass(frozen=True)
class Plan:
    """Outcome of a day's planning; the ids are in the store's tables."""

    version: int
    full: bool
    next_full_scan: date
    added: int
    removed: int
    active: int
    asked: int


def advance(
    state: DataFrame | None, available: DataFrame, answers: DataFrame | None, key: str, today: date, full: bool
) -> DataFrame:
    """The next state: (key, listed, active, asked, change, first_seen, removed_at).

    `answers` has (key, has_data) for what the last plan asked; an asked id without an answer counts as
    one without data. `change` is 'added', 'removed' or NULL; an id that comes back is added again. Without
    answers at all nothing is known about the last requests, and activity stays as it was.
    """
    day = F.lit(today)
    listed = distinct_keys(available.where(F.col(key).isNotNull()), [key]).withColumn("_now", F.lit(True))
    if state is None:
        known = listed.withColumnsRenamed({"_now": "_was"}).where("false")
        known = known.selectExpr(key, "false AS _listed", "false AS _active", "false AS _asked", "CAST(NULL AS DATE) AS _first", "CAST(NULL AS DATE) AS _removed")
    else:
        known = state.select(
            key,
            F.col("listed").alias("_listed"),
            F.col("active").alias("_active"),
            F.col("asked").alias("_asked"),
            F.col("first_seen").alias("_first"),
            F.col("removed_at").alias("_removed"),
        )
    joined = known.join(listed, key, "full")
    if answers is None:
        active = F.coalesce("_active", F.lit(False))
    else:
        data = answers.where(F.col(key).isNotNull()).groupBy(key).agg(F.bool_or("has_data").alias("_data"))
        joined = joined.join(data, key, "left")
        active = F.coalesce(F.when(F.col("_asked"), F.coalesce("_data", F.lit(False))).otherwise(F.col("_active")), F.lit(False))
    now, before = F.col("_now").isNotNull(), F.coalesce("_listed", F.lit(False))
    change = F.when(now & ~before, "added").when(~now & before, "removed")
    wanted = now if full else now & (active | ~before)
    return joined.select(
        key,
        now.alias("listed"),
        active.alias("active"),
        wanted.alias("asked"),
        change.alias("change"),
        F.coalesce("_first", day).alias("first_seen"),
        F.when(~now, F.coalesce("_removed", day)).alias("removed_at"),
    )


def plan_day(
    store: Store,
    name: str,
    available: DataFrame,
    key: str,
    today: date,
    answers: DataFrame | None = None,
    rescan_days: int = RESCAN_DAYS,
    size: int = REQUEST_IDS,
) -> Plan:
    """Advance the state of `name` to today and write the requests, `size` ids each.

    A day that is planned again starts from the day before and replaces its first plan.
    """
    state_table, requests = f"plan_{name}", f"requests_{name}"
    entries = [e for e in store.history(state_table)[state_table] if json.loads(e["detail"])["day"] != str(today)]
    same = [e for e in store.history(state_table)[state_table] if json.loads(e["detail"])["day"] == str(today)]
    last = last_entry(entries)
    state = store.read(state_table, last["version"]) if last is not None else None
    next_full = date.fromisoformat(json.loads(last["detail"])["next_full_scan"]) if last is not None else None
    full = is_full_scan(today, next_full)
    next_full = today + timedelta(days=rescan_days) if full or next_full is None else next_full
    seen = Observation()
    rows = advance(state, available, answers, key, today, full).observe(
        seen,
        F.count_if(F.col("change") == "added").alias("added"),
        F.count_if(F.col("change") == "removed").alias("removed"),
        F.count_if("active").alias("active"),
        F.count_if("asked").alias("asked"),
    )
    version = same[-1]["version"] if same else (last["version"] + 1 if last is not None else 1)
    detail = json.dumps({"day": str(today), "next_full_scan": str(next_full), "full": full})
    store.publish(rows, state_table, version, phase="plan", detail=detail)
    counts = {n: seen.get.get(n) or 0 for n in ("added", "removed", "active", "asked")}
    chunks = request_chunks(store.read(state_table, version).where("asked"), key, size)
    store.publish(chunks, requests, version, phase="plan", source_version=version)
    return Plan(version, full, next_full, **counts)
