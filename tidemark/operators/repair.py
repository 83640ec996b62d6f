"""Gap repair: carry the last earlier known values into the newest gap of each exchange.

Both repairs need one target time and one donor per exchange. They are two grouped
aggregations with map-side combine, so an exchange with very many rows is reduced
before any shuffle and never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.joins import update_from


def newest_gap(df: DataFrame, entity: str, ts: str, missing: Column) -> DataFrame:
    """(entity, gap): the newest time with a missing row."""
    return df.where(missing).groupBy(entity).agg(F.max(ts).alias("gap"))


def donors(df: DataFrame, gaps: DataFrame, entity: str, ts: str, values: Sequence[str], known: Column) -> DataFrame:
    """Per entity, the values of its last known time strictly before the gap; an entity
    without one is left out. Rows of the same time resolve to the greatest values."""
    # reduced to one row per (entity, ts) before the gaps are joined
    ticks = df.where(known).groupBy(entity, ts).agg(F.max(F.struct(*values)).alias("_values"))
    return (
        ticks.join(gaps, on=entity)
        .where(F.col(ts) < F.col("gap"))
        .groupBy(entity, F.col("gap"))
        .agg(F.max(F.struct(F.col(ts), F.col("_values"))).alias("_donor"))
        .select(entity, F.col("gap").alias(ts), *[F.col(f"_donor._values.{v}").alias(v) for v in values])
    )


def _all(columns: Sequence[str], null: bool) -> Column:
    test = F.lit(True)
    for name in columns:
        test = test & (F.col(name).isNull() if null else F.col(name).isNotNull())
    return test


def fill_newest_gap(
    df: DataFrame, entity: str, ts: str, values: Sequence[str], flag: str | None = None
) -> DataFrame:
    """Fill rows of the newest time at which all `values` are missing together."""
    missing, known = _all(values, True), _all(values, False)
    found = donors(df, newest_gap(df, entity, ts, missing), entity, ts, values, known)
    return update_from(df, found, [entity, ts], {v: F.col(f"new_{v}") for v in values}, missing, flag)


def repair_exchange_map(dim_exchange_map: DataFrame, flag: str | None = None) -> DataFrame:
    values = ["maker_fee", "taker_fee", "weekly_visits"]
    return fill_newest_gap(dim_exchange_map, "exchange_id", "snapshot_timestamp", values, flag)


def repair_spot_volume(fact_exchange_assets: DataFrame, flag: str | None = None) -> DataFrame:
    """Fill missing spot volumes of the newest gap and recompute the weight of those rows.

    A found volume of zero gives a NULL weight.
    """
    volume = "spot_volume_usd"
    entity, ts = "exchange_id", "snapshot_timestamp"
    missing, known = F.col(volume).isNull(), F.col(volume).isNotNull()
    found = donors(
        fact_exchange_assets, newest_gap(fact_exchange_assets, entity, ts, missing), entity, ts, [volume], known
    )
    assignments = {
        volume: F.col(f"new_{volume}"),
        "wallet_weight": F.try_divide(F.col("total_usd_value"), F.col(f"new_{volume}")),
    }
    return update_from(fact_exchange_assets, found, [entity, ts], assignments, missing, flag)


@dataclass(frozen=True)
class Repair:
    """What a repair carries from the last known time into a gap, and what follows from it."""

    values: tuple[str, ...]
    follow: tuple[tuple[str, str], ...] = ()  # (column, expression over the row and new_<value>)
    entity: str = "exchange_id"
    ts: str = "snapshot_timestamp"

    def missing(self) -> Column:
        return _all(self.values, True)

    def known(self) -> Column:
        return _all(self.values, False)

    def apply(self, df: DataFrame, found: DataFrame, flag: str | None = None) -> DataFrame:
        """Fill missing rows at the (entity, time) pairs of `found` with its values."""
        assignments = {v: F.col(f"new_{v}") for v in self.values} | {n: F.expr(e) for n, e in self.follow}
        return update_from(df, found, [self.entity, self.ts], assignments, self.missing(), flag)


REPAIRS: dict[str, Repair] = {
    "dim_exchange_map": Repair(("maker_fee", "taker_fee", "weekly_visits")),
    "fact_exchange_assets": Repair(
        ("spot_volume_usd",), (("wallet_weight", "try_divide(total_usd_value, new_spot_volume_usd)"),)
    ),
}
