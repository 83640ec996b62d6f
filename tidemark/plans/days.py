"""Facts by day: how they are laid out in folders, and reading a time range or chosen days of them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.store import Store

AT, DAY = "snapshot_timestamp", "snapshot_day"

#: Tables with many rows a snapshot, whose time is in AT. They have a folder a day.
BY_DAY = ("dim_crypto_map", "dim_exchange_map", "fact_crypto_market", "fact_crypto_category", "fact_exchange_assets")
#: Tables of one row a snapshot: folders by day would hold a row each. Their files are bounded by statistics.
BY_ROW = ("fact_market_sentiment", "fact_global_market")


def layout(table: str, df: DataFrame) -> dict[str, Column]:
    """Partition columns of a table's folders; none for tables without folders by day."""
    return {DAY: F.to_date(AT)} if table in BY_DAY and AT in df.columns else {}


def _utc(moment: datetime) -> Column:
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc))


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """(snapshot_day, year, quarter, month, weekday) of all days from first to last; weekday 1 is Monday."""
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias(DAY))
    return days.select(
        DAY,
        F.year(DAY).alias("year"),
        F.quarter(DAY).alias("quarter"),
        F.month(DAY).alias("month"),
        (F.weekday(DAY) + 1).alias("weekday"),
    )


class Period(Mapping[str, DataFrame]):
    """Warehouse tables by name, with the facts cut to the times low <= t < high, or to some days.

    Times (UTC) bound the partitions of a scan when it is planned. `days`, a frame with a column
    `snapshot_day`, is joined instead: where Catalyst broadcasts it, the same broadcast prunes the
    partitions when the query runs. Rows without day folders are filtered as rows. Dimensions without
    snapshots are whole. Rows without a time are in no period.
    """

    def __init__(
        self, store: Store, low: datetime | None = None, high: datetime | None = None, days: DataFrame | None = None
    ):
        self.store, self.low, self.high, self.days = store, low, high, days

    def _cut(self, df: DataFrame) -> DataFrame:
        day = F.col(DAY) if DAY in df.columns else F.to_date(AT)
        if self.low is not None:
            df = df.where((F.col(AT) >= _utc(self.low)) & (day >= F.to_date(_utc(self.low))))
        if self.high is not None:
            df = df.where((F.col(AT) < _utc(self.high)) & (day <= F.to_date(_utc(self.high))))
        if self.days is not None:
            wanted = self.days.select(F.col(DAY).alias("_day"))
            df = df.join(wanted, day == F.col("_day"), "left_semi")
        return df

    def __getitem__(self, table: str) -> DataFrame:
        df = self.store.read_all(table, prune=self._cut if table in BY_DAY + BY_ROW else None)
        if df is None:
            raise KeyError(table)
        return df

    def __iter__(self) -> Iterator[str]:
        return (table for table, entries in self.store.history().items() if any(e["status"] == "success" for e in entries))

    def __len__(self) -> int:
        return sum(1 for _ in self)
