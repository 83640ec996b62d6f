"""Order-dependent operators that never bring an unbounded group into one task.

Groups are cut into ordered slices by range partitioning: tasks work slice by slice, and one
summary row per slice carries the state to the later slices of its group. That is the only way,
whatever the size of a group. The slices are fixed in a table in the shared folder, which the
operator writes when it is called; its folder can be deleted once the result has been used.

`slices` is their least number, by default `spark.sql.shuffle.partitions`. A slice is sorted by one task,
so there are more of them where one would have over SLICE_ROWS rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import work_dir

#: Rows that a task may sort; a million of the as-of operator's take some 100 MB.
SLICE_ROWS = 1 << 20


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: a fixed input that survives lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sliced(df: DataFrame, group: Sequence[str], order: Sequence[Column], slices: int | None) -> DataFrame:
    """Fixed slices: `_g` is the group as one value (NULL members compare equal) and
    `_slice` grows with the order inside it. Rows equal in group and order share a slice."""
    # written first, so that the rows are known before they are cut and computed once for the sampling and the cut
    df = materialize(df, "unsliced")
    least = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = max(least, -(-df.count() // SLICE_ROWS))
    ranged = df.repartitionByRange(count, *[F.col(g).asc_nulls_first() for g in group], *order)
    whole = F.struct(*group) if group else F.lit(0)
    return materialize(ranged.select("*", whole.alias("_g"), F.spark_partition_id().alias("_slice")), "slices")


def _earlier_slices() -> Window:
    return Window.partitionBy("_g").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


def _with_offset(fixed: DataFrame, weight: Column) -> DataFrame:
    """Add `_before`: the weight of the group in all earlier slices."""
    totals = fixed.groupBy("_g", "_slice").agg(F.sum(weight).alias("_in_slice"))
    before = F.coalesce(F.sum("_in_slice").over(_earlier_slices()), F.lit(0))
    return fixed.join(totals.select("_g", "_slice", before.alias("_before")), on=["_g", "_slice"])


def row_numbers(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str, slices: int | None = None
) -> DataFrame:
    """ROW_NUMBER over (group, order). `order` should end in a unique tie-break, or equal rows share a slice."""
    in_slice = F.row_number().over(Window.partitionBy("_g", "_slice").orderBy(*order))
    numbered = _with_offset(_sliced(df, group, order, slices), F.lit(1))
    return numbered.withColumn(name, (F.col("_before") + in_slice).cast("bigint")).select(*df.columns, name)


def ranks(
    df: DataFrame, group: Sequence[str], by: str, name: str, descending: bool = True, slices: int | None = None
) -> DataFrame:
    """RANK over (group, by). Equal values are counted before they are ordered, so a value shared
    by many rows is one row in the ordered part."""
    order = F.col(by).desc_nulls_first() if descending else F.col(by).asc_nulls_last()
    counted = df.groupBy(*group, by).agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.partitionBy("_g", "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("_before") + F.coalesce(F.sum("_n").over(so_far), F.lit(0)) + 1
    places = _with_offset(_sliced(counted, group, [order], slices), F.col("_n")).select(
        F.struct(*group, by).alias("_key"), place.cast("bigint").alias(name)
    )
    return df.withColumn("_key", F.struct(*group, by)).join(places, on="_key").select(*df.columns, name)


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str) -> DataFrame:
    """First n rows per group. Up to spark.sql.optimizer.windowGroupLimitThreshold (1000) rows,
    WindowGroupLimit trims to n per group before the shuffle; use `row_numbers` for larger n."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(name, place.cast("bigint")).where(F.col(name) <= n)


def chunked(
    df: DataFrame, order: Sequence[Column], size: int, name: str = "chunk_id", slices: int | None = None
) -> DataFrame:
    """Number consecutive rows into chunks of `size`, counted from 1."""
    numbered = row_numbers(df, [], order, "_row", slices)
    return numbered.withColumn(name, F.expr(f"(_row - 1) div {size} + 1")).drop("_row")


def _with_previous(
    ticks: DataFrame, entity: Sequence[str], ts: str, point: Column, name: str, slices: int | None
) -> DataFrame:
    """Add the last strictly earlier non-NULL `point` of the entity.

    `ticks` has one row per (entity, ts); `point` is a struct that starts with `ts`, so
    the greatest earlier point is the last one.
    """
    fixed = _sliced(ticks.withColumn("_point", point), entity, [F.col(ts).asc_nulls_first()], slices)
    last = fixed.groupBy("_g", "_slice").agg(F.max("_point").alias("_point"))
    # the carried point enters its slice as a row before all others
    carried = last.select("_g", "_slice", F.max("_point").over(_earlier_slices()).alias("_point"))
    rows = fixed.withColumn("_is_row", F.lit(1)).unionByName(
        carried.withColumn("_is_row", F.lit(0)), allowMissingColumns=True
    )
    earlier = Window.partitionBy("_g", "_slice").orderBy("_is_row", ts).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn(name, F.max("_point").over(earlier)).where("_is_row = 1")
    return found.select(*ticks.columns, name)


def previous_known(
    df: DataFrame, entity: Sequence[str], ts: str, values: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Backward as-of: per (entity, ts), the values of the last strictly earlier time at
    which all of them are present, as `prev_<value>`, with that time as `prev_<ts>`.

    Rows sharing (entity, ts) are collapsed first, keeping the greatest full tuple.
    """
    full = F.lit(True)
    for v in values:
        full = full & F.col(v).isNotNull()
    point = F.struct(F.col(ts), *[F.col(v) for v in values])
    ticks = df.groupBy(*entity, ts).agg(F.max(F.when(full, point)).alias("_known"))
    found = _with_previous(ticks, entity, ts, F.col("_known"), "_found", slices)
    return found.select(
        *entity,
        ts,
        F.col(f"_found.{ts}").alias(f"prev_{ts}"),
        *[F.col(f"_found.{v}").alias(f"prev_{v}") for v in values],
    )


def fill_from_previous(
    df: DataFrame, entity: Sequence[str], ts: str, value: str, slices: int | None = None
) -> DataFrame:
    """Replace a NULL value by the last strictly earlier known one of the same entity."""
    found = previous_known(df, entity, ts, [value], slices).select(*entity, ts, f"prev_{value}")
    return (
        df.join(found, on=[*entity, ts], how="left")
        .withColumn(value, F.coalesce(F.col(value), F.col(f"prev_{value}")))
        .select(*df.columns)
    )


def runs(
    df: DataFrame, entity: Sequence[str], ts: str, state: str, slices: int | None = None
) -> DataFrame:
    """Gaps and islands: stretches of consecutive times in one (non-NULL) state.

    A time opens a run when the time before it has another state; every other time
    belongs to the last opening before it.
    """
    ticks = df.groupBy(*entity, ts).agg(F.max(state).alias(state))
    before = _with_previous(ticks, entity, ts, F.struct(ts, state), "_before", slices)
    opens = F.when(~F.col(state).eqNullSafe(F.col(f"_before.{state}")), F.struct(ts))
    marked = before.select(*entity, ts, state, opens.alias("_opens"))
    return (
        _with_previous(marked, entity, ts, F.col("_opens"), "_opened", slices)
        .withColumn("run_start", F.coalesce("_opens", "_opened")[ts])
        .groupBy(*entity, "run_start", state)
        .agg(F.max(ts).alias("run_end"), F.count(F.lit(1)).alias("run_length"))
        .select(*entity, state, "run_start", "run_end", "run_length")
    )
