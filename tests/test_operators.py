import itertools
import random

import pytest
from pyspark.sql import Observation, functions as F

from tidemark.operators import clean, increment, joins, ordered, repair

T0 = "2025-01-0{} 00:00:00"


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# clean -------------------------------------------------------------------------


def test_keep_first_prefers_values_over_nulls_and_repeats(spark):
    data = [(1, None, "b"), (1, 5, "z"), (1, 5, "a"), (2, None, None), (2, None, "q")]
    df = spark.createDataFrame(data, "k int, v int, s string")
    for order in itertools.islice(itertools.permutations(data), 8):
        again = spark.createDataFrame(list(order), df.schema)
        assert rows(clean.keep_first(again, ["k"])) == [(1, 5, "a"), (2, None, "q")]
    kept = clean.keep_first(df, ["k"])
    assert rows(clean.keep_first(kept, ["k"])) == rows(kept)


def test_keep_first_trims_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = clean.keep_first(df, ["k"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.index("Exchange") < physical.rindex("WindowGroupLimit")


def test_keep_first_without_payload_is_distinct(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(clean.keep_first(df, ["k"])) == [(1,), (2,)]


def test_latest_per(spark):
    df = spark.createDataFrame([(1, 1, 9.0), (1, 2, None), (2, 1, 3.0), (2, 1, 4.0)], "k int, t int, v double")
    assert sorted(map(tuple, clean.latest_per(df, ["k"], "t", ["v"]).collect())) == [(1, 2, None), (2, 1, 4.0)]


def test_longs_to_ints_and_union(spark):
    a = spark.createDataFrame([(1, 2.0)], "x bigint, y double")
    narrowed = clean.longs_to_ints(a)
    assert narrowed.dtypes == [("x", "int"), ("y", "double")]
    b = spark.createDataFrame([("s",)], "z string")
    assert sorted(map(str, clean.union_all([a, b]).collect())) == sorted(
        ["Row(x=1, y=2.0, z=None)", "Row(x=None, y=None, z='s')"]
    )


# joins --------------------------------------------------------------------------


def test_enforce_fks_counts_each_step(spark):
    facts = spark.createDataFrame([(1, 1), (1, 9), (9, 1), (None, 1), (2, 2)], "a int, b int")
    dim_a = spark.createDataFrame([(1,), (2,)], "a int")
    dim_b = spark.createDataFrame([(1,), (1,)], "b int")  # copies must not multiply rows
    seen = {"a": Observation("a"), "b": Observation("b")}
    assert rows(joins.enforce_fks(facts, {"a": dim_a, "b": dim_b}, seen)) == [(1, 1)]
    assert seen["a"].get["rows"] == 3 and seen["b"].get["rows"] == 1


def test_new_and_existing_keys_make_the_full_set(spark):
    wanted = spark.range(0, 100, 3).withColumnRenamed("id", "k")
    held = spark.range(0, 60).withColumnRenamed("id", "k")
    new = joins.new_keys(wanted, held, ["k"])
    assert {r[0] for r in new.union(held).collect()} == set(range(60)) | set(range(0, 100, 3))
    assert new.join(held, "k").count() == 0


def test_orphans_keep_null_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (9, "b"), (9, "c"), (None, "d")], "k int, v string")
    dim = spark.createDataFrame([(1,)], "k int")
    assert {r.v for r in joins.orphans(facts, dim, "k").collect()} == {"b", "c", "d"}
    assert {r.k for r in joins.orphan_keys(facts, dim, "k").collect()} == {9, None}


def test_update_from_changes_only_matching_rows(spark):
    df = spark.createDataFrame([(1, None, 1.0), (1, 5.0, 2.0), (2, None, 3.0)], "k int, v double, w double")
    source = spark.createDataFrame([(1, 7.0)], "k int, v double")
    updated = joins.update_from(df, source, ["k"], {"v": F.col("new_v")}, F.col("v").isNull())
    assert updated.columns == df.columns
    assert sorted(map(tuple, updated.collect()), key=lambda r: r[2]) == [(1, 7.0, 1.0), (1, 5.0, 2.0), (2, None, 3.0)]


# ordered: both ways against a plain Python answer -----------------------------------


def skewed(seed: int, n: int = 400):
    """One group holds nine tenths of the rows; values and times repeat."""
    rng = random.Random(seed)
    groups = ["hot"] * (n * 9 // 10) + [rng.choice(["b", "c", None]) for _ in range(n // 10)]
    return [(g, rng.choice([None, 0, 0, 0, 1, 2, 3, 50]), i) for i, g in enumerate(groups)]


@pytest.mark.parametrize("slices", [1, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_row_numbers_and_ranks(spark, slices, seed):
    data = skewed(seed)
    df = spark.createDataFrame(data, "g string, v int, i int").repartition(7)
    order = [F.col("v").desc_nulls_first(), F.col("i").asc()]
    key = lambda r: (r[1] is not None, -(r[1] or 0), r[2])
    places, ranking = {}, {}
    for g in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == g), key=key)
        for place, r in enumerate(mine, 1):
            places[r[2]] = place
            ranking[r[2]] = 1 + sum(key(o)[:2] < key(r)[:2] for o in mine)
    numbered = ordered.row_numbers(df, ["g"], order, "place", slices)
    assert numbered.columns == ["g", "v", "i", "place"]
    assert {r.i: r.place for r in numbered.collect()} == places
    ranked = ordered.ranks(df, ["g"], "v", "place", slices=slices)
    assert {r.i: r.place for r in ranked.collect()} == ranking


@pytest.mark.parametrize("slices", [1, 7])
def test_chunks_are_full_and_ordered(spark, slices):
    df = spark.range(1050).repartition(5)
    chunks = ordered.chunked(df, [F.col("id").asc()], 200, slices=slices)
    sizes = {r.chunk_id: (r.n, r.lo) for r in chunks.groupBy("chunk_id").agg(
        F.count("*").alias("n"), F.min("id").alias("lo")).collect()}
    assert sizes == {1: (200, 0), 2: (200, 200), 3: (200, 400), 4: (200, 600), 5: (200, 800), 6: (50, 1000)}


def test_slices_are_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SLICE_ROWS", 100, raising=False)
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    sizes = [r["count"] for r in ordered._sliced(df, ["g"], [F.col("id").asc()], 2).groupBy("_slice").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200
    numbered = ordered.row_numbers(df, ["g"], [F.col("id").asc()], "n", slices=2).collect()
    assert len(numbered) == 1000 and all(r.n == r.id // 2 + 1 for r in numbered)


@pytest.mark.parametrize("slices", [1, 7])
@pytest.mark.parametrize("seed", [3, 4])
def test_previous_known(spark, slices, seed):
    rng = random.Random(seed)
    data = [
        (rng.choice(["hot", "hot", "hot", "x", "y"]), rng.randrange(60), rng.choice([None, 1.0, 2.0]), rng.choice([None, 3.0]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "e string, t int, a double, b double").repartition(6)
    expected = {}
    for e, t, *_ in data:
        full = [(t2, a, b) for e2, t2, a, b in data if e2 == e and t2 < t and a is not None and b is not None]
        expected[e, t] = max(full, default=(None, None, None))
    got = ordered.previous_known(df, ["e"], "t", ["a", "b"], slices)
    assert {(r.e, r.t): (r.prev_t, r.prev_a, r.prev_b) for r in got.collect()} == expected


@pytest.mark.parametrize("slices", [1, 7])
def test_fill_and_runs(spark, slices):
    states = "AABBBABAAAACCCA"
    df = spark.createDataFrame([("hot", i, s) for i, s in enumerate(states)] + [("x", 1, "A")], "e string, t int, s string")
    expected = [("x", "A", 1, 1, 1)]
    for state, run in itertools.groupby(enumerate(states), key=lambda p: p[1]):
        times = [t for t, _ in run]
        expected.append(("hot", state, times[0], times[-1], len(times)))
    assert rows(ordered.runs(df.repartition(5), ["e"], "t", "s", slices)) == sorted(expected)
    gaps = spark.createDataFrame([("e", 1, None), ("e", 2, 5.0), ("e", 3, None), ("e", 4, None)], "e string, t int, v double")
    filled = ordered.fill_from_previous(gaps, ["e"], "t", "v", slices)
    assert [r.v for r in filled.orderBy("t").collect()] == [None, 5.0, 5.0, 5.0]


def test_top_n(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1)], "g string, v int")
    top = ordered.top_n(df, ["g"], [F.col("v").desc()], 2, "place")
    assert rows(top) == [("a", 8, 2), ("a", 9, 1), ("b", 1, 1)]


# repair ------------------------------------------------------------------------------

MAP = "exchange_id int, snapshot_timestamp string, maker_fee double, taker_fee double, weekly_visits int"


def test_exchange_map_repair(spark):
    data = [
        # two gaps: only the newest is filled, from the newest full row before it
        (1, T0.format(1), 0.1, 0.2, 10), (1, T0.format(2), None, None, None), (1, T0.format(3), 0.3, 0.4, 30),
        (1, T0.format(4), 0.5, None, 40), (1, T0.format(5), None, None, None), (1, T0.format(6), 0.9, 0.9, 90),
        # no predecessor
        (2, T0.format(1), None, None, None), (2, T0.format(2), 0.1, 0.1, 1),
        # a predecessor with two of three fields
        (3, T0.format(1), 0.1, 0.1, None), (3, T0.format(2), None, None, None),
    ]
    df = spark.createDataFrame(data, MAP).withColumn("snapshot_timestamp", F.to_timestamp("snapshot_timestamp"))
    fixed = repair.repair_exchange_map(df)
    values = [tuple(r) for r in fixed.orderBy("exchange_id", "snapshot_timestamp").select(
        "maker_fee", "taker_fee", "weekly_visits").collect()]
    expected = [d[2:] for d in data]
    expected[4] = (0.3, 0.4, 30)
    assert values == expected


def test_exchange_map_repair_is_idempotent_without_older_gaps(spark):
    data = [(1, T0.format(1), 0.1, 0.2, 10), (1, T0.format(2), None, None, None)]
    df = spark.createDataFrame(data, MAP).withColumn("snapshot_timestamp", F.to_timestamp("snapshot_timestamp"))
    once = repair.repair_exchange_map(df)
    assert rows(repair.repair_exchange_map(once)) == rows(once)


def test_spot_volume_repair(spark):
    schema = "exchange_id int, snapshot_timestamp string, wallet string, spot_volume_usd double, total_usd_value double, wallet_weight double"
    data = [
        (1, T0.format(1), "a", 100.0, 10.0, 0.1), (1, T0.format(1), "b", 200.0, 10.0, 0.05),
        (1, T0.format(2), "a", None, 50.0, None), (1, T0.format(2), "b", None, None, None),
        (1, T0.format(2), "c", 7.0, 14.0, 2.0),
        (2, T0.format(1), "a", 0.0, 1.0, None), (2, T0.format(2), "a", None, 1.0, None),
        (3, T0.format(1), "a", None, 1.0, None), (3, T0.format(2), "a", None, 1.0, None),
    ]
    df = spark.createDataFrame(data, schema).withColumn("snapshot_timestamp", F.to_timestamp("snapshot_timestamp"))
    fixed = repair.repair_spot_volume(df).orderBy("exchange_id", "snapshot_timestamp", "wallet")
    assert [(r.spot_volume_usd, r.wallet_weight) for r in fixed.collect()] == [
        (100.0, 0.1), (200.0, 0.05),
        (200.0, 0.25), (200.0, None), (7.0, 2.0),  # greatest volume of the donor time; filled rows only
        (0.0, None), (0.0, None),  # a zero volume is carried, its weight stays NULL
        (None, None), (None, None),
    ]


# increment -----------------------------------------------------------------------------


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id int")


def test_key_changes(spark):
    old, new = ids(spark, 1, 2, 2, 3), ids(spark, 2, 3, 3, 4)
    assert rows(increment.key_changes(old, new, "id")) == [(1, "removed"), (4, "added")]
    assert rows(increment.change_summary(old, old, "id")) == [(0, 0, False)]


def test_ids_to_fetch(spark):
    from datetime import date

    available, known = ids(spark, 1, 2, 3), ids(spark, 2)
    assert rows(increment.ids_to_fetch(available, known, "id")) == [(1,), (3,)]
    assert rows(increment.ids_to_fetch(available, None, "id")) == [(1,), (2,), (3,)]
    assert rows(increment.ids_to_fetch(available, known, "id", full_scan=True)) == [(1,), (2,), (3,)]
    assert increment.is_full_scan(date(2025, 1, 2), date(2025, 1, 2))
    assert increment.is_full_scan(date(2025, 1, 2), None)
    assert not increment.is_full_scan(date(2025, 1, 1), date(2025, 1, 2))


def test_active_set(spark):
    asked, previous = ids(spark, 1, 2, 3), ids(spark, 1, 2, 7)
    responses = spark.createDataFrame([(1, True), (2, False), (3, True), (8, True)], "id int, has_data boolean")
    assert rows(increment.active_set(asked, responses, "id", True, previous)) == [(1,), (3,)]
    assert rows(increment.active_set(asked, responses, "id", False, previous)) == [(1,), (7,)]


def test_reconcile(spark):
    got = increment.reconcile(ids(spark, 1, 2, 3), ids(spark, 1), "id").first()
    assert tuple(got) == (3, 1, 2, True)
    assert tuple(increment.reconcile(ids(spark, 1), ids(spark, 1), "id").first()) == (1, 1, 0, False)


def test_fresh_snapshots(spark):
    snaps = spark.sql(
        "SELECT * FROM VALUES ('new', TIMESTAMP'2025-01-02 10:00:00'), ('same_day', TIMESTAMP'2025-01-01 10:00:00'), "
        "('old', TIMESTAMP'2024-12-31 10:00:00'), ('never', TIMESTAMP'2024-01-01 00:00:00'), "
        "('unreadable', CAST(NULL AS TIMESTAMP)) AS t(k, snapshot_ts)"
    )
    runs = spark.sql(
        "SELECT k, TIMESTAMP'2025-01-01 08:00:00' AS ended_at FROM VALUES ('new'), ('same_day'), ('old'), ('unreadable') AS t(k)"
    )
    decide = lambda **kw: {r.k: r.should_transform for r in increment.fresh_snapshots(snaps, runs, "k", **kw).collect()}
    assert decide() == {"new": True, "same_day": False, "old": False, "never": True, "unreadable": True}
    assert decide(daily=False)["same_day"] is True
    assert set(decide(force=True).values()) == {True}


def test_load_decisions(spark):
    transforms = spark.createDataFrame(
        [("a", 1, "success", "transformed"), ("b", 1, "success", "transformed"), ("b", 2, "success", "transformed"),
         ("c", 2, "failed", "transformed"), ("d", 2, "success", "transformed")],
        "k string, ended_at int, status string, current_status string",
    )
    loads = spark.createDataFrame(
        [("a", 5, 1), ("b", 5, 1), ("c", 5, 1), ("e", 5, None)], "k string, ended_at int, transformation_ended_at int"
    )
    got = {r.k: r.should_load for r in increment.load_decisions(transforms, loads, "k").collect()}
    assert got == {"a": False, "b": True, "c": False, "d": True, "e": False}


def test_observed_counts_without_another_job(spark):
    df, seen = increment.observed(spark.range(17), "n")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 17


def test_required_keys_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, v string").write.parquet(f"{tmp_path}/t")
    df = clean.require_keys(spark.read.parquet(f"{tmp_path}/t"), ["k", "v"])
    assert rows(df) == [(1, "a")]
    plan = df._jdf.queryExecution().toString()
    assert "IsNotNull(k), IsNotNull(v)" in plan
