"""Repairs and checks from new loads and carried state against those that read everything."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import checks, days, loads, upkeep
from tidemark.sources.store import Store

MAP = "exchange_id int, snapshot_timestamp timestamp, weekly_visits int, maker_fee double, taker_fee double"
START = datetime(2024, 1, 1)


def made(rng, low, high, n):
    """Rows of a few exchanges between two days: whole, without values, or in part."""
    rows = []
    for _ in range(n):
        values = rng.choice(([rng.randrange(9), rng.random(), 0.5], [None] * 3, [None] * 3, [1, None, None]))
        rows.append((rng.randrange(1, 5), START + timedelta(days=rng.randrange(low, high)), *values))
    return rows


def rows_of(store, name):
    return sorted(map(str, store.read_all(name).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_repairs_equal_full_ones(spark, tmp_path, seed):
    rng = random.Random(seed)
    a, b = Store(spark, f"{tmp_path}/a"), Store(spark, f"{tmp_path}/b")
    # in order, overlapping, late as a whole, and none
    in_turn = [(10, 20, 15), (18, 28, 12), (0, 9, 8), None, (25, 40, 12)] if seed == 1 else [(20, 30, 10), (5, 25, 14), None]
    for bounds in in_turn:
        if bounds:
            df = spark.createDataFrame(made(rng, *bounds), MAP)
            for store in (a, b):
                store.publish(df, "dim_exchange_map", phase="load", derived=days.layout("dim_exchange_map", df))
        assert upkeep.run_repairs(a) == loads.run_repairs(b)
        assert rows_of(a, "dim_exchange_map") == rows_of(b, "dim_exchange_map")
    a.compact("dim_exchange_map", appended=True)
    b.compact("dim_exchange_map", appended=True)
    for _ in range(2):
        assert upkeep.run_repairs(a) == loads.run_repairs(b)
        assert rows_of(a, "dim_exchange_map") == rows_of(b, "dim_exchange_map")


def load_day(spark, store, k, known, wallets=3):
    df = spark.range(wallets).select(
        F.lit(7).alias("exchange_id"),
        F.lit(START + timedelta(days=k)).cast("timestamp").alias("snapshot_timestamp"),
        F.lit(100.0 if known else None).cast("double").alias("spot_volume_usd"),
        F.lit(5.0).alias("total_usd_value"),
        F.lit(None).cast("double").alias("wallet_weight"),
    )
    store.publish(df, "fact_exchange_assets", phase="load", derived=days.layout("fact_exchange_assets", df))


def test_a_run_reads_new_loads_only(spark, tmp_path, monkeypatch):
    store = Store(spark, f"{tmp_path}/w")
    for k in range(3):
        load_day(spark, store, k, True)
        upkeep.run_repairs(store)
    load_day(spark, store, 3, False)
    read, plain = [], Store.read_versions

    def spy(self, table, versions, *args, **kw):
        if table == "fact_exchange_assets":
            read.append(list(versions))
        return plain(self, table, versions, *args, **kw)

    monkeypatch.setattr(Store, "read_versions", spy)
    assert upkeep.run_repairs(store) == {"fact_exchange_assets": 3}
    assert read == [[4], [4]]  # once for the state, once to be rewritten
    got = store.read_all("fact_exchange_assets").where("wallet_weight IS NOT NULL").collect()
    assert [(r.spot_volume_usd, r.wallet_weight) for r in got] == [(100.0, 0.05)] * 3


def test_a_broken_off_repair_is_finished(spark, tmp_path, monkeypatch):
    store = Store(spark, f"{tmp_path}/w")
    load_day(spark, store, 0, True)
    load_day(spark, store, 1, False)
    apply = upkeep._apply_fills
    monkeypatch.setattr(upkeep, "_apply_fills", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        upkeep.run_repairs(store)
    assert store.read_all("fact_exchange_assets").where("spot_volume_usd IS NULL").count() == 3
    monkeypatch.setattr(upkeep, "_apply_fills", apply)
    assert upkeep.run_repairs(store) == {"fact_exchange_assets": 3}
    assert upkeep.run_repairs(store) == {"fact_exchange_assets": 0}
    assert store.read_all("fact_exchange_assets").where("spot_volume_usd = 100").count() == 6


KEYS = "crypto_id int, snapshot_timestamp timestamp"


def test_unique_checks_equal_full_ones(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    store, state = Store(spark, f"{tmp_path}/w"), Store(spark, f"{tmp_path}/s")
    name, table = "crypto_06_duplicate_map_key", "dim_crypto_map"
    read, plain = [], Store.read_versions
    monkeypatch.setattr(Store, "read_versions", lambda self, t, v, *a, **k: (read.append((t, list(v))), plain(self, t, v, *a, **k))[1])
    for low, high in ((0, 6), (4, 9), (0, 3), (8, 12)):
        rows = [(rng.choice((1, 2, 3, 4, 5, None)), rng.choice((START + timedelta(days=rng.randrange(low, high)), None))) for _ in range(8)]
        store.publish(spark.createDataFrame(rows, KEYS), table, phase="load")
        read.clear()
        found = upkeep.check_unique(store, state, name)
        assert [v for t, v in read if t == table] == [[max(store.committed(table))]]
        full = checks.violations(name, {table: store.read_all(table)})
        assert sorted(map(str, found.collect())) == sorted(map(str, full.collect()))
    assert sorted(map(str, upkeep.check_unique(store, state, name).collect())) == sorted(map(str, full.collect()))


def test_counts_of_other_days_are_not_opened(spark, tmp_path):
    store, state = Store(spark, f"{tmp_path}/w"), Store(spark, f"{tmp_path}/s")
    name, table = "crypto_06_duplicate_map_key", "dim_crypto_map"
    opened, plain = [], Store.read_versions

    def spy(self, t, versions, *args, **kw):
        df = plain(self, t, versions, *args, **kw)
        if t.startswith("counts_") and kw.get("prune"):
            opened.extend(f.split("snapshot_day=")[1][:10] for f in df.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
        return df

    for k in range(5):
        store.publish(spark.createDataFrame([(1, START + timedelta(days=k // 2))], KEYS), table, phase="load")
        Store.read_versions = spy if k == 4 else plain
        try:
            found = upkeep.check_unique(store, state, name)
        finally:
            Store.read_versions = plain
    assert opened == [] and found.count() == 2  # day 2 is new; days 0 and 1 repeat


def test_reference_checks_clear_keys_that_come_late(spark, tmp_path):
    store, state = Store(spark, f"{tmp_path}/w"), Store(spark, f"{tmp_path}/s")
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "exchange_id int")
    for venues, wallets in (([1], [1, 2, 2, None]), ([2], [3, 1]), ([], []), ([4], [3])):
        store.publish(frame(venues), "dim_exchange_id", phase="load")
        store.publish(frame(wallets), "fact_exchange_assets", phase="load")
        found = upkeep.check_references(store, state, "exchange_08_asset_orphans")
        tables = {t: store.read_all(t) for t in ("dim_exchange_id", "fact_exchange_assets")}
        full = checks.violations("exchange_08_asset_orphans", tables).groupBy("exchange_id").count()
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    assert sum(r.cnt for r in found.collect()) == 3  # the NULL and the third exchange twice


def test_versions_are_followed_through_rewrites(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/w")
    for k in range(3):
        load_day(spark, store, k, True)
    store.compact("fact_exchange_assets", appended=True)
    entries = store.history("fact_exchange_assets")["fact_exchange_assets"]
    assert upkeep.where_now(entries, [1, 3]) == [4] and upkeep.unseen_loads(entries, 2) == [3]
    assert upkeep.unseen_loads(entries, None) == [4]
