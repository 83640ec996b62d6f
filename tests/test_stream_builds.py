"""Builds driven by the streams' file logs, and scans shared by the tables of a folder."""

import json
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_cycle import raw
from tidemark.plans import loads, steps
from tidemark.sources.store import Store
from tidemark.streaming import builds

START = datetime(2030, 1, 1)


def stage(spark, bronze, k, *endpoints, fees=True):
    day = START + timedelta(days=k)
    for endpoint in endpoints or steps.PARSERS:
        assert steps.parse_to_bronze(raw(spark, day, fees), endpoint, bronze, day)


def parquet_files(root):
    return sorted(str(p) for p in Path(root).rglob("*.parquet") if p.is_file())


def rows(store, table, *columns):
    return sorted(map(str, store.read_all(table).select(*columns).collect()))


def test_feeds_order_folders():
    order = [f.folder for f in builds.feeds(steps.builds_for("all"))]
    assert len(order) == len(set(order)) == 11
    assert order.index("exchange_map_data") < order.index("exchange_info_data") < order.index("exchange_assets_data")
    found = {f.folder: f for f in builds.feeds(steps.builds_for("daily"))}
    assert found["exchange_info_data"].beside and found["exchange_map_data"].beside
    assert found["crypto_map_data"].steps == ("dim_crypto_id", "dim_crypto_map") and not found["crypto_map_data"].beside


def test_streams_build_what_batch_runs_build(spark, tmp_path):
    root = str(tmp_path)
    streamed, batch = Store(spark, f"{root}/streamed"), Store(spark, f"{root}/batch")
    targets = Store(spark, f"{root}/w1"), Store(spark, f"{root}/w2")
    run = lambda **kw: builds.run_stream_builds(spark, f"{root}/bronze", streamed, f"{root}/check", **kw)
    stage(spark, f"{root}/bronze", 1)
    first = run()
    assert set(first.values()) == {"success"} and set(first) == set(steps.STEPS)
    stage(spark, f"{root}/bronze", 2, "exchange_info", "exchange_assets", "crypto_listings", "sentiment_history", fees=False)
    stage(spark, f"{root}/bronze", 3, "exchange_assets", fees=False)
    second = run()
    done = {name for name, outcome in second.items() if outcome == "success"}
    assert done == {"dim_exchange_info", "dim_exchange_map", "fact_exchange_assets", "fact_crypto_market"}
    assert set(run().values()) == {"up to date"}
    steps.run_builds(spark, f"{root}/bronze", batch)
    for silver, warehouse in zip((streamed, batch), targets):
        loads.run_loads(silver, warehouse)
    for table in loads.LOADS:
        if table not in ("fact_exchange_assets", "fact_market_sentiment", "dim_exchange_map"):
            assert rows(targets[0], table, "*") == rows(targets[1], table, "*"), table
    # two runs see what was newest beside each: the volume of day 1, then of day 2; a single run the newest only
    assert len(rows(targets[0], "fact_exchange_assets", "*")) == 3
    keys = ("exchange_id", "snapshot_timestamp", "is_active")
    assert rows(targets[0], "dim_exchange_map", *keys) == rows(targets[1], "dim_exchange_map", *keys)


def test_archived_files_are_not_listed_again(spark, tmp_path):
    root = str(tmp_path)
    silver = Store(spark, f"{root}/s")
    run = lambda: builds.run_stream_builds(
        spark, f"{root}/bronze", silver, f"{root}/check", "10x", archive_root=f"{root}/built"
    )
    stage(spark, f"{root}/bronze", 1, "crypto_categories", "global_metrics")
    before = parquet_files(f"{root}/bronze")
    assert run() == {
        "dim_crypto_category": "success", "fact_crypto_category": "success", "fact_global_market": "success",
        "sentiment_live": "no folder",
    }
    for k in (2, 3):
        stage(spark, f"{root}/bronze", k, "crypto_categories")
        assert run()["fact_crypto_category"] == "success"
    days_of = lambda folder: {d for f in parquet_files(folder) for d in ("02", "03", "04") if f"2030-01-{d}" in f}
    left = f"{root}/bronze/crypto_categories_data"
    for _ in range(100):  # files move beside the query
        if days_of(left) == {"04"}:
            break
        time.sleep(0.1)
    assert days_of(left) == {"04"} and not set(parquet_files(left)) & set(before)
    assert days_of(f"{root}/built") == {"02", "03"}
    assert len(silver.committed("fact_crypto_category")) == 3 and len(silver.committed("fact_global_market")) == 1


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    silver = Store(spark, f"{tmp_path}/s")
    feed = next(f for f in builds.feeds(["dim_crypto_category", "fact_crypto_category"]))
    path = f"{tmp_path}/crypto_categories_data/x-2030-01-01_00-00-00.parquet"
    schema = steps.folder_schema(spark, feed.folder)
    def rows(names):
        data = [json.dumps({"category_id": n, "name": n, "date_snapshot": "2030-01-01T00:00:00Z"}) for n in names]
        df = spark.read.schema(schema).json(spark.createDataFrame([(d,) for d in data], "value string").rdd.map(lambda r: r[0]))
        return df.selectExpr("*", f"'{path}' AS _file")
    for batch, names in (("a 0", "xy"), ("a 0", "xyz"), ("a 1", "w")):
        builds.build_batch(silver, feed, rows(names), batch)
    assert silver.committed("dim_crypto_category") == [1, 2]
    assert sorted(r.category_id for r in silver.read_all("dim_crypto_category").collect()) == ["w", "x", "y", "z"]
    assert builds.build_batch(silver, feed, rows(""), "a 2") == {}


def test_paths_are_matched_once_a_file(spark, tmp_path, monkeypatch):
    matched = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def suffix(path):
        matched.add(1)
        return path[-27:-8] if path.endswith(".parquet") else None

    monkeypatch.setattr(builds, "snapshot_suffix", suffix)
    feed = next(f for f in builds.feeds(["fact_crypto_category"]))
    names = {f.name: F.lit(None).cast(f.dataType) for f in steps.folder_schema(spark, feed.folder).fields}
    names["category_id"] = F.col("id").cast("string")
    names["date_snapshot"] = F.lit("2030-01-01T00:00:00Z")
    path = F.concat(F.lit("f/x-2030-01-0"), (F.col("id") % 2 + 1).cast("string"), F.lit("_00-00-00.parquet"))
    rows = spark.range(1000).select(*[column.alias(n) for n, column in names.items()], path.alias("_file"))
    silver = Store(spark, f"{tmp_path}/s")
    assert builds.build_batch(silver, feed, rows, "a 0") == {"fact_crypto_category": "success"}
    assert silver.read("fact_crypto_category").count() == 1000
    assert silver.last("fact_crypto_category")["read_upto"] == datetime(2030, 1, 2)
    assert 0 < matched.value < 100


def test_a_failed_build_is_repeated_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    silver = Store(spark, f"{root}/s")
    stage(spark, f"{root}/bronze", 1, "crypto_categories")
    run = lambda: builds.run_stream_builds(spark, f"{root}/bronze", silver, f"{root}/check", "10x")
    publish, calls = silver.publish, []

    def failing(df, table, *args, **kw):
        calls.append(table)
        if calls == ["dim_crypto_category", "fact_crypto_category"]:
            raise RuntimeError("lost")
        return publish(df, table, *args, **kw)

    monkeypatch.setattr(silver, "publish", failing)
    with pytest.raises(Exception, match="lost"):
        run()
    assert run()["fact_crypto_category"] == "success"
    assert silver.committed("dim_crypto_category") == [1] and silver.committed("fact_crypto_category") == [1]


def test_tables_of_a_folder_share_its_scan(spark, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", Store(spark, f"{tmp_path}/s")
    stage(spark, bronze, 1, "crypto_categories", "crypto_listings")
    found = steps.snapshots_to_read(spark, bronze, silver, ["dim_crypto_category", "fact_crypto_category", "fact_crypto_market"])
    scans = steps.SharedScans(spark, bronze)
    chosen = found["dim_crypto_category", "crypto_categories_data"]
    for source, rows in ((steps.CATEGORIES, chosen), (steps.CATEGORIES, chosen), (steps.LISTINGS, found["fact_crypto_market", "crypto_listings_latest_data"])):
        scans.announce(source, rows)
    shared = [scans.read(steps.CATEGORIES, chosen) for _ in range(2)]
    assert all("InMemoryTableScan" in df._jdf.queryExecution().toString() for df in shared)
    alone = scans.read(steps.LISTINGS, found["fact_crypto_market", "crypto_listings_latest_data"])
    assert "InMemoryTableScan" not in alone._jdf.queryExecution().toString()
    scans.over(steps.CATEGORIES, chosen)
    assert len(scans.held) == 1
    scans.over(steps.CATEGORIES, chosen)
    assert not scans.held
