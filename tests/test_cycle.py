"""Payloads to warehouse: parse, transform, load, repair, check and export."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import checks, loads, steps
from tidemark.sources.store import Store, write_payloads

PAYLOAD = "endpoint string, request_id string, fetched_at string, body string"


def raw(spark, day, fees):
    usd = {"price": 2.0, "volume_24h": 4.0, "market_cap": 8.0}
    coins = [{"id": i, "name": f"c{i}", "symbol": f"S{i}", "rank": i, "is_active": 1} for i in (1, 2)]
    info = {"id": 5, "urls": {"website": ["w"]}, "fiats": ["USD"], "spot_volume_usd": 100.0 if fees else None}
    info |= {"maker_fee": 0.1, "taker_fee": 0.2, "weekly_visits": 7} if fees else {}
    asset = {"wallet_address": "w1", "balance": 3.0, "currency": {"crypto_id": 1, "price_usd": 2.0}}
    bodies = [
        ("exchange_map", "1", [{"id": 5, "name": "X", "is_active": 1}]),
        ("exchange_info", "1", {"5": info}),
        ("exchange_assets", "5", [asset, {"wallet_address": "w2", "balance": 1.0, "currency": {"crypto_id": 99, "price_usd": 1.0}}]),
        ("crypto_map", "1", coins),
        ("crypto_info", "1", {"1": {"slug": "c1", "logo": "l"}}),
        ("crypto_listings", "1", [c | {"quote": {"USD": usd}} for c in coins]),
        ("crypto_listings", "6", [{"id": 3, "quote": {"USD": usd}}]),
        ("crypto_categories", "1", [{"id": "k", "name": "K", "num_tokens": 2, "market_cap": 5.0, "volume": 1.0}]),
        ("crypto_category", "1", {"id": "k", "coins": [{"id": 1}, {"id": 42}]}),
        ("global_metrics", "1", {"btc_dominance": 50.0, "last_updated": day.isoformat() + "+00:00"}),
        ("sentiment_history", "1", [{"value": 10, "timestamp": "0"}, {"value": 20, "timestamp": "86400"}]),
        ("sentiment_latest", "1", {"value": 30, "update_time": day.isoformat() + "+00:00"}),
    ]
    return spark.createDataFrame([(e, r, str(day), json.dumps({"data": d})) for e, r, d in bodies], PAYLOAD)


@pytest.fixture(scope="module")
def cycle(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cycle")
    bronze, silver, warehouse = f"{root}/bronze", Store(spark, f"{root}/silver"), Store(spark, f"{root}/warehouse")
    log = []
    start = datetime.now().replace(microsecond=0) + timedelta(days=1)
    for day, fees in ((start, True), (start + timedelta(days=2), False)):
        for endpoint in steps.PARSERS:
            assert steps.parse_to_bronze(raw(spark, day, fees), endpoint, bronze, day) is not None
        log.append((steps.run_builds(spark, bronze, silver, "all"), loads.run_loads(silver, warehouse)))
    return bronze, silver, warehouse, log


def test_builds_follow_new_snapshots(cycle):
    (first, _), (second, _) = cycle[3]
    assert set(first.values()) == {"success"} and len(first) == 14
    assert second["sentiment_history"] == "up to date"
    assert set(second.values()) == {"success", "up to date"}


def test_loads_take_new_keys_and_valid_rows(cycle):
    (_, first), (_, second) = cycle[3]
    assert first["dim_crypto_id"] == 2 and second["dim_crypto_id"] == 0
    assert first["crypto_category_link"] == 1 and first["fact_exchange_assets"] == 1
    assert first["fact_crypto_market"] == 2  # coin 3 is not in the dimension
    assert first["fact_market_sentiment"] == 3  # the history and the live row
    assert second["fact_market_sentiment"] == 1


def test_nothing_new_is_not_loaded_again(cycle):
    _, silver, warehouse, _ = cycle
    assert set(loads.run_loads(silver, warehouse).values()) == {"up to date"}


def test_repair_rewrites_only_the_load_with_the_gap(cycle):
    _, _, warehouse, _ = cycle
    before = warehouse.live("dim_exchange_map")
    assert loads.run_repairs(warehouse) == {"dim_exchange_map": 1, "fact_exchange_assets": 1}
    assert warehouse.live("dim_exchange_map") == [before[0], before[-1] + 1]
    rows = warehouse.read_all("dim_exchange_map").orderBy("snapshot_timestamp").collect()
    assert [(r.maker_fee, r.weekly_visits) for r in rows] == [(0.1, 7)] * 2
    assets = warehouse.read_all("fact_exchange_assets").collect()
    assert [(r.spot_volume_usd, r.wallet_weight) for r in assets] == [(100.0, 0.06)] * 2
    assert loads.run_repairs(warehouse) == {"dim_exchange_map": 0, "fact_exchange_assets": 0}


def test_summary_matches_the_single_checks(cycle):
    _, _, warehouse, _ = cycle
    tables = {name: warehouse.read_all(name) for name in loads.LOADS}
    found = checks.summary(tables)
    assert set(found) == set(checks.CHECKS)
    for name in ("crypto_03_missing_urls", "global_01_missing_metrics", "exchange_01_missing_spot_volume"):
        df = checks.violations(name, tables)
        assert found[name] == (df.first()[0] if name.startswith("exchange_01") else df.count())


def test_compacting_an_appended_table_keeps_its_rows(cycle):
    _, _, warehouse, _ = cycle
    before = sorted(map(str, warehouse.read_all("fact_global_market").collect()))
    warehouse.compact("fact_global_market", appended=True)
    assert len(warehouse.live("fact_global_market")) == 1
    assert sorted(map(str, warehouse.read_all("fact_global_market").collect())) == before


def test_backlog_is_built_whole(spark, tmp_path):
    bronze, silver, warehouse = f"{tmp_path}/b", Store(spark, f"{tmp_path}/s"), Store(spark, f"{tmp_path}/w")
    start = datetime.now().replace(microsecond=0) + timedelta(days=1)
    for k in range(3):
        day = start + timedelta(days=k)
        bodies = [
            ("crypto_category", {"id": "k", "coins": [{"id": k + 1}]}),
            ("crypto_categories", [{"id": "k", "name": "K", "num_tokens": 2, "market_cap": 5.0, "volume": 1.0}]),
            ("crypto_map", [{"id": k + 1, "name": f"c{k}", "symbol": "S", "rank": 1, "is_active": 1}]),
        ]
        data = [(e, "1", str(day), json.dumps({"data": d})) for e, d in bodies]
        for endpoint, _ in bodies:
            steps.parse_to_bronze(spark.createDataFrame(data, PAYLOAD), endpoint, bronze, day)
    assert steps.run_builds(spark, bronze, silver, "daily")["crypto_category_link"] == "success"
    first = loads.run_loads(silver, warehouse, ("daily",))
    assert first["dim_crypto_id"] == 3 and first["crypto_category_link"] == "dim_crypto_category not loaded yet"
    steps.run_builds(spark, bronze, silver, "10x")
    second = loads.run_loads(silver, warehouse)
    assert second["crypto_category_link"] == 3 and second["dim_crypto_map"] == "up to date"
    assert warehouse.read_all("dim_crypto_map").count() == 3
    assert warehouse.read_all("fact_crypto_category").count() == 3


def test_compacting_a_built_table_loads_nothing(spark, tmp_path):
    silver, warehouse = Store(spark, f"{tmp_path}/s"), Store(spark, f"{tmp_path}/w")
    row = spark.sql("SELECT TIMESTAMP '2024-01-01' AS snapshot_timestamp, 5 AS fear_greed_score, 'x' AS sentiment_label")
    silver.publish(row, "fact_market_sentiment")
    assert loads.run_loads(silver, warehouse)["fact_market_sentiment"] == 1
    silver.compact("fact_market_sentiment")
    assert loads.run_loads(silver, warehouse)["fact_market_sentiment"] == "up to date"
    assert warehouse.read_all("fact_market_sentiment").count() == 1


def test_dropped_rows_are_counted(spark, tmp_path):
    warehouse = Store(spark, f"{tmp_path}/w")
    for name, column, ids in (("dim_crypto_id", "crypto_id", [1, 2]), ("dim_exchange_id", "exchange_id", [])):
        loads.load(warehouse, name, spark.createDataFrame([(i,) for i in ids], f"{column} int"), 1)
    assets = spark.createDataFrame([(1, 7), (2, 8), (3, 7), (4, 7)], "crypto_id int, exchange_id int")
    with pytest.raises(LookupError):
        loads.load(warehouse, "fact_exchange_assets", assets, 1)
    loads.load(warehouse, "dim_exchange_id", spark.createDataFrame([(7,)], "exchange_id int"), 2)
    assert loads.load(warehouse, "fact_exchange_assets", assets, 1) == 1
    assert json.loads(warehouse.last("fact_exchange_assets", "load")["dropped"]) == {"crypto_id": 2, "exchange_id": 1}
    bodies = ['{"data":[{"id":1},3]}', '{"data":[{"id":2}', None, "[]", '{"data":7}']
    raw = spark.createDataFrame([("exchange_map", "1", "t", b) for b in bodies], PAYLOAD)
    steps.parse_to_bronze(raw, "exchange_map", f"{tmp_path}/b", datetime(2024, 1, 1), warehouse)
    entry = warehouse.last("exchange_map_data", "parse")
    assert entry["rows"] == 1 and json.loads(entry["dropped"]) == {"damaged": 4, "invalid": 1}


def test_command_line(spark, cycle, tmp_path, capsys, monkeypatch):
    from tidemark import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda: spark)
    bronze, silver, warehouse, _ = cycle
    cli.main(["transform", bronze, silver.root, "--frequency", "init"])
    assert "up to date" in capsys.readouterr().out
    cli.main(["load", silver.root, warehouse.root, "--frequency", "weekly"])
    cli.main(["repair", warehouse.root])
    cli.main(["check", warehouse.root, "--state", f"{tmp_path}/state"])
    assert "'exchange_08_asset_orphans': 0" in capsys.readouterr().out
    cli.main(["repair", warehouse.root, "--full"])
    cli.main(["check", warehouse.root])
    assert "crypto_01_missing_name_or_symbol" in capsys.readouterr().out
    cli.main(["export", warehouse.root, "vw_crypto_price_evolution", f"{tmp_path}/csv"])
    assert spark.read.option("header", "true").csv(f"{tmp_path}/csv").count() == 4
    cli.main(["export", warehouse.root, "vw_crypto_price_evolution", f"{tmp_path}/none", "--until", "2001-01-01"])
    assert spark.read.option("header", "true").csv(f"{tmp_path}/none").count() == 0
    cli.main(["stream", bronze, f"{tmp_path}/silver", f"{tmp_path}/checkpoint", "--frequency", "weekly"])
    assert "'dim_crypto_info': 'success'" in capsys.readouterr().out
    write_payloads(raw(spark, datetime(2030, 1, 1), True), f"{tmp_path}/payloads")
    cli.main(["parse", f"{tmp_path}/payloads", "exchange_map", f"{tmp_path}/bronze"])
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/bronze").where(F.col("id") == 5).count() == 1


def test_many_keys_are_not_broadcast(spark, tmp_path, monkeypatch):
    store, plans = Store(spark, str(tmp_path)), {}
    publish = store.publish

    def kept(df, table, *args, **kwargs):
        plans.setdefault(table, []).append(df._jdf.queryExecution().executedPlan().toString())
        return publish(df, table, *args, **kwargs)

    monkeypatch.setattr(store, "publish", kept)
    coins = spark.range(300_000).select(F.col("id").cast("int").alias("crypto_id"), F.lit("c").alias("name"))
    links = spark.createDataFrame([("k", 5), ("k", 299_999), ("k", 300_000), ("x", 5), ("k", None)], "category_id string, crypto_id int")
    loads.load(store, "dim_crypto_id", coins, 1)
    loads.load(store, "dim_crypto_category", spark.createDataFrame([("k",)], "category_id string"), 1)
    assert loads.load(store, "crypto_category_link", links, 1) == 2
    assert loads.load(store, "dim_crypto_id", coins.withColumn("crypto_id", F.col("crypto_id") + 10), 2) == 10
    assert plans["crypto_category_link"][0].count("SortMergeJoin") == plans["crypto_category_link"][0].count("BroadcastHashJoin") == 1
    assert "SortMergeJoin" in plans["dim_crypto_id"][1] and "BroadcastHashJoin" not in plans["dim_crypto_id"][1]


def test_rows_are_counted_beside_an_empty_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "HELD_KEYS", 1)
    store = Store(spark, str(tmp_path))
    coins = spark.range(3).select(F.col("id").cast("int").alias("crypto_id"))
    loads.load(store, "dim_crypto_id", coins, 1)
    ranks = spark.createDataFrame([(1, 1), (7, 2)], "crypto_id int, rank int")
    assert loads.load(store, "dim_crypto_map", ranks.where("rank > 2"), 1) == 0
    assert loads.load(store, "dim_crypto_map", ranks.where("rank > 1"), 2) == 0
    assert [json.loads(store.history("dim_crypto_map")["dim_crypto_map"][i]["dropped"]) for i in (0, 1)] == [{"crypto_id": 0}, {"crypto_id": 1}]
