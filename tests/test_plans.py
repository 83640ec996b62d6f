import pytest
from pyspark.sql import functions as F

from tidemark.plans import builds, checks, schemas, views
from tidemark.sources.snapshots import read_strict


def frame(spark, ddl, *dict_rows):
    names = [part.strip().split(" ")[0] for part in ddl.split(",")] if "<" not in ddl else None
    if names is None:
        return spark.createDataFrame(list(dict_rows), ddl)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in dict_rows], ddl)


DAY = "2025-05-07T12:00:00+00:00"


def test_market_fact_edge_cases(spark):
    df = frame(
        spark, schemas.LISTINGS,
        {"id": None, "date_snapshot": DAY}, {"id": 1, "date_snapshot": None}, {"id": 1, "date_snapshot": "junk"},
        {"id": 2**40, "date_snapshot": DAY},
        {"id": 5, "date_snapshot": DAY, "price_usd": None}, {"id": 5, "date_snapshot": DAY, "price_usd": 2.0, "batch_index": 2},
        {"id": 5, "date_snapshot": DAY, "price_usd": 1.0, "batch_index": 1},
        {"id": 6, "date_snapshot": DAY, "num_market_pairs": float("nan"), "platform_id": 7.9, "market_cap_usd": 4.0},
    )
    got = {r.crypto_id: r for r in builds.fact_crypto_market(df).collect()}
    assert set(got) == {5, 6}
    assert got[5].price_usd == 1.0 and got[5].snapshot_str == "2025-05-07 12:00:00"
    assert got[6].num_market_pairs is None and got[6].platform_id == 7
    assert got[6].volume_to_market_cap_ratio is None and got[5].volume_to_market_cap_ratio == 0.0


def test_strict_read_fills_missing_columns(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/x")
    df = read_strict(spark, schemas.CRYPTO_ID, f"{tmp_path}/x")
    assert builds.dim_crypto_id(df).orderBy("crypto_id").first().asDict() == {
        "crypto_id": 0, "name": None, "symbol": None, "platform_id": None, "platform_name": None,
        "platform_symbol": None, "platform_token_address": None,
    }


def exchange_info(spark):
    base = {"slug": None, "description": None, "date_launched": "2017-07-14T00:00:00.000Z", "logo": "l", "date_snapshot": DAY}
    urls = [None, {"website": None}, {"website": []}, {"website": ["a", "b"], "fee": ["f"]}]
    fiats = [None, "", "USD", "USD, EUR,GBP "]
    rows = []
    for i, (u, f) in enumerate(zip(urls, fiats), 1):
        links = None if u is None else {k: u.get(k) for k in ("blog", "fee", "twitter", "website")}
        rows.append(base | {"id": i, "urls": links, "fiats": f, "weekly_visits": 10.0, "maker_fee": 0.1, "taker_fee": 0.2,
                            "spot_volume_usd": 2.0 * i})
    return spark.createDataFrame(rows, schemas.EXCHANGE_INFO)


def test_exchange_info_links_and_currencies(spark):
    info = builds.dim_exchange_info(exchange_info(spark))
    got = [r for r in info.orderBy("exchange_id").collect()]
    assert [r.website_url for r in got] == [None, None, None, "a"]
    assert [r.fee_url for r in got] == [None, None, None, "f"]
    assert [r.fiats for r in got] == [None, [""], ["USD"], ["USD", "EUR", "GBP"]]
    assert got[0].date_launched == "2017-07-14 00:00:00"
    names = spark.createDataFrame([(i, f"n{i}") for i in range(1, 5)], "exchange_id int, name string")
    tables = {"dim_exchange_info": info, "dim_exchange_id": names}
    listed = views.view("vw_exchange_supported_fiats", tables)
    assert sorted((r.exchange_id, r.fiat_currency) for r in listed.collect()) == [
        (2, ""), (3, "USD"), (4, "EUR"), (4, "GBP"), (4, "USD"),
    ]
    assert views.exchange_supported_fiats(tables, drop_empty=True).count() == 4
    # launch dates carry a time of day, so the plain-date check reports every row
    assert checks.violations("exchange_11_malformed_launch_date", tables).count() == 4


def test_exchange_map_keeps_its_rows_with_repeated_activity(spark):
    activity = spark.createDataFrame([(1, "a", 1), (1, "a", 0), (2, "b", None)], schemas.EXCHANGE_MAP)
    got = builds.dim_exchange_map(exchange_info(spark), activity)
    assert got.count() == 4
    assert {r.exchange_id: r.is_active for r in got.collect()} == {1: False, 2: None, 3: None, 4: None}


def test_assets_use_the_latest_volume(spark):
    info = exchange_info(spark)
    older = info.withColumns({"date_snapshot": F.lit("2025-05-01T00:00:00Z"), "spot_volume_usd": F.lit(1.0)})
    assets = frame(
        spark, schemas.EXCHANGE_ASSETS,
        {"exchange_id": 1, "date_snapshot": DAY, "wallet_address": "w", "currency_crypto_id": 3, "balance": 4.0, "currency_price_usd": 2.0},
        {"exchange_id": 9, "date_snapshot": DAY, "wallet_address": "w", "currency_crypto_id": 3, "balance": None, "currency_price_usd": 2.0},
        {"exchange_id": 1, "date_snapshot": DAY, "wallet_address": None, "currency_crypto_id": 3},
    )
    got = {r.exchange_id: r for r in builds.fact_exchange_assets(assets, info.unionByName(older)).collect()}
    assert (got[1].spot_volume_usd, got[1].total_usd_value, got[1].wallet_weight) == (2.0, 8.0, 4.0)
    assert (got[9].spot_volume_usd, got[9].total_usd_value, got[9].wallet_weight) == (None, None, None)
    assert builds.fact_exchange_assets(assets).where("spot_volume_usd IS NULL").count() == 2


def test_global_fact_guards_and_flags(spark):
    rows = [
        {"date_snapshot": DAY, "quote_total_market_cap": 1e-7, "quote_total_volume_24h": 5.0},
        {"date_snapshot": "2025-05-08T00:00:00Z", "quote_total_market_cap": -2.0, "quote_total_volume_24h": 5.0, "btc_dominance": 3.0,
         "btc_dominance_yesterday": 1.0, "total_cryptocurrencies": 4, "past_30d_incremental_crypto_number": 1,
         "total_crypto_dex_currencies": 2**40, "tracked_maxIncrementalDate": "2025-02-30", "tracked_minIncrementalDate": "2025-02-03",
         "last_updated": "2025-05-07T23:54:59.5Z"},
    ]
    fact = builds.fact_global_market(frame(spark, schemas.GLOBAL, *rows))
    first, second = fact.orderBy("snapshot_timestamp").collect()
    assert len(fact.columns) == 58
    assert (first.market_liquidity_ratio, first.check_market_liquidity_ratio) == (0.0, False)
    assert (first.defi_volume_share, first.check_defi_volume_share) == (None, None)
    assert second.market_liquidity_ratio == -2.5 and second.btc_dominance_delta == 2.0
    assert second.crypto_growth_rate_30d == 0.25 and second.total_crypto_dex_currencies is None
    assert second.max_new_cryptos_day is None and str(second.min_new_cryptos_day) == "2025-02-03"
    late = views.view("vw_outdated_last_updated_timestamp", {"fact_global_market": fact}).collect()
    assert [r.delay_seconds for r in late] == [300.5]


def test_sentiment_history_and_live_agree(spark):
    history = spark.createDataFrame([(40, "fear", "1746576000"), (40, "fear", "x")], schemas.SENTIMENT_HISTORY)
    live = spark.createDataFrame([(40, "fear", "2025-05-07T00:00:00Z")], schemas.SENTIMENT_LATEST)
    assert builds.sentiment_history(history).collect() == builds.sentiment_live(live).collect()


def test_bands(spark):
    scores = [-1, 0, 24, 25, 49, 50, 51, 74, 75, 100, 101, None]
    df = spark.createDataFrame([(s,) for s in scores], "s int").select(views.sentiment_band(F.col("s")))
    assert [r[0] for r in df.collect()] == [
        None, "extreme fear", "extreme fear", "fear", "fear", "neutral", "greed", "greed", "extreme greed",
        "extreme greed", None, None,
    ]


def test_ordered_views_put_nulls_first_when_descending(spark):
    exmap = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP'2025-01-01 00:00:00', 0.2D, 0.1D), (2, TIMESTAMP'2025-01-01 00:00:00', CAST(NULL AS DOUBLE), 0.1D),"
        " (1, TIMESTAMP'2025-01-02 00:00:00', 0.2D, 0.1D) AS t(exchange_id, snapshot_timestamp, maker_fee, taker_fee)"
    )
    names = spark.createDataFrame([(1, "a"), (2, "b")], "exchange_id int, name string")
    got = views.view("vw_exchange_fee_history", {"dim_exchange_map": exmap, "dim_exchange_id": names}, ordered=True).collect()
    assert [(r.exchange_id, r.snapshot_timestamp.day) for r in got] == [(2, 1), (1, 2), (1, 1)]


def test_checks_find_planted_faults(spark):
    twice = spark.createDataFrame([(1, "a", None), (1, "b", "B")], "crypto_id int, name string, symbol string")
    assert [tuple(r) for r in checks.violations("crypto_02_duplicate_id", {"dim_crypto_id": twice}).collect()] == [(1, 2)]
    assert checks.violations("crypto_01_missing_name_or_symbol", {"dim_crypto_id": twice}).count() == 1
    info = spark.createDataFrame(
        [(1, "2025-01-01", None), (2, "2025-1-01", None), (3, None, "2025-01-01 00:00:00")],
        "crypto_id int, date_added string, date_launched string",
    )
    assert {r.crypto_id for r in checks.violations("crypto_04_malformed_dates", {"dim_crypto_info": info}).collect()} == {2, 3}
    growth = spark.createDataFrame([(1, 5, 9, 6), (2, 7, 9, 6), (3, 10, 9, 6), (4, None, 9, 6), (5, 10, 9, None)],
                                   "snapshot_timestamp int, new_cryptos_last_30d int, max_daily_new_cryptos int, min_daily_new_cryptos int")
    found = checks.violations("global_10_growth_consistency", {"fact_global_market": growth}).collect()
    assert {r.snapshot_timestamp for r in found} == {1, 3, 5}


def test_register_views_for_sql(spark):
    coins = spark.createDataFrame([(1, "a", None)], "crypto_id int, name string, symbol string")
    views.register(spark, {"dim_crypto_id": coins})
    assert spark.sql("SELECT count(*) FROM vw_crypto_missing_names_or_symbols").first()[0] == 1
    assert len(views.names()) == 50 and len(checks.CHECKS) == 42


@pytest.mark.parametrize("name", sorted(views.VIEWS))
def test_declared_views_name_their_dimension_key(name):
    spec = views.VIEWS[name]
    assert spec.dim is None or views.DIMENSIONS[spec.dim][0] in spec.columns
