import json

from tidemark.sources import payloads


def frame(spark, *bodies, request_id="7"):
    data = [("e", request_id, "2025-01-01T00:00:00+00:00", b if isinstance(b, str) else json.dumps(b)) for b in bodies]
    return spark.createDataFrame(data, "endpoint string, request_id string, fetched_at string, body string")


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_array_payloads_drop_what_is_no_object(spark):
    df = frame(spark, {"data": [{"id": 1, "name": "A", "is_active": 1}, "junk", 5, None, [1], {"id": "x"}]})
    assert [(r["id"], r["name"]) for r in dicts(payloads.exchange_map(df))] == [(1, "A"), (None, None)]
    assert tuple(payloads.malformed_count(payloads.elements(df)).first()) == (2, 4)


def test_unreadable_payloads_give_no_rows(spark):
    df = frame(spark, "not json", {"data": {"id": 1}}, {"data": None}, {}, {"data": "text"}, "[]")
    for parse in (payloads.exchange_map, payloads.crypto_map, payloads.listings, payloads.categories):
        assert parse(df).count() == 0


def test_exchange_info(spark):
    full = {"id": 3, "name": "X", "urls": {"website": ["a", "b"], "fee": []}, "fiats": ["USD", "EUR"], "maker_fee": "bad"}
    got = dicts(payloads.exchange_info(frame(spark, {"data": {"3": full, "4": {"id": 4}, "5": "junk", "6": None}})))
    got.sort(key=lambda r: r["id"])
    assert [r["id"] for r in got] == [3, 4]
    assert got[0]["urls"]["website"] == ["a", "b"] and got[0]["urls"]["fee"] == []
    assert (got[0]["fiats"], got[1]["fiats"]) == ("USD, EUR", "")
    assert got[0]["maker_fee"] is None and got[1]["urls"] is None


def test_exchange_assets_nested_objects_may_miss(spark):
    items = [
        {"wallet_address": "w", "balance": 2, "platform": {"symbol": "S"}, "currency": {"crypto_id": 9, "price_usd": 1.5}},
        {"wallet_address": "v", "platform": None},
    ]
    got = dicts(payloads.exchange_assets(frame(spark, {"data": items})))
    assert got[0]["exchange_id"] == 7 and got[0]["currency_crypto_id"] == 9 and got[0]["currency_price_usd"] == 1.5
    assert got[1]["platform_symbol"] is None and got[1]["balance"] is None


def test_crypto_info_first_links_and_tags(spark):
    data = {
        "10": {"name": "N", "urls": {"website": ["x", "y"], "twitter": []}, "tags": ["a", "b"]},
        "11": {"name": "M", "tags": []},
        "12": "junk",
    }
    got = sorted(dicts(payloads.crypto_info(frame(spark, {"data": data}))), key=lambda r: r["id"])
    assert [(r["id"], r["website"], r["twitter"], r["tags"]) for r in got] == [
        (10, "x", None, "a,b"), (11, None, None, None),
    ]


def test_listings_flatten_quotes(spark):
    coin = {
        "id": 1, "quote": {"USD": {"price": "1e3", "volume_24h": None, "market_cap": True}}, "platform": {"id": 5},
        "tags": [], "infinite_supply": False,
    }
    got = dicts(payloads.listings(frame(spark, {"data": [coin, {"id": 2, "quote": {}, "platform": None}]})))
    assert got[0]["price_usd"] == 1000.0 and got[0]["platform_id"] == 5.0
    assert got[0]["market_cap_usd"] is None and got[0]["tags"] is None and got[0]["infinite_supply"] is False
    assert got[1]["price_usd"] is None and got[1]["platform_id"] is None


def test_category_links(spark):
    bodies = [
        {"data": {"id": "c1", "coins": [{"id": 1}, {"id": None}, {"name": "x"}, {"id": 2}]}},
        {"data": {"id": "c2", "coins": []}},
        {"data": {"coins": [{"id": 3}]}},
    ]
    assert sorted(map(tuple, payloads.category_links(frame(spark, *bodies)).collect())) == [(1, "c1"), (2, "c1")]


def test_global_metrics_keep_rows_without_tracking(spark):
    body = {"data": {"btc_dominance": 50.5, "active_exchanges": 3, "quote": {"USD": {"total_market_cap": 9}}}}
    got = dicts(payloads.global_metrics(frame(spark, body)))[0]
    assert got["btc_dominance"] == 50.5 and got["quote_total_market_cap"] == 9.0
    assert got["tracked_maxIncrementalNumber"] is None and got["active_exchanges"] == 3
    assert len(got) == 44


def test_sentiment_lists_and_single_records(spark):
    df = frame(spark, {"data": [{"value": "40", "timestamp": "1"}, {"value": 60}]}, {"data": {"value": 10, "update_time": "t"}})
    assert sorted(r["value"] for r in dicts(payloads.sentiment(df))) == [10, 40, 60]


def test_span_and_completeness(spark):
    df = spark.createDataFrame([("86400", None), ("0", "x")], "timestamp string, other string")
    assert tuple(payloads.history_span(df, "timestamp").first()) == (2, "0", "86400", "1970-01-01", "1970-01-02")
    got = payloads.completeness(df).orderBy("timestamp").collect()
    assert [(r.non_null_fields, r.null_fields) for r in got] == [(2, 0), (1, 1)]
