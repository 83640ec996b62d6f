"""Facts in folders by day, and reads that open only the days they need."""

import re
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.bindings.queries import market_by_day
from tidemark.plans import days, loads, views
from tidemark.sources.store import Store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def market(spark):
    return market_by_day(spark, SF)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def scanned_partitions(df):
    """Partitions that the fact's scan has opened, after the query has run."""
    df.collect()
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        elif name == "FileSourceScanExec" and node.metrics().contains("numPartitions"):
            found.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found


def test_bounds_become_partition_filters(market):
    year = days.Period(market, datetime(1997, 1, 1), datetime(1998, 1, 1))
    df = views.view("vw_crypto_price_evolution", year)
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_day[^\]]*>= 1997-01-01", plan_of(df))
    assert re.search(r"PushedFilters: \[[^\]]*price_usd", plan_of(df))
    whole = days.Period(market)["fact_crypto_market"]
    assert 0 < max(scanned_partitions(df)) <= 5 < max(scanned_partitions(days.Period(market, datetime(1990, 1, 1))["fact_crypto_market"]))
    expected = whole.where("year(snapshot_timestamp) = 1997 AND price_usd IS NOT NULL")
    known = market.read_all("dim_crypto_id", ["crypto_id"])
    assert df.count() == expected.join(known, "crypto_id").count() > 0


def test_joined_days_prune_when_the_query_runs(spark, market):
    chosen = days.calendar(spark, date(1992, 1, 1), date(1999, 12, 31)).where("quarter = 4 AND year = 1996")
    df = views.view("vw_crypto_price_evolution", days.Period(market, days=chosen))
    assert "dynamicpruning#" in plan_of(df)
    assert max(scanned_partitions(df)) == 1
    assert {r[0] for r in df.select("snapshot_timestamp").distinct().collect()} == {datetime(1996, 10, 1, 6)}


def test_calendar(spark):
    rows = days.calendar(spark, date(2024, 2, 28), date(2024, 3, 3)).collect()
    assert [(str(r.snapshot_day), r.year, r.quarter, r.month, r.weekday) for r in rows] == [
        ("2024-02-28", 2024, 1, 2, 3), ("2024-02-29", 2024, 1, 2, 4), ("2024-03-01", 2024, 1, 3, 5),
        ("2024-03-02", 2024, 1, 3, 6), ("2024-03-03", 2024, 1, 3, 7),
    ]


def test_layouts_mix_and_columns_stay(spark, tmp_path):
    """Versions in day folders, without them and with a later column are one table."""
    store = Store(spark, f"{tmp_path}/w")
    day = "SELECT 1 AS crypto_id, TIMESTAMP '2024-01-0{0} 10:00:00' AS snapshot_timestamp, {0}.0D AS price_usd"
    name = "fact_crypto_market"
    plain, by_day, wider = (spark.sql(day.format(k)) for k in (1, 2, 3))
    late = spark.sql("SELECT 9 AS crypto_id, CAST(NULL AS TIMESTAMP) AS snapshot_timestamp, 9.0D AS price_usd")
    store.publish(plain, name, phase="load")
    store.publish(by_day.unionByName(late), name, phase="load", derived=days.layout(name, by_day))
    store.publish(wider.withColumn("extra", F.lit("x")), name, phase="load", derived=days.layout(name, wider))
    rows = store.read_all(name, with_version=True)
    assert rows.columns == ["crypto_id", "snapshot_timestamp", "price_usd", "extra", "version"]
    assert sorted((r.version, r.price_usd, r.extra) for r in rows.collect()) == [(1, 1.0, None), (2, 2.0, None), (2, 9.0, None), (3, 3.0, "x")]
    for period, prices in (
        (days.Period(store, datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10)), [1.0]),
        (days.Period(store, datetime(2024, 1, 1, 11), datetime(2024, 1, 9, tzinfo=timezone.utc)), [2.0, 3.0]),
        (days.Period(store, high=datetime(2024, 1, 2, 10, 1)), [1.0, 2.0]),
        (days.Period(store, days=days.calendar(spark, date(2024, 1, 1), date(2024, 1, 2))), [1.0, 2.0]),
        (days.Period(store), [1.0, 2.0, 3.0, 9.0]),
    ):
        assert sorted(r.price_usd for r in period[name].collect()) == prices
    assert list(days.Period(store)) == [name] and len(days.Period(store)) == 1
    with pytest.raises(KeyError):
        days.Period(store)["dim_crypto_id"]
    store.compact(name, appended=True, derived=days.layout(name, plain))
    assert sorted(r.price_usd for r in days.Period(store, datetime(2024, 1, 2))[name].collect()) == [2.0, 3.0]


def test_repair_keeps_day_folders(spark, tmp_path):
    warehouse = Store(spark, f"{tmp_path}/w")
    row = "SELECT 5 AS exchange_id, TIMESTAMP '2024-01-0{} 07:00:00' AS snapshot_timestamp, {} AS weekly_visits, {} AS maker_fee, {} AS taker_fee"
    loads.load(warehouse, "dim_exchange_id", spark.sql("SELECT 5 AS exchange_id, 'x' AS name"), 1)
    for k, values in enumerate((("7", "0.1D", "0.2D"), ("CAST(NULL AS INT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)")), 1):
        loads.load(warehouse, "dim_exchange_map", spark.sql(row.format(k, *values)), k)
    assert loads.run_repairs(warehouse)["dim_exchange_map"] == 1
    got = days.Period(warehouse, datetime(2024, 1, 2), datetime(2024, 1, 3))["dim_exchange_map"].collect()
    assert [(r.weekly_visits, r.maker_fee) for r in got] == [(7, 0.1)]
