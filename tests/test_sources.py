from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans import loads, steps
from tidemark.sources import snapshots, store


def put(spark, folder, *names):
    for i, name in enumerate(names):
        spark.range(i + 1).coalesce(1).write.parquet(f"{folder}/{name}")


def test_latest_files_and_unreadable_names(spark, tmp_path):
    folder = str(tmp_path)
    put(spark, folder, "map-2025-05-06_10-00-00.parquet", "map-2025-05-07_09-00-00.parquet", "nodate.parquet",
        "map-2025-05-07_10-00-00.parquet")
    newest = snapshots.latest_snapshots(spark, folder, 2).collect()
    assert [r.suffix for r in newest] == ["2025-05-07_10-00-00", "2025-05-07_09-00-00"]
    assert newest[0].snapshot_ts == datetime(2025, 5, 7, 10) and newest[0]["name"] == "map"
    assert snapshots.list_snapshots(spark, folder).count() == 3


@pytest.mark.parametrize("members, complete", [(5, True), (3, False)])
def test_latest_batch(spark, tmp_path, members, complete):
    folder = str(tmp_path)
    put(spark, folder, *[f"b{i}-2025-05-06_10-00-00.parquet" for i in range(5)])
    put(spark, folder, *[f"b{i}-2025-05-07_10-00-00.parquet" for i in range(members)])
    row = snapshots.latest_batch(spark, folder).first()
    assert (row.suffix, row.members, row.is_complete) == ("2025-05-07_10-00-00", members, complete)
    batch = snapshots.read_latest_batch(spark, "id bigint, gone string", folder)
    assert batch.count() == sum(range(1, members + 1)) and batch.where("gone IS NOT NULL").count() == 0
    strict = snapshots.read_latest_batch(spark, "id bigint", folder, complete_only=True)
    assert strict.count() == 15  # the older batch when the newest is incomplete
    assert snapshots.read_latest_batch(spark, "id bigint", folder, expected=9, complete_only=True) is None


def test_snapshot_write_skips_empty(spark, tmp_path):
    at = datetime(2025, 1, 2, 3, 4, 5)
    assert snapshots.write_snapshot(spark.range(0), str(tmp_path), "x", at) is None
    assert snapshots.write_snapshot(spark.range(2), str(tmp_path), "x", at).endswith("x-2025-01-02_03-04-05.parquet")


def test_versions_and_ledger(spark, tmp_path):
    table = store.Store(spark, str(tmp_path))
    assert table.ledger().count() == 0 and table.read_all("t") is None
    with pytest.raises(LookupError):
        table.read("t")
    assert table.publish(spark.range(3), "t") == (1, 3)
    assert table.publish(spark.range(5).withColumn("extra", F.lit("x")), "t") == (2, 5)
    assert table.read("t").count() == 5 and table.read("t", 1).count() == 3
    assert table.read("t", columns=["extra"]).columns == ["extra"]
    assert table.read_all("t").columns == ["id", "extra"]
    assert table.read_all("t").where("extra IS NULL").count() == 3
    table.publish(spark.range(1).select(F.lit("x").alias("id")), "u", 1)
    table.publish(spark.range(1), "u", 2)
    with pytest.raises(TypeError):
        table.read_all("u")
    # writing a version again replaces it
    assert table.publish(spark.range(4), "t", 2) == (2, 4)
    assert table.read("t").count() == 4 and table.committed("t") == [1, 2]
    assert table.last("t", "transform")["rows"] == 4
    assert table.compact("t") == (3, 4) and table.read("t").count() == 4


def test_an_uncommitted_version_stays_invisible(spark, tmp_path):
    table = store.Store(spark, str(tmp_path))
    table.publish(spark.range(3), "t")
    spark.range(99).write.parquet(table.path("t", 2))  # a write that died before its ledger entry
    assert table.read("t").count() == 3
    with pytest.raises(LookupError):
        table.read("t", 2)


def test_steps_record_skips_and_leave_no_trace_of_failures(spark, tmp_path):
    table = store.Store(spark, str(tmp_path))
    assert steps.run_step(table, "a", lambda: None) == "skipped"
    assert steps.run_step(table, "a", lambda: spark.range(2)) == "success"
    with pytest.raises(Exception):
        steps.run_step(table, "b", lambda: spark.sql("SELECT raise_error('no')"))
    entries = {(r.table_name, r.status) for r in table.ledger().collect()}
    assert entries == {("a", "skipped"), ("a", "success")}


def test_groups_cover_every_table_once():
    grouped = [t for group in loads.FREQUENCIES.values() for t in group]
    assert sorted(grouped) == sorted(loads.LOADS)
    order = loads.load_order()
    for name, spec in loads.LOADS.items():
        for _, referenced in spec.fks:
            assert order.index(referenced) < order.index(name)
    assert loads.load_order(("weekly",)) == ["dim_crypto_info"]
    assert len(steps.builds_for("all")) == 14


def test_load_twice_is_load_once(spark, tmp_path):
    warehouse = store.Store(spark, str(tmp_path))
    coins = spark.createDataFrame([(1, "a"), (2, "b")], "crypto_id int, name string")
    with pytest.raises(LookupError):
        loads.load(warehouse, "fact_crypto_market", coins, 1)
    assert loads.load(warehouse, "dim_crypto_id", coins, 1) == 2
    assert loads.load(warehouse, "dim_crypto_id", coins, 1) == 2  # replay
    assert loads.load(warehouse, "dim_crypto_id", coins, 2) == 0  # nothing new
    assert warehouse.committed("dim_crypto_id") == [1]
    assert warehouse.last("dim_crypto_id", "load", "skipped") is not None
    more = coins.union(spark.createDataFrame([(3, "c")], coins.schema))
    assert loads.load(warehouse, "dim_crypto_id", more, 3) == 1
    facts = spark.createDataFrame([(1, 5.0), (9, 6.0)], "crypto_id int, price_usd double")
    assert loads.load(warehouse, "fact_crypto_market", facts, 1) == 1
    assert loads.load(warehouse, "fact_crypto_market", facts, 2) == 1  # facts append every run
    assert warehouse.read_all("fact_crypto_market").count() == 2


def test_csv_and_payload_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("e", "1", "t", '{"data":[1,"a"]}')], "endpoint string, request_id string, fetched_at string, body string")
    store.write_payloads(df, f"{tmp_path}/p")
    assert store.read_payloads(spark, f"{tmp_path}/p").collect() == df.collect()
    store.export_csv(spark.range(3).withColumn("tags", F.array(F.lit("a,b"), F.lit('c"d'))), f"{tmp_path}/c")
    assert spark.read.option("header", "true").csv(f"{tmp_path}/c").count() == 3
