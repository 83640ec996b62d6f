"""One scan and one write per parse: records, rejects and counts."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.plans import steps
from tidemark.sources import payloads, snapshots

PAYLOAD = "endpoint string, request_id string, fetched_at string, body string"
AT = datetime(2024, 3, 1, 8, 30)


def raw(spark, endpoint, *bodies):
    data = [(endpoint, str(k), "t", b if b is None or isinstance(b, str) else json.dumps(b)) for k, b in enumerate(bodies)]
    return spark.createDataFrame([*data, ("other", "9", "t", "x")], PAYLOAD)


def jobs_of(spark, run):
    """Spark jobs that `run` starts."""
    group = f"jobs-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def rejects(spark, root, endpoint):
    found = steps.read_rejects(spark, root, endpoint)
    return found and sorted((r.request_id, r.reason, r.piece, r.snapshot_ts) for r in found.na.fill("NULL").collect())


def test_rejects_of_every_shape(spark, tmp_path):
    good = {"id": 1, "name": "A"}
    cases = {
        "exchange_map": ([{"data": [good, 5, None, "x"]}, {"data": []}, {"data": {"id": 2}}, "{", None], 1),
        "exchange_info": ([{"data": {"3": good, "4": "junk"}}, {"data": {}}, {"data": [1]}, "[]"], 1),
        "crypto_category": ([{"data": {"id": "k", "coins": [{"id": 1}, {"id": 2}]}}, {"data": 7}, {"data": {"coins": []}}, "{"], 2),
        "global_metrics": ([{"data": {"btc_dominance": 1}}, {"data": None}, {"data": "x"}], 1),
        "sentiment_latest": ([{"data": {"value": 3}}, {"data": [{"value": 4}, 8]}, {}], 2),
    }
    expected = {
        "exchange_map": [("0", "not an object", "5"), ("0", "not an object", "NULL"), ("0", "not an object", "x"),
            ("2", "damaged", '{"data": {"id": 2}}'), ("3", "damaged", "{"), ("4", "damaged", "NULL")],
        "exchange_info": [("0", "not an object", "junk"), ("2", "damaged", '{"data": [1]}'), ("3", "damaged", "[]")],
        "crypto_category": [("1", "not an object", "7"), ("3", "damaged", "{")],
        "global_metrics": [("1", "damaged", '{"data": null}'), ("2", "not an object", "x")],
        "sentiment_latest": [("1", "not an object", "8"), ("2", "damaged", "{}")],
    }
    for endpoint, (bodies, records) in cases.items():
        path = steps.parse_to_bronze(raw(spark, endpoint, *bodies), endpoint, f"{tmp_path}", AT)
        assert spark.read.parquet(path).count() == records, endpoint
        assert rejects(spark, f"{tmp_path}", endpoint) == [(*r, AT) for r in expected[endpoint]], endpoint
        plain = steps.PARSERS[endpoint][0](raw(spark, endpoint, *bodies).where(F.col("endpoint") == endpoint))
        plain = plain.drop("date_snapshot")
        kept = spark.read.parquet(path).select(*plain.columns)
        assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))
    assert {r["name"] for r in snapshots.list_snapshots(spark, f"{tmp_path}").collect()} == set(cases)


def test_one_scan_and_one_job(spark, tmp_path):
    source = f"{tmp_path}/payloads"
    raw(spark, "exchange_map", *[{"data": [{"id": k}, k]} for k in range(50)], "{").repartition(3).write.json(source)
    read = spark.read.schema(PAYLOAD).json(source)
    plan = steps.tagged(read, "exchange_map", AT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    path, jobs = jobs_of(spark, lambda: steps.parse_to_bronze(read, "exchange_map", f"{tmp_path}/b", AT))
    assert jobs == 1 and spark.read.parquet(path).count() == 50
    assert len(rejects(spark, f"{tmp_path}/b", "exchange_map")) == 51


def test_nothing_but_rejects_and_nothing_at_all(spark, tmp_path):
    assert steps.parse_to_bronze(raw(spark, "crypto_map", "{"), "crypto_map", f"{tmp_path}", AT) is None
    assert rejects(spark, f"{tmp_path}", "crypto_map") == [("0", "damaged", "{", AT)]
    assert steps.parse_to_bronze(raw(spark, "crypto_map"), "crypto_info", f"{tmp_path}", AT) is None
    assert rejects(spark, f"{tmp_path}", "crypto_info") is None
    assert snapshots.list_snapshots(spark, f"{tmp_path}").count() == 0


def test_a_snapshot_is_written_by_one_job(spark, tmp_path):
    folder = f"{tmp_path}/f"
    rows = spark.range(100).repartition(4).write.parquet(f"{tmp_path}/rows") or spark.read.parquet(f"{tmp_path}/rows")
    path, jobs = jobs_of(spark, lambda: snapshots.write_snapshot(rows, folder, "x", AT))
    assert jobs == 1 and spark.read.parquet(path).count() == 100
    path, jobs = jobs_of(spark, lambda: snapshots.write_snapshot(rows.where("id < 0"), folder, "y", AT))
    assert jobs == 1 and path is None
    with pytest.raises(FileExistsError):
        snapshots.write_snapshot(rows, folder, "x", AT)
    assert [r["name"] for r in snapshots.list_snapshots(spark, folder).collect()] == ["x"]
    assert spark.read.schema("id long").option("recursiveFileLookup", "true").parquet(folder).count() == 100
    assert Path(folder, "_attempts").is_dir()


def test_records_are_as_without_rejects(spark):
    frame = raw(spark, "e", {"data": [{"id": 1}]})
    assert payloads.crypto_map(frame).columns == [n for n in payloads.crypto_map(payloads.keep_rejects(frame)).columns if n != payloads.REJECT]
