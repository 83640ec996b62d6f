from pyspark.sql import functions as F

from tidemark.streaming import ingest

SCHEMA = "k int, t timestamp, v string"


def put(spark, folder, name, *rows):
    spark.createDataFrame(list(rows), "k int, t string, v string").withColumn("t", F.to_timestamp("t")).coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{folder}/{name}-2025-01-01_00-00-00.parquet")


DAY = "2025-01-0{} 00:00:00"


def test_each_file_is_taken_once(spark, tmp_path):
    folder, target, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    put(spark, folder, "a", (1, DAY.format(1), "x"))
    drain = lambda: ingest.drain(ingest.snapshot_stream(spark, SCHEMA, folder, 1), target, check)
    drain()
    drain()
    assert spark.read.parquet(target).count() == 1
    put(spark, folder, "b", (2, DAY.format(2), "y"))
    drain()
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [1, 2]


def test_new_keys_are_published_once_however_late(spark, tmp_path):
    folder, target = f"{tmp_path}/in", f"{tmp_path}/out"
    for prune in (None, "t"):
        out = f"{target}-{prune}"
        publish = ingest.publish_new_keys(out, ["k", "t"], prune_by=prune)
        check = f"{tmp_path}/check-{prune}"
        put(spark, folder, "a", (1, DAY.format(1), "x"), (1, DAY.format(1), "x"), (2, DAY.format(5), "y"), (None, DAY.format(5), "n"))
        put(spark, folder, "b", (1, DAY.format(1), "late"), (3, DAY.format(2), "z"))
        ingest.drain_batches(ingest.snapshot_stream(spark, SCHEMA, folder, 1), publish, check)
        got = [(r.k, r.t.day) for r in ingest.read_published(spark, out).collect()]
        assert sorted(got) == [(1, 1), (2, 5), (3, 2)]


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    target = f"{tmp_path}/out"
    publish = ingest.publish_new_keys(target, ["k"])
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0)):
        publish(batch, number)
    assert sorted(r.k for r in ingest.read_published(spark, target).collect()) == [1, 2, 3]
    facts = ingest.publish_fact(f"{target}-facts", {"k": first.select("k")})
    for number in (0, 1, 1):
        facts(second, number)
    assert [r.k for r in ingest.read_published(spark, f"{target}-facts").collect()] == [2, 2]


def test_dedupe_within_a_delay(spark, tmp_path):
    folder, target, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    put(spark, folder, "a", (1, DAY.format(1), "x"), (1, DAY.format(1), "x"), (2, DAY.format(1), "y"))
    stream = ingest.dedupe_within(ingest.snapshot_stream(spark, SCHEMA, folder), ["k", "t"], "t", "2 days")
    ingest.drain(stream, target, check)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [1, 2]


def test_work_of_a_batch_does_not_grow_with_history(spark, tmp_path):
    """Ten batches of 1000 rows, half of them keys of the batch before: each looks up its own keys only."""
    folder, target, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    for k in range(10):
        rows = spark.range(1000).selectExpr(f"CAST(id + {k} * 500 AS INT) AS k", "CAST(NULL AS TIMESTAMP) AS t", f"'{k}' AS v")
        rows.coalesce(1).write.parquet(f"{folder}/a-2025-01-{k + 1:02d}_00-00-00.parquet")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    query = ingest.drain_first_rows(ingest.snapshot_stream(spark, SCHEMA, folder, 1), ["k"], target, check)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 10 and {p["numInputRows"] for p in batches} == {1000}
    assert [len(p["sources"]) for p in batches] == [1] * 10  # what was published is no input
    states = [p["stateOperators"][0] for p in batches]
    assert [s["numRowsTotal"] for s in states] == [1000 + 500 * k for k in range(10)]
    gets = [s["customMetrics"]["rocksdbGetCount"] for s in states]
    assert max(gets[1:]) <= 1.1 * min(gets[1:])
    assert [s["numRowsUpdated"] for s in states] == [1000] + [500] * 9
    rows = spark.read.parquet(target)
    assert rows.count() == rows.select("k").distinct().count() == 5500
    # a later call goes on with the same state, and copies are found however late
    put(spark, folder, "b", (0, DAY.format(1), "late"), (9999, DAY.format(1), "new"), (None, DAY.format(1), "n"), (9999, DAY.format(1), "new"))
    ingest.drain_first_rows(ingest.snapshot_stream(spark, SCHEMA, folder, 1), ["k"], target, check)
    assert [r.k for r in spark.read.parquet(target).where("v IN ('late', 'new', 'n')").collect()] == [9999]


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    folder, target, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    put(spark, folder, "a", (1, DAY.format(1), "x"), (2, DAY.format(8), "x"))
    put(spark, folder, "b", (2, DAY.format(8), "copy"), (8, DAY.format(7), "x"))
    put(
        spark, folder, "c", (1, DAY.format(1), "copy"), (3, DAY.format(5), "late but new"), (4, DAY.format(6), "at it"),
        (5, DAY.format(7), "in time"), (2, DAY.format(8), "copy"),
    )
    put(spark, folder, "d", (5, DAY.format(7), "copy"), (6, DAY.format(9), "x"))
    stream = ingest.dedupe_within(ingest.snapshot_stream(spark, SCHEMA, folder, 1), ["k"], "t", "2 days")
    ingest.drain(stream, target, check)
    assert sorted((r.k, r.v) for r in spark.read.parquet(target).collect()) == [
        (1, "x"), (2, "x"), (5, "in time"), (6, "x"), (8, "x"),
    ]
