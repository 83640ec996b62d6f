from tidemark import session

SCANS = "spark.sql.files.maxPartitionBytes"


def test_pin_bounds_what_a_task_scans(spark):
    before = spark.conf.get(SCANS)
    try:
        for given, kept in (("128m", session.SCAN_BYTES), ("134217728b", session.SCAN_BYTES), ("1m", 1 << 20)):
            spark.conf.set(SCANS, given)
            session.pin(spark)
            assert session._bytes(spark, spark.conf.get(SCANS)) == kept
    finally:
        spark.conf.set(SCANS, before)


def test_pin_bounds_what_a_task_reads_after_a_shuffle(spark):
    session.pin(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 2)
        rows = spark.range(1 << 21).selectExpr("id", "xxhash64(id) AS a", "xxhash64(id, 1) AS b", "xxhash64(id, 2) AS c")
        # some 64 MB, which two partitions would hold in halves
        assert rows.repartition("id").rdd.getNumPartitions() > 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
