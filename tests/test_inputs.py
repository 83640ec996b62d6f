from datetime import datetime

from tidemark.bindings import inputs

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"
LINES = (
    "l_partkey bigint, l_linestatus string, l_shipdate timestamp, l_tax double, l_discount double, "
    "l_extendedprice double, l_quantity double"
)


def test_categories_equal_their_text_and_aggregate_by_hash(spark, tmp_path):
    parts = [
        (1, "pear", "Brand#1", "SMALL", 1), (2, "apple", "Brand#1", "SMALL", 2), (2, "Zebra", "Brand#1", "SMALL", 2),
        (3, None, "Brand#2", "SMALL", 3), (4, "apple", "Brand#8", "LARGE", 4), (5, "fig", "Brand#9", None, 5),
        (6, "fig", None, "LARGE", 6), (6, "fig", None, "LARGE", 6), (None, "kiwi", "Brand#1", "SMALL", 7),
    ]
    lines = [
        (part, status, at, 0.02, 0.05, 100.25 * k, float(k))
        for k, part in enumerate([1, 1, 2, 3, 4, 5, 6, None, 7], 1)
        for status in ("O", "F", None)
        for at in (datetime(2024, 4, 2), datetime(2024, 4, 30), datetime(2024, 6, 1), None)
    ]
    spark.createDataFrame(parts, PART).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = inputs.derive(spark, str(tmp_path), "in_categories")
    tables = {name: inputs.scan(spark, str(tmp_path), name) for name in ("lineitem", "part")}
    wanted = spark.sql(inputs.INPUTS["in_categories"], **tables)
    key = lambda row: [str(value) for value in row]
    assert found.schema.simpleString() == wanted.schema.simpleString()
    assert sorted(found.collect(), key=key) == sorted(wanted.collect(), key=key) and found.count() > 10
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
