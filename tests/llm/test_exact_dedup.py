from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import drop_exact_copies, exact_groups

SCHEMA = "doc_id long, text string, h int, keep_id string, text_sha256 int"
ROWS = [
    (5, "a  b", 1, "x", 1),
    (3, "a\tb", 1, None, 2),
    (4, "a b ", 1, "x", None),
    (9, None, 1, "x", 1),
    (8, "", None, "x", 1),
    (8, "", 1, "x", 1),
    (None, "c", 1, "x", 1),
    (7, "long " * 50_000, 1, "x", 1),
    (6, "long " * 50_000, 1, "x", 1),
    (2, "a b", 1, "x", 1),
]


def result(frame):
    return sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in frame.collect())


def test_groups(spark):
    got = result(exact_groups(spark.createDataFrame(ROWS, SCHEMA)))
    assert got == [
        (0, None, 1, True),
        (2, 2, 3, True),
        (3, 2, 3, False),
        (4, 4, 1, True),
        (5, 2, 3, False),
        (6, 6, 2, True),
        (7, 6, 2, False),
        (8, 8, 3, True),
        (8, 8, 3, True),
        (9, 8, 3, False),
    ]


def test_hash_collisions_stay_apart(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    assert result(exact_groups(docs, content_hash=lambda digest: F.lit(b"same"))) == result(exact_groups(docs))


def test_empty_table(spark):
    assert exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_survivors_keep_their_columns(spark):
    kept = drop_exact_copies(spark.createDataFrame(ROWS, SCHEMA))
    assert kept.columns == ["doc_id", "text", "h", "keep_id", "text_sha256"]
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 4, 6, 8, 8]
