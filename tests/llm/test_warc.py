import hashlib

import pytest
from pyspark.sql import functions as F

from tests.parity import connect, differences
from tidemark.llm import queries, warc
from tidemark.session import work_dir

SCHEMA = "page_id long, url string, html string, off int, record_type string"
LONG = "x" * 120
INNER = "a" + warc.MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + warc.MAGIC + warc.MAGIC[:-1] + warc.MAGIC
ROWS = [
    (4, "http://a", LONG, 1, "x"),
    (2, "http://b\r\nContent-Length: 1", LONG, 1, "x"),
    (9, None, LONG, None, None),
    (1, "http://c", "short", 1, "x"),
    (3, "http://d", "short", 1, "x"),
    (5, "http://e", None, 1, "x"),
    (6, "http://f", "", 1, "x"),
    (7, "http://g", INNER + LONG, 1, "x"),
    (8, "http://h", INNER + LONG, 1, "x"),
    (10, "http://i", "\r\n\r\n" + warc.MAGIC, 1, "x"),
    (11, "http://j", "ä€😀" * 40_000 + INNER, 1, "x"),
    (None, "http://k", "null id", 1, "x"),
    (12, "http://l", INNER, 1, "x"),
    (12, "http://l", INNER, 1, "x"),
]


def expected(rows):
    first = {}
    for page_id, _, html, *_ in rows:
        if len((html or "").encode()) >= 100 and page_id is not None:
            first[html] = min(page_id, first.get(html, page_id))
    out = []
    for page_id, _, html, *_ in rows:
        data, to = (html or "").encode(), first.get(html, page_id)
        revisit = to != page_id
        out.append((page_id or 0, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def collected(frame):
    rows = [(r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()]
    return sorted(rows, key=str)


@pytest.mark.parametrize("parts", [1, 3])
def test_round_trip(spark, parts):
    pages = spark.createDataFrame(ROWS, SCHEMA).coalesce(parts)
    assert collected(warc.page_records(pages, work_dir(spark, "t-warc"))) == expected(ROWS)


def test_small_splits_of_plain_files(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    path = work_dir(spark, "t-warc")
    warc.write_warc(warc.record_types(pages), path, compression="none")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3997")
        got = sorted((r.payload_bytes, r.payload_sha256) for r in warc.read_warc(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == sorted((r[1], r[2]) for r in expected(ROWS))


def test_damage_ends_a_file(spark):
    path = work_dir(spark, "t-warc")
    warc.write_warc(warc.record_types(spark.createDataFrame(ROWS[:1], SCHEMA)).coalesce(1), path, compression="none")
    whole = spark.read.text(path, wholetext=True).first()[0]
    for text, n in ((whole * 3, 3), (whole + whole[:-9], 1), (whole + "junk" + whole, 1), ("junk", 0)):
        other = work_dir(spark, "t-warc")
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(other)
        assert warc.read_warc(spark, other).count() == n


def test_empty_table(spark):
    assert warc.page_records(spark.createDataFrame([], SCHEMA), work_dir(spark, "t-warc")).count() == 0


def test_chain_against_a_walk(spark):
    import random

    random.seed(3)
    rows, want = [], set()
    for file in ("a", "b"):
        nexts = {off: random.choice([off + 1, off + 2, off + 5, None, 99]) for off in range(0, 60)}
        rows += [(file, off, n) for off, n in nexts.items()]
        at = 0
        while at is not None and at in nexts:
            want.add((file, at))
            at = nexts[at]
    links = spark.createDataFrame(rows, "file string, off long, next long")
    assert {(r.file, r.off) for r in warc.reachable(links).collect()} == want


def test_small_payloads_do_not_meet_in_one_task(spark):
    """Nine pages in ten are empty: dealt by the join's key, no partition holds twice the median."""
    rows = [(i, f"u{i}", None if i % 10 else "x" * 200, 1) for i in range(20_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key int").select("page_id", "url", "html")
    small = pages.where("html IS NULL").select(warc.join_key().alias("key"))
    counts = [r["count"] for r in small.groupBy(F.pmod(F.hash("key"), F.lit(16))).count().collect()]
    assert len(counts) == 16 and max(counts) < 2 * sorted(counts)[8]
    typed = warc.record_types(pages)
    assert typed.where("refers_to IS NOT NULL").count() == 1999 and typed.where("refers_to <> 0").count() == 0
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # the counted digests are a written table


def test_text_ids_come_back(spark, tmp_path):
    pages = spark.createDataFrame([("a", "u", "y" * 150), ("b", "u", "y" * 150), (None, "u", "z"), ("c d", "u", None)], "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.page_records(pages, f"{tmp_path}/w").collect()}
    assert got == {"a": ("response", None), "b": ("revisit", "a"), None: ("response", None), "c d": ("response", None)}
