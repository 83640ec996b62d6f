from tidemark.llm import language

SCHEMA = "doc_id long, text string, lang string, held_out string, score string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = language.identify(docs).join(docs, "doc_id").where("held_out").collect()
    assert len(found) > 2000
    assert sum(r.lang == r.lang_pred for r in found) > 0.99 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def sample(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()
    return [(r.doc_id, r.text, r.lang, "x", "y") for r in rows]


def test_held_out_labels_change_nothing(spark):
    import zlib

    rows = sample(spark)
    hide = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    other = [(i, t, "zz" if hide(i) else lang, a, b) for i, t, lang, a, b in rows]
    one, two = (
        {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in language.identify(spark.createDataFrame(x, SCHEMA)).collect()}
        for x in (rows, other)
    )
    assert one == two and all(one[i][0] == hide(i) for i in one)


def test_odd_rows(spark):
    odd = [(9001, None, "en", "", ""), (9002, "", "en", "", ""), (9003, "12 -- ²!", "en", "", ""), (None, "the thing that was", None, None, None)]
    rows = [*sample(spark), *odd, (9004, "that thing " * 100_000, None, "", ""), odd[0]]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i].lang_pred for i in (9001, 9002, 9003)] == ["und"] * 3 and got[9001].score == 0
    assert got[9004].lang_pred == "en" and got[None].held_out is not None
    empty = spark.createDataFrame(odd, SCHEMA).limit(0)
    assert language.identify(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "text", None, "", "")], SCHEMA)
    assert language.identify(unlabelled).first().lang_pred == "und"
    single = spark.createDataFrame([(i, "only text", "en", "", "") for i in range(9)], SCHEMA)
    assert {r.lang_pred for r in language.identify(single).collect()} == {"en"}
