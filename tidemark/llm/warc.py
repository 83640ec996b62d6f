"""WARC archives: writing, and reading by boundary-chain verification.

A reader that splits a file at the magic `WARC/1.1` also splits inside payloads that contain it. So
each occurrence is only a candidate, with the offset where its successor would start. From the file
start, pointer jumping over those links (each round doubles the reach) keeps the reachable records.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import settle, text_or_empty

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
#: Payloads below this many bytes are never revisits.
REVISIT_BYTES = 100


def record_types(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_sha256, refers_to; refers_to is NULL for responses.

    Digests are counted with partial aggregation, and those that occur twice are written out before the pages
    meet them, so that a hot one is one side of a plain join, which adaptive execution can split. Small payloads
    can't be revisits; they join by keys of their own, not by the digest that many of them share.
    Among equal payloads the smallest page_id is the response; rows that repeat that id are responses too.
    """
    rows = pages.select(
        F.col("page_id"),
        F.col("url"),
        text_or_empty("html").alias("html"),
        F.sha2(text_or_empty("html"), 256).alias("payload_sha256"),
        join_key(revisit_bytes).alias("key"),
    )
    repeated = (
        rows.where(F.octet_length("html") >= revisit_bytes)
        .groupBy("key")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(settle(repeated, "repeated-digests"), "key", "left").select(
        "page_id", "url", "html", "payload_sha256", F.when(revisits, F.col("first_id")).alias("refers_to")
    )


def join_key(revisit_bytes: int = REVISIT_BYTES) -> Column:
    """The digest of a payload that may repeat; of a smaller one a text that is no digest and differs by page."""
    own = F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("-"), F.coalesce("url", F.lit("")))
    return F.when(F.octet_length(text_or_empty("html")) >= revisit_bytes, F.sha2(text_or_empty("html"), 256)).otherwise(own)


def _header(name: str, value: Column) -> Column:
    """One header line, left out where the value is NULL; control characters cannot break the line."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\x00-\x1F\x7F]", " "), F.lit("\r\n")), F.lit(""))


def _page_urn(name: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.col(name).cast("string"), F.lit(">"))


def write_warc(typed: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """One record per row of `record_types`, one archive per partition.

    Spark's text writer ends each row with the blank lines that end a record, so the files are plain
    WARC on any file system. A revisit carries its payload too, with the id of the page it repeats.
    A NULL id or url leaves its header out. An empty table gives archives without records.
    """
    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(F.col("refers_to").isNull(), F.lit("response")).otherwise(F.lit("revisit")),
        F.lit("\r\n"),
        _header("WARC-Record-ID", _page_urn("page_id")),
        _header("WARC-Refers-To", _page_urn("refers_to")),
        F.lit(f"WARC-Date: {date}\r\n"),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_sha256"))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length("html") + F.lit(len(HTTP_HEAD))).cast("string"),
        F.lit(END + HTTP_HEAD),
        F.col("html"),
    )
    typed.select(record.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text after each magic, with the place it was read at."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("rid"),
            "value",
        )
    )


def _field(head: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _parsed(pieces: DataFrame) -> DataFrame:
    """Header fields and, if the piece holds its whole record, the payload.

    `need` is the length a piece must have to be a whole record; NULL where no header can be read.
    """
    head = F.substring_index("value", END, 1)
    frame = pieces.withColumn("_head", head).withColumn(
        "_length", F.expr("try_cast(regexp_extract(_head, '(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]+)', 1) AS BIGINT)")
    )
    frame = frame.withColumn("_start", F.octet_length("_head") + F.lit(len(END)))
    frame = frame.withColumn("need", F.when(F.octet_length("value") >= F.col("_start"), F.col("_start") + F.col("_length") + F.lit(len(END))))
    block = F.expr("CAST(substring(CAST(value AS BINARY), _start + 1) AS STRING)")
    http = F.lower(F.coalesce(_field(F.col("_head"), "Content-Type"), F.lit(""))).startswith("application/http")
    frame = frame.withColumn(
        "_http", F.when(http, F.octet_length(F.substring_index(block, END, 1)) + F.lit(len(END))).otherwise(F.lit(0))
    )
    return frame.select(
        *pieces.columns,
        "need",
        _field(F.col("_head"), "WARC-Type").alias("record_type"),
        _field(F.col("_head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("_head"), "WARC-Refers-To").alias("refers_to"),
        _field(F.col("_head"), "WARC-Target-URI").alias("url"),
        F.expr("substring(CAST(value AS BINARY), CAST(_start + _http + 1 AS INT), CAST(_length - _http AS INT))").alias("payload"),
    )


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """Per magic: file, off, next (NULL if no record can start there), whole, and the fields of the piece.

    Offsets are sums of piece lengths: within a split (a bounded number of bytes), then over the splits.
    """
    parsed = (
        _parsed(_pieces(spark, path))
        .withColumn("length", F.octet_length("value").cast("long"))
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
        .withColumn("payload_sha256", F.sha2("payload", 256))
        .drop("value", "payload")
    )
    step = F.col("length") + F.lit(len(MAGIC))
    upto = Window.partitionBy("file", "block").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    rows = parsed.withColumn("_inside", F.coalesce(F.sum(step).over(upto), F.lit(0)))
    totals = parsed.groupBy("file", "block").agg(F.sum(step).alias("_total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", "block", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    off = F.col("_before") + F.col("_inside") - F.lit(len(MAGIC))
    return (
        rows.join(starts, ["file", "block"])
        .withColumn("off", off)
        .where("off >= 0")
        .withColumn("next", F.col("off") + F.lit(len(MAGIC)) + F.col("need"))
        .withColumn("whole", F.col("need") == F.col("length"))
        .drop("_inside", "_before", "block")
    )


def reachable(links: DataFrame) -> DataFrame:
    """file, off of all candidates that the chain from offset 0 of their file reaches.

    `links` has file, off, next. Pointer jumping: after round k each row points 2^k records ahead and
    the first 2^k records are marked, so a file of n candidates takes log2(n) rounds of equi-joins. A
    chain that leaves the candidates (end of the file, or damage) ends there.
    """
    most = links.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    state = links.select("file", "off", F.col("next").alias("hop"), (F.col("off") == 0).alias("seen"))
    for _ in range(math.ceil(math.log2(most)) if most > 1 else 0):
        ahead = state.select("file", F.col("off").alias("hop"), F.col("hop").alias("_hop"))
        marked = state.where("seen AND hop IS NOT NULL").select("file", F.col("hop").alias("off"), F.lit(True).alias("_seen"))
        state = settle(
            state.join(ahead, ["file", "hop"], "left")
            .join(marked, ["file", "off"], "left")
            .select("file", "off", F.col("_hop").alias("hop"), (F.col("seen") | F.coalesce("_seen", F.lit(False))).alias("seen")),
            "warc-jumps",
        )
    return state.where("seen").select("file", "off")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Per record: file, off, record_type, record_id, refers_to, url, payload_bytes, payload_sha256.

    Payloads that contain the magic, or whole records, come back as they were written. A record whose
    end lies beyond the file, and all that follows a damaged header, is not returned. Files without
    records give no rows.
    """
    fields = ["record_type", "record_id", "refers_to", "url", "payload_bytes", "payload_sha256"]
    candidates = settle(_candidates(spark, path), "warc-candidates")
    records = candidates.join(reachable(candidates.select("file", "off", "next")), ["file", "off"])
    split = records.where("next IS NOT NULL AND NOT whole").select("file", F.col("off").alias("record"), "next")
    # A split record meets the pieces inside it by mebibytes of the file, so one long record is no hot key.
    places = F.explode(F.expr("sequence(record >> 20, (next - 1) >> 20)")).alias("place")
    inside = settle(
        split.select("*", places)
        .join(candidates.select("file", "off", "rid", F.expr("off >> 20").alias("place")), ["file", "place"])
        .where("off >= record AND off < next")
        .select("rid", "file", "record", "off"),
        "warc-split-records",
    )
    joined = (
        _pieces(spark, path)
        .select("rid", "value")
        .join(inside, "rid")
        .groupBy("file", "record")
        .agg(F.array_join(F.expr("transform(array_sort(collect_list(struct(off, value))), x -> x.value)"), MAGIC).alias("value"))
        .withColumnRenamed("record", "off")
    )
    mended = (
        _parsed(joined)
        .where(F.octet_length("value") >= F.col("need"))
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
        .withColumn("payload_sha256", F.sha2("payload", 256))
    )
    return records.where("whole").select("file", "off", *fields).unionByName(mended.select("file", "off", *fields))


def page_records(pages: DataFrame, path: str) -> DataFrame:
    """Write the pages as archives under `path`, read them back: page_id, payload_bytes, payload_digest,
    record_type, refers_to. A NULL page_id stays NULL; ids come back in the type that they had."""
    write_warc(record_types(pages), path)
    kind = pages.schema["page_id"].dataType.simpleString()
    urn = lambda name: F.expr(f"try_cast(regexp_extract({name}, '^<urn:page:(.*)>$', 1) AS {kind})")
    return read_warc(pages.sparkSession, path).select(
        urn("record_id").alias("page_id"),
        "payload_bytes",
        F.col("payload_sha256").alias("payload_digest"),
        "record_type",
        urn("refers_to").alias("refers_to"),
    )
