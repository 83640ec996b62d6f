"""Folders of snapshot files and JSON payload rows, derived from the verification tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.bindings.inputs import derive, scan
from tidemark.session import pin, work_dir, work_root

_staged: dict[tuple[str, str, str], str] = {}


def snapshot_folder(spark: SparkSession, sf_dir: str) -> str:
    """Line items as one snapshot per year and line number, written by a single job.

    Files are balanced by rows, so a year that holds most rows is spread over many files.
    """
    key = (spark.sparkContext.applicationId, work_root(spark), sf_dir)
    if key not in _staged:
        pin(spark)
        name = F.concat(
            F.lit("listings_batch"),
            F.col("l_linenumber").cast("string"),
            F.lit("-"),
            F.date_format(F.date_trunc("year", "l_shipdate"), "yyyy-MM-dd'_06-00-00.parquet'"),
        )
        folder = work_dir(spark, "snapshots")
        staged = scan(spark, sf_dir, "lineitem").withColumn("snapshot", name).hint("rebalance", "snapshot")
        staged.write.partitionBy("snapshot").parquet(folder)
        _staged[key] = folder
    return _staged[key]


def event_arrivals(spark: SparkSession, sf_dir: str) -> str:
    """A folder of event files in order of arrival, five days to a file.

    Clicks come on time and again with the next file, errors one file late, purchases four files late; all
    others come on time.
    """
    events = scan(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    lags = F.when(F.col("event_type") == "click", F.array(F.lit(0), F.lit(1)))
    lags = lags.when(F.col("event_type") == "error", F.array(F.lit(1)))
    lags = lags.when(F.col("event_type") == "purchase", F.array(F.lit(4))).otherwise(F.array(F.lit(0)))
    period = F.floor(F.datediff("ts", F.lit("2024-01-01")) / 5)
    sent = events.select("*", F.explode(F.transform(lags, lambda lag: period + lag)).alias("arrival"))
    folder = work_dir(spark, "arrivals")
    low, high = sent.agg(F.min("arrival"), F.max("arrival")).first()
    for arrival in range(low, high + 1):  # one after the other: a stream takes files by their time
        part = sent.where(F.col("arrival") == arrival).drop("arrival")
        part.coalesce(1).write.parquet(f"{folder}/arrival-{arrival:04d}.parquet")
    return folder


def _object(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _payload(df: DataFrame, endpoint: str, body: Column, request_id: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(endpoint).alias("endpoint"),
        (F.lit(None) if request_id is None else request_id).cast("string").alias("request_id"),
        F.lit("2024-03-01T00:00:00+00:00").alias("fetched_at"),
        body.alias("body"),
    )


def _list_body(element: Column) -> Column:
    """An array payload whose other elements are no objects."""
    return F.concat(F.lit('{"status":{"error_code":0},"data":['), element, F.lit(',"junk",7,null]}'))


def _map_body(key: Column, element: Column) -> Column:
    return F.concat(F.lit('{"data":{"'), key.cast("string"), F.lit('":'), element, F.lit(',"bad":"junk"}}'))


def _object_body(element: Column) -> Column:
    return F.concat(F.lit('{"data":'), element, F.lit("}"))


def exchange_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    element = _object(
        id=c("s_suppkey"), name=c("s_name"), slug=F.lower("s_name"), is_active=(c("s_acctbal") > 0).cast("int")
    )
    return _payload(scan(spark, sf_dir, "supplier"), "exchange/map", _list_body(element))


def exchange_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    links = F.when(c("s_nationkey") > 5, F.struct(F.array(F.concat(F.lit("https://"), c("s_name"))).alias("website")))
    fiats = F.when(c("s_nationkey") > 10, F.array(F.lit("USD"), F.lit("EUR")))
    element = _object(
        id=c("s_suppkey"),
        name=c("s_name"),
        weekly_visits=c("s_nationkey") * 1000,
        spot_volume_usd=c("s_acctbal"),
        maker_fee=F.when(c("s_nationkey") == 1, F.lit("n/a")).otherwise(F.lit("0.25")),
        urls=links,
        fiats=fiats,
    )
    return _payload(scan(spark, sf_dir, "supplier"), "exchange/info", _map_body(c("s_suppkey"), element))


def exchange_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    platform = F.when(
        c("l_linestatus") == "O", F.struct(c("l_linenumber").alias("crypto_id"), c("l_returnflag").alias("symbol"))
    )
    currency = F.when(
        c("l_returnflag") != "R", F.struct(c("l_partkey").alias("crypto_id"), c("l_extendedprice").alias("price_usd"))
    )
    element = _object(
        wallet_address=F.concat(F.lit("w"), c("l_orderkey").cast("string")),
        balance=c("l_quantity"),
        platform=platform,
        currency=currency,
    )
    body = F.concat(F.lit('{"data":['), element, F.lit("]}"))
    return _payload(scan(spark, sf_dir, "lineitem"), "exchange/assets", body, c("l_suppkey"))


def crypto_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    platform = F.when(
        c("p_size") > 10, F.struct(c("p_size").alias("id"), c("p_type").alias("name"), c("p_brand").alias("token_address"))
    )
    element = _object(id=c("p_partkey"), rank=c("p_size"), name=c("p_name"), symbol=c("p_brand"), platform=platform)
    return _payload(scan(spark, sf_dir, "part"), "crypto/map", _list_body(element))


def crypto_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    urls = F.when(
        c("p_size") > 5,
        F.struct(
            F.array(c("p_name"), F.lit("second")).alias("website"),
            F.array().cast("array<string>").alias("twitter"),
        ),
    )
    tags = F.when(c("p_size") > 20, F.array(c("p_type"), c("p_brand"))).otherwise(F.array().cast("array<string>"))
    element = _object(name=c("p_name"), slug=c("p_brand"), category=c("p_type"), urls=urls, tags=tags)
    return _payload(scan(spark, sf_dir, "part"), "crypto/info", _map_body(c("p_partkey"), element))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    price = F.when(c("l_tax") == 0.08, F.lit("free")).otherwise(c("l_extendedprice").cast("string"))
    usd = F.struct(price.alias("price"), c("l_quantity").alias("volume_24h"), c("l_discount").alias("market_cap"))
    element = _object(
        id=c("l_partkey"),
        cmc_rank=c("l_linenumber"),
        infinite_supply=c("l_linestatus") == "O",
        tags=F.when(c("l_returnflag") == "A", F.array(F.lit("x"), F.lit("y"))),
        platform=F.when(c("l_returnflag") == "N", F.struct(c("l_suppkey").alias("id"))),
        quote=F.when(c("l_returnflag") != "R", F.struct(usd.alias("USD"))),
    )
    return _payload(scan(spark, sf_dir, "lineitem"), "crypto/listings", _list_body(element))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some payloads carry an object where a list is due; they give no rows."""
    c = F.col
    element = _object(
        id=F.concat_ws("/", "p_type", "p_brand"),
        name=c("p_name"),
        num_tokens=F.when(c("p_size") == 3, F.lit("many")).otherwise(c("p_size").cast("string")),
        market_cap=c("p_retailprice"),
    )
    body = F.when(c("p_size") == 50, _object_body(element)).otherwise(_list_body(element))
    return _payload(scan(spark, sf_dir, "part"), "crypto/categories", body)


def category_coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    coins = F.array(F.struct(c("p_partkey").alias("id")), F.struct(F.lit(None).cast("bigint").alias("id")))
    element = _object(id=F.when(c("p_size") > 2, c("p_type")), coins=F.when(c("p_size") < 49, coins))
    return _payload(scan(spark, sf_dir, "part"), "crypto/category", _object_body(element))


def global_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat global input folded back into its nested payload."""
    df = derive(spark, sf_dir, "in_global")
    quotes = [F.col(n).alias(n.removeprefix("quote_")) for n in df.columns if n.startswith("quote_")]
    tracked = [F.col(n).alias(n.removeprefix("tracked_")) for n in df.columns if n.startswith("tracked_")]
    plain = [n for n in df.columns if not n.startswith(("quote_", "tracked_")) and n != "date_snapshot"]
    no_tracking = F.col("tracked_minIncrementalDate") == "soon"
    element = _object(
        **{n: F.col(n) for n in plain},
        quote=F.struct(F.struct(*quotes).alias("USD")),
        tracked_yearly_number=F.when(~no_tracking, F.struct(*tracked)),
    )
    return _payload(df, "global", _object_body(element)).withColumn("fetched_at", F.lit("2024-03-01"))


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of two records and single records."""
    c = F.col
    record = _object(
        value=c("event_id"), value_classification=c("event_type"), timestamp=F.unix_seconds(c("ts").cast("timestamp")).cast("string")
    )
    listed = F.concat(F.lit('{"data":['), record, F.lit(","), record, F.lit("]}"))
    body = F.when(c("event_type") == "view", listed).otherwise(_object_body(record))
    return _payload(scan(spark, sf_dir, "events"), "sentiment", body)
