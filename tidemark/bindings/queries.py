"""Every registered query: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.bindings import staging
from tidemark.bindings.expected_reports import SUMMARIES
from tidemark.bindings.inputs import bronze, derive, scan
from tidemark.bindings.silver import BUILDS, Silver
from tidemark.functions import columns as cols, kpi
from tidemark.operators import clean, increment, joins, ordered, repair
from tidemark.plans import builds, checks, days, loads, planning, steps, upkeep, views
from tidemark.session import pin, work_dir
from tidemark.sources import payloads, snapshots, store
from tidemark.streaming import builds as stream_builder, ingest

Query = Callable[[SparkSession, str], DataFrame]
c = F.col


def flat(df: DataFrame) -> DataFrame:
    """Arrays and dates as text, so that results compare across engines."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    shown = {
        "array": lambda n: F.array_join(n, "|"),
        "date": lambda n: c(n).cast("string"),
    }
    return df.select(*[shown[k](n).alias(n) if k in shown else c(n) for n, k in kinds.items()])


QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: flat(build(pin(spark), sf_dir))
    return build


# builds ----------------------------------------------------------------------


def _register_tables() -> None:
    def built(table: str) -> Query:
        return lambda spark, sf_dir: flat(BUILDS[table](pin(spark), sf_dir))

    def viewed(name: str) -> Query:
        return lambda spark, sf_dir: flat(views.view(name, Silver(pin(spark), sf_dir)))

    def checked(name: str) -> Query:
        return lambda spark, sf_dir: flat(checks.violations(name, Silver(pin(spark), sf_dir)))

    def summed(table: str) -> Query:
        return lambda spark, sf_dir: checks.row_rule_counts(
            table, Silver(pin(spark), sf_dir)[table], None if table == "fact_global_market" else SUMMARIES[table]
        )

    def loaded(table: str) -> Query:
        return lambda spark, sf_dir: flat(load_rows(Silver(pin(spark), sf_dir), table))

    for table in BUILDS:
        QUERIES[f"build_{table}"] = built(table)
    for name in views.names():
        QUERIES[f"view_{name.removeprefix('vw_')}"] = viewed(name)
    for name in checks.CHECKS:
        QUERIES[f"dq_{name}"] = checked(name)
    for table in SUMMARIES:
        QUERIES[f"dq_summary_{table}"] = summed(table)
    for table in loads.LOADS:
        QUERIES[f"load_{table}"] = loaded(table)


@query
def build_exchange_assets_single_run(spark, sf_dir):
    """Spot volume joined by exchange only, from its latest snapshot."""
    return builds.fact_exchange_assets(
        bronze(spark, sf_dir, "in_exchange_assets"), bronze(spark, sf_dir, "in_exchange_info")
    )


@query
def build_exchange_assets_without_info(spark, sf_dir):
    return builds.fact_exchange_assets(bronze(spark, sf_dir, "in_exchange_assets"))


@query
def build_sentiment_live(spark, sf_dir):
    return builds.sentiment_live(bronze(spark, sf_dir, "in_sentiment"))


@query
def flagship_supply_utilization(spark, sf_dir):
    """Raw listings to the supply report in one plan: clean, dedupe, KPIs, foreign keys, names."""
    coins = builds.dim_crypto_id(bronze(spark, sf_dir, "in_crypto_map"))
    market = builds.fact_crypto_market(bronze(spark, sf_dir, "in_listings"))
    valid = joins.enforce_fks(market, {"crypto_id": coins})
    return views.view("vw_crypto_supply_utilization", {"fact_crypto_market": valid, "dim_crypto_id": coins})


# dashboard questions -----------------------------------------------------------


def _dashboard(name: str, build: Callable[..., DataFrame], *args) -> None:
    QUERIES[f"dash_{name}"] = lambda spark, sf_dir: flat(build(Silver(pin(spark), sf_dir), *args))


_dashboard("market_size_over_time", views.market_size_over_time)
_dashboard("dominance_over_time", views.dominance_over_time)
_dashboard("category_over_time", views.category_over_time, "SMALL/Brand#2")
_dashboard("leading_categories", views.leading_categories, 10)
_dashboard("capitalisation_and_dominance", views.capitalisation_and_dominance)
_dashboard("defi_over_time", views.defi_over_time)
_dashboard("sentiment_bands", views.sentiment_bands)
_dashboard("sentiment_runs", views.sentiment_runs)
_dashboard("top_wallets", views.top_wallets, 10)


@query
def dq_duplicates_before_dedupe(spark, sf_dir):
    """The uniqueness check on rows that were not deduplicated."""
    raw = bronze(spark, sf_dir, "in_categories")
    keyed = raw.select("category_id", cols.to_time("date_snapshot").alias("snapshot_timestamp"))
    return checks.violations("crypto_15_duplicate_category_key", {"fact_crypto_category": keyed})


# checks that the builds leave nothing to find for, on rows as they come
RAW_REPEATS = {
    "crypto_02_duplicate_id": ("dim_crypto_id", "in_crypto_map", {"crypto_id": "id"}),
    "crypto_06_duplicate_map_key": ("dim_crypto_map", "in_crypto_ranks", {"crypto_id": "id"}),
    "exchange_02_duplicate_asset_key": (
        "fact_exchange_assets",
        "in_exchange_assets",
        {"exchange_id": "exchange_id", "wallet_address": "wallet_address", "crypto_id": "currency_crypto_id"},
    ),
    "exchange_05_duplicate_map_key": ("dim_exchange_map", "in_exchange_info", {"exchange_id": "id"}),
    "sentiment_04_duplicate_time": ("fact_market_sentiment", "in_sentiment", {}),
}


def _raw_repeats(name: str) -> Query:
    table, source, keys = RAW_REPEATS[name]

    def found(spark, sf_dir):
        raw = derive(spark, sf_dir, source)
        columns = [c(old).alias(new) for new, old in keys.items()]
        if source == "in_sentiment":
            columns.append(c("hour_start").cast("timestamp").alias("snapshot_timestamp"))
        elif "date_snapshot" in raw.columns:
            columns.append(cols.to_time("date_snapshot").alias("snapshot_timestamp"))
        return checks.violations(name, {table: raw.select(*columns)})

    return found


for _name in RAW_REPEATS:
    QUERIES[f"dq_raw_{_name}"] = lambda spark, sf_dir, run=_raw_repeats(_name): flat(run(pin(spark), sf_dir))


@query
def dq_raw_global_07_duplicate_time(spark, sf_dir):
    """The time check on a global snapshot for every order, so that days with several orders repeat."""
    noon = (c("o_orderdate").cast("timestamp") + F.expr("INTERVAL 12 HOURS")).alias("snapshot_timestamp")
    return checks.violations("global_07_duplicate_time", {"fact_global_market": scan(spark, sf_dir, "orders").select(noon)})


@query
def dq_raw_malformed_dates(spark, sf_dir):
    """The date check on the text that the build casts."""
    raw = derive(spark, sf_dir, "in_crypto_info").withColumnRenamed("id", "crypto_id")
    return checks.violations("crypto_04_malformed_dates", {"dim_crypto_info": raw})


@query
def dq_raw_reference_orphans(spark, sf_dir):
    """Distinct exchanges with wallets that the exchange list leaves out, from unloaded data."""
    tables = {
        "crypto_category_link": bronze(spark, sf_dir, "in_exchange_assets").select(c("exchange_id").alias("crypto_id")),
        "dim_crypto_id": bronze(spark, sf_dir, "in_exchange_map").select(c("id").alias("crypto_id")),
    }
    found = checks.violations("crypto_13_link_crypto_orphans", tables)
    return found.withColumnRenamed("crypto_id", "exchange_id")


# loads and repairs ---------------------------------------------------------------

# what the warehouse holds before the load, for tables that take only new keys
HELD = {
    "dim_crypto_id": "platform_id <= 20",
    "dim_exchange_id": "exchange_id IS NOT NULL AND name LIKE '%0%'",
    "dim_crypto_category": "description = 'SMALL'",
    "dim_crypto_info": "category = 'ECONOMY'",
    "dim_exchange_info": "description LIKE 'A%'",
    "crypto_category_link": "category_id LIKE 'SMALL%'",
}


def load_rows(t: Silver, table: str) -> DataFrame:
    existing = t[table].where(HELD[table]) if table in HELD else None
    return loads.rows_to_load(table, t[table], existing, t)


@query
def load_store_cycle(spark, sf_dir):
    """Load part of a dimension, load it again in full twice, then a fact that refers to it."""
    t = Silver(spark, sf_dir)
    target = store.Store(spark, work_dir(spark, "warehouse"))
    coins = t["dim_crypto_id"]
    loads.load(target, "dim_crypto_id", coins.where(HELD["dim_crypto_id"]), version=1)
    for _ in range(2):
        loads.load(target, "dim_crypto_id", coins, version=2)
    loads.load(target, "fact_crypto_market", t["fact_crypto_market"], version=1)
    market = target.read_all("fact_crypto_market", ["crypto_id", "snapshot_timestamp", "price_usd"])
    names = target.read_all("dim_crypto_id", ["crypto_id", "name"])
    return market.join(names, on="crypto_id")


@query
def step_groups(spark, sf_dir):
    """Bronze snapshots through all build and load groups; the warehouse ledger as result."""
    root = work_dir(spark, "groups")
    staged = {
        "crypto_map_data": "in_crypto_map", "crypto_info_data": "in_crypto_info",
        "crypto_category_data": "in_category_links", "crypto_categories_data": "in_categories",
        "crypto_listings_latest_data": "in_listings", "global_metrics_data": "in_global",
        "latest_fear_and_greed_data": "in_sentiment",
    }
    for folder, name in staged.items():
        snapshots.write_snapshot(bronze(spark, sf_dir, name), f"{root}/bronze/{folder}", "s", datetime(2024, 3, 1))
    silver, warehouse = store.Store(spark, f"{root}/silver"), store.Store(spark, f"{root}/warehouse")
    steps.run_builds(spark, f"{root}/bronze", silver)
    loads.run_loads(silver, warehouse)
    return warehouse.ledger().select("table_name", "phase", "status", "rows")


# what of each table shows whether its rows are right: texts, then numbers
CONTENTS = {
    "dim_crypto_id": (("name", "symbol", "platform_name"), ("crypto_id", "platform_id")),
    "dim_exchange_id": (("name",), ("exchange_id",)),
    "dim_crypto_category": (("category_id", "name", "title"), ()),
    "dim_crypto_info": (("slug", "category", "website_url"), ("crypto_id",)),
    "dim_exchange_info": (("slug", "date_launched", "website_url"), ("exchange_id",)),
    "crypto_category_link": (("category_id",), ("crypto_id",)),
    "dim_crypto_map": (("last_historical_data",), ("crypto_id", "rank", "is_active")),
    "dim_exchange_map": ((), ("exchange_id", "weekly_visits", "maker_fee")),
    "fact_crypto_market": (("last_updated_usd",), ("crypto_id", "price_usd", "supply_utilization")),
    "fact_crypto_category": (("category_id",), ("num_tokens", "market_cap", "dominance_per_token")),
    "fact_exchange_assets": (("wallet_address",), ("exchange_id", "crypto_id", "wallet_weight")),
    "fact_market_sentiment": (("sentiment_label",), ("fear_greed_score",)),
    "fact_global_market": (("last_updated_str",), ("total_market_cap", "btc_dominance_delta", "active_exchanges")),
}


def contents(warehouse: store.Store) -> DataFrame:
    """Rows of all warehouse tables under common column names."""
    frames = []
    for table, (texts, numbers) in CONTENTS.items():
        df = warehouse.read_all(table)
        at = c("snapshot_timestamp") if "snapshot_timestamp" in df.columns else F.lit(None).cast("timestamp")
        shown = [c(n) for n in texts] + [F.lit(None).cast("string")] * (3 - len(texts))
        counted = [c(n).cast("double") for n in numbers] + [F.lit(None).cast("double")] * (3 - len(numbers))
        columns = [x.alias(f"t{i}") for i, x in enumerate(shown)] + [x.alias(f"n{i}") for i, x in enumerate(counted)]
        frames.append(df.select(F.lit(table).alias("table_name"), at.alias("at"), *columns))
    return clean.union_all(frames)


def stage_bronze(spark, sf_dir, root: str) -> None:
    """One snapshot of each of the 11 bronze folders; scores before a day are history, later ones live."""
    frames = {
        "crypto_info_data": "in_crypto_info", "crypto_category_data": "in_category_links",
        "crypto_categories_data": "in_categories", "crypto_listings_latest_data": "in_listings",
        "global_metrics_data": "in_global", "exchange_map_data": "in_exchange_map",
        "exchange_info_data": "in_exchange_info", "exchange_assets_data": "in_exchange_assets",
    }
    staged = {folder: bronze(spark, sf_dir, name) for folder, name in frames.items()}
    coins, coin_ranks = bronze(spark, sf_dir, "in_crypto_map"), bronze(spark, sf_dir, "in_crypto_ranks")
    staged["crypto_map_data"] = coins.join(coin_ranks, "id", "left")
    scores = bronze(spark, sf_dir, "in_sentiment")
    early = F.expr("timestamp::bigint div 86400 % 2 = 0")
    staged["fear_and_greed_data"], staged["latest_fear_and_greed_data"] = scores.where(early), scores.where(~early)
    for folder, df in staged.items():
        snapshots.write_snapshot(df, f"{root}/{folder}", "s", datetime(2024, 3, 1))


@query
def step_shared_scan(spark, sf_dir):
    """All 11 folders through the builds, each scanned once for its tables, and the loads; what 13 tables hold."""
    root = work_dir(spark, "shared")
    stage_bronze(spark, sf_dir, f"{root}/bronze")
    silver, warehouse = store.Store(spark, f"{root}/silver"), store.Store(spark, f"{root}/warehouse")
    steps.run_builds(spark, f"{root}/bronze", silver)
    loads.run_loads(silver, warehouse)
    return contents(warehouse)


@query
def stream_builds(spark, sf_dir):
    """The same 11 folders by streams, the category links in two later snapshots; each call builds what is new."""
    root = work_dir(spark, "stream-builds")
    stage_bronze(spark, sf_dir, f"{root}/bronze")
    silver, warehouse = store.Store(spark, f"{root}/silver"), store.Store(spark, f"{root}/warehouse")
    links = bronze(spark, sf_dir, "in_category_links")
    for day in (2, 3):
        stream_builder.run_stream_builds(
            spark, f"{root}/bronze", silver, f"{root}/checkpoint", archive_root=f"{root}/built"
        )
        loads.run_loads(silver, warehouse)
        part = links.where(F.pmod("crypto_id", F.lit(3)) < day)
        snapshots.write_snapshot(part, f"{root}/bronze/crypto_category_data", "s", datetime(2024, 3, day))
    stream_builder.run_stream_builds(spark, f"{root}/bronze", silver, f"{root}/checkpoint", archive_root=f"{root}/built")
    loads.run_loads(silver, warehouse)
    return contents(warehouse)


@query
def step_backlog(spark, sf_dir):
    """Three snapshots of the category links, each with other keys, built and loaded in one run."""
    root = work_dir(spark, "backlog")
    links = bronze(spark, sf_dir, "in_category_links")
    for day in range(3):
        part = links.where(F.pmod("crypto_id", F.lit(3)) == day)
        snapshots.write_snapshot(part, f"{root}/bronze/crypto_category_data", "s", datetime(2024, 3, 1 + day))
    for folder, name in (("crypto_map_data", "in_crypto_map"), ("crypto_categories_data", "in_categories")):
        snapshots.write_snapshot(bronze(spark, sf_dir, name), f"{root}/bronze/{folder}", "s", datetime(2024, 3, 1))
    silver, warehouse = store.Store(spark, f"{root}/silver"), store.Store(spark, f"{root}/warehouse")
    steps.run_builds(spark, f"{root}/bronze", silver)
    loads.run_loads(silver, warehouse)
    return warehouse.read_all("crypto_category_link")


@query
def load_after_compact(spark, sf_dir):
    """A compacted build is no new build: the second run loads nothing."""
    root = work_dir(spark, "compacted")
    silver, warehouse = store.Store(spark, f"{root}/silver"), store.Store(spark, f"{root}/warehouse")
    silver.publish(Silver(spark, sf_dir)["fact_market_sentiment"], "fact_market_sentiment")
    loads.run_loads(silver, warehouse)
    silver.compact("fact_market_sentiment")
    loads.run_loads(silver, warehouse)
    return warehouse.read_all("fact_market_sentiment")


@query
def load_drop_counts(spark, sf_dir):
    """What the ledger says about rows that foreign keys dropped."""
    t = Silver(spark, sf_dir)
    target = store.Store(spark, work_dir(spark, "drops"))
    for table in ("dim_crypto_id", "dim_exchange_id", "fact_exchange_assets"):
        loads.load(target, table, t[table], version=1)
    kept = target.ledger().where("dropped IS NOT NULL")
    counts = F.from_json("dropped", "crypto_id bigint, exchange_id bigint")
    return kept.select("table_name", "rows", counts["crypto_id"].alias("crypto_id"), counts["exchange_id"].alias("exchange_id"))


@query
def step_repairs(spark, sf_dir):
    """Two loads of the exchange map with the repair run on the warehouse after them."""
    warehouse = store.Store(spark, work_dir(spark, "repairs"))
    rows = Silver(spark, sf_dir)["dim_exchange_map"]
    late = F.month("snapshot_timestamp") > 6
    warehouse.publish(rows.where(~late), "dim_exchange_map", 1, phase="load")
    warehouse.publish(rows.where(late), "dim_exchange_map", 2, phase="load")
    loads.run_repairs(warehouse)
    return warehouse.read_all("dim_exchange_map")


def in_three_loads(df: DataFrame, ts: str) -> list[DataFrame]:
    """Two loads in order of time, and a third with the newest rows and those of all Mays, which come late."""
    late, at = F.month(ts) == 5, F.year(ts)
    number = F.when(late, 3).when(at < 1998, 1).when(at < 2000, 2).otherwise(3)
    return [df.where(F.coalesce(number, F.lit(3)) == k) for k in (1, 2, 3)]


@query
def repair_incremental(spark, sf_dir):
    """Three loads of both exchange tables, each repaired from the load and the state carried from the last."""
    warehouse, t = store.Store(spark, work_dir(spark, "upkeep")), Silver(spark, sf_dir)
    parts = {name: in_three_loads(t[name], "snapshot_timestamp") for name in repair.REPAIRS}
    for k in range(3):
        for name, loaded in parts.items():
            warehouse.publish(loaded[k], name, phase="load", derived=days.layout(name, loaded[k]))
        upkeep.run_repairs(warehouse)
    shown = {"dim_exchange_map": ("weekly_visits", "maker_fee", "taker_fee"), "fact_exchange_assets": ("spot_volume_usd", "wallet_weight", "balance")}
    frames = []
    for name, numbers in shown.items():
        values = [c(n).cast("double").alias(f"n{i}") for i, n in enumerate(numbers)]
        frames.append(warehouse.read_all(name).select(F.lit(name).alias("table_name"), "exchange_id", "snapshot_timestamp", *values))
    return clean.union_all(frames)


@query
def dq_incremental_duplicates(spark, sf_dir):
    """Keys that repeat inside and across three loads of rows as they come, from counts by load."""
    warehouse, state = (store.Store(spark, work_dir(spark, n)) for n in ("raw-loads", "check-state"))
    raw = bronze(spark, sf_dir, "in_crypto_ranks")
    keyed = raw.select(c("id").alias("crypto_id"), cols.to_time("date_snapshot").alias("snapshot_timestamp"), "rank")
    # by rank, so that keys repeat across loads
    for k in range(3):
        warehouse.publish(keyed.where(F.coalesce(F.pmod("rank", F.lit(3)), F.lit(0)) == k), "dim_crypto_map", phase="load")
        found = upkeep.check_unique(warehouse, state, "crypto_06_duplicate_map_key")
    return found


@query
def dq_incremental_orphans(spark, sf_dir):
    """Wallets of unlisted exchanges over three loads; some exchanges are listed after their wallets."""
    warehouse, state = (store.Store(spark, work_dir(spark, n)) for n in ("raw-loads", "check-state"))
    t = Silver(spark, sf_dir)
    listed = c("exchange_id") % 2 == 0
    venues = (t["dim_exchange_id"].where(listed), t["dim_exchange_id"].where("false"), t["dim_exchange_id"].where(~listed))
    for wallets, names in zip(in_three_loads(t["fact_exchange_assets"], "snapshot_timestamp"), venues, strict=True):
        warehouse.publish(names, "dim_exchange_id", phase="load")
        warehouse.publish(wallets.select("exchange_id", "wallet_address"), "fact_exchange_assets", phase="load")
        found = upkeep.check_references(warehouse, state, "exchange_08_asset_orphans")
    return found


@query
def repair_exchange_map(spark, sf_dir):
    return repair.repair_exchange_map(Silver(spark, sf_dir)["dim_exchange_map"])


@query
def repair_spot_volume(spark, sf_dir):
    return repair.repair_spot_volume(Silver(spark, sf_dir)["fact_exchange_assets"])


# payload parsing -------------------------------------------------------------------


@query
def parse_exchange_map(spark, sf_dir):
    return payloads.exchange_map(staging.exchange_map(spark, sf_dir))


@query
def parse_exchange_info(spark, sf_dir):
    parsed = payloads.exchange_info(staging.exchange_info(spark, sf_dir))
    return parsed.withColumn("urls", cols.first_of("urls.website"))


@query
def parse_exchange_assets(spark, sf_dir):
    return payloads.exchange_assets(staging.exchange_assets(spark, sf_dir))


@query
def parse_crypto_map(spark, sf_dir):
    return payloads.crypto_map(staging.crypto_map(spark, sf_dir))


@query
def parse_crypto_info(spark, sf_dir):
    return payloads.crypto_info(staging.crypto_info(spark, sf_dir))


@query
def parse_listings(spark, sf_dir):
    return payloads.listings(staging.listings(spark, sf_dir))


@query
def parse_categories(spark, sf_dir):
    return payloads.categories(staging.categories(spark, sf_dir))


@query
def parse_category_links(spark, sf_dir):
    return payloads.category_links(staging.category_coins(spark, sf_dir))


@query
def parse_global_metrics(spark, sf_dir):
    return payloads.global_metrics(staging.global_metrics(spark, sf_dir))


@query
def parse_sentiment(spark, sf_dir):
    return payloads.sentiment(staging.sentiment(spark, sf_dir))


@query
def parse_event_properties(spark, sf_dir):
    events = scan(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query
def parse_malformed_count(spark, sf_dir):
    return payloads.malformed_count(payloads.elements(staging.exchange_map(spark, sf_dir)))


@query
def parse_payload_counts(spark, sf_dir):
    """Payloads of which some end too early, counted by the rule of the parse step."""
    whole = staging.exchange_map(spark, sf_dir)
    cut = c("body").contains("5,")
    raw = whole.withColumn("body", F.when(cut, F.expr("substring(body, 1, length(body) - 9)")).otherwise(c("body")))
    return raw.agg(*payloads.count_columns())


def damaged_exchange_map(spark, sf_dir) -> DataFrame:
    """Payloads of which some end too early."""
    cut = F.when(c("body").contains("5,"), F.expr("substring(body, 1, length(body) - 9)")).otherwise(c("body"))
    return staging.exchange_map(spark, sf_dir).withColumns({"endpoint": F.lit("exchange_map"), "body": cut})


@query
def parse_rejects(spark, sf_dir):
    """Bodies and elements that gave no record, with their reasons, and the records from the same write."""
    root = work_dir(spark, "rejects")
    path = steps.parse_to_bronze(damaged_exchange_map(spark, sf_dir), "exchange_map", root, datetime(2024, 3, 1))
    rejects = steps.read_rejects(spark, root, "exchange_map").select("reason", "piece", "fetched_at")
    names = snapshots.read_strict(spark, "name string", path).select(F.lit("record").alias("reason"), c("name").alias("piece"))
    return rejects.unionByName(names, allowMissingColumns=True)


@query
def parse_numeric_coercion(spark, sf_dir):
    text = F.when(c("event_type") == "error", F.lit("n/a")).otherwise(c("value").cast("string"))
    events = scan(spark, sf_dir, "events").select("event_id", text.alias("value"))
    return payloads.numeric(events, ["value", "not_there"])


@query
def parse_completeness(spark, sf_dir):
    return payloads.completeness(derive(spark, sf_dir, "in_crypto_info")).select(
        "id", "non_null_fields", "null_fields"
    )


@query
def parse_stamped_rows(spark, sf_dir):
    rows = scan(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return payloads.stamped(rows, F.lit("2024-03-01T00:00:00+00:00"), c("l_linenumber") - 1)


@query
def parse_request_chunks(spark, sf_dir):
    return increment.request_chunks(scan(spark, sf_dir, "part"), "p_partkey", 200)


@query
def parse_file_batches(spark, sf_dir):
    """Rows to chunks of 200, five chunks to a file."""
    rows = scan(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    chunks = ordered.chunked(rows, [c("o_orderkey").asc()], 200)
    return (
        chunks.withColumn("file_id", F.expr("(chunk_id - 1) div 5 + 1"))
        .groupBy("file_id")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
            F.max("chunk_id").alias("last_chunk"),
        )
    )


@query
def parse_history_span(spark, sf_dir):
    return payloads.history_span(bronze(spark, sf_dir, "in_sentiment"), "timestamp")


@query
def parse_then_build_market(spark, sf_dir):
    """Payload text all the way to the fact: parse, stamp, clean, KPIs."""
    parsed = payloads.listings(staging.listings(spark, sf_dir))
    stamped = payloads.stamped(parsed, F.lit("2024-03-01T00:00:00+00:00"), F.lit(1))
    fact = builds.fact_crypto_market(stamped)
    return fact.select("crypto_id", "snapshot_timestamp", "cmc_rank", "price_usd", "volume_to_market_cap_ratio")


# increment planning ------------------------------------------------------------------


def _since(later: bool):
    """Orders before a day, or from it on: every order is on one of the two sides."""
    return (c("o_orderdate") >= "1993-01-01") == later


def _customers_of(spark, sf_dir, later: bool) -> DataFrame:
    return scan(spark, sf_dir, "orders").where(_since(later)).select(c("o_custkey").alias("id"))


def _customers(spark, sf_dir) -> DataFrame:
    return scan(spark, sf_dir, "customer").select(c("c_custkey").alias("id"))


@query
def plan_key_changes(spark, sf_dir):
    return increment.key_changes(_customers_of(spark, sf_dir, False), _customers_of(spark, sf_dir, True), "id")


@query
def plan_change_summary(spark, sf_dir):
    return increment.change_summary(_customers_of(spark, sf_dir, False), _customers_of(spark, sf_dir, True), "id")


@query
def plan_ids_to_fetch(spark, sf_dir):
    return increment.ids_to_fetch(_customers(spark, sf_dir), _customers_of(spark, sf_dir, False), "id")


@query
def plan_categories_to_fetch(spark, sf_dir):
    links, known = derive(spark, sf_dir, "in_category_links"), derive(spark, sf_dir, "in_categories")
    return increment.ids_to_fetch(links, known, "category_id")


def _responses(spark, sf_dir) -> DataFrame:
    orders = scan(spark, sf_dir, "orders").where(_since(True))
    return orders.select(c("o_custkey").alias("id"), (c("o_totalprice") > 250000).alias("has_data"))


@query
def plan_active_set_full(spark, sf_dir):
    asked = _customers(spark, sf_dir)
    return increment.active_set(asked, _responses(spark, sf_dir), "id", True, asked)


@query
def plan_active_set_partial(spark, sf_dir):
    previous = _customers_of(spark, sf_dir, False)
    asked = _responses(spark, sf_dir)
    return increment.active_set(asked, asked, "id", False, previous)


PLAN_DAYS = (date(2024, 3, 1), date(2024, 3, 11), date(2024, 4, 5))


def plan_three_days(spark, sf_dir) -> store.Store:
    """Customers of every third order year are listed on a day; those with a large order there have data."""
    target = store.Store(spark, work_dir(spark, "plan"))
    orders = scan(spark, sf_dir, "orders").select(
        c("o_custkey").alias("id"), (c("o_totalprice") > 250000).alias("has_data"), F.pmod(F.year("o_orderdate"), F.lit(3)).alias("part")
    )
    parts, answers = [orders.where(c("part") == k) for k in range(3)], None
    for day, part in zip(PLAN_DAYS, parts, strict=True):
        planning.plan_day(target, "coins", part, "id", day, answers)
        answers = part.select("id", "has_data")
    return target


@query
def plan_state_step(spark, sf_dir):
    """The state of ids after three days: a full scan, a partial one and the next full one."""
    state = plan_three_days(spark, sf_dir).read("plan_coins")
    return state.withColumns({n: c(n).cast("string") for n in ("first_seen", "removed_at")})


@query
def plan_state_requests(spark, sf_dir):
    """Requests of all three days: which ids, in which chunk."""
    target = plan_three_days(spark, sf_dir)
    return target.read_all("requests_coins", with_version=True).withColumnRenamed("version", "day_number")


@query
def plan_reconcile(spark, sf_dir):
    return increment.reconcile(_customers(spark, sf_dir), _customers_of(spark, sf_dir, False), "id")


@query
def plan_freshness(spark, sf_dir):
    return _freshness(spark, sf_dir, daily=True)


@query
def plan_freshness_exact(spark, sf_dir):
    return _freshness(spark, sf_dir, daily=False)


def _freshness(spark, sf_dir, daily: bool) -> DataFrame:
    orders = scan(spark, sf_dir, "orders").withColumn("at", c("o_orderdate").cast("timestamp"))
    runs = orders.where("o_orderstatus <> 'O'").select(
        c("o_custkey").alias("table_id"), (c("at") + F.expr("INTERVAL 6 HOURS")).alias("ended_at")
    )
    taken = orders.where("o_orderstatus = 'O'").groupBy(c("o_custkey").alias("table_id")).agg(
        (F.max("at") + F.expr("INTERVAL 9 HOURS")).alias("snapshot_ts")
    )
    unreadable = scan(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").select(
        c("c_custkey").alias("table_id"), F.lit(None).cast("timestamp").alias("snapshot_ts")
    )
    return increment.fresh_snapshots(taken.unionByName(unreadable), runs, "table_id", daily)


def _transforms(spark, sf_dir) -> DataFrame:
    orders = scan(spark, sf_dir, "orders").where("o_orderpriority < '4'")
    return orders.select(
        c("o_custkey").alias("table_id"),
        F.date_trunc("year", "o_orderdate").alias("ended_at"),
        F.when(c("o_orderstatus") == "P", "skipped").otherwise("success").alias("status"),
        F.lit("transformed").alias("current_status"),
    )


def _loads(spark, sf_dir) -> DataFrame:
    orders = scan(spark, sf_dir, "orders").where("o_orderpriority >= '4'")
    return orders.select(
        c("o_custkey").alias("table_id"),
        c("o_orderdate").cast("timestamp").alias("ended_at"),
        F.date_trunc("year", "o_orderdate").alias("transformation_ended_at"),
    )


@query
def plan_load_decisions(spark, sf_dir):
    return increment.load_decisions(_transforms(spark, sf_dir), _loads(spark, sf_dir), "table_id")


@query
def plan_last_entries(spark, sf_dir):
    ledger = scan(spark, sf_dir, "orders").select(
        c("o_custkey").alias("table_id"), c("o_orderdate").cast("timestamp").alias("ended_at"),
        c("o_orderkey").alias("run_id"), c("o_orderstatus").alias("status"),
    )
    return increment.last_entries(ledger, "table_id", "ended_at")


@query
def plan_not_initialised(spark, sf_dir):
    done = (c("o_orderstatus") == "F") & (c("o_orderpriority") == "1-URGENT")
    ledger = scan(spark, sf_dir, "orders").select(
        c("o_custkey").alias("id"), F.when(done, "success").otherwise("skipped").alias("status")
    )
    return increment.not_initialised(_customers(spark, sf_dir), ledger, "id")


@query
def plan_loaded_category_ids(spark, sf_dir):
    links = derive(spark, sf_dir, "in_category_links")
    return links.groupBy("category_id").agg(F.count(F.lit(1)).alias("links"))


@query
def plan_frame_profile(spark, sf_dir):
    return increment.frame_profile(scan(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"))


# cleaning ------------------------------------------------------------------------


@query
def clean_rename_select(spark, sf_dir):
    renamed = scan(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": "holder_id", "c_acctbal": "balance"})
    return clean.project(renamed, {"holder_id": "holder_id", "balance": "balance", "segment": "c_mktsegment"})


@query
def clean_narrowing(spark, sf_dir):
    """Casts whose overflow gives NULL."""
    lines = scan(spark, sf_dir, "lineitem")
    return clean.project(
        lines,
        {
            "l_orderkey": "l_orderkey",
            "scaled_price": cols.to_int(c("l_extendedprice") * 50000),
            "scaled_key": cols.to_int(c("l_partkey") * 4000000),
        },
    )


@query
def clean_longs_to_ints(spark, sf_dir):
    return clean.longs_to_ints(scan(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))


@query
def clean_required_keys(spark, sf_dir):
    return clean.require_keys(derive(spark, sf_dir, "in_exchange_assets"), ["wallet_address", "balance"])


@query
def clean_keep_first(spark, sf_dir):
    lines = scan(spark, sf_dir, "lineitem").withColumn("l_shipdate", c("l_shipdate").cast("timestamp"))
    return clean.keep_first(lines, ["l_orderkey", "l_linenumber"])


@query
def clean_latest_per_supplier(spark, sf_dir):
    lines = scan(spark, sf_dir, "lineitem").withColumn("l_shipdate", c("l_shipdate").cast("timestamp"))
    return clean.latest_per(lines, ["l_suppkey"], "l_shipdate", ["l_extendedprice", "l_partkey"])


@query
def clean_times(spark, sf_dir):
    listings = derive(spark, sf_dir, "in_listings")
    taken = cols.to_time("date_snapshot")
    return clean.project(
        listings,
        {
            "id": "id",
            "taken": taken,
            "taken_text": cols.time_text(taken),
            "taken_day": cols.time_text(taken, cols.DAY),
            "updated_day": cols.to_day(cols.to_time("last_updated_usd")),
        },
    )


@query
def clean_epoch_text(spark, sf_dir):
    events = scan(spark, sf_dir, "events")
    text = F.unix_seconds(c("ts").cast("timestamp")).cast("string")
    text = F.when(c("event_type") == "error", F.lit("soon")).otherwise(text)
    return events.select("event_id", text.alias("text")).select("event_id", cols.epoch_to_time("text").alias("at"))


@query
def clean_split_lists(spark, sf_dir):
    info = derive(spark, sf_dir, "in_exchange_info").select("id", "date_snapshot", "fiats", "slug")
    return clean.project(
        info,
        {
            "id": "id",
            "date_snapshot": "date_snapshot",
            "parts": F.array_join(cols.split_trimmed("fiats"), "|"),
            "part_count": F.size(cols.split_trimmed("fiats")),
            "filled_count": F.size(cols.split_trimmed("fiats", drop_empty=True)),
            "first_part": cols.first_of(cols.split_trimmed("fiats")),
            "slug_parts": F.array_join(cols.split_plain("slug"), "|"),
        },
    )


@query
def clean_typed_null(spark, sf_dir):
    return clean.with_typed_null(scan(spark, sf_dir, "nation").select("n_nationkey"), "spot_volume_usd", "double")


@query
def clean_union_missing_columns(spark, sf_dir):
    customers = scan(spark, sf_dir, "customer").select(c("c_name").alias("name"), c("c_acctbal").alias("balance"))
    suppliers = scan(spark, sf_dir, "supplier").select(c("s_name").alias("name"), c("s_nationkey").alias("nation"))
    return clean.union_all([customers, suppliers])


@query
def clean_two_projections(spark, sf_dir):
    """A dimension and its metrics from one source, counted side by side."""
    source = bronze(spark, sf_dir, "in_categories")
    dim = builds.dim_crypto_category(source).agg(F.count(F.lit(1)).alias("row_count"))
    metrics = builds.category_metrics(source).agg(F.count(F.lit(1)).alias("row_count"))
    return dim.withColumn("part", F.lit("dimension")).unionByName(metrics.withColumn("part", F.lit("metrics")))


# KPIs -----------------------------------------------------------------------------


@query
def kpi_guards(spark, sf_dir):
    """Ratio, difference and product under their guards, row by row."""
    rows = derive(spark, sf_dir, "in_listings")
    return rows.select(
        "id",
        "batch_index",
        "last_updated_usd",
        kpi.guarded_ratio(c("volume_24h_usd"), c("market_cap_usd")).alias("ratio"),
        kpi.guarded_ratio(c("volume_24h_usd"), c("market_cap_usd"), eps=500.0).alias("ratio_eps"),
        kpi.guarded_ratio(c("price_usd"), c("max_supply"), require=[c("total_supply")], default=None).alias("ratio_null"),
        kpi.guarded_diff(c("total_supply"), c("max_supply")).alias("difference"),
        kpi.guarded_product(c("price_usd"), c("volume_24h_usd"), default=None).alias("product"),
        kpi.is_meaningful(kpi.guarded_ratio(c("volume_24h_usd"), c("market_cap_usd"))).alias("check_ratio"),
    )


@query
def kpi_delay_seconds(spark, sf_dir):
    events = scan(spark, sf_dir, "events")
    at = c("ts").cast("timestamp")
    return events.select("event_id", kpi.delay_seconds(at, F.date_trunc("hour", at)).alias("delay_seconds"))


# joins ------------------------------------------------------------------------------


@query
def join_enrich(spark, sf_dir):
    activity = builds.exchange_activity(bronze(spark, sf_dir, "in_exchange_map"))
    measures = Silver(spark, sf_dir)["dim_exchange_map"].select("exchange_id", "snapshot_timestamp")
    return joins.enrich(measures, activity, ["exchange_id"])


@query
def join_enforce_fks(spark, sf_dir):
    t = Silver(spark, sf_dir)
    facts = t["fact_exchange_assets"].select("exchange_id", "crypto_id", "snapshot_timestamp", "wallet_address")
    return joins.enforce_fks(facts, {"crypto_id": t["dim_crypto_id"], "exchange_id": t["dim_exchange_id"]})


@query
def join_new_composite_keys(spark, sf_dir):
    t = Silver(spark, sf_dir)
    held = t["fact_crypto_market"].where("infinite_supply").select("crypto_id", "snapshot_timestamp")
    wanted = t["dim_crypto_map"].select("crypto_id", "snapshot_timestamp", "rank")
    return joins.new_keys(wanted, held, ["crypto_id", "snapshot_timestamp"])


@query
def join_orphan_rows(spark, sf_dir):
    t = Silver(spark, sf_dir)
    return joins.orphans(t["fact_exchange_assets"].select("crypto_id", "wallet_address"), t["dim_crypto_id"], "crypto_id")


@query
def join_orphan_keys(spark, sf_dir):
    t = Silver(spark, sf_dir)
    return joins.orphan_keys(t["fact_exchange_assets"], t["dim_crypto_id"], "crypto_id")


def _supplier_days(spark, sf_dir) -> DataFrame:
    lines = scan(spark, sf_dir, "lineitem")
    return lines.select(
        "l_suppkey",
        c("l_shipdate").cast("timestamp").alias("seen_at"),
        F.when(c("l_returnflag") == "A", c("l_extendedprice")).alias("price"),
        F.when(c("l_linestatus") == "O", c("l_discount")).alias("discount"),
        F.when(c("l_linenumber") < 6, c("l_tax")).alias("tax"),
    )


@query
def join_asof_last_known(spark, sf_dir):
    return ordered.previous_known(_supplier_days(spark, sf_dir), ["l_suppkey"], "seen_at", ["price"])


@query
def join_asof_last_tuple(spark, sf_dir):
    days = _supplier_days(spark, sf_dir)
    return ordered.previous_known(days, ["l_suppkey"], "seen_at", ["price", "discount", "tax"])


@query
def join_asof_last_tuple_sliced(spark, sf_dir):
    days = _supplier_days(spark, sf_dir)
    return ordered.previous_known(days, ["l_suppkey"], "seen_at", ["price", "discount", "tax"], slices=3)


@query
def join_asof_fill(spark, sf_dir):
    days = _supplier_days(spark, sf_dir).groupBy("l_suppkey", "seen_at").agg(F.max("price").alias("price"))
    return ordered.fill_from_previous(days, ["l_suppkey"], "seen_at", "price")


@query
def join_update_from(spark, sf_dir):
    """Part prices replaced by the highest line price where the part is small."""
    parts = scan(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    best = scan(spark, sf_dir, "lineitem").groupBy(c("l_partkey").alias("p_partkey")).agg(
        F.max("l_extendedprice").alias("price")
    )
    return joins.update_from(parts, best, ["p_partkey"], {"p_retailprice": c("new_price")}, c("p_size") < 20)


# ordered operators --------------------------------------------------------------------


def _quantities(spark, sf_dir) -> DataFrame:
    return scan(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@query
def window_rank(spark, sf_dir):
    return ordered.ranks(_quantities(spark, sf_dir), ["l_returnflag"], "l_quantity", "quantity_rank")


@query
def window_rank_sliced(spark, sf_dir):
    """The way taken by groups too large for one task."""
    lines = _quantities(spark, sf_dir)
    return ordered.ranks(lines, ["l_returnflag"], "l_quantity", "quantity_rank", slices=3)


def _totals(spark, sf_dir) -> DataFrame:
    return scan(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query
def window_row_number(spark, sf_dir):
    order = [c("o_totalprice").desc(), c("o_orderkey").asc()]
    return ordered.row_numbers(_totals(spark, sf_dir), ["o_orderstatus"], order, "place")


@query
def window_row_number_sliced(spark, sf_dir):
    order = [c("o_totalprice").desc(), c("o_orderkey").asc()]
    return ordered.row_numbers(_totals(spark, sf_dir), ["o_orderstatus"], order, "place", slices=3)


@query
def window_top_n(spark, sf_dir):
    orders = scan(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    order = [c("o_totalprice").desc(), c("o_orderkey").asc()]
    return ordered.top_n(orders, ["o_custkey"], order, 3, "place")


def _day_states(spark, sf_dir) -> DataFrame:
    """Each day's dominant order status."""
    orders = scan(spark, sf_dir, "orders")
    counts = orders.groupBy(c("o_orderdate").cast("timestamp").alias("day")).agg(
        F.sum(F.when(c("o_orderstatus") == "F", 1).otherwise(-1)).alias("balance")
    )
    return counts.select("day", F.when(c("balance") > 0, "mostly F").otherwise("mostly not F").alias("state"))


@query
def window_runs(spark, sf_dir):
    return ordered.runs(_day_states(spark, sf_dir), [], "day", "state")


@query
def window_runs_sliced(spark, sf_dir):
    return ordered.runs(_day_states(spark, sf_dir), [], "day", "state", slices=3)


@query
def set_difference(spark, sf_dir):
    parts = scan(spark, sf_dir, "part").select(c("p_partkey").alias("id"))
    coins = Silver(spark, sf_dir)["dim_crypto_id"].select(c("crypto_id").cast("bigint").alias("id"))
    return joins.new_keys(parts, coins, ["id"])


# sources and sinks ------------------------------------------------------------------


@query
def source_strict_read(spark, sf_dir):
    """Declared columns only; one of them is not in the file."""
    schema = "o_orderkey bigint, o_totalprice double, o_discount double"
    return snapshots.read_strict(spark, schema, f"{sf_dir}/orders.parquet")


@query
def source_list_snapshots(spark, sf_dir):
    listing = snapshots.list_snapshots(spark, staging.snapshot_folder(spark, sf_dir))
    return listing.select("name", "suffix", "snapshot_ts")


@query
def source_latest_snapshots(spark, sf_dir):
    newest = snapshots.latest_snapshots(spark, staging.snapshot_folder(spark, sf_dir), 3)
    return newest.select("name", "suffix")


@query
def source_numbered_latest(spark, sf_dir):
    listing = snapshots.list_snapshots(spark, staging.snapshot_folder(spark, sf_dir))
    return snapshots.numbered_latest(listing, 2).select("name", "suffix", c("age").cast("bigint").alias("age"))


@query
def source_batches(spark, sf_dir):
    return snapshots.batches(spark, staging.snapshot_folder(spark, sf_dir), expected=5)


_LINES = "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double"


@query
def source_read_latest_batch(spark, sf_dir):
    folder = staging.snapshot_folder(spark, sf_dir)
    return snapshots.read_latest_batch(spark, _LINES, folder)


@query
def source_column_read(spark, sf_dir):
    table = store.Store(spark, work_dir(spark, "columns"))
    table.publish(Silver(spark, sf_dir)["dim_crypto_id"], "dim_crypto_id")
    return table.read("dim_crypto_id", columns=["crypto_id"])


@query
def view_ordered_position(spark, sf_dir):
    """Where each row of a sorted view stands."""
    placed = views.view("vw_category_dominance_index", Silver(spark, sf_dir), ordered=True).withColumn(
        "at", F.monotonically_increasing_id()
    )
    return ordered.row_numbers(placed, [], [c("at").asc()], "position").select("category_id", "snapshot_timestamp", "position")


@query
def source_time_travel(spark, sf_dir):
    """Two published versions of one table, each read back by number and the latest by default."""
    table = store.Store(spark, work_dir(spark, "versions"))
    orders = scan(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    table.publish(orders.where("o_orderstatus = 'F'"), "orders")
    table.publish(orders, "orders", partition_by=["o_orderstatus"])
    first = table.read("orders", 1).withColumn("which", F.lit("first"))
    return first.unionByName(table.read("orders").withColumn("which", F.lit("latest"))).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "which"
    )


def market_by_day(spark, sf_dir) -> store.Store:
    """A warehouse whose market fact came in two loads, each in folders by day."""
    t = Silver(spark, sf_dir)
    warehouse = store.Store(spark, work_dir(spark, "days"))
    loads.load(warehouse, "dim_crypto_id", t["dim_crypto_id"], 1)
    late = F.year("snapshot_timestamp") >= 1998
    loads.load(warehouse, "fact_crypto_market", t["fact_crypto_market"].where(~late), 1)
    loads.load(warehouse, "fact_crypto_market", t["fact_crypto_market"].where(late), 2)
    return warehouse


@query
def source_partition_pruning(spark, sf_dir):
    """Prices of the last quarters, by days joined to the scan, and of one year, by bounds of its partitions."""
    warehouse, name = market_by_day(spark, sf_dir), "vw_crypto_price_evolution"
    last_quarters = days.calendar(spark, date(1990, 1, 1), date(2009, 12, 31)).where("quarter = 4")
    chosen = views.view(name, days.Period(warehouse, days=last_quarters))
    year = views.view(name, days.Period(warehouse, datetime(1997, 4, 1, 6), datetime(1998, 4, 1, 6)))
    return chosen.withColumn("way", F.lit("days")).unionByName(year.withColumn("way", F.lit("bounds")))


@query
def source_compact(spark, sf_dir):
    """A table of many small files rewritten as its next version."""
    table = store.Store(spark, work_dir(spark, "compact"))
    parts = scan(spark, sf_dir, "part").select("p_partkey", "p_size")
    table.publish(parts.repartition(16), "parts")
    table.compact("parts")
    return table.read("parts")


@query
def source_append(spark, sf_dir):
    """Each priority appended as its own version; all read together."""
    table = store.Store(spark, work_dir(spark, "append"))
    orders = scan(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    urgent = c("o_orderpriority") == "1-URGENT"
    table.publish(orders.where(urgent), "orders", 1, phase="load")
    table.publish(orders.where(~urgent), "orders", 2, phase="load")
    return table.read_all("orders")


@query
def source_snapshot_write(spark, sf_dir):
    """A snapshot written and found again by its name; an empty one is not written."""
    folder = work_dir(spark, "bronze")
    suppliers = scan(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    snapshots.write_snapshot(suppliers, folder, "suppliers", datetime(2024, 3, 1, 8, 30))
    snapshots.write_snapshot(suppliers.where("s_suppkey < 0"), folder, "suppliers", datetime(2024, 3, 2, 8, 30))
    newest = snapshots.latest_snapshots(spark, folder).first()
    return spark.read.parquet(newest["path"]).withColumn("suffix", F.lit(newest["suffix"]))


@query
def source_csv_export(spark, sf_dir):
    """Customers with a list, which CSV holds as JSON text."""
    path = work_dir(spark, "csv")
    customers = scan(spark, sf_dir, "customer").withColumn("tags", F.array("c_mktsegment", F.lit('a "b", c')))
    store.export_csv(customers, path)
    read = spark.read.schema(customers.withColumn("tags", F.lit("")).schema).option("header", "true").option("escape", '"')
    return read.csv(path).withColumn("tags", F.from_json("tags", "array<string>"))


@query
def source_payload_replay(spark, sf_dir):
    """Raw payloads kept as JSON lines, read back and parsed again."""
    path = work_dir(spark, "payloads")
    store.write_payloads(staging.crypto_map(spark, sf_dir), path)
    return payloads.crypto_map(store.read_payloads(spark, path))


# streams ------------------------------------------------------------------------------


def _line_stream(spark, sf_dir) -> DataFrame:
    """A few micro-batches locally; on large folders the same call takes many files each."""
    return ingest.snapshot_stream(spark, _LINES, staging.snapshot_folder(spark, sf_dir), 25)


@query
def stream_ingest(spark, sf_dir):
    target = work_dir(spark, "stream")
    stream = _line_stream(spark, sf_dir)
    for _ in range(2):  # the second drain finds nothing new
        ingest.drain(stream, target, f"{target}-checkpoint")
    return spark.read.parquet(target)


@query
def stream_publish_new_keys(spark, sf_dir):
    target = work_dir(spark, "stream")
    publish = ingest.publish_new_keys(target, ["l_partkey"], lambda df: df.select("l_partkey", "l_extendedprice"))
    ingest.drain_batches(_line_stream(spark, sf_dir), publish, f"{target}-checkpoint")
    return ingest.read_published(spark, target).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("times"))


@query
def stream_publish_state(spark, sf_dir):
    """Each key once, by a state of keys in place of reads of what was published."""
    target = work_dir(spark, "stream")
    lines = _line_stream(spark, sf_dir).select("l_partkey", "l_extendedprice")
    ingest.drain_first_rows(lines, ["l_partkey"], target, f"{target}-checkpoint")
    return spark.read.parquet(target).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("times"))


@query
def stream_dedupe_watermark(spark, sf_dir):
    """Events in order of arrival, with copies and late ones: state and lateness are bounded by ten days."""
    target = work_dir(spark, "stream")
    arrivals = ingest.snapshot_stream(
        spark, "event_id bigint, ts timestamp, event_type string", staging.event_arrivals(spark, sf_dir), 1
    )
    ingest.drain(ingest.dedupe_within(arrivals, ["event_id"], "ts", "10 days"), target, f"{target}-checkpoint")
    return spark.read.parquet(target)


@query
def stream_publish_fact(spark, sf_dir):
    target = work_dir(spark, "stream")
    coins = Silver(spark, sf_dir)["dim_crypto_id"].select(c("crypto_id").cast("bigint").alias("l_partkey"))
    publish = ingest.publish_fact(target, {"l_partkey": coins})
    ingest.drain_batches(_line_stream(spark, sf_dir), publish, f"{target}-checkpoint")
    return ingest.read_published(spark, target).select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")


@query
def stream_dedupe_snapshots(spark, sf_dir):
    """Copies of one (coin, line) key across all files reduced to one, however far apart."""
    target = work_dir(spark, "stream")
    publish = ingest.publish_new_keys(
        target, ["l_partkey", "l_linenumber"], lambda df: df.select("l_partkey", "l_linenumber"), "l_partkey"
    )
    ingest.drain_batches(_line_stream(spark, sf_dir), publish, f"{target}-checkpoint")
    return ingest.read_published(spark, target)


_register_tables()
