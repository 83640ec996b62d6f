"""Bronze frames to dimension and fact tables. Every build is lazy: frame in, frame out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import kpi
from tidemark.functions.columns import (
    DAY,
    SECONDS,
    epoch_to_time,
    first_of,
    split_plain,
    split_trimmed,
    time_text,
    to_day,
    to_int,
    to_time,
)
from tidemark.operators.clean import keep_first, latest_per, longs_to_ints, project, require_keys, with_typed_null
from tidemark.operators.joins import enrich

c = F.col


def _with_text(df: DataFrame, pattern: str = SECONDS) -> DataFrame:
    """Add `snapshot_str` next to its timestamp. It follows from the key, so it is added
    after the dedupe and never sorted or shuffled."""
    text = time_text("snapshot_timestamp", pattern).alias("snapshot_str")
    columns = [[c(n), text] if n == "snapshot_timestamp" else [c(n)] for n in df.columns]
    return df.select(*[column for pair in columns for column in pair])


def _keyed(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key: of the newest snapshot where rows have one, then by the other columns."""
    rest = [name for name in df.columns if name not in keys]
    order = [c(name).asc_nulls_last() for name in rest if name != "snapshot_timestamp"]
    if "snapshot_timestamp" in rest:
        order.insert(0, c("snapshot_timestamp").desc_nulls_last())
    return keep_first(require_keys(df, keys), keys, order)


# crypto ------------------------------------------------------------------


def dim_crypto_id(bronze_map: DataFrame) -> DataFrame:
    columns = {"crypto_id": to_int("id"), "name": "name", "symbol": "symbol", "platform_id": to_int("platform_id")}
    columns |= {n: n for n in ("platform_name", "platform_symbol", "platform_token_address")}
    return _keyed(project(bronze_map, columns), "crypto_id")


def dim_crypto_map(bronze_map: DataFrame) -> DataFrame:
    columns = {"crypto_id": to_int("id"), "snapshot_timestamp": to_time("date_snapshot")}
    columns |= {
        "rank": to_int("rank"),
        "is_active": to_int("is_active"),
        "last_historical_data": time_text(to_time("last_historical_data")),
    }
    return _with_text(_keyed(project(bronze_map, columns), "crypto_id", "snapshot_timestamp"))


def dim_crypto_info(bronze_info: DataFrame) -> DataFrame:
    taken = to_time("date_snapshot")
    columns = {
        "crypto_id": to_int("id"),
        "slug": "slug",
        "snapshot_timestamp": taken,
        "snapshot_date": to_day(taken),
        "date_launched": to_day(to_time("date_launched")),
        "date_added": to_day(to_time("date_added")),
        "category": "category",
        "tags": split_plain("tags"),
        "description": "description",
        "logo_url": "logo",
    }
    columns |= {f"{n}_url": n for n in ("website", "technical_doc", "explorer", "source_code", "twitter")}
    return _keyed(project(bronze_info, columns), "crypto_id")


def clean_crypto_market(listings: DataFrame) -> DataFrame:
    """Typed, keyed listing rows before any KPI."""
    same = lambda *names: {n: n for n in names}
    columns = {"crypto_id": to_int("id"), "snapshot_timestamp": to_time("date_snapshot")}
    columns |= {n: to_int(n) for n in ("batch_index", "cmc_rank")}
    columns |= {"last_updated_usd": time_text(to_time("last_updated_usd"))}
    columns |= {n: to_int(n) for n in ("platform_id", "num_market_pairs")}
    columns |= same(
        "price_usd", "volume_24h_usd", "volume_change_24h", "percent_change_1h_usd", "percent_change_24h_usd",
        "percent_change_7d_usd", "market_cap_usd", "market_cap_dominance_usd", "fully_diluted_market_cap_usd",
        "self_reported_market_cap", "circulating_supply", "total_supply", "max_supply", "infinite_supply",
        "self_reported_circulating_supply",
    )
    return _with_text(_keyed(project(listings, columns), "crypto_id", "snapshot_timestamp"))


def fact_crypto_market(listings: DataFrame) -> DataFrame:
    return clean_crypto_market(listings).withColumns(kpi.market_kpis())


# categories --------------------------------------------------------------


def dim_crypto_category(bronze: DataFrame) -> DataFrame:
    return _keyed(bronze.select("category_id", "name", "title", "description"), "category_id")


def category_metrics(bronze: DataFrame) -> DataFrame:
    columns = {"category_id": c("category_id"), "snapshot_timestamp": to_time("date_snapshot")}
    columns |= {"num_tokens": to_int("num_tokens")}
    columns |= {
        n: c(n) for n in ("avg_price_change", "market_cap", "market_cap_change", "volume", "volume_change")
    }
    columns |= {"last_updated": time_text(to_time("last_updated"))}
    return _with_text(_keyed(project(bronze, columns), "category_id", "snapshot_timestamp"))


def fact_crypto_category(bronze: DataFrame) -> DataFrame:
    return category_metrics(bronze).withColumns(kpi.category_kpis())


def crypto_category_link(bronze: DataFrame) -> DataFrame:
    pairs = bronze.select(to_int("crypto_id").alias("crypto_id"), "category_id")
    return _keyed(pairs, "crypto_id", "category_id")


# exchanges ---------------------------------------------------------------


def dim_exchange_id(bronze_map: DataFrame) -> DataFrame:
    return _keyed(bronze_map.select(to_int("id").alias("exchange_id"), "name"), "exchange_id")


def exchange_activity(bronze_map: DataFrame) -> DataFrame:
    active = bronze_map.select(to_int("id").alias("exchange_id"), c("is_active").cast("boolean").alias("is_active"))
    return _keyed(active, "exchange_id")


def dim_exchange_info(bronze_info: DataFrame) -> DataFrame:
    columns = {
        "exchange_id": to_int("id"),
        "slug": c("slug"),
        "date_launched": time_text(to_time("date_launched")),
        "description": c("description"),
        "logo_url": c("logo"),
    }
    columns |= {f"{n}_url": first_of(f"urls.{n}") for n in ("website", "twitter", "fee", "blog")}
    columns |= {"fiats": split_trimmed("fiats")}
    return _keyed(project(bronze_info, columns), "exchange_id")


def exchange_measures(bronze_info: DataFrame) -> DataFrame:
    """Per-snapshot visits, fees and spot volume; shared by the map dimension and the asset fact."""
    columns = {"exchange_id": to_int("id"), "snapshot_timestamp": to_time("date_snapshot")}
    columns |= {"weekly_visits": to_int("weekly_visits")}
    columns |= {n: c(n) for n in ("spot_volume_usd", "maker_fee", "taker_fee")}
    return require_keys(project(bronze_info, columns), ["exchange_id"])


def dim_exchange_map(bronze_info: DataFrame, bronze_map: DataFrame | None = None) -> DataFrame:
    measures = exchange_measures(bronze_info).drop("spot_volume_usd")
    keyed = _with_text(_keyed(measures, "exchange_id", "snapshot_timestamp"))
    if bronze_map is None:
        return keyed
    return enrich(keyed, exchange_activity(bronze_map), ["exchange_id"])


def spot_volumes(bronze_info: DataFrame, by_snapshot: bool = False) -> DataFrame:
    """One spot volume per exchange (the latest), or per exchange and snapshot."""
    measures = exchange_measures(bronze_info).select("exchange_id", "snapshot_timestamp", "spot_volume_usd")
    if by_snapshot:
        return _keyed(measures, "exchange_id", "snapshot_timestamp")
    return latest_per(measures, ["exchange_id"], "snapshot_timestamp", ["spot_volume_usd"]).drop("snapshot_timestamp")


def fact_exchange_assets(
    bronze_assets: DataFrame, bronze_info: DataFrame | None = None, by_snapshot: bool = False
) -> DataFrame:
    """Wallet balances with their exchange's spot volume.

    A single run joins the volume by exchange. `by_snapshot` joins it by exchange and
    snapshot, which gives in one job what one run per snapshot gives together.
    """
    columns = {"exchange_id": to_int("exchange_id"), "snapshot_timestamp": to_time("date_snapshot")}
    columns |= {"blockchain_symbol": c("platform_symbol"), "blockchain_name": c("platform_name")}
    columns |= {"wallet_address": c("wallet_address"), "crypto_id": to_int("currency_crypto_id")}
    columns |= {n: c(n) for n in ("balance", "currency_price_usd")}
    wallets = _keyed(
        project(bronze_assets, columns), "exchange_id", "wallet_address", "crypto_id", "snapshot_timestamp"
    )
    if bronze_info is None:
        priced = with_typed_null(wallets, "spot_volume_usd", "double")
    else:
        keys = ["exchange_id", "snapshot_timestamp"] if by_snapshot else ["exchange_id"]
        priced = enrich(wallets, spot_volumes(bronze_info, by_snapshot), keys)
    return _with_text(priced).withColumns(kpi.wallet_kpis()).select(
        "exchange_id", "snapshot_timestamp", "snapshot_str", "spot_volume_usd", "blockchain_symbol",
        "blockchain_name", "wallet_address", "crypto_id", "balance", "currency_price_usd", "total_usd_value",
        "wallet_weight",
    )


# global market and sentiment ---------------------------------------------

# Columns whose names differ between bronze and the fact.
GLOBAL_RENAMES = {
    "btc_dominance_24h_percentage_change": "btc_dominance_24h_change",
    "eth_dominance_24h_percentage_change": "eth_dominance_24h_change",
    "quote_total_market_cap_yesterday_percentage_change": "total_market_cap_yesterday_change",
    "quote_total_volume_24h_yesterday_percentage_change": "total_volume_24h_yesterday_change",
    "today_incremental_crypto_number": "new_cryptos_today",
    "past_24h_incremental_crypto_number": "new_cryptos_last_24h",
    "past_7d_incremental_crypto_number": "new_cryptos_last_7d",
    "past_30d_incremental_crypto_number": "new_cryptos_last_30d",
    "today_change_percent": "new_cryptos_today_pct",
    "tracked_maxIncrementalNumber": "max_daily_new_cryptos",
    "tracked_maxIncrementalDate": "max_new_cryptos_day",
    "tracked_minIncrementalNumber": "min_daily_new_cryptos",
    "tracked_minIncrementalDate": "min_new_cryptos_day",
}


def fact_global_market(bronze: DataFrame) -> DataFrame:
    renames = {n: n.removeprefix("quote_") for n in bronze.columns if n.startswith("quote_")} | GLOBAL_RENAMES
    metrics = longs_to_ints(bronze.withColumnsRenamed(renames))
    taken, updated = to_time("date_snapshot"), to_time("last_updated")
    times = {
        "snapshot_timestamp": taken,
        "snapshot_str": time_text(taken),
        "last_updated_timestamp": updated,
        "last_updated_str": time_text(updated),
    }
    days = ("max_new_cryptos_day", "min_new_cryptos_day")
    kept = [n for n in metrics.columns if n not in ("date_snapshot", "last_updated")]
    columns = times | {n: to_day(n) if n in days else c(n) for n in kept} | kpi.global_kpis()
    return project(metrics, columns)


def _sentiment(bronze: DataFrame, taken: Column) -> DataFrame:
    columns = {
        "snapshot_timestamp": taken,
        "fear_greed_score": to_int("value"),
        "sentiment_label": c("value_classification"),
    }
    return _with_text(_keyed(project(bronze, columns), "snapshot_timestamp"), DAY)


def sentiment_history(bronze: DataFrame) -> DataFrame:
    return _sentiment(bronze, epoch_to_time("timestamp"))


def sentiment_live(bronze: DataFrame) -> DataFrame:
    return _sentiment(bronze, to_time("update_time"))
