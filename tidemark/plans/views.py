"""The reporting, anomaly and monitoring views, and the dashboard questions.

A view is a projection of one table, optionally joined to a dimension and filtered.
Row order is not part of a result, so `ordered=True` must be asked for: it costs a
range shuffle that a report on a small slice wants and a large scan does not.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.kpi import delay_seconds
from tidemark.operators.joins import orphans
from tidemark.operators.ordered import ranks, row_numbers, runs, top_n

Tables = Mapping[str, DataFrame]

# dimension -> (key, descriptive columns)
DIMENSIONS = {
    "dim_crypto_id": ("crypto_id", ("name",)),
    "dim_exchange_id": ("exchange_id", ("name",)),
    "dim_crypto_category": ("category_id", ("name",)),
}


@dataclass(frozen=True)
class View:
    source: str
    columns: tuple[str, ...] = ()  # none: all
    where: str | None = None
    dim: str | None = None
    order: tuple[str, ...] = ()

    def column_list(self, df: DataFrame) -> list[str]:
        return list(self.columns) or df.columns


def _sorted(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`order` holds names; a leading '-' means descending, with NULLs first."""
    keys = [F.col(o[1:]).desc_nulls_first() if o[0] == "-" else F.col(o).asc_nulls_last() for o in order]
    return df.orderBy(*keys) if keys else df


def with_dimension(df: DataFrame, tables: Tables, dim: str) -> DataFrame:
    """Inner join to the names of a dimension on its key."""
    key, names = DIMENSIONS[dim]
    return df.join(tables[dim].select(key, *names), on=key)


def run_view(view: View, tables: Tables, ordered: bool = False) -> DataFrame:
    df = tables[view.source]
    if view.where:
        df = df.where(view.where)
    names = view.column_list(df)
    if view.dim:
        key, labels = DIMENSIONS[view.dim]
        own = [n for n in names if n not in labels or n in df.columns]
        df = with_dimension(df.select(*dict.fromkeys([key, *own])), tables, view.dim)
    df = df.select(*names)
    return _sorted(df, view.order) if ordered else df


def present(*columns: str) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def absent(*columns: str, every: bool = False) -> str:
    return (" AND " if every else " OR ").join(f"{c} IS NULL" for c in columns)


def outside(low: float | None, high: float | None, *columns: str) -> str:
    """Any column below `low` or above `high`."""
    tests = [f"{c} < {low!r}D" for c in columns if low is not None]
    tests += [f"{c} > {high!r}D" for c in columns if high is not None]
    return " OR ".join(tests)


MARKET, CATEGORY, ASSETS = "fact_crypto_market", "fact_crypto_category", "fact_exchange_assets"
GLOBAL, SENTIMENT, EXMAP = "fact_global_market", "fact_market_sentiment", "dim_exchange_map"
COIN, KIND, VENUE = "dim_crypto_id", "dim_crypto_category", "dim_exchange_id"
AT = "snapshot_timestamp"


def _global(*columns: str) -> View:
    return View(GLOBAL, (AT, *columns), order=(f"-{AT}",))


# Names, columns and order of the views.
VIEWS: dict[str, View] = {
    # trends by category
    "vw_category_dominance_index": View(
        CATEGORY, ("category_id", "name", AT, "dominance_per_token", "volume_to_market_cap_ratio"),
        present("dominance_per_token"), KIND, ("category_id", f"-{AT}"),
    ),
    "vw_category_market_trend": View(
        CATEGORY,
        ("category_id", "name", AT, "num_tokens", "market_cap", "volume", "market_cap_change",
            "volume_change", "market_cap_change_rate", "volume_change_rate"),
        present("market_cap", "volume"), KIND, ("category_id", f"-{AT}"),
    ),
    "vw_category_price_change_index": View(
        CATEGORY, ("category_id", "name", AT, "avg_price_change", "price_change_index"),
        present("price_change_index"), KIND, ("category_id", f"-{AT}"),
    ),
    # trends by coin
    "vw_crypto_info_overview": View(
        "dim_crypto_info",
        ("crypto_id", "name", "slug", "category", "description", "logo_url", "website_url", "twitter_url",
            "source_code_url", "technical_doc_url"),
        dim=COIN,
    ),
    "vw_crypto_market_cap_trend": View(
        MARKET, ("crypto_id", "name", AT, "market_cap_usd", "market_cap_dominance_usd",
            "fully_diluted_market_cap_usd"),
        present("market_cap_usd"), COIN, ("-market_cap_dominance_usd",),
    ),
    "vw_crypto_market_rank_history": View(
        MARKET, ("crypto_id", "name", AT, "cmc_rank", "num_market_pairs"), present("cmc_rank"), COIN,
            ("cmc_rank",),
    ),
    "vw_crypto_price_evolution": View(
        MARKET, ("crypto_id", "name", AT, "price_usd", "percent_change_24h_usd", "percent_change_7d_usd"),
        present("price_usd"), COIN, (f"-{AT}", "-price_usd"),
    ),
    "vw_crypto_supply_utilization": View(
        MARKET,
        ("crypto_id", "name", AT, "circulating_supply", "total_supply", "max_supply", "infinite_supply",
            "self_reported_circulating_supply", "supply_utilization", "missing_supply_ratio",
            "fully_diluted_cap_ratio"),
        present("supply_utilization"), COIN, ("-supply_utilization",),
    ),
    "vw_crypto_volume_vs_price": View(
        MARKET,
        ("crypto_id", "name", AT, "price_usd", "volume_24h_usd", "volume_change_24h",
            "percent_change_24h_usd", "volume_to_market_cap_ratio"),
        present("price_usd", "volume_24h_usd"), COIN, (f"-{AT}", "-volume_to_market_cap_ratio"),
    ),
    # trends by exchange
    "vw_exchange_fee_history": View(
        EXMAP, ("exchange_id", "name", AT, "maker_fee", "taker_fee"), None, VENUE, ("-maker_fee",
            "-taker_fee", f"-{AT}"),
    ),
    "vw_exchange_info_overview": View(
        "dim_exchange_info", ("exchange_id", "name", "slug", "description", "logo_url", "website_url",
            "fee_url"), dim=VENUE,
    ),
    "vw_exchange_weekly_visits_trend": View(
        EXMAP, ("exchange_id", "name", AT, "weekly_visits"), present("weekly_visits"), VENUE, ("exchange_id",
            f"-{AT}"),
    ),
    # sentiment and global market
    "vw_fear_greed_daily_trend": View(
        SENTIMENT, (AT, "fear_greed_score", "sentiment_label"), present("fear_greed_score"),
            order=(f"-{AT}",),
    ),
    "vw_altcoin_market_trend": _global("altcoin_market_cap", "altcoin_volume_24h",
        "altcoin_volume_24h_reported"),
    "vw_btc_eth_dominance_trend": _global(
        "btc_dominance", "eth_dominance", "btc_dominance_yesterday", "eth_dominance_yesterday",
        "btc_dominance_24h_change", "eth_dominance_24h_change", "btc_dominance_delta", "eth_dominance_delta"
    ),
    "vw_crypto_creation_activity": _global(
        "total_cryptocurrencies", "new_cryptos_today", "new_cryptos_last_24h", "new_cryptos_last_7d",
        "new_cryptos_last_30d", "crypto_growth_rate_30d", "max_daily_new_cryptos", "max_new_cryptos_day",
        "min_daily_new_cryptos", "min_new_cryptos_day"
    ),
    "vw_defi_market_trend": _global(
        "defi_market_cap", "defi_volume_24h", "defi_volume_24h_reported", "defi_volume_share",
        "defi_24h_percentage_change", "check_defi_volume_share"
    ),
    "vw_derivatives_activity_trend": _global(
        "derivatives_volume_24h", "derivatives_volume_24h_reported", "derivatives_24h_percentage_change"
    ),
    "vw_global_market_overview": _global(
        "total_market_cap", "total_volume_24h", "total_market_cap_yesterday", "total_volume_24h_yesterday",
        "total_market_cap_yesterday_change", "total_volume_24h_yesterday_change", "total_volume_24h_reported",
        "market_liquidity_ratio"
    ),
    "vw_market_participants_trend": _global(
        "active_cryptocurrencies", "total_cryptocurrencies", "active_market_pairs", "active_exchanges",
        "total_exchanges"
    ),
    "vw_stablecoin_market_trend": _global(
        "stablecoin_market_cap", "stablecoin_volume_24h", "stablecoin_volume_24h_reported",
        "stablecoin_market_share", "stablecoin_24h_percentage_change", "check_stablecoin_market_share"
    ),
    # anomalies
    "vw_categories_volume_to_market_cap_anomalies": View(
        CATEGORY, ("category_id", AT, "volume_to_market_cap_ratio"), outside(None, 10.0, "volume_to_market_cap_ratio"),
    ),
    "vw_crypto_market_cap_outliers": View(
        MARKET, ("crypto_id", AT, "volume_to_market_cap_ratio"), outside(None, 10.0, "volume_to_market_cap_ratio"),
    ),
    "vw_crypto_missing_names_or_symbols": View(COIN, ("crypto_id",), absent("name", "symbol")),
    "vw_crypto_missing_urls": View("dim_crypto_info", ("crypto_id",), absent("logo_url", "website_url")),
    "vw_extreme_category_price_change_index": View(
        CATEGORY, ("category_id", AT, "price_change_index"), outside(-100.0, 1000.0, "price_change_index"),
    ),
    "vw_supply_utilization_outliers": View(
        MARKET, ("crypto_id", AT, "supply_utilization"), outside(None, 1.1, "supply_utilization"),
    ),
    "vw_high_fee_exchanges": View(
        EXMAP, ("exchange_id", AT, "maker_fee", "taker_fee"), outside(None, 0.5, "maker_fee", "taker_fee"),
    ),
    "vw_missing_urls": View(
        "dim_exchange_info", ("exchange_id", "website_url", "logo_url"), absent("website_url", "logo_url"),
    ),
    "vw_wallet_weight_anomalies": View(
        ASSETS, ("exchange_id", AT, "wallet_address", "crypto_id", "wallet_weight", "total_usd_value",
            "spot_volume_usd"),
        outside(None, 100.0, "wallet_weight"),
    ),
    "vw_weekly_visits_outliers": View(
        EXMAP, ("exchange_id", AT, "weekly_visits"), "weekly_visits > 100000000",
    ),
    "vw_invalid_fear_greed_scores": View(SENTIMENT, where="fear_greed_score NOT BETWEEN 0 AND 100"),
    "vw_missing_sentiment_labels": View(SENTIMENT, where=absent("sentiment_label")),
    "vw_defi_volume_share_anomalies": View(
        GLOBAL, (AT, "defi_volume_24h", "total_volume_24h", "defi_volume_share"), outside(0.0, 1.0,
            "defi_volume_share"),
    ),
    "vw_invalid_dominance_percentages": View(
        GLOBAL, (AT, "btc_dominance", "eth_dominance"), outside(0.0, 90.0, "btc_dominance", "eth_dominance"),
    ),
    "vw_market_liquidity_ratio_outliers": View(
        GLOBAL, (AT, "total_volume_24h", "total_market_cap", "market_liquidity_ratio"),
        outside(0.01, 10.0, "market_liquidity_ratio"),
    ),
    "vw_stablecoin_market_share_anomalies": View(
        GLOBAL, (AT, "stablecoin_market_cap", "total_market_cap", "stablecoin_market_share"),
        outside(0.0, 1.0, "stablecoin_market_share"),
    ),
    # monitoring
    "vw_missing_crypto_prices": View(MARKET, ("crypto_id", AT), absent("price_usd")),
    "vw_missing_crypto_rank_or_status": View("dim_crypto_map", ("crypto_id", AT), absent("rank",
        "is_active")),
    "vw_missing_metrics_in_crypto_category": View(CATEGORY, where=absent("market_cap", "volume",
        "num_tokens")),
    "vw_pipeline_misalignment_exchange_map": View(
        EXMAP, ("exchange_id", AT), absent("maker_fee", "taker_fee", "weekly_visits", every=True),
    ),
    "vw_missing_spot_volume": View(
        ASSETS, ("exchange_id", AT, "wallet_address", "crypto_id", "balance", "currency_price_usd",
            "total_usd_value"),
        absent("spot_volume_usd"),
    ),
    "vw_missing_critical_market_metrics": View(
        GLOBAL, (AT, "total_market_cap", "total_volume_24h", "btc_dominance"),
        absent("total_market_cap", "total_volume_24h", "btc_dominance"),
    ),
}


# views that are more than a projection ------------------------------------


def top_categories_by_market_cap(t: Tables) -> DataFrame:
    """Rank of every category within its snapshot, equal caps sharing a rank."""
    capped = with_dimension(t[CATEGORY].where(present("market_cap")), t, KIND)
    capped = capped.select("category_id", "name", AT, "market_cap")
    return ranks(capped, [AT], "market_cap", "category_rank")


def average_asset_price_by_crypto(t: Tables) -> DataFrame:
    """Mean price per coin and snapshot; averaged before the names are joined."""
    priced = t[ASSETS].where(present("currency_price_usd"))
    means = priced.groupBy("crypto_id", AT).agg(F.avg("currency_price_usd").alias("avg_price_usd"))
    coins = t[COIN].select("crypto_id", "name", "symbol")
    return means.join(coins, on="crypto_id").select("crypto_id", "name", "symbol", AT, "avg_price_usd")


def exchange_supported_fiats(t: Tables, drop_empty: bool = False) -> DataFrame:
    """One row per exchange and listed currency; repeated currencies stay repeated."""
    listed = t["dim_exchange_info"].where(present("fiats"))
    currencies = listed.select("exchange_id", F.explode("fiats").alias("fiat_currency"))
    if drop_empty:
        currencies = currencies.where("fiat_currency <> ''")
    return with_dimension(currencies, t, VENUE).select("exchange_id", "name", "fiat_currency")


def _valued_wallets(t: Tables) -> DataFrame:
    columns = ("exchange_id", AT, "wallet_address", "crypto_id", "total_usd_value")
    valued = t[ASSETS].where(present("total_usd_value")).select(*columns)
    return with_dimension(valued, t, VENUE).select(
        "exchange_id", "name", AT, "wallet_address", "crypto_id", "total_usd_value"
    )


def _wallet_order() -> list[Column]:
    return [F.col("total_usd_value").desc(), F.col("wallet_address").asc(), F.col("crypto_id").asc()]


def top_wallets_by_usd_value(t: Tables) -> DataFrame:
    """Every valued wallet, numbered by value within its exchange and snapshot."""
    group = ["exchange_id", AT]
    return row_numbers(_valued_wallets(t), group, _wallet_order(), "wallet_rank")


def top_wallets(t: Tables, n: int = 10) -> DataFrame:
    """Only the n largest wallets per exchange and snapshot."""
    return top_n(_valued_wallets(t), ["exchange_id", AT], _wallet_order(), n, "wallet_rank")


def wallet_concentration_by_exchange(t: Tables) -> DataFrame:
    weighted = t[ASSETS].where(present("wallet_weight"))
    sums = weighted.groupBy("exchange_id", AT).agg(
        F.count(F.lit(1)).alias("wallet_count"),
        F.avg("wallet_weight").alias("avg_weight"),
        F.max("wallet_weight").alias("max_weight"),
    )
    return with_dimension(sums, t, VENUE).select(
        "exchange_id", "name", AT, "wallet_count", "avg_weight", "max_weight"
    )


def fact_crypto_market_invalid_fks(t: Tables) -> DataFrame:
    return orphans(t[MARKET].select("crypto_id", AT), t[COIN], "crypto_id")


def outdated_last_updated_timestamp(t: Tables) -> DataFrame:
    """Snapshots whose source was last updated more than five minutes earlier."""
    lag = delay_seconds(F.col(AT), F.col("last_updated_timestamp"))
    times = t[GLOBAL].select(AT, "last_updated_timestamp", lag.alias("delay_seconds"))
    return times.where("delay_seconds > 300")


COMPUTED: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {
    "vw_top_categories_by_market_cap": (top_categories_by_market_cap, f"-{AT} category_rank"),
    "vw_average_asset_price_by_crypto": (average_asset_price_by_crypto, "crypto_id"),
    "vw_exchange_supported_fiats": (exchange_supported_fiats, "exchange_id -fiat_currency"),
    "vw_top_wallets_by_usd_value": (top_wallets_by_usd_value, f"-{AT} exchange_id wallet_rank"),
    "vw_wallet_concentration_by_exchange": (wallet_concentration_by_exchange, "-avg_weight -max_weight"),
    "vw_fact_crypto_market_invalid_fks": (fact_crypto_market_invalid_fks, ""),
    "vw_outdated_last_updated_timestamp": (outdated_last_updated_timestamp, ""),
}

# the tables each computed view reads
COMPUTED_SOURCES = {
    "vw_top_categories_by_market_cap": (CATEGORY, KIND),
    "vw_average_asset_price_by_crypto": (ASSETS, COIN),
    "vw_exchange_supported_fiats": ("dim_exchange_info", VENUE),
    "vw_top_wallets_by_usd_value": (ASSETS, VENUE),
    "vw_wallet_concentration_by_exchange": (ASSETS, VENUE),
    "vw_fact_crypto_market_invalid_fks": (MARKET, COIN),
    "vw_outdated_last_updated_timestamp": (GLOBAL,),
}


def names() -> list[str]:
    return [*VIEWS, *COMPUTED]


def view(name: str, tables: Tables, ordered: bool = False) -> DataFrame:
    """A view by name over the given tables."""
    if name in VIEWS:
        return run_view(VIEWS[name], tables, ordered)
    build, order = COMPUTED[name]
    df = build(tables)
    return _sorted(df, order) if ordered else df


def sources_of(name: str) -> set[str]:
    """The tables a view reads."""
    if name in COMPUTED_SOURCES:
        return set(COMPUTED_SOURCES[name])
    return {VIEWS[name].source, VIEWS[name].dim or VIEWS[name].source}


def register(spark: SparkSession, tables: Tables, only: Collection[str] | None = None) -> None:
    """Register tables, and the views (or `only` some) whose tables are given, for spark.sql.

    The two ranking views write their slices when they are registered.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name in names():
        if sources_of(name) <= set(tables) and (only is None or name in only):
            view(name, tables).createOrReplaceTempView(name)


# dashboard questions ---------------------------------------------------------


def market_size_over_time(t: Tables) -> DataFrame:
    return view("vw_global_market_overview", t).select(
        AT, "total_market_cap", "total_volume_24h", "total_volume_24h_reported", "market_liquidity_ratio"
    )


def dominance_over_time(t: Tables) -> DataFrame:
    """Both dominances with their deltas and combined share."""
    combined = (F.col("btc_dominance") + F.col("eth_dominance")).alias("combined_dominance")
    return view("vw_btc_eth_dominance_trend", t).select("*", combined)


def category_over_time(t: Tables, category_id: str) -> DataFrame:
    return view("vw_category_dominance_index", t).where(F.col("category_id") == category_id)


def leading_categories(t: Tables, n: int = 10) -> DataFrame:
    """Categories ranked n or better, ties included."""
    return top_categories_by_market_cap(t).where(F.col("category_rank") <= n)


def capitalisation_and_dominance(t: Tables) -> DataFrame:
    return view("vw_crypto_market_cap_trend", t)


def defi_over_time(t: Tables) -> DataFrame:
    return view("vw_defi_market_trend", t)


# Upper bounds of the sentiment bands.
BANDS = ((24, "extreme fear"), (49, "fear"), (50, "neutral"), (74, "greed"), (100, "extreme greed"))


def sentiment_band(score: Column) -> Column:
    """Band of a score; NULL outside 0..100."""
    band = F.when((score < 0) | (score > BANDS[-1][0]), None)
    for upper, label in BANDS:
        band = band.when(score <= upper, label)
    return band


def sentiment_bands(t: Tables) -> DataFrame:
    return view("vw_fear_greed_daily_trend", t).withColumn("band", sentiment_band(F.col("fear_greed_score")))


def sentiment_runs(t: Tables) -> DataFrame:
    """Unbroken stretches of one band, with an `is_extreme` flag."""
    banded = sentiment_bands(t).where("band IS NOT NULL").select(AT, "band")
    return runs(banded, [], AT, "band").withColumn("is_extreme", F.col("band").startswith("extreme"))
