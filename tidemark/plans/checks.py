"""The data-quality checks. An empty result means the check passes, except for the one
that returns a count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.kpi import delay_seconds
from tidemark.operators.joins import orphan_keys, orphans
from tidemark.plans.views import absent, outside, outdated_last_updated_timestamp

Tables = Mapping[str, DataFrame]

# Fixed pattern: a plain calendar date.
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"

AT = "snapshot_timestamp"


@dataclass(frozen=True)
class RowRule:
    """Rows of one table that meet a predicate."""

    table: str
    where: str
    columns: tuple[str, ...] = ("*",)


@dataclass(frozen=True)
class UniqueRule:
    """Keys of one table that occur more than once."""

    table: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKeyRule:
    """Key values of one table that are missing in another."""

    table: str
    key: str
    reference: str
    distinct: bool = False


@dataclass(frozen=True)
class CountRule:
    """How many rows of one table meet a predicate."""

    table: str
    where: str
    name: str


@dataclass(frozen=True)
class LagRule:
    """Snapshots that lag behind their source by more than five minutes."""

    table: str


def malformed(column: str) -> str:
    return f"({column} IS NOT NULL AND NOT CAST({column} AS STRING) RLIKE r'{DATE_TEXT}')"


# Names, tables, bounds and columns of the checks.
CHECKS: dict[str, RowRule | UniqueRule | ForeignKeyRule | CountRule | LagRule] = {
    # crypto
    "crypto_01_missing_name_or_symbol": RowRule("dim_crypto_id", absent("name", "symbol")),
    "crypto_02_duplicate_id": UniqueRule("dim_crypto_id", ("crypto_id",)),
    "crypto_03_missing_urls": RowRule("dim_crypto_info", absent("logo_url", "website_url")),
    "crypto_04_malformed_dates": RowRule(
        "dim_crypto_info",
        malformed("date_added") + " OR " + malformed("date_launched"),
        ("crypto_id", "date_added", "date_launched"),
    ),
    "crypto_05_missing_rank_or_status": RowRule("dim_crypto_map", absent("rank", "is_active")),
    "crypto_06_duplicate_map_key": UniqueRule("dim_crypto_map", ("crypto_id", AT)),
    "crypto_07_missing_price": RowRule("fact_crypto_market", absent("price_usd")),
    "crypto_08_volume_ratio_outlier": RowRule(
        "fact_crypto_market",
        outside(None, 10.0, "volume_to_market_cap_ratio"),
        ("crypto_id", AT, "volume_to_market_cap_ratio"),
    ),
    "crypto_09_supply_utilization_outlier": RowRule(
        "fact_crypto_market", outside(None, 1.1, "supply_utilization"), ("crypto_id", AT, "supply_utilization")
    ),
    "crypto_10_market_orphans": ForeignKeyRule("fact_crypto_market", "crypto_id", "dim_crypto_id"),
    "crypto_11_category_missing_text": RowRule("dim_crypto_category", absent("name", "title")),
    "crypto_12_link_category_orphans": ForeignKeyRule(
        "crypto_category_link", "category_id", "dim_crypto_category", distinct=True
    ),
    "crypto_13_link_crypto_orphans": ForeignKeyRule(
        "crypto_category_link", "crypto_id", "dim_crypto_id", distinct=True
    ),
    "crypto_14_category_missing_metrics": RowRule(
        "fact_crypto_category", absent("market_cap", "volume", "num_tokens")
    ),
    "crypto_15_duplicate_category_key": UniqueRule("fact_crypto_category", ("category_id", AT)),
    "crypto_16_price_change_index_range": RowRule(
        "fact_crypto_category",
        outside(-100.0, 1000.0, "price_change_index"),
        ("category_id", AT, "price_change_index"),
    ),
    "crypto_17_category_volume_ratio": RowRule(
        "fact_crypto_category",
        outside(None, 10.0, "volume_to_market_cap_ratio"),
        ("category_id", AT, "volume_to_market_cap_ratio"),
    ),
    # exchange
    "exchange_01_missing_spot_volume": CountRule(
        "fact_exchange_assets", absent("spot_volume_usd"), "null_spot_volume_usd"
    ),
    "exchange_02_duplicate_asset_key": UniqueRule(
        "fact_exchange_assets", ("exchange_id", "wallet_address", "crypto_id", AT)
    ),
    "exchange_03_wallet_weight_outlier": RowRule(
        "fact_exchange_assets", outside(None, 100.0, "wallet_weight"), ("exchange_id", AT, "wallet_weight")
    ),
    "exchange_04_map_all_missing": RowRule(
        "dim_exchange_map", absent("maker_fee", "taker_fee", "weekly_visits", every=True), ("exchange_id", AT)
    ),
    "exchange_05_duplicate_map_key": UniqueRule("dim_exchange_map", ("exchange_id", AT)),
    "exchange_06_extreme_fees": RowRule(
        "dim_exchange_map", outside(None, 0.5, "maker_fee", "taker_fee"), ("exchange_id", AT, "maker_fee",
            "taker_fee")
    ),
    "exchange_07_extreme_visits": RowRule(
        "dim_exchange_map", "weekly_visits > 100000000", ("exchange_id", AT, "weekly_visits")
    ),
    "exchange_08_asset_orphans": ForeignKeyRule("fact_exchange_assets", "exchange_id", "dim_exchange_id"),
    "exchange_09_missing_name": RowRule("dim_exchange_id", absent("name")),
    "exchange_10_missing_urls": RowRule("dim_exchange_info", absent("website_url", "logo_url"),
        ("exchange_id",)),
    "exchange_11_malformed_launch_date": RowRule(
        "dim_exchange_info", malformed("date_launched"), ("exchange_id", "date_launched")
    ),
    # sentiment
    "sentiment_01_missing_score": RowRule("fact_market_sentiment", absent("fear_greed_score")),
    "sentiment_02_score_range": RowRule("fact_market_sentiment", "fear_greed_score NOT BETWEEN 0 AND 100"),
    "sentiment_03_missing_label": RowRule("fact_market_sentiment", absent("sentiment_label")),
    "sentiment_04_duplicate_time": UniqueRule("fact_market_sentiment", (AT,)),
    # global market
    "global_01_missing_metrics": RowRule(
        "fact_global_market", absent("total_market_cap", "total_volume_24h", "btc_dominance")
    ),
    "global_02_dominance_range": RowRule(
        "fact_global_market",
        outside(0.0, 100.0, "btc_dominance", "eth_dominance"),
        (AT, "btc_dominance", "eth_dominance"),
    ),
    "global_03_liquidity_range": RowRule(
        "fact_global_market", outside(0.01, 10.0, "market_liquidity_ratio"), (AT, "market_liquidity_ratio")
    ),
    "global_04_defi_share_range": RowRule(
        "fact_global_market", outside(0.0, 1.0, "defi_volume_share"), (AT, "defi_volume_share")
    ),
    "global_05_stablecoin_share_range": RowRule(
        "fact_global_market", outside(0.0, 1.0, "stablecoin_market_share"), (AT, "stablecoin_market_share")
    ),
    "global_06_growth_rate_range": RowRule(
        "fact_global_market", outside(0.0, 0.5, "crypto_growth_rate_30d"), (AT, "crypto_growth_rate_30d")
    ),
    "global_07_duplicate_time": UniqueRule("fact_global_market", (AT,)),
    "global_08_stale_update": LagRule("fact_global_market"),
    "global_09_negative_metrics": RowRule(
        "fact_global_market",
        outside(0.0, None, "total_market_cap", "total_volume_24h"),
        (AT, "total_market_cap", "total_volume_24h"),
    ),
    "global_10_growth_consistency": RowRule(
        "fact_global_market",
        "new_cryptos_last_30d NOT BETWEEN min_daily_new_cryptos AND max_daily_new_cryptos",
        (AT, "new_cryptos_last_30d", "max_daily_new_cryptos", "min_daily_new_cryptos"),
    ),
}


def violations(name: str, tables: Tables) -> DataFrame:
    """The rows a check reports."""
    rule = CHECKS[name]
    df = tables[rule.table]
    match rule:
        case RowRule():
            return df.where(rule.where).select(*rule.columns)
        case UniqueRule():
            return df.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
        case ForeignKeyRule():
            find = orphan_keys if rule.distinct else orphans
            return find(df.select(rule.key), tables[rule.reference], rule.key)
        case CountRule():
            return df.agg(F.count_if(F.expr(rule.where)).alias(rule.name))
        case LagRule():
            return outdated_last_updated_timestamp({rule.table: df})


def _row_predicate(rule) -> str | None:
    return rule.where if isinstance(rule, (RowRule, CountRule)) else None


def row_rule_counts(table: str, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(check_name, violation_count) of every row-level rule of a table, from one scan."""
    chosen = {
        n: F.expr(_row_predicate(r))
        for n, r in CHECKS.items()
        if r.table == table and _row_predicate(r) and (names is None or n in names)
    }
    if names is None and table == "fact_global_market":
        chosen["global_08_stale_update"] = delay_seconds(F.col(AT), F.col("last_updated_timestamp")) > 300
    counts = df.agg(*[F.count_if(p).alias(n) for n, p in chosen.items()])
    return counts.select(
        F.explode(F.map_from_arrays(F.array(*map(F.lit, chosen)), F.array(*map(F.col, chosen)))).alias(
            "check_name", "violation_count"
        )
    )


def summary(tables: Tables) -> dict[str, int]:
    """check -> number of reported rows, for every check whose tables are given.

    The row-level checks of a table share one scan.
    """
    counts: dict[str, int] = {}
    for table, df in tables.items():
        if any(rule.table == table and _row_predicate(rule) for rule in CHECKS.values()):
            counts |= {r["check_name"]: r["violation_count"] for r in row_rule_counts(table, df).collect()}
    for name, rule in CHECKS.items():
        needed = {rule.table, rule.reference} if isinstance(rule, ForeignKeyRule) else {rule.table}
        if name not in counts and needed <= set(tables):
            counts[name] = violations(name, tables).count()
    return dict(sorted(counts.items()))
