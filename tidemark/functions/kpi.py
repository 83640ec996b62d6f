"""Null- and zero-safe KPI columns.

The guard alone decides between the computed value and `default`; a NULL numerator
under a passing guard gives NULL, never the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed value: denominators at or below this size count as zero in global metrics.
EPSILON = 1e-6


def _literal(default) -> Column:
    return F.lit(default).cast("double")


def guarded_ratio(
    num: Column,
    den: Column,
    *,
    eps: float | None = None,
    require: Sequence[Column] = (),
    default: float | None = 0.0,
) -> Column:
    """num / den when den is usable and every `require` column is present."""
    usable = den.isNotNull() & ((F.abs(den) > eps) if eps is not None else (den != 0))
    for column in require:
        usable = usable & column.isNotNull()
    return F.when(usable, F.try_divide(num, den)).otherwise(_literal(default))


def guarded_diff(a: Column, b: Column, default: float | None = 0.0) -> Column:
    """a - b when both are present."""
    return F.when(a.isNotNull() & b.isNotNull(), a - b).otherwise(_literal(default))


def guarded_product(a: Column, b: Column, default: float | None = 0.0) -> Column:
    """a * b when both are present."""
    return F.when(a.isNotNull() & b.isNotNull(), a * b).otherwise(_literal(default))


def is_meaningful(kpi: Column) -> Column:
    """Flag a KPI that differs from the 0.0 placeholder; NULL stays NULL."""
    return kpi != F.lit(0.0)


def delay_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two timestamps, with the fraction kept."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def market_kpis() -> dict[str, Column]:
    c = F.col
    return {
        "volume_to_market_cap_ratio": guarded_ratio(c("volume_24h_usd"), c("market_cap_usd")),
        "missing_supply_ratio": guarded_ratio(
            c("total_supply") - c("circulating_supply"), c("total_supply"), require=[c("circulating_supply")]
        ),
        "supply_utilization": guarded_ratio(
            c("circulating_supply"), c("max_supply"), require=[c("circulating_supply")]
        ),
        "fully_diluted_cap_ratio": guarded_ratio(
            c("fully_diluted_market_cap_usd"), c("market_cap_usd"), require=[c("fully_diluted_market_cap_usd")]
        ),
    }


def category_kpis() -> dict[str, Column]:
    c = F.col
    return {
        "volume_to_market_cap_ratio": guarded_ratio(c("volume"), c("market_cap")),
        "dominance_per_token": guarded_ratio(c("market_cap"), c("num_tokens")),
        "market_cap_change_rate": guarded_ratio(c("market_cap_change"), c("market_cap")),
        "volume_change_rate": guarded_ratio(c("volume_change"), c("volume")),
        "price_change_index": guarded_product(c("avg_price_change"), c("num_tokens")),
    }


def wallet_kpis() -> dict[str, Column]:
    c = F.col
    value = c("balance") * c("currency_price_usd")
    return {
        "total_usd_value": guarded_product(c("balance"), c("currency_price_usd"), default=None),
        "wallet_weight": guarded_ratio(
            value, c("spot_volume_usd"), require=[c("balance"), c("currency_price_usd")], default=None
        ),
    }


def global_kpis() -> dict[str, Column]:
    """Six KPIs, each followed by its `check_` flag."""
    c = F.col
    kpis = {
        "market_liquidity_ratio": guarded_ratio(c("total_volume_24h"), c("total_market_cap"), eps=EPSILON),
        "defi_volume_share": guarded_ratio(c("defi_volume_24h"), c("total_volume_24h"), eps=EPSILON),
        "stablecoin_market_share": guarded_ratio(c("stablecoin_market_cap"), c("total_market_cap"), eps=EPSILON),
        "btc_dominance_delta": guarded_diff(c("btc_dominance"), c("btc_dominance_yesterday")),
        "eth_dominance_delta": guarded_diff(c("eth_dominance"), c("eth_dominance_yesterday")),
        "crypto_growth_rate_30d": guarded_ratio(c("new_cryptos_last_30d"), c("total_cryptocurrencies")),
    }
    return kpis | {f"check_{name}": is_meaningful(kpi) for name, kpi in kpis.items()}
