"""Bronze read schemas as DDL text: only the columns a build uses, so the scan reads no others."""

from __future__ import annotations

from tidemark.sources.payloads import GLOBAL_COUNTS, GLOBAL_METRICS, GLOBAL_QUOTES


CRYPTO_ID = (
    "id bigint, name string, symbol string, platform_id double, platform_name string, "
    "platform_symbol string, platform_token_address string"
)
CRYPTO_MAP = ("id bigint, rank bigint, is_active bigint, last_historical_data string, date_snapshot string")
CRYPTO_INFO = (
    "id bigint, slug string, category string, tags string, description string, date_launched string, "
    "date_added string, logo string, website string, technical_doc string, twitter string, explorer string, "
    "source_code string, date_snapshot string"
)
LISTINGS = (
    "id bigint, cmc_rank bigint, num_market_pairs double, circulating_supply double, total_supply double, "
    "max_supply double, infinite_supply boolean, self_reported_circulating_supply double, "
    "self_reported_market_cap double, platform_id double, price_usd double, volume_24h_usd double, "
    "volume_change_24h double, percent_change_1h_usd double, percent_change_24h_usd double, "
    "percent_change_7d_usd double, market_cap_usd double, market_cap_dominance_usd double, "
    "fully_diluted_market_cap_usd double, last_updated_usd string, date_snapshot string, batch_index bigint"
)
CATEGORIES = (
    "category_id string, name string, title string, description string, num_tokens double, "
    "avg_price_change double, market_cap double, market_cap_change double, volume double, "
    "volume_change double, last_updated string, date_snapshot string"
)
CATEGORY_LINKS = ("crypto_id bigint, category_id string")
EXCHANGE_MAP = ("id bigint, name string, is_active bigint")
EXCHANGE_INFO = (
    "id bigint, slug string, description string, date_launched string, logo string, weekly_visits double, "
    "spot_volume_usd double, maker_fee double, taker_fee double, "
    "urls struct<blog: array<string>, fee: array<string>, twitter: array<string>, website: array<string>>, "
    "fiats string, date_snapshot string"
)
EXCHANGE_ASSETS = (
    "exchange_id bigint, date_snapshot string, platform_symbol string, platform_name string, "
    "wallet_address string, currency_crypto_id bigint, balance double, currency_price_usd double"
)
GLOBAL = (
    ", ".join(
        [f"{n} bigint" for n in GLOBAL_COUNTS]
        + [f"{n} double" for n in GLOBAL_METRICS]
        + [f"quote_{n} double" for n in GLOBAL_QUOTES]
        + [f"tracked_{s}IncrementalNumber bigint, tracked_{s}IncrementalDate string" for s in ("max", "min")]
        + ["last_updated string", "date_snapshot string"]
    )
)
SENTIMENT_HISTORY = ("value bigint, value_classification string, timestamp string")
SENTIMENT_LATEST = ("value bigint, value_classification string, update_time string")
