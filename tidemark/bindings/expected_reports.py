"""DuckDB texts for the views, dashboard questions and data-quality checks."""

from __future__ import annotations

from tidemark.bindings.oracle import AT, sql

C = "fact_crypto_category JOIN dim_crypto_category USING (category_id)"
M = "fact_crypto_market JOIN dim_crypto_id d USING (crypto_id)"
X = "dim_exchange_map JOIN dim_exchange_id USING (exchange_id)"
G = "fact_global_market"
S = "fact_market_sentiment"
W = "fact_exchange_assets JOIN dim_exchange_id USING (exchange_id)"
LAG = f"""SELECT {AT}, last_updated_timestamp,
    CAST(epoch_us({AT}) - epoch_us(last_updated_timestamp) AS DOUBLE) / 1e6 AS delay_seconds
    FROM fact_global_market WHERE {AT} > last_updated_timestamp + INTERVAL 5 MINUTE"""

_VIEWS: dict[str, str] = {
    "vw_category_dominance_index": f"SELECT category_id, name, {AT}, dominance_per_token, volume_to_market_cap_ratio FROM {C} WHERE dominance_per_token IS NOT NULL",
    "vw_category_market_trend": f"SELECT category_id, name, {AT}, num_tokens, market_cap, volume, market_cap_change, volume_change, market_cap_change_rate, volume_change_rate FROM {C} WHERE market_cap IS NOT NULL AND volume IS NOT NULL",
    "vw_category_price_change_index": f"SELECT category_id, name, {AT}, avg_price_change, price_change_index FROM {C} WHERE price_change_index IS NOT NULL",
    "vw_crypto_info_overview": "SELECT crypto_id, d.name, slug, category, description, logo_url, website_url, twitter_url, source_code_url, technical_doc_url FROM dim_crypto_info JOIN dim_crypto_id d USING (crypto_id)",
    "vw_crypto_market_cap_trend": f"SELECT crypto_id, name, {AT}, market_cap_usd, market_cap_dominance_usd, fully_diluted_market_cap_usd FROM {M} WHERE market_cap_usd IS NOT NULL",
    "vw_crypto_market_rank_history": f"SELECT crypto_id, name, {AT}, cmc_rank, num_market_pairs FROM {M} WHERE cmc_rank IS NOT NULL",
    "vw_crypto_price_evolution": f"SELECT crypto_id, name, {AT}, price_usd, percent_change_24h_usd, percent_change_7d_usd FROM {M} WHERE price_usd IS NOT NULL",
    "vw_crypto_supply_utilization": f"SELECT crypto_id, name, {AT}, circulating_supply, total_supply, max_supply, infinite_supply, self_reported_circulating_supply, supply_utilization, missing_supply_ratio, fully_diluted_cap_ratio FROM {M} WHERE supply_utilization IS NOT NULL",
    "vw_crypto_volume_vs_price": f"SELECT crypto_id, name, {AT}, price_usd, volume_24h_usd, volume_change_24h, percent_change_24h_usd, volume_to_market_cap_ratio FROM {M} WHERE price_usd IS NOT NULL AND volume_24h_usd IS NOT NULL",
    "vw_top_categories_by_market_cap": f"SELECT category_id, name, {AT}, market_cap, rank() OVER (PARTITION BY {AT} ORDER BY market_cap DESC) AS category_rank FROM {C} WHERE market_cap IS NOT NULL",
    "vw_average_asset_price_by_crypto": f"SELECT crypto_id, name, symbol, {AT}, sum(currency_price_usd) / count(currency_price_usd) AS avg_price_usd FROM fact_exchange_assets JOIN dim_crypto_id USING (crypto_id) WHERE currency_price_usd IS NOT NULL GROUP BY ALL",
    "vw_exchange_fee_history": f"SELECT exchange_id, name, {AT}, maker_fee, taker_fee FROM {X}",
    "vw_exchange_info_overview": "SELECT exchange_id, name, slug, description, logo_url, website_url, fee_url FROM dim_exchange_info JOIN dim_exchange_id USING (exchange_id)",
    "vw_exchange_supported_fiats": "SELECT exchange_id, name, unnest(fiats) AS fiat_currency FROM dim_exchange_info JOIN dim_exchange_id USING (exchange_id)",
    "vw_exchange_weekly_visits_trend": f"SELECT exchange_id, name, {AT}, weekly_visits FROM {X} WHERE weekly_visits IS NOT NULL",
    "vw_top_wallets_by_usd_value": f"SELECT exchange_id, name, {AT}, wallet_address, crypto_id, total_usd_value, row_number() OVER (PARTITION BY exchange_id, {AT} ORDER BY total_usd_value DESC, wallet_address, crypto_id) AS wallet_rank FROM {W} WHERE total_usd_value IS NOT NULL",
    "vw_wallet_concentration_by_exchange": f"SELECT exchange_id, name, {AT}, count(*) AS wallet_count, sum(wallet_weight) / count(*) AS avg_weight, max(wallet_weight) AS max_weight FROM {W} WHERE wallet_weight IS NOT NULL GROUP BY ALL",
    "vw_fear_greed_daily_trend": f"SELECT {AT}, fear_greed_score, sentiment_label FROM {S} WHERE fear_greed_score IS NOT NULL",
    "vw_altcoin_market_trend": f"SELECT {AT}, altcoin_market_cap, altcoin_volume_24h, altcoin_volume_24h_reported FROM {G}",
    "vw_btc_eth_dominance_trend": f"SELECT {AT}, btc_dominance, eth_dominance, btc_dominance_yesterday, eth_dominance_yesterday, btc_dominance_24h_change, eth_dominance_24h_change, btc_dominance_delta, eth_dominance_delta FROM {G}",
    "vw_crypto_creation_activity": f"SELECT {AT}, total_cryptocurrencies, new_cryptos_today, new_cryptos_last_24h, new_cryptos_last_7d, new_cryptos_last_30d, crypto_growth_rate_30d, max_daily_new_cryptos, CAST(max_new_cryptos_day AS VARCHAR) AS max_new_cryptos_day, min_daily_new_cryptos, CAST(min_new_cryptos_day AS VARCHAR) AS min_new_cryptos_day FROM {G}",
    "vw_defi_market_trend": f"SELECT {AT}, defi_market_cap, defi_volume_24h, defi_volume_24h_reported, defi_volume_share, defi_24h_percentage_change, check_defi_volume_share FROM {G}",
    "vw_derivatives_activity_trend": f"SELECT {AT}, derivatives_volume_24h, derivatives_volume_24h_reported, derivatives_24h_percentage_change FROM {G}",
    "vw_global_market_overview": f"SELECT {AT}, total_market_cap, total_volume_24h, total_market_cap_yesterday, total_volume_24h_yesterday, total_market_cap_yesterday_change, total_volume_24h_yesterday_change, total_volume_24h_reported, market_liquidity_ratio FROM {G}",
    "vw_market_participants_trend": f"SELECT {AT}, active_cryptocurrencies, total_cryptocurrencies, active_market_pairs, active_exchanges, total_exchanges FROM {G}",
    "vw_stablecoin_market_trend": f"SELECT {AT}, stablecoin_market_cap, stablecoin_volume_24h, stablecoin_volume_24h_reported, stablecoin_market_share, stablecoin_24h_percentage_change, check_stablecoin_market_share FROM {G}",
    "vw_categories_volume_to_market_cap_anomalies": f"SELECT category_id, {AT}, volume_to_market_cap_ratio FROM fact_crypto_category WHERE volume_to_market_cap_ratio > 10",
    "vw_crypto_market_cap_outliers": f"SELECT crypto_id, {AT}, volume_to_market_cap_ratio FROM fact_crypto_market WHERE volume_to_market_cap_ratio > 10",
    "vw_crypto_missing_names_or_symbols": "SELECT crypto_id FROM dim_crypto_id WHERE name IS NULL OR symbol IS NULL",
    "vw_crypto_missing_urls": "SELECT crypto_id FROM dim_crypto_info WHERE logo_url IS NULL OR website_url IS NULL",
    "vw_extreme_category_price_change_index": f"SELECT category_id, {AT}, price_change_index FROM fact_crypto_category WHERE NOT price_change_index BETWEEN -100 AND 1000",
    "vw_supply_utilization_outliers": f"SELECT crypto_id, {AT}, supply_utilization FROM fact_crypto_market WHERE supply_utilization > CAST(1.1 AS DOUBLE)",
    "vw_high_fee_exchanges": f"SELECT exchange_id, {AT}, maker_fee, taker_fee FROM dim_exchange_map WHERE maker_fee > 0.5 OR taker_fee > 0.5",
    "vw_missing_urls": "SELECT exchange_id, website_url, logo_url FROM dim_exchange_info WHERE website_url IS NULL OR logo_url IS NULL",
    "vw_wallet_weight_anomalies": f"SELECT exchange_id, {AT}, wallet_address, crypto_id, wallet_weight, total_usd_value, spot_volume_usd FROM fact_exchange_assets WHERE wallet_weight > 100",
    "vw_weekly_visits_outliers": f"SELECT exchange_id, {AT}, weekly_visits FROM dim_exchange_map WHERE weekly_visits > 100000000",
    "vw_invalid_fear_greed_scores": f"SELECT * FROM {S} WHERE fear_greed_score < 0 OR fear_greed_score > 100",
    "vw_missing_sentiment_labels": f"SELECT * FROM {S} WHERE sentiment_label IS NULL",
    "vw_defi_volume_share_anomalies": f"SELECT {AT}, defi_volume_24h, total_volume_24h, defi_volume_share FROM {G} WHERE NOT defi_volume_share BETWEEN 0 AND 1",
    "vw_invalid_dominance_percentages": f"SELECT {AT}, btc_dominance, eth_dominance FROM {G} WHERE btc_dominance < 0 OR btc_dominance > 90 OR eth_dominance < 0 OR eth_dominance > 90",
    "vw_market_liquidity_ratio_outliers": f"SELECT {AT}, total_volume_24h, total_market_cap, market_liquidity_ratio FROM {G} WHERE NOT market_liquidity_ratio BETWEEN CAST(0.01 AS DOUBLE) AND 10",
    "vw_stablecoin_market_share_anomalies": f"SELECT {AT}, stablecoin_market_cap, total_market_cap, stablecoin_market_share FROM {G} WHERE NOT stablecoin_market_share BETWEEN 0 AND 1",
    "vw_fact_crypto_market_invalid_fks": f"SELECT crypto_id, {AT} FROM fact_crypto_market f WHERE NOT EXISTS (FROM dim_crypto_id d WHERE d.crypto_id = f.crypto_id)",
    "vw_missing_crypto_prices": f"SELECT crypto_id, {AT} FROM fact_crypto_market WHERE price_usd IS NULL",
    "vw_missing_crypto_rank_or_status": f"SELECT crypto_id, {AT} FROM dim_crypto_map WHERE rank IS NULL OR is_active IS NULL",
    "vw_missing_metrics_in_crypto_category": "SELECT * FROM fact_crypto_category WHERE market_cap IS NULL OR volume IS NULL OR num_tokens IS NULL",
    "vw_pipeline_misalignment_exchange_map": f"SELECT exchange_id, {AT} FROM dim_exchange_map WHERE maker_fee IS NULL AND taker_fee IS NULL AND weekly_visits IS NULL",
    "vw_missing_spot_volume": f"SELECT exchange_id, {AT}, wallet_address, crypto_id, balance, currency_price_usd, total_usd_value FROM fact_exchange_assets WHERE spot_volume_usd IS NULL",
    "vw_missing_critical_market_metrics": f"SELECT {AT}, total_market_cap, total_volume_24h, btc_dominance FROM {G} WHERE total_market_cap IS NULL OR total_volume_24h IS NULL OR btc_dominance IS NULL",
    "vw_outdated_last_updated_timestamp": LAG,
}

_BAND = """CASE WHEN fear_greed_score BETWEEN 0 AND 24 THEN 'extreme fear' WHEN fear_greed_score BETWEEN 25 AND 49 THEN 'fear'
    WHEN fear_greed_score = 50 THEN 'neutral' WHEN fear_greed_score BETWEEN 51 AND 74 THEN 'greed'
    WHEN fear_greed_score BETWEEN 75 AND 100 THEN 'extreme greed' END"""

_DASHBOARDS: dict[str, str] = {
    "market_size_over_time": f"SELECT {AT}, total_market_cap, total_volume_24h, total_volume_24h_reported, market_liquidity_ratio FROM {G}",
    "dominance_over_time": f"SELECT {AT}, btc_dominance, eth_dominance, btc_dominance_yesterday, eth_dominance_yesterday, btc_dominance_24h_change, eth_dominance_24h_change, btc_dominance_delta, eth_dominance_delta, btc_dominance + eth_dominance AS combined_dominance FROM {G}",
    "category_over_time": f"SELECT category_id, name, {AT}, dominance_per_token, volume_to_market_cap_ratio FROM {C} WHERE dominance_per_token IS NOT NULL AND category_id = 'SMALL/Brand#2'",
    "leading_categories": f"SELECT category_id, name, {AT}, market_cap, rank() OVER (PARTITION BY {AT} ORDER BY market_cap DESC) AS category_rank FROM {C} WHERE market_cap IS NOT NULL QUALIFY category_rank <= 10",
    "capitalisation_and_dominance": f"SELECT crypto_id, name, {AT}, market_cap_usd, market_cap_dominance_usd, fully_diluted_market_cap_usd FROM {M} WHERE market_cap_usd IS NOT NULL",
    "defi_over_time": f"SELECT {AT}, defi_market_cap, defi_volume_24h, defi_volume_24h_reported, defi_volume_share, defi_24h_percentage_change, check_defi_volume_share FROM {G}",
    "sentiment_bands": f"SELECT {AT}, fear_greed_score, sentiment_label, {_BAND} AS band FROM {S} WHERE fear_greed_score IS NOT NULL",
    "sentiment_runs": f"""SELECT band, min({AT}) AS run_start, max({AT}) AS run_end, count(*) AS run_length, band IN ('extreme fear', 'extreme greed') AS is_extreme
        FROM (SELECT {AT}, band, row_number() OVER (ORDER BY {AT}) - row_number() OVER (PARTITION BY band ORDER BY {AT}) AS island
              FROM (SELECT {AT}, {_BAND} AS band FROM {S}) WHERE band IS NOT NULL) GROUP BY band, island""",
    "top_wallets": f"SELECT exchange_id, name, {AT}, wallet_address, crypto_id, total_usd_value, row_number() OVER (PARTITION BY exchange_id, {AT} ORDER BY total_usd_value DESC, wallet_address, crypto_id) AS wallet_rank FROM {W} WHERE total_usd_value IS NOT NULL QUALIFY wallet_rank <= 10",
}


def _repeated(table: str, keys: str) -> str:
    return f"SELECT {keys}, count(*) AS cnt FROM {table} GROUP BY {keys} HAVING cnt > 1"


_INFO = "crypto_id, slug, snapshot_timestamp, CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(date_launched AS VARCHAR) AS date_launched, CAST(date_added AS VARCHAR) AS date_added, category, array_to_string(tags, '|') AS tags, description, logo_url, website_url, technical_doc_url, explorer_url, source_code_url, twitter_url"
_BAD_DATE = "NOT regexp_full_match(CAST({0} AS VARCHAR), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"

_CHECKS: dict[str, str] = {
    "crypto_01_missing_name_or_symbol": "SELECT * FROM dim_crypto_id WHERE name IS NULL OR symbol IS NULL",
    "crypto_02_duplicate_id": _repeated("dim_crypto_id", "crypto_id"),
    "crypto_03_missing_urls": f"SELECT {_INFO} FROM dim_crypto_info WHERE logo_url IS NULL OR website_url IS NULL",
    "crypto_04_malformed_dates": f"SELECT crypto_id, CAST(date_added AS VARCHAR) AS date_added, CAST(date_launched AS VARCHAR) AS date_launched FROM dim_crypto_info WHERE {_BAD_DATE.format('date_added')} OR {_BAD_DATE.format('date_launched')}",
    "crypto_05_missing_rank_or_status": "SELECT * FROM dim_crypto_map WHERE rank IS NULL OR is_active IS NULL",
    "crypto_06_duplicate_map_key": _repeated("dim_crypto_map", f"crypto_id, {AT}"),
    "crypto_07_missing_price": "SELECT * FROM fact_crypto_market WHERE price_usd IS NULL",
    "crypto_08_volume_ratio_outlier": f"SELECT crypto_id, {AT}, volume_to_market_cap_ratio FROM fact_crypto_market WHERE volume_to_market_cap_ratio > 10",
    "crypto_09_supply_utilization_outlier": f"SELECT crypto_id, {AT}, supply_utilization FROM fact_crypto_market WHERE supply_utilization > CAST(1.1 AS DOUBLE)",
    "crypto_10_market_orphans": "SELECT crypto_id FROM fact_crypto_market f WHERE NOT EXISTS (FROM dim_crypto_id d WHERE d.crypto_id = f.crypto_id)",
    "crypto_11_category_missing_text": "SELECT * FROM dim_crypto_category WHERE name IS NULL OR title IS NULL",
    "crypto_12_link_category_orphans": "SELECT category_id FROM crypto_category_link EXCEPT SELECT category_id FROM dim_crypto_category",
    "crypto_13_link_crypto_orphans": "SELECT crypto_id FROM crypto_category_link EXCEPT SELECT crypto_id FROM dim_crypto_id",
    "crypto_14_category_missing_metrics": "SELECT * FROM fact_crypto_category WHERE market_cap IS NULL OR volume IS NULL OR num_tokens IS NULL",
    "crypto_15_duplicate_category_key": _repeated("fact_crypto_category", f"category_id, {AT}"),
    "crypto_16_price_change_index_range": f"SELECT category_id, {AT}, price_change_index FROM fact_crypto_category WHERE NOT price_change_index BETWEEN -100 AND 1000",
    "crypto_17_category_volume_ratio": f"SELECT category_id, {AT}, volume_to_market_cap_ratio FROM fact_crypto_category WHERE volume_to_market_cap_ratio > 10",
    "exchange_01_missing_spot_volume": "SELECT count(*) - count(spot_volume_usd) AS null_spot_volume_usd FROM fact_exchange_assets",
    "exchange_02_duplicate_asset_key": _repeated("fact_exchange_assets", f"exchange_id, wallet_address, crypto_id, {AT}"),
    "exchange_03_wallet_weight_outlier": f"SELECT exchange_id, {AT}, wallet_weight FROM fact_exchange_assets WHERE wallet_weight > 100",
    "exchange_04_map_all_missing": f"SELECT exchange_id, {AT} FROM dim_exchange_map WHERE maker_fee IS NULL AND taker_fee IS NULL AND weekly_visits IS NULL",
    "exchange_05_duplicate_map_key": _repeated("dim_exchange_map", f"exchange_id, {AT}"),
    "exchange_06_extreme_fees": f"SELECT exchange_id, {AT}, maker_fee, taker_fee FROM dim_exchange_map WHERE maker_fee > 0.5 OR taker_fee > 0.5",
    "exchange_07_extreme_visits": f"SELECT exchange_id, {AT}, weekly_visits FROM dim_exchange_map WHERE weekly_visits > 100000000",
    "exchange_08_asset_orphans": "SELECT exchange_id FROM fact_exchange_assets f WHERE NOT EXISTS (FROM dim_exchange_id d WHERE d.exchange_id = f.exchange_id)",
    "exchange_09_missing_name": "SELECT * FROM dim_exchange_id WHERE name IS NULL",
    "exchange_10_missing_urls": "SELECT exchange_id FROM dim_exchange_info WHERE website_url IS NULL OR logo_url IS NULL",
    "exchange_11_malformed_launch_date": f"SELECT exchange_id, date_launched FROM dim_exchange_info WHERE {_BAD_DATE.format('date_launched')}",
    "sentiment_01_missing_score": f"SELECT * FROM {S} WHERE fear_greed_score IS NULL",
    "sentiment_02_score_range": f"SELECT * FROM {S} WHERE NOT fear_greed_score BETWEEN 0 AND 100",
    "sentiment_03_missing_label": f"SELECT * FROM {S} WHERE sentiment_label IS NULL",
    "sentiment_04_duplicate_time": _repeated(S, AT),
    "global_01_missing_metrics": f"SELECT * REPLACE (CAST(max_new_cryptos_day AS VARCHAR) AS max_new_cryptos_day, CAST(min_new_cryptos_day AS VARCHAR) AS min_new_cryptos_day) FROM {G} WHERE total_market_cap IS NULL OR total_volume_24h IS NULL OR btc_dominance IS NULL",
    "global_02_dominance_range": f"SELECT {AT}, btc_dominance, eth_dominance FROM {G} WHERE btc_dominance < 0 OR btc_dominance > 100 OR eth_dominance < 0 OR eth_dominance > 100",
    "global_03_liquidity_range": f"SELECT {AT}, market_liquidity_ratio FROM {G} WHERE NOT market_liquidity_ratio BETWEEN CAST(0.01 AS DOUBLE) AND 10",
    "global_04_defi_share_range": f"SELECT {AT}, defi_volume_share FROM {G} WHERE NOT defi_volume_share BETWEEN 0 AND 1",
    "global_05_stablecoin_share_range": f"SELECT {AT}, stablecoin_market_share FROM {G} WHERE NOT stablecoin_market_share BETWEEN 0 AND 1",
    "global_06_growth_rate_range": f"SELECT {AT}, crypto_growth_rate_30d FROM {G} WHERE NOT crypto_growth_rate_30d BETWEEN 0 AND 0.5",
    "global_07_duplicate_time": _repeated(G, AT),
    "global_08_stale_update": LAG,
    "global_09_negative_metrics": f"SELECT {AT}, total_market_cap, total_volume_24h FROM {G} WHERE total_market_cap < 0 OR total_volume_24h < 0",
    "global_10_growth_consistency": f"SELECT {AT}, new_cryptos_last_30d, max_daily_new_cryptos, min_daily_new_cryptos FROM {G} WHERE new_cryptos_last_30d < min_daily_new_cryptos OR new_cryptos_last_30d > max_daily_new_cryptos",
}


def texts() -> dict[str, str]:
    found = {f"view_{n.removeprefix('vw_')}": sql(t) for n, t in _VIEWS.items()}
    found |= {f"dash_{n}": sql(t) for n, t in _DASHBOARDS.items()}
    found |= {f"dq_{n}": sql(t) for n, t in _CHECKS.items()}
    for table, prefix in SUMMARIES.items():
        parts = [
            f"SELECT '{n}' AS check_name, " + ("null_spot_volume_usd" if n.startswith("exchange_01") else "count(*)")
            + f" AS violation_count FROM ({_CHECKS[n]})"
            for n in prefix
        ]
        found[f"dq_summary_{table}"] = sql(" UNION ALL ".join(parts))
    return found


# row-level checks per table, counted together in one scan
SUMMARIES = {
    "fact_crypto_market": [
        "crypto_07_missing_price", "crypto_08_volume_ratio_outlier", "crypto_09_supply_utilization_outlier",
    ],
    "fact_crypto_category": [
        "crypto_14_category_missing_metrics", "crypto_16_price_change_index_range", "crypto_17_category_volume_ratio",
    ],
    "fact_exchange_assets": ["exchange_01_missing_spot_volume", "exchange_03_wallet_weight_outlier"],
    "dim_exchange_map": ["exchange_04_map_all_missing", "exchange_06_extreme_fees", "exchange_07_extreme_visits"],
    "fact_market_sentiment": ["sentiment_01_missing_score", "sentiment_02_score_range", "sentiment_03_missing_label"],
    "fact_global_market": [
        "global_01_missing_metrics", "global_02_dominance_range", "global_03_liquidity_range",
        "global_04_defi_share_range", "global_05_stablecoin_share_range", "global_06_growth_rate_range",
        "global_08_stale_update", "global_09_negative_metrics", "global_10_growth_consistency",
    ],
}
