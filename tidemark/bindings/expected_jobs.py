"""DuckDB texts for builds, loads, repairs, parsing, planning, operators and streams."""

from __future__ import annotations

from tidemark.bindings.oracle import AT, TABLES, flat, sql

NULL_TEXT = "CAST(NULL AS VARCHAR)"
NULL_NUM = "CAST(NULL AS DOUBLE)"
NULL_LONG = "CAST(NULL AS BIGINT)"


def _moment() -> str:
    return "CAST(TRY_CAST(date_snapshot AS TIMESTAMPTZ) AS TIMESTAMP)"


def _nulls(names: str, null: str) -> str:
    return ", ".join(f"{null} AS {n}" for n in names.split())


# what the warehouse holds before a load of new keys
_HELD = {
    "dim_crypto_id": "platform_id <= 20",
    "dim_exchange_id": "contains(name, '0')",
    "dim_crypto_category": "description = 'SMALL'",
    "dim_crypto_info": "category = 'ECONOMY'",
    "dim_exchange_info": "starts_with(description, 'A')",
    "crypto_category_link": "starts_with(category_id, 'SMALL')",
}
_REFERENCES = {
    "dim_crypto_info": ["crypto_id"],
    "dim_exchange_info": ["exchange_id"],
    "crypto_category_link": ["category_id", "crypto_id"],
    "dim_crypto_map": ["crypto_id"],
    "dim_exchange_map": ["exchange_id"],
    "fact_crypto_market": ["crypto_id"],
    "fact_crypto_category": ["category_id"],
    "fact_exchange_assets": ["crypto_id", "exchange_id"],
}
_OWNER = {"crypto_id": "dim_crypto_id", "exchange_id": "dim_exchange_id", "category_id": "dim_crypto_category"}


def _load(table: str) -> str:
    tests = [f"{key} IN (SELECT {key} FROM {_OWNER[key]})" for key in _REFERENCES.get(table, [])]
    if table in _HELD:
        tests.append(f"({_HELD[table]}) IS NOT TRUE")
    return flat(table) + (f" WHERE {' AND '.join(tests)}" if tests else "")


_ASSET_COLUMNS = (
    f"exchange_id, {AT}, snapshot_str, {{spot}} AS spot_volume_usd, blockchain_symbol, blockchain_name, wallet_address, "
    "crypto_id, balance, currency_price_usd, balance * currency_price_usd AS total_usd_value, "
    "balance * currency_price_usd / nullif({spot}, 0) AS wallet_weight"
)

_BUILDS = {
    "build_exchange_assets_single_run": "SELECT " + _ASSET_COLUMNS.format(spot="spot") + f""" FROM wallets LEFT JOIN (
        SELECT exchange_id, spot_volume_usd AS spot FROM exchange_measures
        QUALIFY row_number() OVER (PARTITION BY exchange_id ORDER BY {AT} DESC, spot_volume_usd DESC NULLS LAST) = 1
        ) USING (exchange_id)""",
    "build_exchange_assets_without_info": "SELECT " + _ASSET_COLUMNS.format(spot=NULL_NUM) + " FROM wallets",
    "build_sentiment_live": flat("fact_market_sentiment"),
    "flagship_supply_utilization": f"""SELECT crypto_id, name, {AT}, circulating_supply, total_supply, max_supply,
        infinite_supply, self_reported_circulating_supply, supply_utilization, missing_supply_ratio, fully_diluted_cap_ratio
        FROM fact_crypto_market JOIN dim_crypto_id USING (crypto_id) WHERE supply_utilization IS NOT NULL""",
    "load_store_cycle": f"""SELECT crypto_id, {AT}, price_usd, name
        FROM fact_crypto_market JOIN dim_crypto_id USING (crypto_id)""",
}

_REPAIRS = {
    "repair_exchange_map": f"""
        SELECT m.exchange_id, m.{AT}, snapshot_str,
               CASE WHEN hit THEN donor.weekly_visits ELSE m.weekly_visits END AS weekly_visits,
               CASE WHEN hit THEN donor.maker_fee ELSE m.maker_fee END AS maker_fee,
               CASE WHEN hit THEN donor.taker_fee ELSE m.taker_fee END AS taker_fee, is_active
        FROM dim_exchange_map m LEFT JOIN (
            SELECT g.exchange_id, g.gap, TRUE AS hit,
                   arg_max(struct_pack(weekly_visits := p.weekly_visits, maker_fee := p.maker_fee, taker_fee := p.taker_fee), p.{AT}) AS donor
            FROM (SELECT exchange_id, max({AT}) AS gap FROM dim_exchange_map
                  WHERE coalesce(maker_fee, taker_fee, weekly_visits) IS NULL GROUP BY ALL) g
            JOIN dim_exchange_map p ON p.exchange_id = g.exchange_id AND p.{AT} < g.gap
                 AND p.maker_fee + p.taker_fee + p.weekly_visits IS NOT NULL
            GROUP BY ALL) d ON d.exchange_id = m.exchange_id AND d.gap = m.{AT}""",
    "repair_spot_volume": f"""
        SELECT m.* REPLACE (CASE WHEN spot_volume_usd IS NULL THEN found ELSE spot_volume_usd END AS spot_volume_usd,
                            CASE WHEN spot_volume_usd IS NULL AND found IS NOT NULL
                                 THEN total_usd_value / nullif(found, 0) ELSE wallet_weight END AS wallet_weight)
        FROM fact_exchange_assets m LEFT JOIN (
            SELECT g.exchange_id, g.gap, arg_max(p.spot_volume_usd, p.{AT}) AS found
            FROM (SELECT exchange_id, max({AT}) AS gap FROM fact_exchange_assets
                  WHERE spot_volume_usd IS NULL GROUP BY ALL) g
            JOIN (SELECT exchange_id, {AT}, max(spot_volume_usd) AS spot_volume_usd FROM fact_exchange_assets
                  WHERE spot_volume_usd IS NOT NULL GROUP BY ALL) p ON p.exchange_id = g.exchange_id AND p.{AT} < g.gap
            GROUP BY ALL) d ON d.exchange_id = m.exchange_id AND d.gap = m.{AT}""",
}



def _repaired_by_load(table: str) -> str:
    """The table after three loads, each followed by a repair of all that is there."""
    number = f"CASE WHEN month({AT}) = 5 THEN 3 WHEN year({AT}) < 1998 THEN 1 WHEN year({AT}) < 2000 THEN 2 ELSE 3 END"
    full = _REPAIRS["repair_exchange_map" if table == "dim_exchange_map" else "repair_spot_volume"]
    ctes, before = [f"loads_{table} AS MATERIALIZED (SELECT *, {number} AS part FROM {table})"], ""
    for k in (1, 2, 3):
        ctes.append(f"loaded_{k} AS MATERIALIZED ({before}SELECT * EXCLUDE (part) FROM loads_{table} WHERE part = {k})")
        ctes.append(f"fixed_{k} AS MATERIALIZED ({full.replace(table, f'loaded_{k}')})")
        before = f"SELECT * FROM fixed_{k} UNION ALL BY NAME "
    return f"(WITH {', '.join(ctes)} SELECT * FROM fixed_3)"


def _loaded(table: str) -> str:
    tests = [f"{key} IN (SELECT {key} FROM {_OWNER[key]})" for key in _REFERENCES.get(table, [])]
    where = f" WHERE {' AND '.join(tests)}" if tests else ""
    return f"SELECT '{table}' AS table_name, 'load' AS phase, 'success' AS status, count(*) AS rows FROM {table}{where}"


# texts, then numbers
_SHOWN = {
    "dim_crypto_id": "name symbol platform_name | crypto_id platform_id",
    "dim_exchange_id": "name | exchange_id",
    "dim_crypto_category": "category_id name title |",
    "dim_crypto_info": "slug category website_url | crypto_id",
    "dim_exchange_info": "slug date_launched website_url | exchange_id",
    "crypto_category_link": "category_id | crypto_id",
    "dim_crypto_map": "last_historical_data | crypto_id rank is_active",
    "dim_exchange_map": "| exchange_id weekly_visits maker_fee",
    "fact_crypto_market": "last_updated_usd | crypto_id price_usd supply_utilization",
    "fact_crypto_category": "category_id | num_tokens market_cap dominance_per_token",
    "fact_exchange_assets": "wallet_address | exchange_id crypto_id wallet_weight",
    "fact_market_sentiment": "sentiment_label | fear_greed_score",
    "fact_global_market": "last_updated_str | total_market_cap btc_dominance_delta active_exchanges",
}


def _contents(table: str) -> str:
    texts, numbers = (part.split() for part in _SHOWN[table].split("|"))
    tests = [f"{key} IN (SELECT {key} FROM {_OWNER[key]})" for key in _REFERENCES.get(table, [])]
    timed = table.startswith("fact_") or table in ("dim_crypto_map", "dim_exchange_map", "dim_crypto_info")
    columns = [f"'{table}' AS table_name", f"{AT if timed else 'CAST(NULL AS TIMESTAMP)'} AS at"]
    columns += [f"{n} AS t{i}" for i, n in enumerate(texts + [NULL_TEXT] * (3 - len(texts)))]
    columns += [f"CAST({n} AS DOUBLE) AS n{i}" for i, n in enumerate(numbers + [NULL_NUM] * (3 - len(numbers)))]
    source = f"({_BUILDS['build_exchange_assets_single_run']})" if table == "fact_exchange_assets" else table
    return f"SELECT {', '.join(columns)} FROM {source}" + (f" WHERE {' AND '.join(tests)}" if tests else "")


_ALL_CONTENTS = " UNION ALL ".join(map(_contents, _SHOWN))

_STEPS = {
    "step_shared_scan": _ALL_CONTENTS,
    "stream_builds": _ALL_CONTENTS,
    "dq_duplicates_before_dedupe": f"""SELECT category_id, CAST(TRY_CAST(date_snapshot AS TIMESTAMPTZ) AS TIMESTAMP) AS {AT},
        count(*) AS cnt FROM in_categories GROUP BY ALL HAVING cnt > 1""",
    "dq_raw_reference_orphans": "SELECT exchange_id FROM in_exchange_assets EXCEPT SELECT id FROM in_exchange_map",
    # ranks are staged without a snapshot time, so their table is loaded without rows
    "step_groups": " UNION ALL ".join(
        _loaded(t)
        for t in (
            "dim_crypto_id", "dim_crypto_category", "dim_crypto_info", "crypto_category_link", "fact_crypto_market",
            "fact_crypto_category", "fact_global_market", "fact_market_sentiment",
        )
    )
    + " UNION ALL SELECT 'dim_crypto_map', 'load', 'success', 0",
    "repair_incremental": f"""SELECT 'dim_exchange_map' AS table_name, exchange_id, {AT}, CAST(weekly_visits AS DOUBLE) AS n0,
            maker_fee AS n1, taker_fee AS n2 FROM {_repaired_by_load('dim_exchange_map')}
        UNION ALL SELECT 'fact_exchange_assets', exchange_id, {AT}, spot_volume_usd, wallet_weight, balance
        FROM {_repaired_by_load('fact_exchange_assets')}""",
    "dq_incremental_duplicates": f"SELECT id AS crypto_id, {_moment()} AS {AT}, count(*) AS cnt FROM in_crypto_ranks GROUP BY ALL HAVING cnt > 1",
    "dq_incremental_orphans": """SELECT exchange_id, count(*) AS cnt FROM fact_exchange_assets a
        WHERE NOT EXISTS (FROM dim_exchange_id d WHERE d.exchange_id = a.exchange_id) GROUP BY exchange_id""",
    "step_repairs": _REPAIRS["repair_exchange_map"],
    "step_backlog": flat("crypto_category_link")
    + " WHERE category_id IN (SELECT category_id FROM dim_crypto_category) AND crypto_id IN (SELECT crypto_id FROM dim_crypto_id)",
    "load_after_compact": flat("fact_market_sentiment"),
    "load_drop_counts": """SELECT 'fact_exchange_assets' AS table_name, count(*) FILTER (coin AND venue) AS rows,
        count(*) FILTER (NOT coin) AS crypto_id, count(*) FILTER (coin AND NOT venue) AS exchange_id
        FROM (SELECT crypto_id IN (SELECT crypto_id FROM dim_crypto_id WHERE crypto_id IS NOT NULL) AS coin,
                     exchange_id IN (SELECT exchange_id FROM dim_exchange_id WHERE exchange_id IS NOT NULL) AS venue
              FROM fact_exchange_assets)""",
}

_PARSING = {
    "parse_exchange_map": "SELECT s_suppkey AS id, s_name AS name, lower(s_name) AS slug, CAST(s_acctbal > 0 AS BIGINT) AS is_active FROM supplier",
    "parse_exchange_info": f"""SELECT s_suppkey AS id, s_name AS name, {_nulls('slug description date_launched notice logo', NULL_TEXT)},
        CAST(s_nationkey * 1000 AS DOUBLE) AS weekly_visits, s_acctbal AS spot_volume_usd,
        CASE WHEN s_nationkey <> 1 THEN CAST(0.25 AS DOUBLE) END AS maker_fee, {NULL_NUM} AS taker_fee,
        CASE WHEN s_nationkey > 5 THEN 'https://' || s_name END AS urls,
        CASE WHEN s_nationkey > 10 THEN 'USD, EUR' ELSE '' END AS fiats FROM supplier""",
    "parse_exchange_assets": f"""SELECT l_suppkey AS exchange_id, 'w' || l_orderkey AS wallet_address, l_quantity AS balance,
        CASE WHEN l_linestatus = 'O' THEN CAST(l_linenumber AS BIGINT) END AS platform_crypto_id,
        CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS platform_symbol, {NULL_TEXT} AS platform_name,
        CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS currency_crypto_id, {_nulls('currency_symbol currency_name', NULL_TEXT)},
        CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS currency_price_usd FROM lineitem""",
    "parse_crypto_map": f"""SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS rank, p_name AS name, p_brand AS symbol,
        {NULL_LONG} AS is_active, {_nulls('first_historical_data last_historical_data', NULL_TEXT)},
        CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) END AS platform_id, CASE WHEN p_size > 10 THEN p_type END AS platform_name,
        {_nulls('platform_symbol platform_slug', NULL_TEXT)}, CASE WHEN p_size > 10 THEN p_brand END AS platform_token_address FROM part""",
    "parse_crypto_info": f"""SELECT p_partkey AS id, p_name AS name, p_brand AS slug, p_type AS category,
        {_nulls('symbol logo description date_added date_launched technical_doc twitter reddit explorer source_code', NULL_TEXT)},
        CASE WHEN p_size > 5 THEN p_name END AS website, CASE WHEN p_size > 20 THEN p_type || ',' || p_brand END AS tags FROM part""",
    "parse_listings": f"""SELECT l_partkey AS id, CAST(l_linenumber AS BIGINT) AS cmc_rank, l_linestatus = 'O' AS infinite_supply,
        {_nulls('name symbol slug date_added self_reported_tags last_updated_usd', NULL_TEXT)},
        {_nulls('num_market_pairs circulating_supply total_supply max_supply self_reported_circulating_supply self_reported_market_cap volume_change_24h percent_change_1h_usd percent_change_24h_usd percent_change_7d_usd market_cap_dominance_usd fully_diluted_market_cap_usd', NULL_NUM)},
        CASE WHEN l_returnflag = 'A' THEN 'x,y' END AS tags,
        CASE WHEN l_returnflag = 'N' THEN CAST(l_suppkey AS DOUBLE) END AS platform_id,
        CASE WHEN l_returnflag <> 'R' AND l_tax <> CAST(0.08 AS DOUBLE) THEN l_extendedprice END AS price_usd,
        CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS volume_24h_usd,
        CASE WHEN l_returnflag <> 'R' THEN l_discount END AS market_cap_usd FROM lineitem""",
    "parse_categories": f"""SELECT p_type || '/' || p_brand AS category_id, p_name AS name, {_nulls('title description last_updated', NULL_TEXT)},
        CASE WHEN p_size <> 3 THEN CAST(p_size AS DOUBLE) END AS num_tokens, p_retailprice AS market_cap,
        {_nulls('avg_price_change market_cap_change volume volume_change', NULL_NUM)} FROM part WHERE p_size <> 50""",
    "parse_category_links": "SELECT p_partkey AS crypto_id, p_type AS category_id FROM part WHERE p_size BETWEEN 3 AND 48",
    "parse_global_metrics": """SELECT * EXCLUDE (kept) REPLACE ('2024-03-01' AS date_snapshot,
        CASE WHEN kept THEN tracked_maxIncrementalNumber END AS tracked_maxIncrementalNumber,
        CASE WHEN kept THEN tracked_maxIncrementalDate END AS tracked_maxIncrementalDate,
        CASE WHEN kept THEN tracked_minIncrementalNumber END AS tracked_minIncrementalNumber,
        CASE WHEN kept THEN tracked_minIncrementalDate END AS tracked_minIncrementalDate)
        FROM (SELECT *, tracked_minIncrementalDate <> 'soon' AS kept FROM in_global)""",
    "parse_sentiment": f"""SELECT event_id AS value, event_type AS value_classification,
        CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS timestamp, {NULL_TEXT} AS update_time
        FROM events JOIN (VALUES (1), (2)) v(copy) ON copy = 1 OR event_type = 'view'""",
    "parse_event_properties": "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events",
    "parse_malformed_count": "SELECT count(*) AS valid, 3 * count(*) AS invalid FROM supplier",
    "parse_payload_counts": """SELECT count(*) AS payloads, count(*) FILTER (cut) AS damaged, count(*) FILTER (NOT cut) AS valid,
        3 * count(*) FILTER (NOT cut) AS invalid
        FROM (SELECT contains('"id":' || s_suppkey || ',', '5,') AS cut FROM supplier)""",
    "parse_rejects": """WITH bodies AS (SELECT s_name, '{"status":{"error_code":0},"data":[{"id":' || s_suppkey || ',"name":"' || s_name
            || '","slug":"' || lower(s_name) || '","is_active":' || (s_acctbal > 0)::INT || '},"junk",7,null]}' AS body FROM supplier)
        SELECT 'record' AS reason, s_name AS piece, CAST(NULL AS VARCHAR) AS fetched_at FROM bodies WHERE NOT contains(body, '5,')
        UNION ALL SELECT 'damaged', left(body, length(body) - 9), '2024-03-01T00:00:00+00:00' FROM bodies WHERE contains(body, '5,')
        UNION ALL SELECT 'not an object', unnest(['junk', '7', NULL]), '2024-03-01T00:00:00+00:00' FROM bodies WHERE NOT contains(body, '5,')""",
    "parse_numeric_coercion": "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events",
    "parse_completeness": """SELECT id, CAST(14 - missing AS INTEGER) AS non_null_fields, CAST(missing AS INTEGER) AS null_fields
        FROM (SELECT id, (tags IS NULL)::INT + (logo IS NULL)::INT + (website IS NULL)::INT + (technical_doc IS NULL)::INT
              + (explorer IS NULL)::INT + (source_code IS NULL)::INT AS missing FROM in_crypto_info)""",
    "parse_stamped_rows": """SELECT l_orderkey, l_partkey, l_linenumber, '2024-03-01T00:00:00+00:00' AS date_snapshot,
        CAST(l_linenumber - 1 AS BIGINT) AS batch_index FROM lineitem""",
    "parse_request_chunks": """SELECT chunk_id, count(*) AS id_count, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS id_list
        FROM (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 200 + 1 AS chunk_id FROM (SELECT DISTINCT p_partkey AS id FROM part))
        GROUP BY chunk_id""",
    "parse_file_batches": """SELECT (chunk - 1) // 5 + 1 AS file_id, count(*) AS row_count, min(o_orderkey) AS first_key,
        max(o_orderkey) AS last_key, max(chunk) AS last_chunk
        FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 200 + 1 AS chunk FROM orders) GROUP BY file_id""",
    "parse_history_span": """SELECT count(*) AS records_fetched, CAST(CAST(epoch(min(hour_start)) AS BIGINT) AS VARCHAR) AS first_timestamp,
        CAST(CAST(epoch(max(hour_start)) AS BIGINT) AS VARCHAR) AS last_timestamp,
        strftime(min(hour_start), '%Y-%m-%d') AS first_date_utc, strftime(max(hour_start), '%Y-%m-%d') AS last_date_utc FROM in_sentiment""",
    "parse_then_build_market": f"""SELECT CAST(id AS INTEGER) AS crypto_id, TIMESTAMP '2024-03-01 00:00:00' AS {AT},
        CAST(rank AS INTEGER) AS cmc_rank, price AS price_usd, CASE WHEN cap <> 0 THEN volume / cap ELSE 0 END AS volume_to_market_cap_ratio
        FROM (SELECT l_partkey AS id, l_linenumber AS rank, CASE WHEN l_returnflag = 'N' THEN l_suppkey END AS platform,
                     CASE WHEN l_returnflag <> 'R' AND l_tax <> CAST(0.08 AS DOUBLE) THEN l_extendedprice END AS price,
                     CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS volume,
                     CASE WHEN l_returnflag <> 'R' THEN l_discount END AS cap FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank NULLS LAST, platform NULLS LAST, price NULLS LAST,
                                   volume NULLS LAST, cap NULLS LAST) = 1""",
}


_BEFORE = "SELECT o_custkey AS id FROM orders WHERE o_orderdate < '1993-01-01'"
_FROM = "SELECT o_custkey AS id FROM orders WHERE o_orderdate >= '1993-01-01'"


_CHANGES = f"""SELECT id, 'added' AS change FROM ({_FROM} EXCEPT {_BEFORE})
    UNION ALL SELECT id, 'removed' AS change FROM ({_BEFORE} EXCEPT {_FROM})"""
_RESPONDED = "SELECT o_custkey AS id FROM orders WHERE o_orderdate >= '1993-01-01' AND o_totalprice > 250000"


def _fresh(newer: str) -> str:
    return f"""SELECT table_id, snapshot_ts, last_ended_at, coalesce({newer}, TRUE) AS should_transform
        FROM (SELECT o_custkey AS table_id, max(o_orderdate) + INTERVAL 9 HOUR AS snapshot_ts FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL
              UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_mktsegment = 'MACHINERY')
        LEFT JOIN (SELECT o_custkey AS table_id, max(o_orderdate) + INTERVAL 6 HOUR AS last_ended_at FROM orders WHERE o_orderstatus <> 'O' GROUP BY ALL)
        USING (table_id)"""


_PLANNING = {
    "plan_key_changes": _CHANGES,
    "plan_change_summary": f"SELECT added, removed, added + removed > 0 AS changed FROM (SELECT count(*) FILTER (change = 'added') AS added, count(*) FILTER (change = 'removed') AS removed FROM ({_CHANGES}))",
    "plan_ids_to_fetch": f"SELECT c_custkey AS id FROM customer EXCEPT {_BEFORE}",
    "plan_categories_to_fetch": "SELECT category_id FROM in_category_links EXCEPT SELECT category_id FROM in_categories",
    "plan_active_set_full": f"SELECT c_custkey AS id FROM customer INTERSECT {_RESPONDED}",
    "plan_active_set_partial": f"{_BEFORE} EXCEPT ({_FROM} EXCEPT {_RESPONDED})",
    "plan_reconcile": f"""SELECT *, expected_count <> parsed_count AS needs_refresh FROM (SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS expected_count,
        (SELECT count(DISTINCT id) FROM ({_BEFORE})) AS parsed_count,
        (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT {_BEFORE})) AS missing_count)""",
    "plan_freshness": _fresh("CAST(snapshot_ts AS DATE) > CAST(last_ended_at AS DATE)"),
    "plan_freshness_exact": _fresh("snapshot_ts > last_ended_at"),
    "plan_load_decisions": """SELECT table_id, CASE WHEN l.loaded IS NULL THEN TRUE WHEN t.done IS NULL THEN FALSE
               ELSE t.status = 'success' AND t.done <> l.source END AS should_load
        FROM (SELECT o_custkey AS table_id, date_trunc('year', o_orderdate) AS done, CASE WHEN o_orderstatus = 'P' THEN 'skipped' ELSE 'success' END AS status
              FROM orders WHERE o_orderpriority < '4'
              QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY done DESC, status DESC) = 1) t
        FULL JOIN (SELECT o_custkey AS table_id, o_orderdate AS loaded, date_trunc('year', o_orderdate) AS source
              FROM orders WHERE o_orderpriority >= '4'
              QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY loaded DESC) = 1) l USING (table_id)""",
    "plan_last_entries": """SELECT o_custkey AS table_id, o_orderdate AS ended_at, o_orderkey AS run_id, o_orderstatus AS status FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC) = 1""",
    "plan_not_initialised": "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'",
    "plan_loaded_category_ids": "SELECT category_id, count(*) AS links FROM in_category_links GROUP BY category_id",
    "plan_frame_profile": "SELECT count(*) AS row_count, 'struct<o_orderkey:bigint,o_totalprice:double>' AS schema_text FROM orders",
}

_STATES = """o AS (SELECT o_custkey AS id, o_totalprice > 250000 AS has_data, year(o_orderdate) % 3 AS part FROM orders),
    s1 AS (SELECT DISTINCT id, TRUE AS listed, FALSE AS active, TRUE AS asked, 'added' AS change, '2024-03-01' AS first_seen,
                  CAST(NULL AS VARCHAR) AS removed_at FROM o WHERE part = 0),
    j2 AS (SELECT id, s1.id IS NOT NULL AS was, a.id IS NOT NULL AS listed,
                  s1.id IS NOT NULL AND id IN (SELECT id FROM o WHERE part = 0 AND has_data) AS active
           FROM s1 FULL JOIN (SELECT DISTINCT id FROM o WHERE part = 1) a USING (id)),
    s2 AS (SELECT id, listed, active, listed AND (active OR NOT was) AS asked,
                  CASE WHEN listed AND NOT was THEN 'added' WHEN was AND NOT listed THEN 'removed' END AS change,
                  CASE WHEN was THEN '2024-03-01' ELSE '2024-03-11' END AS first_seen,
                  CASE WHEN NOT listed THEN '2024-03-11' END AS removed_at FROM j2),
    s3 AS (SELECT id, a.id IS NOT NULL AS listed,
                  CASE WHEN s2.asked THEN id IN (SELECT id FROM o WHERE part = 1 AND has_data) ELSE coalesce(s2.active, FALSE) END AS active,
                  a.id IS NOT NULL AS asked,
                  CASE WHEN a.id IS NOT NULL AND s2.listed IS NOT TRUE THEN 'added' WHEN a.id IS NULL AND s2.listed THEN 'removed' END AS change,
                  coalesce(s2.first_seen, '2024-04-05') AS first_seen,
                  CASE WHEN a.id IS NULL THEN coalesce(s2.removed_at, '2024-04-05') END AS removed_at
           FROM s2 FULL JOIN (SELECT DISTINCT id FROM o WHERE part = 2) a USING (id))"""

_PLANNING |= {
    "plan_state_step": f"WITH {_STATES} SELECT * FROM s3",
    "plan_state_requests": f"""WITH {_STATES}, asked AS (SELECT 1 AS day_number, id FROM s1 WHERE asked UNION ALL SELECT 2, id FROM s2 WHERE asked
            UNION ALL SELECT 3, id FROM s3 WHERE asked),
        placed AS (SELECT *, (row_number() OVER (PARTITION BY day_number ORDER BY id) - 1) // 200 + 1 AS chunk_id FROM asked)
        SELECT CAST(day_number AS BIGINT) AS day_number, chunk_id, count(*) AS id_count, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS id_list
        FROM placed GROUP BY ALL""",
}

_PARTS = "regexp_split_to_array(trim(fiats), ',\\s*')"

_CLEANING = {
    "clean_rename_select": "SELECT c_custkey AS holder_id, c_acctbal AS balance, c_mktsegment AS segment FROM customer",
    "clean_narrowing": """SELECT l_orderkey, TRY_CAST(trunc(l_extendedprice * 50000) AS INTEGER) AS scaled_price,
        TRY_CAST(l_partkey * 4000000 AS INTEGER) AS scaled_key FROM lineitem""",
    "clean_longs_to_ints": "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice FROM orders",
    "clean_required_keys": "SELECT * FROM in_exchange_assets WHERE wallet_address IS NOT NULL AND balance IS NOT NULL",
    "clean_keep_first": """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey,
        l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "clean_latest_per_supplier": """SELECT l_suppkey, l_shipdate, l_extendedprice, l_partkey FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC) = 1""",
    "clean_times": """SELECT id, taken, strftime(taken, '%Y-%m-%d %H:%M:%S') AS taken_text, strftime(taken, '%Y-%m-%d') AS taken_day, updated_day
        FROM (SELECT id, CAST(TRY_CAST(date_snapshot AS TIMESTAMPTZ) AS TIMESTAMP) AS taken, left(last_updated_usd, 10) AS updated_day FROM in_listings)""",
    "clean_epoch_text": "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS at FROM events",
    "clean_split_lists": f"""SELECT id, date_snapshot, array_to_string({_PARTS}, '|') AS parts, CAST(len({_PARTS}) AS INTEGER) AS part_count,
        CAST(CASE WHEN fiats = '' THEN 0 ELSE len({_PARTS}) END AS INTEGER) AS filled_count, {_PARTS}[1] AS first_part, slug AS slug_parts
        FROM in_exchange_info""",
    "clean_typed_null": f"SELECT n_nationkey, {NULL_NUM} AS spot_volume_usd FROM nation",
    "clean_union_missing_columns": """SELECT c_name AS name, c_acctbal AS balance, CAST(NULL AS INTEGER) AS nation FROM customer
        UNION ALL SELECT s_name, NULL, s_nationkey FROM supplier""",
    "clean_two_projections": f"""SELECT 'dimension' AS part, count(DISTINCT category_id) AS row_count FROM in_categories
        UNION ALL SELECT 'metrics', count(DISTINCT (category_id, date_snapshot)) FROM in_categories WHERE category_id IS NOT NULL""",
    "kpi_guards": """SELECT id, batch_index, last_updated_usd, CASE WHEN market_cap_usd <> 0 THEN volume_24h_usd / market_cap_usd ELSE 0 END AS ratio,
        CASE WHEN abs(market_cap_usd) > 500 THEN volume_24h_usd / market_cap_usd ELSE 0 END AS ratio_eps,
        CASE WHEN max_supply <> 0 AND total_supply IS NOT NULL THEN price_usd / max_supply END AS ratio_null,
        coalesce(total_supply - max_supply, 0) AS difference, price_usd * volume_24h_usd AS product, ratio <> 0 AS check_ratio FROM in_listings""",
    "kpi_delay_seconds": "SELECT event_id, CAST(epoch_us(ts) - epoch_us(date_trunc('hour', ts)) AS DOUBLE) / 1e6 AS delay_seconds FROM events",
}

_TICKS = """SELECT l_suppkey, l_shipdate AS seen_at, CASE WHEN l_returnflag = 'A' THEN l_extendedprice END AS price,
    CASE WHEN l_linestatus = 'O' THEN l_discount END AS discount, CASE WHEN l_linenumber < 6 THEN l_tax END AS tax FROM lineitem"""


def _asof(known: str, order: str, shown: str) -> str:
    columns = ", ".join(f"p.{n} AS prev_{n}" for n in shown.split())
    return f"""SELECT t.l_suppkey, t.seen_at, p.seen_at AS prev_seen_at, {columns} FROM (SELECT DISTINCT l_suppkey, seen_at FROM ({_TICKS})) t
        ASOF LEFT JOIN (SELECT * FROM ({_TICKS}) WHERE {known}
                        QUALIFY row_number() OVER (PARTITION BY l_suppkey, seen_at ORDER BY {order}) = 1) p
        ON t.l_suppkey = p.l_suppkey AND t.seen_at > p.seen_at"""


_JOINS = {
    "join_enrich": f"SELECT exchange_id, {AT}, is_active FROM dim_exchange_map",
    "join_enforce_fks": f"""SELECT exchange_id, crypto_id, {AT}, wallet_address FROM fact_exchange_assets
        WHERE crypto_id IN (SELECT crypto_id FROM dim_crypto_id) AND exchange_id IN (SELECT exchange_id FROM dim_exchange_id)""",
    "join_new_composite_keys": f"""SELECT crypto_id, {AT}, rank FROM dim_crypto_map m
        WHERE NOT EXISTS (FROM fact_crypto_market f WHERE f.infinite_supply AND f.crypto_id = m.crypto_id AND f.{AT} = m.{AT})""",
    "join_orphan_rows": "SELECT crypto_id, wallet_address FROM fact_exchange_assets a WHERE NOT EXISTS (FROM dim_crypto_id d WHERE d.crypto_id = a.crypto_id)",
    "join_orphan_keys": "SELECT crypto_id FROM fact_exchange_assets EXCEPT SELECT crypto_id FROM dim_crypto_id",
    "join_asof_last_known": _asof("price IS NOT NULL", "price DESC", "price"),
    "join_asof_last_tuple": _asof(
        "price + discount + tax IS NOT NULL", "price DESC, discount DESC, tax DESC", "price discount tax"
    ),
    "join_asof_fill": f"""SELECT t.l_suppkey, t.seen_at, coalesce(t.price, p.price) AS price
        FROM (SELECT l_suppkey, seen_at, max(price) AS price FROM ({_TICKS}) GROUP BY ALL) t
        ASOF LEFT JOIN (SELECT l_suppkey, seen_at, max(price) AS price FROM ({_TICKS}) WHERE price IS NOT NULL GROUP BY ALL) p
        ON t.l_suppkey = p.l_suppkey AND t.seen_at > p.seen_at""",
    "join_update_from": """SELECT p_partkey, p_size, CASE WHEN p_size < 20 THEN coalesce(price, p_retailprice) ELSE p_retailprice END AS p_retailprice
        FROM part LEFT JOIN (SELECT l_partkey, max(l_extendedprice) AS price FROM lineitem GROUP BY ALL) ON l_partkey = p_partkey""",
    "window_rank": "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS quantity_rank FROM lineitem",
    "window_row_number": "SELECT o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders",
    "window_top_n": "SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders QUALIFY place <= 3",
    "window_runs": """SELECT state, min(day) AS run_start, max(day) AS run_end, count(*) AS run_length
        FROM (SELECT day, state, row_number() OVER (ORDER BY day) - row_number() OVER (PARTITION BY state ORDER BY day) AS island
              FROM (SELECT o_orderdate AS day, CASE WHEN sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE -1 END) > 0
                           THEN 'mostly F' ELSE 'mostly not F' END AS state FROM orders GROUP BY o_orderdate)) GROUP BY state, island""",
    "set_difference": "SELECT p_partkey AS id FROM part EXCEPT SELECT crypto_id FROM dim_crypto_id",
}

_SNAPSHOTS = """SELECT DISTINCT 'listings_batch' || l_linenumber AS name, strftime(l_shipdate, '%Y') || '-01-01_06-00-00' AS suffix,
    date_trunc('year', l_shipdate) + INTERVAL 6 HOUR AS snapshot_ts FROM lineitem"""

_PRICES = f"""SELECT crypto_id, name, {AT}, price_usd, percent_change_24h_usd, percent_change_7d_usd
    FROM fact_crypto_market JOIN dim_crypto_id USING (crypto_id) WHERE price_usd IS NOT NULL"""

_SOURCES = {
    "source_strict_read": f"SELECT o_orderkey, o_totalprice, {NULL_NUM} AS o_discount FROM orders",
    "source_list_snapshots": _SNAPSHOTS,
    "source_latest_snapshots": f"SELECT name, suffix FROM ({_SNAPSHOTS}) ORDER BY suffix DESC, name DESC LIMIT 3",
    "source_numbered_latest": f"SELECT name, suffix, row_number() OVER (PARTITION BY name ORDER BY suffix DESC) AS age FROM ({_SNAPSHOTS}) QUALIFY age <= 2",
    "source_batches": f"SELECT suffix, snapshot_ts, count(*) AS members, members >= 5 AS is_complete FROM ({_SNAPSHOTS}) GROUP BY suffix, snapshot_ts",
    "source_read_latest_batch": """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
        WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem)""",
    "source_column_read": "SELECT crypto_id FROM dim_crypto_id",
    "source_time_travel": """SELECT o_orderkey, o_orderstatus, o_totalprice, 'latest' AS which FROM orders
        UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'first' FROM orders WHERE o_orderstatus = 'F'""",
    "source_partition_pruning": f"""SELECT 'days' AS way, p.* FROM ({_PRICES}) p WHERE quarter({AT}) = 4
        UNION ALL SELECT 'bounds', p.* FROM ({_PRICES}) p
        WHERE {AT} >= TIMESTAMP '1997-04-01 06:00:00' AND {AT} < TIMESTAMP '1998-04-01 06:00:00'""",
    "source_compact": "SELECT p_partkey, p_size FROM part",
    "source_append": "SELECT o_orderkey, o_orderpriority FROM orders",
    "source_snapshot_write": "SELECT s_suppkey, s_name, '2024-03-01_08-30-00' AS suffix FROM supplier",
    "source_csv_export": "SELECT *, c_mktsegment || '|a \"b\", c' AS tags FROM customer",
    "view_ordered_position": f"""SELECT category_id, {AT}, row_number() OVER (ORDER BY category_id, {AT} DESC) AS position
        FROM fact_crypto_category JOIN dim_crypto_category USING (category_id) WHERE dominance_per_token IS NOT NULL""",
    "dq_raw_global_07_duplicate_time": f"SELECT o_orderdate + INTERVAL 12 HOUR AS {AT}, count(*) AS cnt FROM orders GROUP BY ALL HAVING cnt > 1",
    "dq_raw_malformed_dates": """SELECT id AS crypto_id, date_added, date_launched FROM in_crypto_info
        WHERE NOT regexp_full_match(date_added, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
           OR NOT regexp_full_match(date_launched, '[0-9]{4}-[0-9]{2}-[0-9]{2}')""",
    "dq_raw_crypto_02_duplicate_id": "SELECT id AS crypto_id, count(*) AS cnt FROM in_crypto_map GROUP BY id HAVING cnt > 1",
    "dq_raw_crypto_06_duplicate_map_key": f"SELECT id AS crypto_id, {_moment()} AS {AT}, count(*) AS cnt FROM in_crypto_ranks GROUP BY ALL HAVING cnt > 1",
    "dq_raw_exchange_02_duplicate_asset_key": f"""SELECT exchange_id, wallet_address, currency_crypto_id AS crypto_id, {_moment()} AS {AT},
        count(*) AS cnt FROM in_exchange_assets GROUP BY ALL HAVING cnt > 1""",
    "dq_raw_exchange_05_duplicate_map_key": f"SELECT id AS exchange_id, {_moment()} AS {AT}, count(*) AS cnt FROM in_exchange_info GROUP BY ALL HAVING cnt > 1",
    "dq_raw_sentiment_04_duplicate_time": f"SELECT CAST(hour_start AS TIMESTAMP) AS {AT}, count(*) AS cnt FROM in_sentiment GROUP BY ALL HAVING cnt > 1",
    "source_payload_replay": _PARSING["parse_crypto_map"],
    "stream_ingest": "SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem",
    "stream_publish_new_keys": "SELECT DISTINCT l_partkey, CAST(1 AS BIGINT) AS times FROM lineitem",
    "stream_publish_state": "SELECT DISTINCT l_partkey, CAST(1 AS BIGINT) AS times FROM lineitem",
    # an event comes through if one of its arrivals is newer than all that came two files before, less ten days
    "stream_dedupe_watermark": """WITH sent AS (SELECT event_id, ts, event_type,
            date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 5 + unnest(CASE event_type WHEN 'click' THEN [0, 1]
                WHEN 'error' THEN [1] WHEN 'purchase' THEN [4] ELSE [0] END) AS arrival FROM events),
        newest AS (SELECT arrival, date_trunc('milliseconds', max(max(ts)) OVER (ORDER BY arrival RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING))
            - INTERVAL 10 DAY AS watermark FROM sent GROUP BY arrival)
        SELECT DISTINCT event_id, ts, event_type FROM sent JOIN newest USING (arrival) WHERE watermark IS NULL OR ts > watermark""",
    "stream_publish_fact": "SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_partkey IN (SELECT crypto_id FROM dim_crypto_id)",
    "stream_dedupe_snapshots": "SELECT DISTINCT l_partkey, l_linenumber FROM lineitem",
}


def texts() -> dict[str, str]:
    sliced = ("join_asof_last_tuple", "window_rank", "window_row_number", "window_runs")
    helpers = {"exchange_measures", "wallets"}
    found = {f"build_{t}": flat(t) for t in TABLES if t not in helpers}
    found |= {f"load_{t}": _load(t) for t in TABLES if t not in helpers}
    for group in (_BUILDS, _REPAIRS, _STEPS, _PARSING, _PLANNING, _CLEANING, _JOINS, _SOURCES):
        found |= group
    found |= {f"{name}_sliced": found[name] for name in sliced}
    return {name: sql(text) for name, text in found.items()}
