"""Bronze inputs derived from the verification tables.

Each text is one SELECT that Spark and DuckDB both run. A `{name}` is another input or
a verification table. Rules: some dimension members have other ids than the facts, so that
foreign-key orphans exist; calendar parts and attributes decide which values are missing; sums run
in DECIMAL and averaged values are whole numbers or have power-of-two denominators, so
that no result depends on summation order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.ordered import materialize
from tidemark.session import pin

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

INPUTS: dict[str, str] = {
    "in_crypto_map": """
        SELECT CASE WHEN p_size = 50 AND p_type = 'SMALL' THEN NULL WHEN p_size > 45 THEN -p_partkey ELSE p_partkey END AS id, p_name AS name,
               CASE WHEN p_size = 13 THEN NULL ELSE p_brand END AS symbol,
               CAST(p_size AS DOUBLE) AS platform_id, p_type AS platform_name,
               CASE WHEN p_size > 30 THEN NULL ELSE p_type END AS platform_symbol,
               'addr-' || CAST(p_partkey AS STRING) AS platform_token_address
        FROM {part}
        UNION ALL
        SELECT p_partkey AS id, p_name || ' token' AS name, p_brand AS symbol,
               CAST(p_size AS DOUBLE) + 0.5e0 AS platform_id, p_type AS platform_name,
               NULL AS platform_symbol, NULL AS platform_token_address
        FROM {part} WHERE p_size <= 12""",
    "in_crypto_ranks": """
        SELECT l_partkey AS id,
               CASE WHEN l_tax = 0.05e0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS rank,
               CASE l_returnflag WHEN 'R' THEN NULL WHEN 'A' THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS is_active,
               CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T01:02:03+00:00'
                    ELSE 'pending' END AS last_historical_data,
               CASE WHEN l_discount = 0.1e0 AND l_tax = 0.0e0 THEN 'not a time'
                    ELSE CAST(CAST(date_trunc('quarter', l_shipdate) AS DATE) AS STRING) || 'T06:00:00+00:00' END AS date_snapshot
        FROM {lineitem}""",
    "in_crypto_info": """
        SELECT p_partkey AS id, lower(replace(p_name, ' ', '-')) AS slug, p_type AS category,
               CASE WHEN p_size = 9 THEN NULL ELSE p_type || ',' || p_brand END AS tags,
               p_name || ' by ' || p_brand AS description,
               CASE WHEN p_size <= 28 THEN '2014-02-' || lpad(CAST(p_size AS STRING), 2, '0') ELSE 'unknown' END AS date_launched,
               '2019-' || CASE WHEN p_size <= 12 THEN lpad(CAST(p_size AS STRING), 2, '0') ELSE '12' END || '-15' AS date_added,
               CASE WHEN p_size = 7 THEN NULL ELSE 'https://logo.example/' || CAST(p_partkey AS STRING) END AS logo,
               CASE WHEN p_brand = 'Brand#3' THEN NULL ELSE 'https://coin.example/' || CAST(p_partkey AS STRING) END AS website,
               CASE WHEN p_size > 40 THEN NULL ELSE 'https://doc.example/' || p_type END AS technical_doc,
               'https://social.example/' || p_brand AS twitter,
               CASE WHEN p_size > 25 THEN 'https://scan.example' END AS explorer,
               CASE WHEN p_size > 35 THEN 'https://code.example' END AS source_code,
               '2024-03-0' || CASE WHEN p_size > 20 THEN '1' ELSE '2' END || 'T08:30:00+00:00' AS date_snapshot
        FROM {part}""",
    "in_listings": """
        SELECT l_partkey AS id,
               CASE WHEN l_tax = 0.02e0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) * 10 END AS cmc_rank,
               CAST(l_linenumber AS DOUBLE) * 3.0e0 AS num_market_pairs,
               l_quantity AS circulating_supply,
               CASE WHEN l_tax = 0.0e0 THEN NULL ELSE l_quantity * (1.0e0 + l_tax) END AS total_supply,
               CASE l_returnflag WHEN 'R' THEN 0.0e0 WHEN 'A' THEN 25.0e0 ELSE NULL END AS max_supply,
               l_linestatus = 'O' AS infinite_supply,
               CASE WHEN l_discount > 0.05e0 THEN l_quantity ELSE NULL END AS self_reported_circulating_supply,
               l_extendedprice * l_tax AS self_reported_market_cap,
               CAST(l_suppkey AS DOUBLE) AS platform_id,
               CASE WHEN l_linenumber = 6 THEN NULL ELSE l_extendedprice / l_quantity END AS price_usd,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS volume_24h_usd,
               l_tax * 100.0e0 AS volume_change_24h,
               l_discount - l_tax AS percent_change_1h_usd,
               l_discount AS percent_change_24h_usd,
               l_tax AS percent_change_7d_usd,
               CASE WHEN l_discount = 0.0e0 THEN 0.0e0 WHEN l_linenumber = 5 THEN NULL ELSE l_extendedprice * l_discount END AS market_cap_usd,
               l_discount * 10.0e0 AS market_cap_dominance_usd,
               CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice * (1.0e0 + l_tax) END AS fully_diluted_market_cap_usd,
               CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T10:20:30+00:00' AS last_updated_usd,
               CASE WHEN l_discount = 0.1e0 AND l_tax = 0.0e0 THEN 'not a time'
                    ELSE CAST(CAST(date_trunc('quarter', l_shipdate) AS DATE) AS STRING) || 'T06:00:00+00:00' END AS date_snapshot,
               CAST(l_linenumber AS BIGINT) AS batch_index
        FROM {lineitem}""",
    "in_categories": """
        SELECT CASE WHEN p_brand = 'Brand#9' THEN NULL ELSE p_type || '/' || p_brand END AS category_id,
               MIN(p_name) AS name,
               CASE WHEN p_brand = 'Brand#8' THEN NULL ELSE MAX(p_name) END AS title,
               p_type AS description,
               CASE WHEN EXTRACT(MONTH FROM l_shipdate) = 4 THEN NULL ELSE CAST(COUNT(DISTINCT l_partkey) AS DOUBLE) END AS num_tokens,
               CAST(MIN(CAST(l_tax AS DECIMAL(18,2))) - MAX(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) * 1000.0e0 AS avg_price_change,
               CASE WHEN EXTRACT(MONTH FROM l_shipdate) = 5 THEN NULL WHEN EXTRACT(MONTH FROM l_shipdate) = 6 THEN 0.0e0
                    ELSE CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) END AS market_cap,
               CAST(MAX(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS market_cap_change,
               CASE WHEN EXTRACT(MONTH FROM l_shipdate) = 7 THEN CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) * 16.0e0
                    ELSE CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) END AS volume,
               CAST(MIN(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume_change,
               CAST(MAX(CAST(l_shipdate AS DATE)) AS STRING) || 'T00:30:00+00:00' AS last_updated,
               CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS STRING) || 'T09:00:00+00:00' AS date_snapshot
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        GROUP BY p_type, p_brand, l_linestatus, date_trunc('month', l_shipdate), EXTRACT(MONTH FROM l_shipdate)""",
    "in_category_links": """
        SELECT p_partkey AS crypto_id, p_type || '/' || p_brand AS category_id FROM {part}
        UNION ALL
        SELECT p_partkey AS crypto_id, p_type || '/' || p_brand AS category_id FROM {part} WHERE p_size > 25
        UNION ALL
        SELECT p_partkey AS crypto_id, p_type AS category_id FROM {part} WHERE p_size > 40""",
    "in_exchange_map": """
        SELECT CASE WHEN s_nationkey = 7 THEN -s_suppkey ELSE s_suppkey END AS id, CASE WHEN s_nationkey = 3 THEN NULL ELSE s_name END AS name,
               CASE WHEN s_acctbal < 1000.0e0 THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS is_active
        FROM {supplier}
        UNION ALL
        SELECT s_suppkey AS id, s_name || ' (old)' AS name, CAST(0 AS BIGINT) AS is_active
        FROM {supplier} WHERE s_nationkey BETWEEN 10 AND 15""",
    "in_exchange_info": """
        SELECT l_suppkey AS id, 'exchange-' || CAST(l_suppkey AS STRING) AS slug,
               CASE WHEN MAX(l_linenumber) = 3 THEN NULL ELSE MIN(l_returnflag) || ' venue' END AS description,
               CAST(MIN(CAST(l_shipdate AS DATE)) AS STRING) || 'T00:00:00+00:00' AS date_launched,
               CASE WHEN COUNT(*) = 1 THEN NULL ELSE 'https://logo.example/' || MIN(l_returnflag) END AS logo,
               CASE WHEN COUNT(*) = 2 THEN NULL ELSE CAST(COUNT(*) * 30000000 AS DOUBLE) END AS weekly_visits,
               CASE WHEN COUNT(*) IN (1, 4) THEN NULL WHEN COUNT(*) = 6 THEN 0.0e0 WHEN COUNT(*) = 5 THEN 1024.0e0
                    WHEN MAX(l_quantity) > 40.0e0 THEN 4194304.0e0 ELSE 1048576.0e0 END AS spot_volume_usd,
               CASE WHEN COUNT(*) = 2 THEN NULL ELSE CAST(MAX(CAST(l_discount AS DECIMAL(18,2))) * 6 AS DOUBLE) END AS maker_fee,
               CASE WHEN COUNT(*) IN (2, 3) THEN NULL ELSE CAST(MAX(CAST(l_tax AS DECIMAL(18,2))) * 6 AS DOUBLE) END AS taker_fee,
               CASE WHEN MAX(l_discount) < 0.05e0 THEN NULL ELSE 'https://venue.example/' || MAX(l_returnflag) END AS website,
               'https://social.example/' || CAST(l_suppkey AS STRING) AS twitter,
               CASE WHEN MAX(l_linenumber) = 7 THEN 'https://fees.example' END AS fee,
               CASE COUNT(*) WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'USD' ELSE 'USD, EUR,GBP ' END AS fiats,
               CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS STRING) || 'T07:00:00+00:00' AS date_snapshot
        FROM {lineitem}
        GROUP BY l_suppkey, l_linestatus, date_trunc('month', l_shipdate)""",
    "in_exchange_assets": """
        SELECT l_suppkey AS exchange_id,
               CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS STRING) || 'T07:00:00+00:00' AS date_snapshot,
               l_returnflag AS platform_symbol, l_linestatus AS platform_name,
               CASE WHEN l_tax = 0.08e0 AND l_discount = 0.0e0 THEN NULL ELSE 'w' || CAST(l_linenumber AS STRING) END AS wallet_address,
               l_partkey AS currency_crypto_id,
               CASE WHEN l_discount = 0.07e0 THEN NULL ELSE l_quantity END AS balance,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE FLOOR(l_extendedprice) * 1.0e0 END AS currency_price_usd
        FROM {lineitem}""",
    "in_global": """
        SELECT CAST(COUNT(*) AS BIGINT) AS active_cryptocurrencies,
               CASE WHEN EXTRACT(DAY FROM o_orderdate) = 3 THEN NULL WHEN EXTRACT(DAY FROM o_orderdate) = 4 THEN CAST(0 AS BIGINT)
                    ELSE CAST(COUNT(*) AS BIGINT) + 2 END AS total_cryptocurrencies,
               CAST(MAX(o_custkey) AS BIGINT) AS active_market_pairs,
               CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS active_exchanges,
               CAST(COUNT(DISTINCT o_custkey) AS BIGINT) + 5 AS total_exchanges,
               CASE WHEN EXTRACT(DAY FROM o_orderdate) = 8 THEN CAST(9000000000 AS BIGINT) ELSE CAST(COUNT(*) AS BIGINT) END AS total_crypto_dex_currencies,
               CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS today_incremental_crypto_number,
               CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS past_24h_incremental_crypto_number,
               CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS past_7d_incremental_crypto_number,
               CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS past_30d_incremental_crypto_number,
               CAST(MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 5000.0e0 AS eth_dominance,
               CASE WHEN EXTRACT(DAY FROM o_orderdate) = 5 THEN NULL ELSE CAST(MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 4000.0e0 END AS btc_dominance,
               CASE WHEN EXTRACT(DAY FROM o_orderdate) = 6 THEN NULL ELSE CAST(MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 5000.0e0 END AS eth_dominance_yesterday,
               CAST(MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 4000.0e0 AS btc_dominance_yesterday,
               CAST(COUNT(*) AS DOUBLE) / 8.0e0 AS eth_dominance_24h_percentage_change,
               CAST(COUNT(*) AS DOUBLE) / 16.0e0 AS btc_dominance_24h_percentage_change,
               CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) * 4.0e0 AS defi_volume_24h,
               CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS defi_volume_24h_reported,
               CAST(MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS defi_market_cap,
               CAST(COUNT(*) AS DOUBLE) / 4.0e0 AS defi_24h_percentage_change,
               CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS stablecoin_volume_24h,
               CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) * 0.5e0 AS stablecoin_volume_24h_reported,
               CASE WHEN EXTRACT(DAY FROM o_orderdate) = 9 THEN -1.0e0 ELSE 2.0e0 END
                   * CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS stablecoin_market_cap,
               CAST(COUNT(*) AS DOUBLE) / 2.0e0 AS stablecoin_24h_percentage_change,
               CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS derivatives_volume_24h,
               CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) * 0.25e0 AS derivatives_volume_24h_reported,
               CAST(COUNT(*) AS DOUBLE) / 32.0e0 AS derivatives_24h_percentage_change,
               CAST(COUNT(*) AS DOUBLE) / 64.0e0 AS today_change_percent,
               CASE WHEN EXTRACT(DAY FROM o_orderdate) = 10 THEN 1.0e-7 WHEN EXTRACT(DAY FROM o_orderdate) = 11 THEN NULL
                    WHEN EXTRACT(DAY FROM o_orderdate) = 12 THEN -2.0e0 ELSE 1.0e0 END
                   * CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS quote_total_market_cap,
               CASE WHEN EXTRACT(DAY FROM o_orderdate) = 13 THEN NULL WHEN EXTRACT(DAY FROM o_orderdate) = 14 THEN 0.0e0
                    ELSE CAST(MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) END AS quote_total_volume_24h,
               CAST(MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) * 2.0e0 AS quote_total_volume_24h_reported,
               CAST(MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS quote_altcoin_volume_24h,
               CAST(MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) * 2.0e0 AS quote_altcoin_volume_24h_reported,
               CAST(SUM(CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS quote_altcoin_market_cap,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) * 0.5e0 AS quote_total_market_cap_yesterday,
               CAST(MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) * 4.0e0 AS quote_total_volume_24h_yesterday,
               CAST(COUNT(*) AS DOUBLE) / 128.0e0 AS quote_total_market_cap_yesterday_percentage_change,
               CAST(COUNT(*) AS DOUBLE) / 256.0e0 AS quote_total_volume_24h_yesterday_percentage_change,
               CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END) AS BIGINT) AS tracked_maxIncrementalNumber,
               CAST(CAST(MIN(o_orderdate) AS DATE) AS STRING) AS tracked_maxIncrementalDate,
               CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 0 END) AS BIGINT) AS tracked_minIncrementalNumber,
               CASE WHEN EXTRACT(DAY FROM o_orderdate) = 15 THEN 'soon' ELSE '2016-02-29' END AS tracked_minIncrementalDate,
               CASE WHEN EXTRACT(DAY FROM o_orderdate) = 16 THEN NULL
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || CASE WHEN EXTRACT(DAY FROM o_orderdate) < 20 THEN 'T11:58:30+00:00' ELSE 'T11:50:00+00:00' END END AS last_updated,
               CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T12:00:00+00:00' AS date_snapshot
        FROM {orders} GROUP BY o_orderdate""",
    "in_sentiment": """
        SELECT date_trunc('hour', ts) AS hour_start,
               CASE WHEN EXTRACT(HOUR FROM date_trunc('hour', ts)) = 3 THEN NULL ELSE CAST(FLOOR(MAX(value)) AS BIGINT) - 5 END AS value,
               CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS value_classification
        FROM {events} GROUP BY date_trunc('hour', ts), event_type""",
}

_REFERENCE = re.compile(r"\{(\w+)\}")


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input as a lazy frame."""
    pin(spark)
    text = INPUTS[name]
    if name == "in_categories":
        return _categories(spark, sf_dir, text)
    sources = {
        ref: derive(spark, sf_dir, ref) if ref in INPUTS else scan(spark, sf_dir, ref)
        for ref in set(_REFERENCE.findall(text))
    }
    return spark.sql(text, **sources)


def _categories(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The categories with numbers in place of part names, which are looked up again at the end.

    The numbers follow the order of the names, so MIN and MAX pick the same ones. They let Spark aggregate by
    hash; text in MIN or MAX has it sort all line items by their group, twice.
    """
    parts = scan(spark, sf_dir, "part")
    named = parts.select("p_name").where("p_name IS NOT NULL").distinct().repartitionByRange("p_name")
    # written, so that a name has one number wherever it is read
    names = materialize(named.sortWithinPartitions("p_name").withColumn("nth", F.monotonically_increasing_id()), "names")
    numbered = parts.join(names, "p_name", "left").withColumn("p_name", F.col("nth")).drop("nth")
    found = spark.sql(text, lineitem=scan(spark, sf_dir, "lineitem"), part=numbered)
    columns = found.columns
    for column in ("name", "title"):
        shown = names.select(F.col("nth").alias(column), F.col("p_name").alias(f"_{column}"))
        found = found.join(shown, column, "left").withColumn(column, F.col(f"_{column}"))
    return found.select(*columns)


def plain_sql(name: str) -> str:
    """The same input for an engine where tables and inputs are plain names."""
    return _REFERENCE.sub(r"\1", INPUTS[name])


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input in its bronze form: nested links and epoch text are added here, because
    their SQL differs between engines."""
    df = derive(spark, sf_dir, name)
    if name == "in_exchange_info":
        links = [F.when(F.col(n).isNotNull(), F.array(n)).alias(n) for n in ("fee", "twitter", "website")]
        urls = F.struct(F.array().cast("array<string>").alias("blog"), *links)
        return df.withColumn("urls", urls).drop("fee", "twitter", "website")
    if name == "in_sentiment":
        hour = F.col("hour_start").cast("timestamp")
        return df.select(
            "value",
            "value_classification",
            F.unix_seconds(hour).cast("string").alias("timestamp"),
            F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("update_time"),
        )
    return df
