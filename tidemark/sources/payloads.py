"""JSON payload rows (endpoint, request_id, fetched_at, body) to typed records.

Every parser is one from_json, one explode and one projection. Elements are first
taken as raw text, so that an element that is not an object is told apart and
dropped; leaf fields are read as text and cast with try_cast, so that a bad number
gives NULL and not a lost record.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import first_of, joined, to_double

# Fields of a quote.
QUOTE = (
    "price", "volume_24h", "volume_change_24h", "percent_change_1h", "percent_change_24h",
    "percent_change_7d", "market_cap", "market_cap_dominance", "fully_diluted_market_cap", "last_updated",
)


def _text(names: Iterable[str]) -> str:
    return ", ".join(f"{name} string" for name in names)


def _struct(names: Iterable[str]) -> str:
    return "struct<" + ", ".join(f"{name}: string" for name in names) + ">"


def is_object(raw: Column) -> Column:
    return F.ltrim(raw).startswith("{")


#: Column that a parser adds where rejects are kept: (request_id, fetched_at, reason, piece), NULL for records.
REJECT = "_reject"
#: Why something gave no record.
DAMAGED, NO_OBJECT = "damaged", "not an object"


def keep_rejects(payloads: DataFrame) -> DataFrame:
    """Payloads from which any parser gives, beside its records, a row for each piece that is none.

    A body without readable `data` is a damaged piece; an element that is no object is a piece of its own.
    """
    return payloads.withColumn("_payload", F.struct("request_id", "fetched_at", "body"))


def _pieces(payloads: DataFrame, keep: Sequence[str], data: Column, raw: Column) -> DataFrame:
    """`raw` per payload; where rejects are kept, also for payloads whose `data` is NULL."""
    if "_payload" not in payloads.columns:
        return payloads.select(*keep, raw)
    return payloads.select(*keep, "_payload", data.isNull().alias("_damaged"), raw)


def elements(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Array payloads: one raw element per row in `_raw`; `data` that is no array gives none."""
    data = F.from_json("body", "data array<string>")["data"]
    return _pieces(payloads, keep, data, _each(payloads, data).alias("_raw"))


def _each(payloads: DataFrame, items: Column) -> Column:
    """The items one by one; where rejects are kept, a NULL for items that are NULL as a whole."""
    none = F.array(F.lit(None).cast("string"))
    return F.explode(F.coalesce(items, none) if "_payload" in payloads.columns else items)


def entries(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Map payloads: one (`_key`, `_raw`) per row."""
    mapped = F.from_json("body", "data map<string,string>")["data"]
    none = F.create_map(F.lit(""), F.lit(None).cast("string"))
    each = F.coalesce(mapped, none) if "_payload" in payloads.columns else mapped
    return _pieces(payloads, keep, mapped, F.explode(each).alias("_key", "_raw"))


def single(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Payloads whose `data` is one object; others too where rejects are kept."""
    data = F.from_json("body", "data string")["data"]
    found = _pieces(payloads, keep, data, data.alias("_raw"))
    return found if "_payload" in payloads.columns else found.where(is_object(F.col("_raw")))


def _records(raw: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    if "_payload" not in raw.columns:
        return raw.where(is_object(F.col("_raw"))).select(*keep, F.from_json("_raw", schema).alias("r"))
    good = F.coalesce(is_object(F.col("_raw")), F.lit(False))
    reason = F.when(F.col("_damaged"), DAMAGED).when(~good, NO_OBJECT)
    piece = F.when(F.col("_damaged"), F.col("_payload.body")).otherwise(F.col("_raw"))
    reject = F.struct("_payload.request_id", "_payload.fetched_at", reason.alias("reason"), piece.alias("piece"))
    return raw.select(
        *keep,
        F.from_json(F.when(good, F.col("_raw")), schema).alias("r"),
        F.when(reason.isNotNull(), reject).alias(REJECT),
    )


def _shown(records: DataFrame, *columns: Column | str) -> DataFrame:
    """A parser's columns, with the rejects where they are kept."""
    return records.select(*columns, *(c for c in (REJECT,) if c in records.columns))


def malformed_count(raw: DataFrame) -> DataFrame:
    """How many elements were objects and how many were not."""
    ok = F.coalesce(is_object(F.col("_raw")), F.lit(False))
    return raw.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"))


ARRAY, MAP, OBJECT = "array<string>", "map<string,string>", "string"


def count_columns(shape: str = ARRAY) -> list[Column]:
    """Aggregates over payload rows: payloads, damaged (no readable `data`), and how many of the
    others' elements are objects (valid) or not (invalid)."""
    data = F.from_json("body", f"data {shape}")["data"]
    items = {ARRAY: data, MAP: F.map_values(data), OBJECT: F.when(data.isNotNull(), F.array(data))}[shape]
    good = F.size(F.filter(items, lambda raw: F.coalesce(is_object(raw), F.lit(False))))
    return [
        F.count(F.lit(1)).alias("payloads"),
        F.count_if(data.isNull()).alias("damaged"),
        F.coalesce(F.sum(F.when(data.isNotNull(), good)), F.lit(0)).alias("valid"),
        F.coalesce(F.sum(F.when(data.isNotNull(), F.size(items) - good)), F.lit(0)).alias("invalid"),
    ]


def _r(name: str) -> Column:
    return F.col(f"r.{name}")


def _long(name: str) -> Column:
    return _r(name).try_cast("bigint")


def _fields(kinds: Mapping[str, str]) -> list[Column]:
    """name -> 'long' | 'double' | 'bool' | 'text' projections of record fields."""
    casts = {"long": "bigint", "double": "double", "bool": "boolean", "text": "string"}
    return [_r(name).try_cast(casts[kind]).alias(name) for name, kind in kinds.items()]


def exchange_map(payloads: DataFrame) -> DataFrame:
    kinds = {"id": "long", "name": "text", "slug": "text", "is_active": "long"}
    return _shown(_records(elements(payloads), _text(kinds)), *_fields(kinds))


def exchange_info(payloads: DataFrame) -> DataFrame:
    kinds = {
        "id": "long", "name": "text", "slug": "text", "description": "text", "date_launched": "text",
        "notice": "text", "logo": "text", "weekly_visits": "double", "spot_volume_usd": "double",
        "maker_fee": "double", "taker_fee": "double",
    }
    links = "struct<blog: array<string>, fee: array<string>, twitter: array<string>, website: array<string>>"
    schema = _text(kinds) + f", urls {links}, fiats array<string>"
    return _shown(
        _records(entries(payloads), schema),
        *_fields(kinds),
        _r("urls").alias("urls"),
        F.concat_ws(", ", _r("fiats")).alias("fiats"),
    )


def exchange_assets(payloads: DataFrame) -> DataFrame:
    """`request_id` carries the exchange the payload was asked for."""
    schema = (
        _text(("wallet_address", "balance"))
        + f", platform {_struct(('crypto_id', 'symbol', 'name'))}, currency {_struct(('crypto_id', 'symbol', 'name', 'price_usd'))}"
    )
    return _shown(
        _records(elements(payloads, ["request_id"]), schema, ["request_id"]),
        F.col("request_id").try_cast("bigint").alias("exchange_id"),
        _r("wallet_address").alias("wallet_address"),
        to_double(_r("balance")).alias("balance"),
        _long("platform.crypto_id").alias("platform_crypto_id"),
        _r("platform.symbol").alias("platform_symbol"),
        _r("platform.name").alias("platform_name"),
        _long("currency.crypto_id").alias("currency_crypto_id"),
        _r("currency.symbol").alias("currency_symbol"),
        _r("currency.name").alias("currency_name"),
        to_double(_r("currency.price_usd")).alias("currency_price_usd"),
    )


def crypto_map(payloads: DataFrame) -> DataFrame:
    kinds = {
        "id": "long", "rank": "long", "name": "text", "symbol": "text", "is_active": "long",
        "first_historical_data": "text", "last_historical_data": "text",
    }
    schema = _text(kinds) + f", platform {_struct(('id', 'name', 'symbol', 'slug', 'token_address'))}"
    return _shown(
        _records(elements(payloads), schema),
        *_fields(kinds),
        to_double(_r("platform.id")).alias("platform_id"),
        *[_r(f"platform.{n}").alias(f"platform_{n}") for n in ("name", "symbol", "slug", "token_address")],
    )


def crypto_info(payloads: DataFrame) -> DataFrame:
    kinds = {
        "name": "text", "symbol": "text", "slug": "text", "logo": "text", "description": "text",
        "date_added": "text", "date_launched": "text", "category": "text",
    }
    links = ("website", "technical_doc", "twitter", "reddit", "explorer", "source_code")
    urls = "struct<" + ", ".join(f"{n}: array<string>" for n in links) + ">"
    schema = _text(kinds) + f", urls {urls}, tags array<string>"
    return _shown(
        _records(entries(payloads, []), schema, ["_key"]),
        F.col("_key").try_cast("bigint").alias("id"),
        *_fields(kinds),
        *[first_of(_r(f"urls.{n}")).alias(n) for n in links],
        joined(_r("tags"), ",").alias("tags"),
    )


def listings(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`keep` carries payload columns along, such as the request that a batch is told by."""
    kinds = {
        "id": "long", "name": "text", "symbol": "text", "slug": "text", "cmc_rank": "long",
        "num_market_pairs": "double", "circulating_supply": "double", "total_supply": "double",
        "max_supply": "double", "infinite_supply": "bool", "self_reported_circulating_supply": "double",
        "self_reported_market_cap": "double", "date_added": "text",
    }
    schema = (
        _text(kinds)
        + ", tags array<string>, self_reported_tags array<string>, platform struct<id: string>"
        + f", quote struct<USD: {_struct(QUOTE)}>"
    )
    flat = {
        "price_usd": "price", "volume_24h_usd": "volume_24h", "volume_change_24h": "volume_change_24h",
        "percent_change_1h_usd": "percent_change_1h", "percent_change_24h_usd": "percent_change_24h",
        "percent_change_7d_usd": "percent_change_7d", "market_cap_usd": "market_cap",
        "market_cap_dominance_usd": "market_cap_dominance",
        "fully_diluted_market_cap_usd": "fully_diluted_market_cap",
    }
    return _shown(
        _records(elements(payloads, keep), schema, keep),
        *keep,
        *_fields(kinds),
        joined(_r("tags"), ",").alias("tags"),
        joined(_r("self_reported_tags"), ",").alias("self_reported_tags"),
        to_double(_r("platform.id")).alias("platform_id"),
        *[to_double(_r(f"quote.USD.{source}")).alias(name) for name, source in flat.items()],
        _r("quote.USD.last_updated").alias("last_updated_usd"),
    )


CATEGORY_NUMBERS = ("num_tokens", "avg_price_change", "market_cap", "market_cap_change", "volume", "volume_change")


def categories(payloads: DataFrame) -> DataFrame:
    kinds = {"name": "text", "title": "text", "description": "text"}
    kinds |= dict.fromkeys(CATEGORY_NUMBERS, "double") | {"last_updated": "text"}
    records = _records(elements(payloads), "id string, " + _text(kinds))
    return _shown(records, _r("id").alias("category_id"), *_fields(kinds))


def category_links(payloads: DataFrame) -> DataFrame:
    """One (crypto_id, category_id) per coin of a category payload; missing ids are skipped."""
    records = _records(single(payloads), "id string, coins array<struct<id: string>>")
    named, coins = _r("id").isNotNull() & (_r("id") != ""), F.col("r.coins")
    if REJECT in records.columns:
        rejected = F.col(REJECT).isNotNull()
        named, coins = named | rejected, F.when(rejected, F.array(F.lit(None).cast("struct<id: string>"))).otherwise(coins)
    pairs = _shown(records.where(named), F.explode(coins).alias("coin"), _r("id").alias("category_id"))
    pairs = _shown(pairs, F.col("coin.id").try_cast("bigint").alias("crypto_id"), "category_id")
    return pairs.where(F.col("crypto_id").isNotNull() | (F.col(REJECT).isNotNull() if REJECT in pairs.columns else F.lit(False)))


GLOBAL_COUNTS = (
    "active_cryptocurrencies", "total_cryptocurrencies", "active_market_pairs", "active_exchanges",
    "total_exchanges", "total_crypto_dex_currencies", "today_incremental_crypto_number",
    "past_24h_incremental_crypto_number", "past_7d_incremental_crypto_number",
    "past_30d_incremental_crypto_number",
)
GLOBAL_METRICS = (
    "eth_dominance", "btc_dominance", "eth_dominance_yesterday", "btc_dominance_yesterday",
    "eth_dominance_24h_percentage_change", "btc_dominance_24h_percentage_change", "defi_volume_24h",
    "defi_volume_24h_reported", "defi_market_cap", "defi_24h_percentage_change", "stablecoin_volume_24h",
    "stablecoin_volume_24h_reported", "stablecoin_market_cap", "stablecoin_24h_percentage_change",
    "derivatives_volume_24h", "derivatives_volume_24h_reported", "derivatives_24h_percentage_change",
    "today_change_percent",
)
GLOBAL_QUOTES = (
    "total_market_cap", "total_volume_24h", "total_volume_24h_reported", "altcoin_volume_24h",
    "altcoin_volume_24h_reported", "altcoin_market_cap", "total_market_cap_yesterday",
    "total_volume_24h_yesterday", "total_market_cap_yesterday_percentage_change",
    "total_volume_24h_yesterday_percentage_change",
)


def global_metrics(payloads: DataFrame) -> DataFrame:
    """One flat record per payload; a missing nested object leaves its fields NULL."""
    kinds = dict.fromkeys(GLOBAL_COUNTS, "long") | dict.fromkeys(GLOBAL_METRICS, "double")
    tracked = {"Number": "bigint", "Date": "string"}
    schema = (
        _text(kinds)
        + ", last_updated string"
        + f", quote struct<USD: {_struct(GLOBAL_QUOTES)}>"
        + ", tracked_yearly_number struct<"
        + ", ".join(f"{side}Incremental{what}: string" for side in ("max", "min") for what in tracked)
        + ">"
    )
    return _shown(
        _records(single(payloads, ["fetched_at"]), schema, ["fetched_at"]),
        *_fields(kinds),
        *[
            _r(f"tracked_yearly_number.{side}Incremental{what}").try_cast(t).alias(f"tracked_{side}Incremental{what}")
            for side in ("max", "min")
            for what, t in tracked.items()
        ],
        *[to_double(_r(f"quote.USD.{n}")).alias(f"quote_{n}") for n in GLOBAL_QUOTES],
        _r("last_updated").alias("last_updated"),
        F.col("fetched_at").alias("date_snapshot"),
    )


def sentiment(payloads: DataFrame) -> DataFrame:
    """History (a list) and latest (one object) share their record form."""
    data = F.from_json("body", "data string")["data"]
    as_list = F.when(is_object(data), F.array(data)).otherwise(F.from_json(data, "array<string>"))
    raw = _pieces(payloads, [], as_list, _each(payloads, as_list).alias("_raw"))
    kinds = {"value": "long", "value_classification": "text", "timestamp": "text", "update_time": "text"}
    return _shown(_records(raw, _text(kinds)), *_fields(kinds))


def numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Coerce the named columns to double where they exist; non-numbers give NULL."""
    wanted = set(columns)
    return df.select(*[to_double(c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def completeness(df: DataFrame) -> DataFrame:
    """Per row: how many fields are present and how many are NULL."""
    present = sum((F.col(c).isNotNull().cast("int") for c in df.columns), F.lit(0))
    return df.select("*", present.alias("non_null_fields"), (F.lit(len(df.columns)) - present).alias("null_fields"))


def stamped(df: DataFrame, taken_at: Column, batch_index: Column) -> DataFrame:
    return df.withColumns({"date_snapshot": taken_at, "batch_index": batch_index.cast("bigint")})


def history_span(df: DataFrame, epoch: str) -> DataFrame:
    """Record count and first/last epoch second with their UTC days."""
    seconds = F.col(epoch).try_cast("bigint")
    span = df.agg(F.count(F.lit(1)).alias("records_fetched"), F.min(seconds).alias("lo"), F.max(seconds).alias("hi"))
    day = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd")
    return span.select(
        "records_fetched",
        F.col("lo").cast("string").alias("first_timestamp"),
        F.col("hi").cast("string").alias("last_timestamp"),
        day("lo").alias("first_date_utc"),
        day("hi").alias("last_date_utc"),
    )
