"""Built tables over the derived inputs, written once per data folder and then scanned.

Views, checks and loads read published tables, as they would in production; the builds
themselves run as their own queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.bindings.inputs import bronze
from tidemark.operators.ordered import materialize
from tidemark.plans import builds
from tidemark.session import work_root


def _build(build: Callable[..., DataFrame], *inputs: str, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(*[bronze(spark, sf_dir, n) for n in inputs], **options)


BUILDS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dim_crypto_id": _build(builds.dim_crypto_id, "in_crypto_map"),
    "dim_crypto_map": _build(builds.dim_crypto_map, "in_crypto_ranks"),
    "dim_crypto_info": _build(builds.dim_crypto_info, "in_crypto_info"),
    "fact_crypto_market": _build(builds.fact_crypto_market, "in_listings"),
    "dim_crypto_category": _build(builds.dim_crypto_category, "in_categories"),
    "crypto_category_link": _build(builds.crypto_category_link, "in_category_links"),
    "fact_crypto_category": _build(builds.fact_crypto_category, "in_categories"),
    "dim_exchange_id": _build(builds.dim_exchange_id, "in_exchange_map"),
    "dim_exchange_info": _build(builds.dim_exchange_info, "in_exchange_info"),
    "dim_exchange_map": _build(builds.dim_exchange_map, "in_exchange_info", "in_exchange_map"),
    "fact_exchange_assets": _build(
        builds.fact_exchange_assets, "in_exchange_assets", "in_exchange_info", by_snapshot=True
    ),
    "fact_global_market": _build(builds.fact_global_market, "in_global"),
    "fact_market_sentiment": _build(builds.sentiment_history, "in_sentiment"),
}

_published: dict[tuple[str, str, str, str], DataFrame] = {}


class Silver(Mapping[str, DataFrame]):
    """Tables by name; a table is built and written when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getitem__(self, table: str) -> DataFrame:
        build = BUILDS[table]
        key = (self.spark.sparkContext.applicationId, work_root(self.spark), self.sf_dir, table)
        if key not in _published:
            _published[key] = materialize(build(self.spark, self.sf_dir), table)
        return _published[key]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDS)

    def __len__(self) -> int:
        return len(BUILDS)
