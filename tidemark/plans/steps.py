"""Build steps: which snapshot folders a table is built from, how often, and running them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.increment import is_newer
from tidemark.plans import builds, days, schemas
from tidemark.sources import payloads, snapshots
from tidemark.sources.store import Store, last_entry


@dataclass(frozen=True)
class Source:
    folder: str
    schema: str
    batched: bool = False  # a snapshot made of several files with one time suffix


@dataclass(frozen=True)
class Build:
    table: str
    make: Callable[..., DataFrame]
    sources: tuple[Source, ...]  # the first decides freshness; the others may be missing
    daily: bool = True  # compare days, not times, to tell a new snapshot
    once: bool = False  # a one-time history run


EXCHANGE_MAP = Source("exchange_map_data", schemas.EXCHANGE_MAP)
EXCHANGE_INFO = Source("exchange_info_data", schemas.EXCHANGE_INFO)
CATEGORIES = Source("crypto_categories_data", schemas.CATEGORIES)
LISTINGS = Source("crypto_listings_latest_data", schemas.LISTINGS, batched=True)

STEPS: dict[str, Build] = {
    "sentiment_history": Build(
        "fact_market_sentiment",
        builds.sentiment_history,
        (Source("fear_and_greed_data", schemas.SENTIMENT_HISTORY),),
        once=True,
    ),
    "sentiment_live": Build(
        "fact_market_sentiment",
        builds.sentiment_live,
        (Source("latest_fear_and_greed_data", schemas.SENTIMENT_LATEST),),
        daily=False,
    ),
    "dim_crypto_category": Build("dim_crypto_category", builds.dim_crypto_category, (CATEGORIES,), daily=False),
    "fact_crypto_category": Build("fact_crypto_category", builds.fact_crypto_category, (CATEGORIES,), daily=False),
    "fact_global_market": Build(
        "fact_global_market", builds.fact_global_market, (Source("global_metrics_data", schemas.GLOBAL),), daily=False
    ),
    "fact_crypto_market": Build("fact_crypto_market", builds.fact_crypto_market, (LISTINGS,), daily=False),
    "dim_exchange_id": Build("dim_exchange_id", builds.dim_exchange_id, (EXCHANGE_MAP,)),
    "dim_exchange_info": Build("dim_exchange_info", builds.dim_exchange_info, (EXCHANGE_INFO,)),
    "dim_exchange_map": Build("dim_exchange_map", builds.dim_exchange_map, (EXCHANGE_INFO, EXCHANGE_MAP)),
    "fact_exchange_assets": Build(
        "fact_exchange_assets",
        builds.fact_exchange_assets,
        (Source("exchange_assets_data", schemas.EXCHANGE_ASSETS), EXCHANGE_INFO),
        daily=False,
    ),
    "dim_crypto_id": Build("dim_crypto_id", builds.dim_crypto_id, (Source("crypto_map_data", schemas.CRYPTO_ID),)),
    "dim_crypto_map": Build("dim_crypto_map", builds.dim_crypto_map, (Source("crypto_map_data", schemas.CRYPTO_MAP),)),
    "crypto_category_link": Build(
        "crypto_category_link", builds.crypto_category_link, (Source("crypto_category_data", schemas.CATEGORY_LINKS),)
    ),
    "dim_crypto_info": Build(
        "dim_crypto_info", builds.dim_crypto_info, (Source("crypto_info_data", schemas.CRYPTO_INFO),)
    ),
}

# frequency -> steps, in dependency order
BUILD_GROUPS: dict[str, tuple[str, ...]] = {
    "init": ("sentiment_history",),
    "10x": ("dim_crypto_category", "fact_crypto_category", "fact_global_market", "sentiment_live"),
    "5x": ("fact_crypto_market",),
    "daily": (
        "dim_exchange_id",
        "dim_exchange_info",
        "dim_exchange_map",
        "fact_exchange_assets",
        "dim_crypto_id",
        "dim_crypto_map",
        "crypto_category_link",
    ),
    "weekly": ("dim_crypto_info",),
}


def builds_for(frequency: str) -> tuple[str, ...]:
    if frequency == "all":
        return tuple(dict.fromkeys(step for group in BUILD_GROUPS.values() for step in group))
    return BUILD_GROUPS[frequency]


def run_step(
    store: Store,
    table: str,
    prepare: Callable[[], DataFrame | None],
    phase: str = "transform",
    read_upto: datetime | None = None,
    by_day: bool = False,
) -> str:
    """Prepare, publish and record one table. No frame gives 'skipped'; a failed write
    leaves no ledger entry and raises. With `by_day`, rows go to folders by day."""
    started = datetime.now(timezone.utc)
    df = prepare()
    if df is None:
        store.record(table, phase, "skipped", started_at=started)
        return "skipped"
    store.publish(df, table, phase=phase, read_upto=read_upto, derived=days.layout(table, df) if by_day else None)
    return "success"


def snapshots_to_read(
    spark: SparkSession, bronze_root: str, silver: Store, names: Sequence[str], force: bool = False
) -> dict[tuple[str, str], list[Row]]:
    """(step, folder) -> its snapshots (suffix, path, at, fresh), oldest first, from one listing.

    Of a step's first folder: all that are newer than what the last run of its table read (where the
    ledger does not say, than the end of that run), so that a backlog is built whole and nothing twice.
    Of every folder: the newest one, fresh or not.
    """
    rows = [
        (name, source.folder, STEPS[name].table, phase_of(STEPS[name]), STEPS[name].daily, source is STEPS[name].sources[0])
        for name in names
        for source in STEPS[name].sources
    ]
    wanted = spark.createDataFrame(
        rows, "step string, folder string, table_name string, phase string, daily boolean, is_first boolean"
    )
    runs = silver.ledger().where("status = 'success'").groupBy("table_name", "phase")
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    newest = Window.partitionBy("step", "folder").orderBy(F.desc("suffix"), F.desc("path"))
    found = (
        snapshots.list_snapshots(spark, bronze_root)
        .withColumn("folder", folder)
        .join(wanted, "folder")
        .join(runs.agg(F.max(F.coalesce("read_upto", "ended_at")).alias("last_ended_at")), ["table_name", "phase"], "left")
        .withColumn("is_newest", F.row_number().over(newest) == 1)
        .withColumn("fresh", F.col("is_first") & (F.lit(force) & F.col("is_newest") | ~F.lit(force) & is_newer(F.col("daily"))))
        .where("fresh OR is_newest")
        .select("step", "folder", "suffix", "path", F.unix_seconds("snapshot_ts").alias("at"), "fresh")
    )
    out: dict[tuple[str, str], list[Row]] = {}
    for row in sorted(found.collect(), key=lambda r: (r["suffix"], r["path"])):
        out.setdefault((row["step"], row["folder"]), []).append(row)
    return out


def phase_of(step: Build) -> str:
    return "init" if step.once else "transform"


def folder_schema(spark: SparkSession, folder: str) -> StructType:
    """All columns that any step reads from a folder."""
    found = [s.schema for step in STEPS.values() for s in step.sources if s.folder == folder]
    fields = {f.name: f for schema in found for f in spark.createDataFrame([], schema).schema.fields}
    return StructType(list(fields.values()))


class SharedScans:
    """Frames of bronze snapshots; snapshots that several steps read are scanned once for all of them.

    Such rows are held from their first use until the last announced one is over; rows that one step
    reads are not held.
    """

    def __init__(self, spark: SparkSession, bronze_root: str):
        self.spark, self.root = spark, bronze_root
        self.uses: dict[tuple[str, tuple[str, ...]], int] = {}
        self.left: dict[tuple[str, tuple[str, ...]], int] = {}
        self.held: dict[tuple[str, tuple[str, ...]], DataFrame] = {}

    @staticmethod
    def _key(source: Source, chosen: Sequence[Row]) -> tuple[str, tuple[str, ...]]:
        return source.folder, tuple(dict.fromkeys(row["suffix" if source.batched else "path"] for row in chosen))

    def announce(self, source: Source, chosen: Sequence[Row]) -> None:
        """Tell beforehand what will be read, so that shared snapshots are known."""
        key = self._key(source, chosen)
        self.uses[key] = self.uses.get(key, 0) + 1

    def read(self, source: Source, chosen: Sequence[Row]) -> DataFrame | None:
        """The chosen snapshots of a folder as one scan, with every member of their batches."""
        if not chosen:
            return None
        key = self._key(source, chosen)
        if self.uses.get(key, 0) < 2:
            return self._scan(source, key, source.schema)
        if key not in self.held:
            whole = self._scan(source, key, folder_schema(self.spark, source.folder))
            self.held[key] = whole.persist(StorageLevel.MEMORY_AND_DISK)
        return self.held[key].select(*self.spark.createDataFrame([], source.schema).columns)

    def _scan(self, source: Source, key: tuple[str, tuple[str, ...]], schema: str | StructType) -> DataFrame:
        if source.batched:
            return snapshots.read_batch(self.spark, schema, f"{self.root}/{source.folder}", *key[1])
        return snapshots.read_strict(self.spark, schema, *key[1])

    def over(self, source: Source, chosen: Sequence[Row]) -> None:
        """An announced use is over."""
        key = self._key(source, chosen)
        self.left[key] = self.left.get(key, self.uses.get(key, 0)) - 1
        if self.left[key] == 0 and key in self.held:
            self.held.pop(key).unpersist()

    def release(self) -> None:
        while self.held:
            self.held.popitem()[1].unpersist()


def run_builds(
    spark: SparkSession,
    bronze_root: str,
    silver: Store,
    frequency: str = "all",
    force: bool = False,
    by_day: bool = False,
) -> dict[str, str]:
    """Run the steps of one frequency: step -> 'success', 'no snapshot' or 'up to date'.

    A step reads every snapshot of its first folder since the last run and the newest one of its
    other folders. With `force` it reads the newest only; a history run happens once. Snapshots
    that several steps read are scanned once. A version holds what one run read, and loads read it whole;
    with `by_day` it has folders by day for readers of their own.
    """
    outcome, names = {}, builds_for(frequency)
    found, history = snapshots_to_read(spark, bronze_root, silver, names, force), silver.history()
    scans, wanted = SharedScans(spark, bronze_root), {}
    for name in names:
        step = STEPS[name]
        first = found.get((name, step.sources[0].folder), [])
        fresh = [row for row in first if row["fresh"]]
        if not first:
            outcome[name] = "no snapshot"
        elif not fresh or step.once and last_entry(history.get(step.table, []), (phase_of(step),)) is not None:
            outcome[name] = "up to date"
        else:
            others = [found.get((name, s.folder), [])[-1:] for s in step.sources[1:]]
            wanted[name] = [fresh[-1:] if step.once else fresh, *others]
            for source, rows in zip(step.sources, wanted[name], strict=True):
                scans.announce(source, rows)
    try:
        for name, chosen in wanted.items():
            step = STEPS[name]
            frames = [scans.read(source, rows) for source, rows in zip(step.sources, chosen, strict=True)]
            times = [row["at"] for row in chosen[0] if row["at"] is not None]
            upto = datetime.fromtimestamp(max(times), timezone.utc) if times else None
            outcome[name] = run_step(silver, step.table, lambda: step.make(*frames), phase_of(step), upto, by_day)  # noqa: B023
            for source, rows in zip(step.sources, chosen, strict=True):
                scans.over(source, rows)
    finally:
        scans.release()
    return {name: outcome[name] for name in names}


# payloads to bronze ---------------------------------------------------------------

# 200 coins to a request, five requests to a file.
REQUESTS_PER_FILE = 5


def _listings(raw: DataFrame) -> DataFrame:
    batch = F.ceil(F.col("request_id").try_cast("bigint") / REQUESTS_PER_FILE).cast("bigint")
    return payloads.listings(raw, ["request_id"]).withColumn("batch_index", batch).drop("request_id")


# endpoint -> (parser, bronze folder)
PARSERS: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "exchange_map": (payloads.exchange_map, "exchange_map_data"),
    "exchange_info": (payloads.exchange_info, "exchange_info_data"),
    "exchange_assets": (payloads.exchange_assets, "exchange_assets_data"),
    "crypto_map": (payloads.crypto_map, "crypto_map_data"),
    "crypto_info": (payloads.crypto_info, "crypto_info_data"),
    "crypto_listings": (_listings, "crypto_listings_latest_data"),
    "crypto_categories": (payloads.categories, "crypto_categories_data"),
    "crypto_category": (payloads.category_links, "crypto_category_data"),
    "global_metrics": (payloads.global_metrics, "global_metrics_data"),
    "sentiment_history": (payloads.sentiment, "fear_and_greed_data"),
    "sentiment_latest": (payloads.sentiment, "latest_fear_and_greed_data"),
}


#: Folder of the pieces of payloads that gave no record; its name hides it from listings and streams.
REJECTS = "_rejects"


def tagged(raw: DataFrame, endpoint: str, taken_at: datetime) -> DataFrame:
    """Records and rejects of an endpoint's payloads from one scan, told apart by `kind`."""
    bodies = raw.where(F.col("endpoint") == endpoint)
    parsed = PARSERS[endpoint][0](payloads.keep_rejects(bodies))
    rejected = F.col(payloads.REJECT)
    return parsed.select(
        *[n for n in parsed.columns if n not in (payloads.REJECT, "date_snapshot")],
        F.lit(f"{taken_at:%Y-%m-%dT%H:%M:%S}+00:00").alias("date_snapshot"),
        *[rejected[n].alias(f"_{n}") for n in ("request_id", "fetched_at", "reason", "piece")],
        F.when(rejected.isNull(), "records").otherwise("rejects").alias("kind"),
    )


def parse_to_bronze(
    raw: DataFrame, endpoint: str, bronze_root: str, taken_at: datetime, ledger: Store | None = None
) -> str | None:
    """Parse the payloads of one endpoint into a bronze snapshot stamped `taken_at` (UTC).

    One scan and one write give both the snapshot and, beside it, the pieces that are no records; each
    is committed by a rename if it has rows. With a `ledger`, how many records there are, how many
    payloads were damaged and how many elements were no objects is recorded there.
    """
    spark, folder = raw.sparkSession, f"{bronze_root}/{PARSERS[endpoint][1]}"
    attempt, seen, reason = snapshots.attempt_path(folder), Observation(), F.col("_reason")
    rows = tagged(raw, endpoint, taken_at).observe(
        seen,
        F.count_if(F.col("kind") == "records").alias("records"),
        F.count_if(reason == payloads.DAMAGED).alias("damaged"),
        F.count_if(reason == payloads.NO_OBJECT).alias("invalid"),
    )
    rows.write.partitionBy("kind").parquet(attempt)
    counts = {name: seen.get.get(name) or 0 for name in ("records", "damaged", "invalid")}
    if counts["damaged"] + counts["invalid"]:
        rejects = snapshots.snapshot_path(f"{bronze_root}/{REJECTS}/{PARSERS[endpoint][1]}", endpoint, taken_at)
        snapshots.move(spark, f"{attempt}/kind=rejects", rejects, replace=True)
    path = None
    if counts["records"]:
        # the snapshot comes last: once it is there, the parse is done
        path = snapshots.snapshot_path(folder, endpoint, taken_at)
        snapshots.move(spark, f"{attempt}/kind=records", path)
    snapshots.discard(spark, attempt)
    if ledger is not None:
        dropped = {name: counts[name] for name in ("damaged", "invalid")}
        status = "success" if path else "skipped"
        ledger.record(PARSERS[endpoint][1], "parse", status, rows=counts["records"], path=path, dropped=dropped)
    return path


def read_rejects(spark: SparkSession, bronze_root: str, endpoint: str) -> DataFrame | None:
    """(request_id, fetched_at, reason, piece) of all rejects of an endpoint, with their snapshot time."""
    folder = f"{bronze_root}/{REJECTS}/{PARSERS[endpoint][1]}"
    if not snapshots.exists(spark, folder):
        return None
    names = ("request_id", "fetched_at", "reason", "piece")
    schema = ", ".join(f"_{n} string" for n in names)
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    at = snapshots.snapshot_time(F.col("_metadata.file_path")).alias("snapshot_ts")
    return rows.select(*[F.col(f"_{n}").alias(n) for n in names], at)
