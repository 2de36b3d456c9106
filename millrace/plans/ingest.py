"""Ingest plans: catalog dumps, census and all-or-nothing review loads."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import blank_to_null, brace_list, digits_only, fill_template, leading_date
from millrace.operators.gating import size_class, work_list
from millrace.operators.lookup import attach_lists, last_wins, positions, resolve_names
from millrace.operators.upsert import upsert_replace, upsert_with_previous
from millrace.plans.registry import Node, Registry
from millrace.schemas import CATALOG_GAMES, DUMP_COLUMNS, RAW_TABLES, REVIEWS
from millrace.session import EngineConfig, current_time
from millrace.sources.dumps import CatalogApi, download_dump, read_dump
from millrace.sources.http import stream_bytes
from millrace.sources.loads import create_log, new_load_id, publish_stage, write_load
from millrace.sources.review_pages import Progress, ReviewPages
from millrace.sources.tables import ATTEMPTS, Conflict, Layout, Warehouse

#: Fixed value: the store's number among the external catalogs.
STORE_CATEGORY = 1
#: The catalog is looked up by application and by genre.
CATALOG_LAYOUT = Layout(bloom=("steam_app_id", "genres"), index=("steam_app_id", "genres"))


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """The warehouse under a folder, with its raw tables and views; what doesn't exist is created."""
    warehouse = Warehouse(spark, root)
    for name, (schema, comment) in RAW_TABLES.items():
        warehouse.create_if_absent(f"raw.{name}", schema, comment, CATALOG_LAYOUT if name == "catalog_games" else None)
        warehouse.attach(f"raw.{name}")
    create_log(spark, review_log(warehouse), "raw.reviews", "raw.review_marks", REVIEWS)
    marked = """SELECT c.app_id, c.total_reviews, c.total_positive, c.total_negative, c.review_score, c.review_score_desc, c.checked_at, c.prev_total_reviews,
        coalesce(m.marked_at, c.last_backfill_at) AS last_backfill_at, greatest(m.max_seen, c.last_seen_timestamp_updated) AS last_seen_timestamp_updated
        FROM raw.review_census c LEFT JOIN (SELECT app_id, max(marked_at) AS marked_at, max(max_seen) AS max_seen FROM raw.review_marks GROUP BY app_id) m ON m.app_id = c.app_id"""
    spark.sql(f"CREATE OR REPLACE VIEW raw.review_counts COMMENT 'counts of the last census and marks of the loads' AS {marked}")
    return warehouse


def review_log(warehouse: Warehouse) -> str:
    return warehouse.folder("raw.review_log")


def app_ids(external: DataFrame) -> DataFrame:
    """(game, app_id) of store entries, the last row of a game winning."""
    category = F.coalesce(blank_to_null(F.col("category")), F.col("external_game_source"))
    numbered = external.select("game", digits_only(F.col("uid")).alias("app_id"), digits_only(category).alias("cat"), "row_no")
    kept = numbered.where((F.col("cat") == STORE_CATEGORY) & F.col("app_id").isNotNull()).drop("cat")
    return last_wins(kept, "game", "row_no")


def catalog_games(dumps: dict[str, DataFrame], config: EngineConfig = EngineConfig(), now: datetime | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Catalog rows of games that have an application id, with names in place of ids.

    dumps: the frames of DUMP_COLUMNS, each with row_no (file order); ids: app_ids of them. Broadcasts
    are left to the optimizer, which knows the sizes.
    """
    named = {t: last_wins(dumps[t].select("id", "name", "row_no"), "id", "row_no") for t in ("genres", "companies")}
    links = last_wins(dumps["involved_companies"], "id", "row_no").select(
        F.col("id").alias("link_id"), "company", (F.col("developer") == "t").alias("is_dev"), (F.col("publisher") == "t").alias("is_pub")
    )
    covers = last_wins(dumps["covers"].where(blank_to_null(F.col("image_id")).isNotNull()), "id", "row_no").select(
        F.col("id").alias("cover"), "image_id"
    )
    ids = app_ids(dumps["external_games"]) if ids is None else ids
    games = dumps["games"].join(ids.withColumnRenamed("game", "id"), "id").withColumn("row_key", F.col("row_no"))

    genre_items = positions(games, "row_key", brace_list(F.col("genres")))
    genres = resolve_names(genre_items, "row_key", named["genres"], "id", "name", {"genre_names": F.lit(True)})
    company_names = links.join(named["companies"].withColumnRenamed("id", "company"), "company")
    roles = resolve_names(
        positions(games, "row_key", brace_list(F.col("involved_companies"))),
        "row_key",
        company_names,
        "link_id",
        "name",
        {"developers": F.col("is_dev"), "publishers": F.col("is_pub")},
    )
    wide = attach_lists(attach_lists(games, genres, "row_key", ["genre_names"]), roles, "row_key", ["developers", "publishers"])
    out = wide.join(covers, "cover", "left").select(
        F.col("id").cast("bigint").alias("igdb_id"),
        F.col("app_id").alias("steam_app_id"),
        F.coalesce("name", F.lit("")).alias("name"),  # a blank field is read as NULL
        leading_date(F.col("first_release_date")).alias("first_release_date"),
        F.col("genre_names").alias("genres"),
        "developers",
        "publishers",
        fill_template(config.cover_url_template, "image_id", F.col("image_id")).alias("cover_url"),
        current_time(now).alias("loaded_at"),
        "row_no",
    )
    return last_wins(out, "igdb_id", "row_no").select(*[f.name for f in CATALOG_GAMES])


@dataclass(frozen=True)
class CatalogMetrics:
    games_in_dump: int
    games_with_steam_app_id: int
    rows_upserted: int


def ingest_catalog(spark: SparkSession, warehouse: Warehouse, folder: str, config: EngineConfig = EngineConfig(), now: datetime | None = None) -> CatalogMetrics:
    """Read the six dumps in a folder and upsert the catalog; games that vanish stay.

    Each dump is read once, into columns that the joins read from then on. The metrics are
    observed while rows are written, so nothing is read again to be counted.
    """
    staged, seen = {}, {k: Observation() for k in ("games", "ids", "rows")}
    count = F.count(F.lit(1)).alias("n")

    def stage(df: DataFrame, name: str) -> DataFrame:
        staged[name] = warehouse.stage(df.observe(seen[name], count) if name in seen else df, name)
        return spark.read.schema(df.schema).parquet(staged[name])

    try:
        dumps = {t: stage(read_dump(spark, f"{folder}/{t}.csv", cols, "row_no"), t) for t, cols in DUMP_COLUMNS.items()}
        ids = stage(app_ids(dumps["external_games"]), "ids")
        incoming = stage(catalog_games(dumps, config, now, ids), "rows")
        merge_table(warehouse, "raw.catalog_games", lambda old: upsert_replace(old, incoming, ["igdb_id"]))
        return CatalogMetrics(*(seen[k].get["n"] for k in ("games", "ids", "rows")))
    finally:
        for path in staged.values():
            warehouse.delete(path)


def merge_table(warehouse: Warehouse, table: str, merge: Callable[[DataFrame], DataFrame]) -> int:
    """Publish merge(what the table holds); merged again if another writer has published meanwhile."""
    for attempt in range(ATTEMPTS):
        old = warehouse.snapshot(table)
        try:
            return warehouse.publish(table, merge(old.df), old.version)
        except Conflict:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError("unreachable")


def download_dumps(api: CatalogApi, folder: str, stream: Callable = stream_bytes) -> list[str]:
    """Fetch the dumps that ingest_catalog reads."""
    return [str(download_dump(t, folder, api.locate, stream)) for t in DUMP_COLUMNS]


def census_targets(catalog: DataFrame) -> DataFrame:
    """Distinct known application ids."""
    return catalog.where(F.col("steam_app_id").isNotNull()).select(F.col("steam_app_id").alias("app_id")).distinct()


def ingest_census(warehouse: Warehouse, summaries: DataFrame, now: datetime | None = None) -> int:
    """Upsert the counts of probed applications, keeping the total before; returns how many were probed. Summaries are read once."""
    seen = Observation()
    path = warehouse.stage(summaries.withColumn("checked_at", current_time(now)).observe(seen, F.count(F.lit(1)).alias("n")), "census")
    try:
        incoming = warehouse.spark.read.parquet(path)
        untouched = ["last_backfill_at", "last_seen_timestamp_updated"]
        merge_table(warehouse, "raw.review_census", lambda old: upsert_with_previous(old, incoming, ["app_id"], "total_reviews", "prev_total_reviews", untouched))
        return seen.get["n"]
    finally:
        warehouse.delete(path)


@dataclass
class LoadMetrics:
    reviews_loaded: int = 0
    apps_backfilled: int = 0
    apps_incomplete: int = 0

    @classmethod
    def of(cls, verdicts: DataFrame) -> LoadMetrics:
        n = F.coalesce(F.sum(F.when(F.col("complete"), F.col("fetched"))), F.lit(0))
        return cls(*verdicts.agg(n, F.count_if("complete"), F.count_if(~F.col("complete"))).first())


def load_batch(warehouse: Warehouse, apps: list[tuple[int, int | None]], rows: DataFrame, config: EngineConfig, now: datetime | None) -> LoadMetrics:
    """Load the rows of complete applications and their marks in one transaction; the others leave no trace. The rows are read and written once."""
    stamped = rows.withColumn("loaded_at", current_time(now)).select(*[f.name for f in REVIEWS])
    return LoadMetrics.of(write_load(stamped, review_log(warehouse), new_load_id(), apps, config, now))


def load_streamed(warehouse: Warehouse, app: tuple[int, int | None], pages: PageReader, config: EngineConfig, now: datetime | None) -> LoadMetrics:
    """Load one application by a resumable stream of its pages, published as a whole when its last page is there.

    Micro-batches gather in a folder of the application with the stream's checkpoint; a
    load that ends early goes on there, at the page where it stopped, when it is called
    again. A repeated micro-batch replaces its own files.
    """
    spark, folder = warehouse.spark, f"{warehouse.root}/_stage/app-{app[0]}"

    def keep(batch: DataFrame, number: int) -> None:
        stamped = batch.withColumn("loaded_at", current_time(now)).select(*[f.name for f in REVIEWS])
        stamped.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    while not pages.finished(app, f"{folder}/pages"):
        stream = pages.stream([app], f"{folder}/pages")
        stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(REVIEWS).option("recursiveFileLookup", "true").parquet(f"{folder}/rows")
    verdicts = publish_stage(spark, f"{folder}/rows", review_log(warehouse), new_load_id(), [app], config, now, rows)
    warehouse.delete(folder)
    return LoadMetrics.of(verdicts)


def ingest_reviews(
    spark: SparkSession,
    warehouse: Warehouse,
    read_apps: Callable[[list[tuple[int, int | None]]], DataFrame],
    config: EngineConfig = EngineConfig(),
    now: datetime | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> LoadMetrics:
    """Load every application that was never loaded: none expected, light batches, then heavy ones, each by itself and a few at a time.

    read_apps turns (app, expected total) pairs into review rows; a PageReader can also
    stream the heavy ones, so that they resume. An error in a light batch ends the load,
    with earlier batches kept; an error in a heavy application skips only that one. Rows
    stream through their tasks into files, so memory has a bound without flushes. The
    work list is bounded by the catalog's size, not by the reviews.
    """
    done, lock = LoadMetrics(), threading.Lock()
    pending = work_list(warehouse.read("raw.review_counts"), "last_backfill_at", "total_reviews").withColumn("class", size_class(F.col("total_reviews"), config))
    work = [(r["app_id"], r["total_reviews"], r["class"]) for r in pending.select("app_id", "total_reviews", "class").toLocalIterator()]

    def add(m: LoadMetrics) -> None:
        with lock:
            done.reviews_loaded += m.reviews_loaded
            done.apps_backfilled += m.apps_backfilled
            done.apps_incomplete += m.apps_incomplete

    def load_alone(app: tuple[int, int | None]) -> None:
        try:
            if isinstance(read_apps, PageReader):
                add(load_streamed(warehouse, app, read_apps.shared(config.heavy_workers), config, now))
            else:
                add(load_batch(warehouse, [app], read_apps([app]), config, now))
        except Exception as error:  # the application stays unmarked and is retried by the next run
            print(f"application {app[0]} skipped: {error}")

    empty = [(a, 0) for a, _, c in work if c == "zero"]
    if empty:  # marked without a request
        add(load_batch(warehouse, empty, spark.createDataFrame([], REVIEWS), config, now))
    light = [(a, t) for a, t, c in work if c == "light"]
    for n, i in enumerate(range(0, len(light), config.backfill_batch_size), 1):
        batch = light[i : i + config.backfill_batch_size]
        add(load_batch(warehouse, batch, read_apps(batch), config, now))
        if n % config.pause_every_batches == 0:
            sleep(config.pause_seconds)
    with ThreadPoolExecutor(config.heavy_workers) as pool:
        list(pool.map(load_alone, [(a, t) for a, t, c in work if c == "heavy"]))
    return done


class PageReader:
    """read_apps over the review_pages source; the configuration and options reach its readers.

    lanes is the number of tasks that read side by side. They share the allowed rate with
    the tasks of other reads that run at the same time (`shared`).
    """

    def __init__(self, spark: SparkSession, config: EngineConfig = EngineConfig(), lanes: int | None = None, side_by_side: int = 1, **options):
        spark.dataSource.register(ReviewPages)
        self.spark, self.config, self.given = spark, config, options
        self.lanes, self.side_by_side = lanes or config.light_workers, side_by_side

    def options(self, apps: list) -> dict[str, str]:
        return {"apps": json.dumps([list(a) for a in apps]), "lanes": str(self.lanes), "side_by_side": str(self.side_by_side)} | self.config.as_options() | self.given

    def __call__(self, apps: list) -> DataFrame:
        return self.spark.read.format("review_pages").options(**self.options(apps)).load()

    def shared(self, reads: int) -> PageReader:
        """A reader for one of so many reads at the same time, with a task of its own."""
        return PageReader(self.spark, self.config, 1, reads, **self.given)

    def stream(self, apps: list, state: str) -> DataFrame:
        return self.spark.readStream.format("review_pages").options(state=state, **self.options(apps)).load()

    def finished(self, app: tuple[int, int | None], state: str) -> bool:
        progress = Progress(state)
        return progress.at(app[0], progress.last(app[0]))["done"]


def page_reader(spark: SparkSession, config: EngineConfig = EngineConfig(), **options) -> PageReader:
    return PageReader(spark, config, **options)


def ingest_nodes(spark: SparkSession, config: EngineConfig = EngineConfig(), dumps: str | None = None, now: datetime | None = None, api: CatalogApi | None = None, **options) -> Registry:
    """The loads as nodes of the model graph: dumps to catalog, catalog to counts, counts to reviews.

    dumps: the folder of the catalog's files, downloaded through api first if one is
    given. options go to the review_pages source. A node returns its load's metrics.
    """

    def catalog(warehouse: Warehouse) -> CatalogMetrics:
        if api:
            download_dumps(api, dumps)
        return ingest_catalog(spark, warehouse, dumps, config, now)

    def census(warehouse: Warehouse) -> int:
        targets = census_targets(warehouse.read("raw.catalog_games")).withColumn("total", F.lit(None).cast("bigint"))
        apps = [[r["app_id"], None] for r in targets.orderBy("app_id").toLocalIterator()]  # bounded by the catalog
        return ingest_census(warehouse, page_reader(spark, config, lanes=config.census_workers, mode="summary", **options)(apps), now)

    def reviews(warehouse: Warehouse) -> LoadMetrics:
        return ingest_reviews(spark, warehouse, page_reader(spark, config, **options), config, now)

    return Registry([
        Node("ingest_catalog", "ingest", load=catalog),
        Node("ingest_census", "ingest", load=census, deps=("ingest_catalog",)),
        Node("ingest_reviews", "ingest", load=reviews, deps=("ingest_census",)),
    ])
