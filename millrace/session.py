"""Session settings, engine configuration and an injectable clock."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true",  # tables with different numbers of buckets still join without a shuffle
    "spark.sql.variant.allowDuplicateKeys": "true",  # the last of repeated keys wins, as in the loader
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans rely on to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "millrace") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, pass your own to configure()."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def activate(spark: SparkSession) -> SparkSession:
    """Make a session this thread's active one: writers look up Python data sources there, and threads of a pool have none."""
    SparkSession._get_j_spark_session_class(spark._jvm).setActiveSession(spark._jsparkSession)
    return spark


def current_time(now: datetime | None = None) -> Column:
    """Load time: the query's clock, or a fixed instant for reproducible runs."""
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


@dataclass(frozen=True)
class EngineConfig:
    """Tunable values of the models and loaders.

    The defaults are fixed values that decide results (thresholds, template,
    retry schedule); from_env() overrides them with MILLRACE_<FIELD> variables.
    Row batches of the loaders (catalog, census, page flushes) have no setting:
    partitions and streamed readers take their place. as_options() hands the values
    to a data source, whose readers run elsewhere.
    """

    min_review_length: int = 20
    min_playtime_minutes: int = 120
    top_n_reviews: int = 30
    heavy_review_threshold: int = 10000
    stop_tolerance_min: int = 50
    stop_tolerance_ratio: float = 0.15
    stop_max_retries: int = 6
    stop_backoff_base_seconds: float = 5.0
    http_min_interval_seconds: float = 0.1
    http_max_retries: int = 5
    http_backoff_base_seconds: float = 2.0
    page_size: int = 100
    page_order: str = "updated"
    review_language: str = "all"
    backfill_batch_size: int = 100
    light_workers: int = 5
    heavy_workers: int = 5
    census_workers: int = 8
    pages_per_batch: int = 1000
    pause_every_batches: int = 10
    pause_seconds: float = 120.0
    duplicate_error_threshold: int = 10000
    checklist_glyphs: str = "✅☐"
    review_api_url: str = "https://store.steampowered.com/appreviews"
    catalog_api_url: str = "https://api.igdb.com/v4"
    catalog_token_url: str = "https://id.twitch.tv/oauth2/token"
    cover_url_template: str = "https://images.igdb.com/igdb/image/upload/t_cover_big/{image_id}.jpg"

    def as_options(self) -> dict[str, str]:
        return {f"config.{f.name}": str(getattr(self, f.name)) for f in fields(self)}

    @classmethod
    def from_options(cls, options: dict[str, str]) -> EngineConfig:
        """The values among a data source's options, whose names may have lost their case."""
        low = {k.lower(): v for k, v in options.items()}
        return cls.from_env({f.name.upper(): low[f"config.{f.name}"] for f in fields(cls) if f"config.{f.name}" in low}, prefix="")

    @classmethod
    def from_env(cls, environ: dict[str, str] | None = None, prefix: str = "MILLRACE_") -> EngineConfig:
        env = os.environ if environ is None else environ
        given = {}
        for f in fields(cls):
            raw = env.get(prefix + f.name.upper())
            if raw is not None:
                given[f.name] = type(f.default)(raw)
        return cls(**given)
