"""Raw tables made from `documents`, so that the whole warehouse runs at any size, with the same rows in SQL.

A document is a review, whole text included; a third of all reviews belong to one
application. Every fifth document is also a catalog entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.upsert import upsert_replace
from millrace.plans.ingest import merge_table, open_warehouse, review_log
from millrace.plans.models import highlight_sql_node, review_models
from millrace.schemas import CATALOG_GAMES, REVIEW_COUNTS, REVIEWS
from millrace.session import EngineConfig
from millrace.sources.loads import new_load_id, publish_stage
from millrace.sources.scratch import new_path
from millrace.sources.tables import Warehouse

#: The application of a document, in both dialects.
APP = "CASE WHEN doc_id % 3 = 0 THEN 7 ELSE doc_id % 2000 END"
LOADED = "TIMESTAMP '2024-02-01 00:00:00'"
#: Highlights of the stand-ins are few per group.
CONFIG = EngineConfig(top_n_reviews=3)


def catalog_rows(documents: DataFrame) -> DataFrame:
    return documents.where("doc_id % 5 = 0").selectExpr(
        "doc_id AS igdb_id",
        f"CASE WHEN doc_id % 11 > 0 THEN CAST({APP} AS BIGINT) END AS steam_app_id",
        "concat(source, ' ', doc_id) AS name",
        "CASE WHEN doc_id % 7 > 0 THEN date_add(DATE '2000-01-01', CAST(doc_id % 9000 AS INT)) END AS first_release_date",
        "array(lang, concat('c', n_chars % 1000)) AS genres",
        "array(source) AS developers",
        "CAST(array() AS array<string>) AS publishers",
        "CASE WHEN doc_id % 3 > 0 THEN concat('https://img.example/', doc_id, '.jpg') END AS cover_url",
        f"{LOADED} AS loaded_at",
    )


def count_rows(documents: DataFrame) -> DataFrame:
    counted = documents.groupBy(F.expr(f"CAST({APP} AS BIGINT)").alias("app_id")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("n_chars % 4 > 0")).alias("pos"))
    return counted.where("app_id % 17 > 0").selectExpr(
        "app_id", "CASE WHEN app_id % 13 > 0 THEN n ELSE 0 END AS total_reviews", "pos AS total_positive", "n - pos AS total_negative", "CAST(app_id % 10 AS INT) AS review_score",
        "concat('score ', app_id % 10) AS review_score_desc", f"{LOADED} AS checked_at", "CAST(NULL AS BIGINT) AS prev_total_reviews", "CAST(NULL AS TIMESTAMP) AS last_backfill_at", "CAST(NULL AS BIGINT) AS last_seen_timestamp_updated",
    )


def review_rows(documents: DataFrame) -> DataFrame:
    """Raw reviews; every 997th comes twice."""
    e = F.expr
    author = F.struct(
        e("CAST(doc_id * 7 AS STRING)").alias("steamid"), e("concat('user ', doc_id % 900)").alias("personaname"), e("CASE WHEN doc_id % 4 > 0 THEN concat('https://u.example/', doc_id) END").alias("profile_url"),
        e("concat('a', doc_id % 50)").alias("avatar"), e("CASE WHEN doc_id % 2 = 0 THEN 'online' ELSE 'offline' END").alias("persona_status"), e("doc_id % 300").alias("num_games_owned"), e("doc_id % 9").alias("num_reviews"),
        e("CASE WHEN doc_id % 19 > 0 THEN doc_id * 7919 % 100003 END").alias("playtime_forever"), e("doc_id * 31 % 1000").alias("playtime_at_review"), e("doc_id % 5").alias("playtime_last_two_weeks"), e("1600000000 + doc_id * 3600").alias("last_played"),
    )
    body = F.struct(
        author.alias("author"), e("concat(coalesce(text, ''), CASE WHEN doc_id % 23 = 0 THEN ' ☐' ELSE '' END)").alias("review"), F.col("lang").alias("language"), e("n_chars % 3 > 0").alias("voted_up"),
        e("doc_id % 100").alias("votes_up"), e("doc_id * 2654435761 % 4294967296").alias("votes_funny"), e("CASE WHEN doc_id % 29 > 0 THEN concat('0.', lpad(CAST(doc_id * 7919 % 100000 AS STRING), 5, '0')) END").alias("weighted_vote_score"),
        e("doc_id % 4").alias("comment_count"), e("doc_id % 2 = 0").alias("steam_purchase"), e("doc_id % 3 = 0").alias("received_for_free"), e("doc_id % 5 = 0").alias("written_during_early_access"),
        e("CASE WHEN doc_id % 8 > 0 THEN doc_id % 6 = 0 END").alias("primarily_steam_deck"), e("CASE WHEN doc_id % 10 > 0 THEN doc_id % 7 = 0 END").alias("refunded"), e("CAST(doc_id * 8639 AS DOUBLE) + 0.25D").alias("app_release_date"), F.struct(e("doc_id % 3").alias("k")).alias("reactions"),
    )
    rows = documents.select(
        F.col("doc_id").alias("recommendation_id"), e(f"CAST({APP} AS BIGINT)").alias("app_id"), F.to_json(body).alias("payload"), e("1500000000 + doc_id * 977").alias("timestamp_created"), e("1500000000 + doc_id * 977 + doc_id % 1000").alias("timestamp_updated"), e(LOADED).alias("loaded_at"),
    )
    twice = F.explode(F.when(F.col("recommendation_id") % 997 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("_copy", twice).drop("_copy")


def stand_in_warehouse(spark: SparkSession, documents: DataFrame, need: set[str]) -> Warehouse:
    """A new warehouse in the shared folder with those raw tables that a model needs; reviews are published as one load."""
    w = open_warehouse(spark, new_path(spark, "warehouse"))
    if "catalog_games" in need:
        merge_table(w, "raw.catalog_games", lambda old: upsert_replace(old, catalog_rows(documents).select([f.name for f in CATALOG_GAMES]), ["igdb_id"]))
    if "review_counts" in need:
        merge_table(w, "raw.review_census", lambda old: upsert_replace(old, count_rows(documents).select([f.name for f in REVIEW_COUNTS]), ["app_id"]))
    if "reviews" in need:
        path = w.stage(review_rows(documents).select([f.name for f in REVIEWS]), "reviews")
        publish_stage(spark, path, review_log(w), new_load_id(), [])
    return w


def built(documents: DataFrame, model: str, as_sql: bool = False) -> DataFrame:
    """A model built with all that it depends on, read by its name in the catalog. as_sql: review_highlight from its SQL text."""
    spark, graph = documents.sparkSession, review_models(CONFIG)
    if as_sql:
        graph.nodes["review_highlight"] = highlight_sql_node(config=CONFIG)
    chosen = graph.select(f"+{model}")
    w = stand_in_warehouse(spark, documents, chosen)
    report = graph.run(w, f"+{model}")
    if model not in report.built:
        raise RuntimeError(f"{model} was not built: {[(r.check.name, r.failures) for r in report.checks if r.status == 'error']}")
    return spark.sql(f"SELECT * FROM {graph.nodes[model].table}")


#: The typed reviews in DuckDB SQL, one column each as the model has it.
REVIEW_SQL = f"""review AS (SELECT d.doc_id AS recommendation_id, CAST({APP.replace("doc_id", "d.doc_id")} AS BIGINT) AS app_id, d.doc_id * 7 AS author_steamid, 'user ' || d.doc_id % 900 AS author_personaname,
    CASE WHEN d.doc_id % 4 > 0 THEN 'https://u.example/' || d.doc_id END AS author_profile_url, 'a' || d.doc_id % 50 AS author_avatar, CASE WHEN d.doc_id % 2 = 0 THEN 'online' ELSE 'offline' END AS author_persona_status,
    CAST(d.doc_id % 300 AS INT) AS author_num_games_owned, CAST(d.doc_id % 9 AS INT) AS author_num_reviews, CASE WHEN d.doc_id % 19 > 0 THEN CAST(d.doc_id * 7919 % 100003 AS INT) END AS author_playtime_forever_minutes,
    CAST(d.doc_id * 31 % 1000 AS INT) AS author_playtime_at_review_minutes, CAST(d.doc_id % 5 AS INT) AS author_playtime_last_two_weeks_minutes, make_timestamp((1600000000 + d.doc_id * 3600) * 1000000) AS author_last_played_at,
    coalesce(d.text, '') || CASE WHEN d.doc_id % 23 = 0 THEN ' ☐' ELSE '' END AS review_text, d.lang AS language, d.n_chars % 3 > 0 AS voted_up, CAST(d.doc_id % 100 AS INT) AS votes_up,
    CAST(CASE WHEN d.doc_id * 2654435761 % 4294967296 > 2147483647 THEN d.doc_id * 2654435761 % 4294967296 - 4294967296 ELSE d.doc_id * 2654435761 % 4294967296 END AS INT) AS votes_funny,
    CASE WHEN d.doc_id % 29 > 0 THEN CAST('0.' || lpad(CAST(d.doc_id * 7919 % 100000 AS VARCHAR), 5, '0') AS DECIMAL(38, 20)) END AS weighted_vote_score, CAST(d.doc_id % 4 AS INT) AS comment_count,
    d.doc_id % 2 = 0 AS steam_purchase, d.doc_id % 3 = 0 AS received_for_free, d.doc_id % 5 = 0 AS written_during_early_access, CASE WHEN d.doc_id % 8 > 0 THEN d.doc_id % 6 = 0 END AS primarily_steam_deck,
    CASE WHEN d.doc_id % 10 > 0 THEN d.doc_id % 7 = 0 END AS refunded, make_timestamp(d.doc_id * 8639 * 1000000 + 250000) AS app_release_date, '{{"k":' || d.doc_id % 3 || '}}' AS reactions,
    make_timestamp((1500000000 + d.doc_id * 977) * 1000000) AS created_at, make_timestamp((1500000000 + d.doc_id * 977 + d.doc_id % 1000) * 1000000) AS updated_at, {LOADED} AS loaded_at
    FROM documents d, (SELECT unnest([0, 1]) AS c) WHERE c = 0 OR d.doc_id % 997 = 0),
    typed AS (SELECT *, CAST(length(review_text) AS INT) AS review_text_length, regexp_matches(review_text, '[✅☐]') AS is_generic FROM review)"""
GAME_SQL = f"""game AS (SELECT doc_id AS igdb_id, CASE WHEN doc_id % 11 > 0 THEN CAST({APP} AS BIGINT) END AS steam_app_id, source || ' ' || doc_id AS game_name,
    CASE WHEN doc_id % 7 > 0 THEN DATE '2000-01-01' + CAST(doc_id % 9000 AS INT) END AS first_release_date, lang || '|c' || n_chars % 1000 AS genres, source AS developers, '' AS publishers,
    CASE WHEN doc_id % 3 > 0 THEN 'https://img.example/' || doc_id || '.jpg' END AS cover_url FROM documents WHERE doc_id % 5 = 0)"""
COUNT_SQL = f"""counts AS (SELECT app_id AS steam_app_id, CASE WHEN app_id % 13 > 0 THEN n ELSE 0 END AS total_reviews, pos AS total_positive, n - pos AS total_negative, CAST(app_id % 10 AS INT) AS review_score, 'score ' || app_id % 10 AS review_score_desc
    FROM (SELECT CAST({APP} AS BIGINT) AS app_id, count(*) AS n, count(*) FILTER (WHERE n_chars % 4 > 0) AS pos FROM documents GROUP BY 1) WHERE app_id % 17 > 0)"""
