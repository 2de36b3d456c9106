"""The layered models: typed staging, per-application aggregates and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.json_fields import typed_fields, variant_fields
from millrace.functions.numeric import exact_ratio, flag_rate
from millrace.functions.text import char_length, has_any_glyph
from millrace.operators.quality import Check
from millrace.operators.ranking import top_n_wide
from millrace.plans.registry import Node, Registry, database_for, sql_node
from millrace.schemas import PAYLOAD_FIELDS
from millrace.session import EngineConfig
from millrace.sources.tables import Layout


def renamed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])


def game(catalog: DataFrame) -> DataFrame:
    same = ["first_release_date", "genres", "developers", "publishers", "cover_url"]
    return renamed(catalog, {"igdb_id": "igdb_id", "steam_app_id": "steam_app_id", "name": "game_name"} | {c: c for c in same})


def game_review_count(counts: DataFrame) -> DataFrame:
    same = ["total_reviews", "total_positive", "total_negative", "review_score", "review_score_desc", "checked_at", "prev_total_reviews", "last_backfill_at"]
    return renamed(counts, {"app_id": "steam_app_id"} | {c: c for c in same})


def review_document(reviews: DataFrame) -> DataFrame:
    """Reviews with their payload parsed once, as VARIANT; a malformed payload raises."""
    return reviews.select("recommendation_id", "app_id", F.parse_json("payload").alias("document"), "timestamp_created", "timestamp_updated", "loaded_at")


def review(reviews: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Typed reviews with two derived columns, so later models need not read the text. From raw reviews, or from review_document."""
    times = [
        F.timestamp_seconds("timestamp_created").alias("created_at"),
        F.timestamp_seconds("timestamp_updated").alias("updated_at"),
    ]
    carried = ["recommendation_id", "app_id", "created_at", "updated_at", "loaded_at"]
    base = reviews.withColumns({"created_at": times[0], "updated_at": times[1]})
    parsed = "document" in reviews.columns
    typed = (variant_fields if parsed else typed_fields)(base, "document" if parsed else "payload", PAYLOAD_FIELDS, [F.col(c) for c in carried])
    payload = [name for _, name, _ in PAYLOAD_FIELDS]
    return typed.select(
        *carried[:2],
        *payload,
        *carried[2:],
        char_length(F.col("review_text")).alias("review_text_length"),
        has_any_glyph(F.col("review_text"), config.checklist_glyphs).alias("is_generic"),
    )


def median_and_rates(df: DataFrame, key: str, value: str, flags: dict[str, str]) -> DataFrame:
    """Exact interpolated median of a value and trues/known counters of nullable flags, in one aggregate."""
    counters = []
    for flag, name in flags.items():
        trues, known = flag_rate(F.col(flag))
        counters += [trues.alias(f"{name}_true"), known.alias(f"{name}_known")]
    return df.groupBy(key).agg(F.median(value).alias("median_value"), *counters)


def review_agg(typed: DataFrame) -> DataFrame:
    """Per application: median playtime and shares of two flags over their known values.

    The shares come from exact sums; the marts round them from the decimal.
    """
    parts = median_and_rates(
        typed, "app_id", "author_playtime_forever_minutes", {"primarily_steam_deck": "deck", "refunded": "refunded"}
    )

    def share(name: str) -> Column:
        return exact_ratio(F.col(f"{name}_true"), F.col(f"{name}_known"), 16)

    return parts.select(
        F.col("app_id").alias("steam_app_id"),
        F.col("median_value").alias("median_playtime_forever_minutes"),
        share("deck").alias("pct_primarily_steam_deck"),
        share("refunded").alias("pct_refunded"),
    )


def game_stats(games: DataFrame, counts: DataFrame, agg: DataFrame) -> DataFrame:
    """One row per catalog entry; two entries may share an application and both keep its figures."""

    def percent(share: str) -> Column:
        return F.round(F.col(share) * 100, 1).cast("double").alias(share)

    c = counts.select("steam_app_id", "total_reviews", "total_positive", "review_score")
    return (
        games.join(c, "steam_app_id", "left")
        .join(agg, "steam_app_id", "left")
        .select(
            *["igdb_id", "steam_app_id", "game_name", "genres", "developers", "publishers", "cover_url", "first_release_date"],
            "total_reviews",
            exact_ratio(F.col("total_positive"), F.col("total_reviews"), 1, 100).cast("double").alias("pct_positive_reviews"),
            "review_score",
            "median_playtime_forever_minutes",
            percent("pct_primarily_steam_deck"),
            percent("pct_refunded"),
        )
    )


def review_highlight(typed: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Best reviews per application, vote and language: unknown scores rank first, ids break ties.

    The filter runs before the ranking only; the wide side is unfiltered, as a
    repeated key brings all of its rows.
    """
    key = ["recommendation_id", "app_id"]
    eligible = (
        (F.col("author_playtime_at_review_minutes") > config.min_playtime_minutes)
        & (F.col("review_text_length") > config.min_review_length)
        & ~F.col("is_generic")
    )
    order = [F.col("weighted_vote_score").desc_nulls_first(), F.col("votes_up").desc_nulls_first(), F.col("recommendation_id").asc_nulls_last()]
    narrow = typed.where(eligible).select(*key, "language", "voted_up", "votes_up", "weighted_vote_score")
    wide = ["review_text", "language", "voted_up", "votes_up", "votes_funny", "weighted_vote_score", "author_personaname", "author_avatar", "author_profile_url", "author_playtime_at_review_minutes", "author_last_played_at"]
    groups = ["app_id", "voted_up", "language"]
    joined = top_n_wide(narrow, typed.select(*key, *wide), key, groups, order, config.top_n_reviews, "rank_in_game")
    return joined.select("rank_in_game", *key, *wide)


def daily_trend(df: DataFrame, key: str, time: str, vote: str) -> DataFrame:
    """Totals, positives, negatives and the positive share (4 digits) per key and UTC day; an unknown vote only counts in the total."""
    v = F.col(vote)
    counted = df.groupBy(key, F.to_date(time).alias("review_date")).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(v).alias("total_positive"),
        F.count_if(~v).alias("total_negative"),
    )
    share = exact_ratio(F.col("total_positive"), F.col("total_reviews"), 4).cast("double")
    return counted.withColumn("pct_positive", share)


def _not_null(table: str, *columns: str) -> tuple[Check, ...]:
    return tuple(Check(table, "not_null", (c,)) for c in columns)


#: review_highlight as SQL text; the values come from the configuration.
HIGHLIGHT_SQL = """WITH ranked AS (
    SELECT recommendation_id, app_id, row_number() OVER (PARTITION BY app_id, voted_up, language
        ORDER BY weighted_vote_score DESC NULLS FIRST, votes_up DESC NULLS FIRST, recommendation_id ASC NULLS LAST) AS rank_in_game
    FROM {review} WHERE author_playtime_at_review_minutes > :min_playtime AND review_text_length > :min_length AND NOT is_generic)
SELECT rank_in_game, r.recommendation_id, r.app_id, review_text, language, voted_up, votes_up, votes_funny, weighted_vote_score,
    author_personaname, author_avatar, author_profile_url, author_playtime_at_review_minutes, author_last_played_at
FROM ranked k JOIN {review} r ON r.recommendation_id = k.recommendation_id AND r.app_id = k.app_id WHERE rank_in_game <= :top_n"""


def highlight_sql_node(layer: str = "marts", config: EngineConfig = EngineConfig(), name: str = "review_highlight") -> Node:
    values = {"min_playtime": config.min_playtime_minutes, "min_length": config.min_review_length, "top_n": config.top_n_reviews}
    return sql_node(name, layer, HIGHLIGHT_SQL, values, doc=DOCS["review_highlight"][0], columns=DOCS["review_highlight"][1])


#: Comments of the models and of the columns that they make; columns that they carry keep theirs.
DOCS: dict[str, tuple[str, dict[str, str]]] = {
    "game": ("games of the catalog, renamed", {"game_name": "display name"}),
    "game_review_count": ("counts of the last census per application", {}),
    "review_document": ("reviews with the payload parsed once", {"document": "review document"}),
    "review": ("typed reviews", {
        "created_at": "first written", "updated_at": "last written", "review_text": "text", "language": "language of the text", "voted_up": "recommends the game",
        "weighted_vote_score": "helpfulness, exact", "votes_funny": "wraps at 2^31", "review_text_length": "characters", "is_generic": "a filled checklist form",
    }),
    "review_agg": ("aggregates of the reviews per application", {
        "steam_app_id": "store application id", "median_playtime_forever_minutes": "exact, interpolated", "pct_primarily_steam_deck": "share of the known values", "pct_refunded": "share of the known values",
    }),
    "game_stats": ("a row per catalog entry with its figures", {
        "pct_positive_reviews": "percent, one digit", "median_playtime_forever_minutes": "minutes", "pct_primarily_steam_deck": "percent of known values", "pct_refunded": "percent of known values",
    }),
    "review_highlight": ("best reviews per application, vote and language", {"rank_in_game": "1 is the best"}),
    "game_review_trend_daily": ("reviews per application and UTC day", {"review_date": "day of writing", "total_reviews": "all reviews", "total_positive": "votes up", "total_negative": "votes down", "pct_positive": "share, four digits"}),
}
#: Tables that join by application share its buckets; the wide side of the highlights lies in the buckets of its key.
BY_APP, BY_REVIEW = Layout(bucket_by=("steam_app_id",)), Layout(bucket_by=("recommendation_id", "app_id"), buckets=0)


def review_models(config: EngineConfig = EngineConfig(), databases: dict[str, str] | None = None) -> Registry:
    """All layers over the three raw tables; raw nodes carry the source checks. databases renames the database of a layer's folder."""
    pair = ("recommendation_id", "app_id")
    staging, intermediate, marts = (database_for(folder, (databases or {}).get(folder)) for folder in ("staging", "intermediate", "marts"))

    def model(name: str, layer: str, build, deps: tuple[str, ...], checks: tuple[Check, ...] = (), layout: Layout | None = None) -> Node:
        return Node(name, layer, build, deps, checks, doc=DOCS[name][0], columns=DOCS[name][1], layout=layout)

    return Registry(
        [
            Node("catalog_games", "raw", produced_by="ingest_catalog", checks=(Check("catalog_games", "unique", ("igdb_id",)), *_not_null("catalog_games", "igdb_id"))),
            Node("review_counts", "raw", produced_by="ingest_census", checks=(Check("review_counts", "unique", ("app_id",)), *_not_null("review_counts", "app_id"))),
            Node("reviews", "raw", produced_by="ingest_reviews", checks=(Check("reviews", "unique_combination", pair, severity="warn"), *_not_null("reviews", *pair, "timestamp_updated"))),
            model("game", staging, lambda d: game(d["catalog_games"]), ("catalog_games",), layout=BY_APP),
            model("game_review_count", staging, lambda d: game_review_count(d["review_counts"]), ("review_counts",), layout=BY_APP),
            model("review_document", staging, lambda d: review_document(d["reviews"]), ("reviews",)),
            model(
                "review",
                staging,
                lambda d: review(d["review_document"], config),
                ("review_document",),
                (
                    Check("review", "unique_combination", pair, error_above=config.duplicate_error_threshold),
                    *_not_null("review", *pair, "is_generic", "voted_up", "created_at", "updated_at"),
                ),
                BY_REVIEW,
            ),
            model("review_agg", intermediate, lambda d: review_agg(d["review"]), ("review",), layout=BY_APP),
            model("game_stats", marts, lambda d: game_stats(d["game"], d["game_review_count"], d["review_agg"]), ("game", "game_review_count", "review_agg")),
            model("review_highlight", marts, lambda d: review_highlight(d["review"], config), ("review",)),
            model("game_review_trend_daily", marts, lambda d: daily_trend(d["review"], "app_id", "created_at", "voted_up"), ("review",)),
        ]
    )
