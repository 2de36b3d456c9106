"""Declared schemas of the raw tables and the review payload."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, B = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
TS, D = T.TimestampType(), T.DateType()


def _table(*columns: tuple) -> T.StructType:
    """(name, type, nullable, comment) tuples to a schema whose comments stay as field metadata."""
    return T.StructType([T.StructField(n, t, nullable, {"comment": c}) for n, t, nullable, c in columns])


CATALOG_GAMES = _table(
    ("igdb_id", L, False, "catalog key"),
    ("steam_app_id", L, True, "store application id"),
    ("name", S, True, "display name"),
    ("first_release_date", D, True, "first release"),
    ("genres", T.ArrayType(S), True, "ordered distinct genre names"),
    ("developers", T.ArrayType(S), True, "ordered distinct developer names"),
    ("publishers", T.ArrayType(S), True, "ordered distinct publisher names"),
    ("cover_url", S, True, "cover image"),
    ("loaded_at", TS, False, "load time"),
)

REVIEW_COUNTS = _table(
    ("app_id", L, False, "store application id"),
    ("total_reviews", L, True, "reviews at the last census"),
    ("total_positive", L, True, "positive reviews at the last census"),
    ("total_negative", L, True, "negative reviews at the last census"),
    ("review_score", I, True, "score class"),
    ("review_score_desc", S, True, "score label"),
    ("checked_at", TS, False, "census time"),
    ("prev_total_reviews", L, True, "reviews at the census before"),
    ("last_backfill_at", TS, True, "time of the complete load"),
    ("last_seen_timestamp_updated", L, True, "monotone watermark, epoch seconds"),
)

REVIEWS = _table(
    ("recommendation_id", L, False, "review id, unique within an application at most"),
    ("app_id", L, False, "store application id"),
    ("payload", S, False, "review document, JSON text"),
    ("timestamp_created", L, True, "epoch seconds"),
    ("timestamp_updated", L, False, "epoch seconds"),
    ("loaded_at", TS, False, "load time"),
)

#: Tables that are replaced as a whole, with their comments. The reviews are a log: see sources/loads.py.
RAW_TABLES = {"catalog_games": (CATALOG_GAMES, "games of the external catalog"), "review_census": (REVIEW_COUNTS, "counts of the last census")}

#: Columns read from each catalog dump; all arrive as text.
DUMP_COLUMNS = {
    "external_games": ["game", "uid", "category", "external_game_source"],
    "genres": ["id", "name"],
    "companies": ["id", "name"],
    "involved_companies": ["id", "company", "developer", "publisher"],
    "covers": ["id", "image_id"],
    "games": ["id", "name", "genres", "involved_companies", "cover", "first_release_date"],
}

#: Payload path, output column, output type. "wrapped" is an unsigned 32-bit
#: number to be read as signed; "epoch" and "epoch_real" are seconds.
PAYLOAD_FIELDS = [
    ("author.steamid", "author_steamid", "bigint"),
    ("author.personaname", "author_personaname", "string"),
    ("author.profile_url", "author_profile_url", "string"),
    ("author.avatar", "author_avatar", "string"),
    ("author.persona_status", "author_persona_status", "string"),
    ("author.num_games_owned", "author_num_games_owned", "int"),
    ("author.num_reviews", "author_num_reviews", "int"),
    ("author.playtime_forever", "author_playtime_forever_minutes", "int"),
    ("author.playtime_at_review", "author_playtime_at_review_minutes", "int"),
    ("author.playtime_last_two_weeks", "author_playtime_last_two_weeks_minutes", "int"),
    ("author.last_played", "author_last_played_at", "epoch"),
    ("review", "review_text", "string"),
    ("language", "language", "string"),
    ("voted_up", "voted_up", "boolean"),
    ("votes_up", "votes_up", "int"),
    ("votes_funny", "votes_funny", "wrapped"),
    ("weighted_vote_score", "weighted_vote_score", "decimal(38,20)"),
    ("comment_count", "comment_count", "int"),
    ("steam_purchase", "steam_purchase", "boolean"),
    ("received_for_free", "received_for_free", "boolean"),
    ("written_during_early_access", "written_during_early_access", "boolean"),
    ("primarily_steam_deck", "primarily_steam_deck", "boolean"),
    ("refunded", "refunded", "boolean"),
    ("app_release_date", "app_release_date", "epoch_real"),
    ("reactions", "reactions", "json"),
]
