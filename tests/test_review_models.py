"""Edge cases of the review models, worked out by hand (FIXTURES.md section 4)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import models
from millrace.session import EngineConfig

NOW = dt.datetime(2024, 1, 1)


def payload(**over):
    base = {
        "author": {"steamid": "7", "personaname": "Ann", "playtime_forever": 10, "playtime_at_review": 500, "last_played": 86400},
        "review": "a review that is long enough to count",
        "language": "english",
        "voted_up": True,
        "votes_up": 3,
        "votes_funny": 0,
        "weighted_vote_score": "0.5",
        "primarily_steam_deck": False,
        "refunded": None,
        "app_release_date": 1.1234567,
        "reactions": {"b": 1, "a": [2]},
    }
    return json.dumps(base | over)


def reviews(spark, *rows):
    """rows: (id, app, created, overrides)"""
    data = [(i, a, payload(**o), c, c, NOW) for i, a, c, o in rows]
    return spark.createDataFrame(data, schemas.REVIEWS)


def test_payload_typing(spark):
    got = models.review(reviews(spark, (1, 5, 86399, {"votes_funny": 4294967295}), (2, 5, 86400, {"votes_funny": 2147483648, "author": None, "review": None}), (3, 5, 0, {"votes_funny": 2147483647, "review": "☐ no ✅"})))
    r = {x["recommendation_id"]: x for x in got.withColumn("reactions", F.to_json("reactions")).collect()}
    assert [r[i]["votes_funny"] for i in (1, 2, 3)] == [-1, -2147483648, 2147483647]
    assert r[1]["author_steamid"] == 7 and r[2]["author_steamid"] is None
    assert r[2]["review_text_length"] is None and r[2]["is_generic"] is False and r[3]["is_generic"] is True
    assert r[1]["app_release_date"].microsecond == 123457
    assert json.loads(r[1]["reactions"]) == {"a": [2], "b": 1}
    assert str(r[1]["weighted_vote_score"]).startswith("0.5")
    assert r[1]["author_last_played_at"] == dt.datetime(1970, 1, 2) or r[1]["author_last_played_at"].timestamp() == 86400
    assert len(got.columns) == 32


def test_overflow_raises(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW|NumberFormat|CAST_INVALID"):
        models.review(reviews(spark, (1, 5, 0, {"votes_up": 2147483648}))).collect()


def test_trend_counts_unknown_votes_in_the_total_only(spark):
    rows = reviews(spark, (1, 5, 86399, {"voted_up": True}), (2, 5, 10, {"voted_up": False}), (3, 5, 20, {"voted_up": None}), (4, 5, 86400, {}))
    got = models.daily_trend(models.review(rows), "app_id", "created_at", "voted_up").orderBy("review_date").collect()
    assert [tuple(x)[2:] for x in got] == [(3, 1, 1, 0.3333), (1, 1, 0, 1.0)]
    assert [x["review_date"] for x in got] == [dt.date(1970, 1, 1), dt.date(1970, 1, 2)]


def test_median_and_known_flags(spark):
    times = [1, 2, 10, 11, None]
    refunds = [True, False, None, None, None]
    rows = reviews(spark, *[(i, 5, 0, {"author": {"playtime_forever": t}, "refunded": f}) for i, (t, f) in enumerate(zip(times, refunds))])
    [got] = models.review_agg(models.review(rows)).collect()
    assert got["median_playtime_forever_minutes"] == 6.0 and float(got["pct_refunded"]) == 0.5


def test_highlight_bounds_order_and_duplicates(spark):
    def one(i, minutes=121, text="x" * 21, score="0.1", app=1):
        return (i, app, 0, {"author": {"playtime_at_review": minutes}, "review": text, "weighted_vote_score": score})

    rows = [one(1, minutes=120), one(2, text="x" * 20), one(3), one(4, score=None)]
    rows += [one(5, app=2)] * 2 + [one(100 + i, app=3) for i in range(31)]
    got = models.review_highlight(models.review(reviews(spark, *rows))).collect()
    by = {a: sorted((x["rank_in_game"], x["recommendation_id"]) for x in got if x["app_id"] == a) for a in (1, 2, 3)}
    assert by[1] == [(1, 4), (2, 3)]
    assert len(by[2]) == 4
    assert [r for r, _ in by[3]] == list(range(1, 31))


def test_stats(spark):
    games = spark.createDataFrame(
        [(1, 10, "A", None, [], [], [], None, NOW), (2, 10, "B", None, [], [], [], None, NOW), (3, 20, "C", None, [], [], [], None, NOW), (4, 30, "D", None, [], [], [], None, NOW)],
        schemas.CATALOG_GAMES,
    )
    counts = spark.createDataFrame([(10, 2000, 571, 0, 8, "x", NOW, None, None, None), (20, 0, 0, 0, 0, "x", NOW, None, None, None)], schemas.REVIEW_COUNTS)
    agg = models.review_agg(models.review(reviews(spark, (1, 10, 0, {"refunded": True}), (2, 10, 0, {"refunded": False}))))
    got = {x["igdb_id"]: x for x in models.game_stats(models.game(games), models.game_review_count(counts), agg).collect()}
    assert got[1]["pct_positive_reviews"] == got[2]["pct_positive_reviews"] == 28.6
    assert got[1]["pct_refunded"] == 50.0 and got[1]["total_reviews"] == 2000
    assert got[3]["pct_positive_reviews"] is None and got[3]["total_reviews"] == 0
    assert got[4]["total_reviews"] is None and got[4]["median_playtime_forever_minutes"] is None


def test_config_from_env():
    c = EngineConfig.from_env({"MILLRACE_TOP_N_REVIEWS": "5", "MILLRACE_STOP_TOLERANCE_RATIO": "0.2"})
    assert (c.top_n_reviews, c.stop_tolerance_ratio, c.min_review_length) == (5, 0.2, 20)
