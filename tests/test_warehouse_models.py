"""Models as tables of the catalog: stored variants, buckets, SQL text, comments, wiring."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import ingest, models
from millrace.plans.application import from_environment
from millrace.plans.models import highlight_sql_node, review, review_document, review_models
from millrace.plans.registry import sql_node
from millrace.plans.stand_ins import CONFIG, review_rows, stand_in_warehouse
from millrace.session import EngineConfig
from tests.test_ingest import DUMPS, review_json
from tests.test_review_models import payload, reviews

SF = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def flat(df):
    as_text = {f.name: F.to_json(f.name) for f in df.schema if f.dataType.simpleString() == "variant"}
    return sorted(map(tuple, df.withColumns(as_text).collect()), key=str)


def test_variant_and_text_give_the_same_reviews(spark, documents, tmp_path):
    raw = review_rows(documents).union(
        reviews(
            spark,
            (1, 5, 86399, {"votes_funny": 4294967295, "author": None, "review": None, "refunded": "true"}),
            (2, 5, 0, {"votes_up": "7", "weighted_vote_score": 0.12345, "reactions": None, "app_release_date": 3}),
            (3, 5, 0, {"author": {"steamid": "76561198000000000", "playtime_forever": None}, "review": 'é "q" \\ \n ☐', "reactions": {"a": [1, {"b": None}]}}),
        ).select("recommendation_id", "app_id", "payload", "timestamp_created", "timestamp_updated", "loaded_at")
    )
    raw.write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    review_document(raw).write.parquet(f"{tmp_path}/doc")
    stored = spark.read.parquet(f"{tmp_path}/doc")
    assert stored.schema["document"].dataType.simpleString() == "variant"
    assert flat(review(stored)) == flat(review(raw))


def test_a_malformed_payload_raises(spark):
    row = spark.createDataFrame([(1, 1, '{"a": ', 0, 0, dt.datetime(2024, 1, 1))], schemas.REVIEWS)
    with pytest.raises(Exception, match="MALFORMED"):
        review_document(row).collect()


def test_only_used_fields_of_a_variant_are_read(spark, documents, tmp_path):
    review_document(review_rows(documents)).write.parquet(f"{tmp_path}/doc")
    plan = review(spark.read.parquet(f"{tmp_path}/doc")).select("app_id", "votes_up")._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :]
    assert "struct" in read and "variant" not in read.replace("variant_get", "")


def test_marts_join_by_buckets(spark, documents):
    graph = review_models(CONFIG)
    w = stand_in_warehouse(spark, documents, graph.select("+review_highlight") | graph.select("+game_stats"))
    graph.run(w)
    t = lambda name: spark.table(graph.nodes[name].table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan(models.game_stats(t("game"), t("game_review_count"), t("review_agg")))
        shown = plan(models.review_highlight(t("review"), CONFIG))
        # only the narrow rows move, a few per group; the wide side is read in the buckets of the join's key
        assert shown.count("Exchange hashpartitioning") == 2 and shown.count("Bucketed: true") >= 1
        wide = shown[shown.rindex("FileScan") :]
        assert "Bucketed: true" in wide and "review_text" in wide
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # every model by its name, with its comments
    about = {n.name: {r["col_name"]: r["comment"] or r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {n.table}").collect()} for n in graph.nodes.values() if n.build}
    assert len(about) == 8 and about["game_stats"]["Comment"] == "a row per catalog entry with its figures"
    assert about["review_highlight"]["rank_in_game"] == "1 is the best" and about["game"]["igdb_id"] == "catalog key"
    assert spark.sql("SELECT count(*) FROM marts.game_stats WHERE total_reviews IS NOT NULL").first()[0] > 0
    # one mart both ways
    graph.nodes["review_highlight"] = highlight_sql_node(config=CONFIG)
    one = flat(t("review_highlight"))
    assert graph.run(w, "review_highlight").built == ["review_highlight"] and flat(t("review_highlight")) == one != []


def test_sql_models(spark):
    node = sql_node("x", "gold", "SELECT a.k, :n + 1 AS n FROM {one} a JOIN {two} b ON a.k = b.k JOIN {one} c ON c.k = a.k", {"n": 4})
    assert node.deps == ("one", "two")
    frames = {"one": spark.range(3).toDF("k"), "two": spark.range(2, 9).toDF("k")}
    assert [tuple(r) for r in node.build(frames).collect()] == [(2, 5)]
    with pytest.raises(ValueError):
        sql_node("x", "gold", "SELECT 1")


def test_each_dump_is_read_once(spark, tmp_path, monkeypatch):
    for name, text in DUMPS.items():
        (tmp_path / f"{name}.csv").write_text(text)
    w = ingest.open_warehouse(spark, f"file://{tmp_path}/wh")
    read = []
    monkeypatch.setattr(ingest, "read_dump", lambda s, path, *a, real=ingest.read_dump: read.append(path) or real(s, path, *a).withColumn("_seen", F.lit(1)).drop("_seen"))
    m = ingest.ingest_catalog(spark, w, str(tmp_path))
    assert len(read) == 6 and (m.games_in_dump, m.games_with_steam_app_id, m.rows_upserted) == (4, 3, 3)
    assert not list((tmp_path / "wh/_stage").iterdir())
    from millrace.sources.index import lookup

    assert [r["igdb_id"] for r in lookup(w, "raw.catalog_games", "genres", ["Three"]).collect()] == [1]
    assert [r["igdb_id"] for r in lookup(w, "raw.catalog_games", "steam_app_id", [50]).collect()] == [5]


def test_application_from_the_environment(spark, tmp_path):
    for name, text in DUMPS.items():
        (tmp_path / f"{name}.csv").write_text(text)
    recorded = {"pages": {"11": {"*": {"reviews": [review_json(1, 1)], "cursor": "b"}}}, "summaries": {"11": {"query_summary": {"total_reviews": 1, "total_positive": 1}}}}
    env = {"MILLRACE_WAREHOUSE": f"file://{tmp_path}/wh", "MILLRACE_DUMPS": str(tmp_path), "MILLRACE_HTTP_MIN_INTERVAL_SECONDS": "0", "MILLRACE_STOP_BACKOFF_BASE_SECONDS": "0", "MILLRACE_TOP_N_REVIEWS": "5"}
    app = from_environment(spark, env, client="millrace.sources.review_pages:RecordedClient", **{"client.data": json.dumps(recorded)})
    assert app.config == EngineConfig(http_min_interval_seconds=0.0, stop_backoff_base_seconds=0.0, top_n_reviews=5)
    report = app.run("+game_stats")
    assert report.loaded["ingest_reviews"].reviews_loaded == 1 and "game_stats" in report.built
    with pytest.raises(KeyError, match="WAREHOUSE"):
        from_environment(spark, {})
    with pytest.raises(KeyError, match="belong together"):
        from_environment(spark, env | {"MILLRACE_CATALOG_CLIENT_ID": "x"})


def test_payload_helper_is_whole():
    assert {p.split(".")[0] for p, _, _ in schemas.PAYLOAD_FIELDS} >= set(json.loads(payload())) - {"recommendationid"}
