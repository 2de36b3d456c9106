import datetime as dt
import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.gating import is_complete, size_class, stop_tolerance, stop_tolerance_value
from millrace.operators.upsert import advance_watermark
from millrace.plans import ingest, models
from millrace.plans.registry import Registry, Node, database_for
from millrace.operators.quality import Check
from millrace.session import EngineConfig
from millrace.sources.dumps import CatalogApi, TokenCache, download_dump
from millrace.sources.http import RateLimiter, get_with_retry
from millrace.sources.index import lookup
from millrace.sources.loads import write_load
from millrace.sources.paging import pages
from millrace.sources.review_pages import Apps, RecordedClient, ReviewApi, ReviewPagesReader
from millrace.sources.tables import Conflict, Layout
from millrace.streaming.review_stream import stream_upsert

#: No pauses.
QUICK = EngineConfig(stop_backoff_base_seconds=0.0, http_min_interval_seconds=0.0, http_backoff_base_seconds=0.0)
NOW, LATER = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


@pytest.fixture
def warehouse(spark, tmp_path):
    return ingest.open_warehouse(spark, f"file://{tmp_path}/wh")


DUMPS = {
    "external_games": 'game,uid,category\n1, 10 ,1\n1,11, 1\n2,20,5\n3,x,1\n4,40,1\n5,50,1\n',
    "genres": "id,name\n1,Old\n1,One\n3,Three\n",
    "companies": "id,name\n7,Seven\n8,Eight\n9,Seven\n",
    "involved_companies": "id,company,developer,publisher\n1,7,t,t\n2,8,f,t\n3,9,t,f\n4,99,t,t\n",
    "covers": "id,image_id\n1,abc\n2,\n",
    "games": 'id,name,genres,involved_companies,cover,first_release_date\n1,"A ""q""\nline","{3,1,9,3}","{2,1,3,4}",1,2020-02-03 00:00:00\n2,B,,,,\n4,,{},,2,\n5,E,{1},{5},,\n',
}


def test_catalog_ingest_and_upsert(spark, warehouse, tmp_path):
    for name, text in DUMPS.items():
        (tmp_path / f"{name}.csv").write_text(text)
    m = ingest.ingest_catalog(spark, warehouse, str(tmp_path), now=NOW)
    assert (m.games_in_dump, m.games_with_steam_app_id, m.rows_upserted) == (4, 3, 3)
    got = {r["igdb_id"]: r for r in warehouse.read("raw.catalog_games").collect()}
    a = got[1]
    assert (a["steam_app_id"], a["name"], a["genres"]) == (11, 'A "q"\nline', ["Three", "One"])
    assert a["developers"] == ["Seven"] and a["publishers"] == ["Eight", "Seven"]
    assert a["cover_url"].endswith("/abc.jpg") and a["first_release_date"] == dt.date(2020, 2, 3)
    b = got[4]
    assert (b["name"], b["genres"], b["cover_url"], b["first_release_date"]) == ("", [], None, None)
    (tmp_path / "games.csv").write_text("id,name,genres,involved_companies,cover,first_release_date\n5,New,,,,\n")
    ingest.ingest_catalog(spark, warehouse, str(tmp_path), now=LATER)
    got = {r["igdb_id"]: r for r in warehouse.read("raw.catalog_games").collect()}
    assert set(got) == {1, 4, 5} and got[5]["name"] == "New" and got[5]["genres"] == []


def census(spark, *rows):
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], "app_id bigint, total_reviews bigint, total_positive bigint, total_negative bigint, review_score int, review_score_desc string")


def test_census_keeps_the_total_before(spark, warehouse):
    for total in (10, 12, None):
        ingest.ingest_census(warehouse, census(spark, (1, total)), NOW)
        [r] = warehouse.read("raw.review_counts").collect()
        assert r["total_reviews"] == total
    assert r["prev_total_reviews"] == 12


def test_watermark_never_falls(spark):
    t = spark.createDataFrame([(1, None, None), (2, 100, None), (3, 5, None)], "k bigint, seen bigint, at string")
    m = spark.createDataFrame([(1, 50), (2, 50)], "k bigint, v bigint")
    got = {r["k"]: (r["seen"], r["at"]) for r in advance_watermark(t, m, "k", "seen", "at", "v", F.lit("now")).collect()}
    assert got == {1: (50, "now"), 2: (100, "now"), 3: (5, None)}


def test_gates(spark):
    df = spark.createDataFrame([(0, 0), (None, 0), (10000, 8500), (10001, 0), (100, 50), (334, 284), (1000, 850), (1000, 849)], "t bigint, f bigint")
    got = df.select(size_class(F.col("t")).alias("c"), stop_tolerance(F.col("t")).alias("s"), is_complete(F.col("t"), F.col("f")).alias("ok")).collect()
    assert [r["c"] for r in got] == ["zero", "light", "light", "heavy", "light", "light", "light", "light"]
    assert [r["s"] for r in got] == [50, 50, 1500, 1500, 50, 50, 150, 150]
    assert [r["ok"] for r in got] == [True, True, True, False, True, True, True, False]
    assert [stop_tolerance_value(t) for t in (None, 100, 334, 1000)] == [50, 50, 50, 150]


def test_pagination():
    page = lambda n, c: {"reviews": [{}] * n, "cursor": c}
    # a page that repeats its cursor is dropped, even with rows
    answers = {"*": page(2, "a"), "a": page(3, "a")}
    assert [len(p) for p in pages(answers.get, None)] == [2]
    # far from the expected total the cursor is replayed, then given up
    slept = []
    assert sum(len(p) for p in pages(answers.get, 1000, sleep=slept.append)) == 2
    assert slept == [5, 10, 20, 40, 80, 160]
    # progress resets the counter
    seen = []

    def flaky(cursor):
        seen.append(cursor)
        if seen.count(cursor) < 3:
            return {}
        return page(100, chr(ord("a") + len(set(seen)))) if len(set(seen)) < 4 else {}

    slept.clear()
    assert sum(len(p) for p in pages(flaky, 310, sleep=slept.append)) == 300
    assert slept == [5, 10] * 3


def test_http_helpers():
    calls, slept = [], []

    def fetch():
        calls.append(1)
        if len(calls) < 4:
            raise ValueError
        return {"ok": 1}

    assert get_with_retry(fetch, sleep=slept.append) == {"ok": 1} and slept == [2, 4, 8]
    with pytest.raises(OSError):
        get_with_retry(lambda: (_ for _ in ()).throw(OSError()), sleep=slept.append)
    assert slept[3:] == [2, 4, 8, 16, 32]
    t, waits = [0.0], []
    limiter = RateLimiter(0.1, lambda: t[0], waits.append)
    for _ in range(3):
        limiter.wait()
    assert waits == pytest.approx([0.1, 0.2])


def test_token_and_download(tmp_path):
    clock, n = [0.0], []
    cache = TokenCache(lambda: n.append(1) or {"access_token": f"t{len(n)}", "expires_in": 100}, lambda: clock[0])
    assert cache.get() == cache.get() == "t1"
    clock[0] = 41
    assert cache.get() == "t2"
    p = download_dump("genres", tmp_path / "new", lambda e: f"signed/{e}", lambda url, size: [url.encode(), b"!"])
    assert p.read_bytes() == b"signed/genres!"
    with pytest.raises(OSError):
        download_dump("games", tmp_path, str, lambda url, size: (_ for _ in ()).throw(OSError()))
    assert not (tmp_path / "games.csv").exists()


def test_dump_addresses_are_asked_for_with_a_token():
    asked = []

    def fetch(url, params=None, headers=None, post=False):
        asked.append((url, params, headers, post))
        return {"access_token": "T"} if post else {"s3_url": "signed"} if url.endswith("games") else {}

    api = CatalogApi("me", "secret", EngineConfig(catalog_api_url="http://c", catalog_token_url="http://t"), fetch)
    assert api.locate("games") == api.locate("games") == "signed"
    assert [a[0] for a in asked] == ["http://t", "http://c/dumps/games", "http://c/dumps/games"]
    assert asked[0][1] == {"client_id": "me", "client_secret": "secret", "grant_type": "client_credentials"}
    assert asked[1][2]["Authorization"] == "Bearer T" and asked[1][2]["Client-ID"] == "me"
    with pytest.raises(ValueError):
        api.locate("none")


def test_review_requests():
    asked = []
    api = ReviewApi(EngineConfig(review_api_url="http://r", page_size=7), lambda url, params: asked.append((url, params)) or {})
    api.page(5, "*"), api.summary(5)
    shared = {"json": 1, "language": "all", "purchase_type": "all", "filter_offtopic_activity": 0}
    assert asked == [("http://r/5", {**shared, "num_per_page": 7, "filter": "updated", "cursor": "*"}), ("http://r/5", {**shared, "num_per_page": 0, "filter": "all"})]


def test_configuration_reaches_readers():
    given = EngineConfig(page_size=9, stop_backoff_base_seconds=0.5, cover_url_template="x{image_id}")
    assert EngineConfig.from_options({k.upper(): v for k, v in given.as_options().items()}) == given
    assert EngineConfig.from_env({"MILLRACE_PAGE_SIZE": "3"}).page_size == 3


class FlakyClient(RecordedClient):
    """Fails twice on every request before it answers."""

    calls = 0

    def page(self, app_id, cursor):
        FlakyClient.calls += 1
        if FlakyClient.calls % 3:
            raise OSError("reset")
        return super().page(app_id, cursor)


def test_reader_retries_and_spaces_requests(monkeypatch):
    data = json.dumps({"pages": {"1": {"*": {"reviews": [review_json(1, 1)], "cursor": "b"}}}, "summaries": {}})
    waited = []
    monkeypatch.setattr("millrace.sources.http.time.sleep", waited.append)
    reader = ReviewPagesReader({"client": "tests.test_ingest:FlakyClient", "client.data": data, "apps": "[[1, null]]", **EngineConfig(http_backoff_base_seconds=2.0, http_min_interval_seconds=5.0).as_options()})
    limits = []
    monkeypatch.setattr("millrace.sources.review_pages.RateLimiter", lambda interval: limits.append(interval))
    assert [r[0] for r in reader.read(Apps([[1, None]], 3))] == [1]
    assert limits == [15.0] and FlakyClient.calls == 6


def test_limiter_keeps_threads_apart():
    from concurrent.futures import ThreadPoolExecutor

    t, passed = [0.0], []

    def sleep(s):
        t[0] += s

    limiter = RateLimiter(0.5, lambda: t[0], sleep)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: limiter.wait() or passed.append(t[0]), range(8)))
    assert t[0] == pytest.approx(3.5)


def review_json(i, ts):
    return {"recommendationid": str(i), "timestamp_created": ts, "timestamp_updated": ts, "voted_up": True, "review": "r"}


def test_review_load_is_all_or_nothing(spark, warehouse, tmp_path):
    recorded = {
        "pages": {
            "1": {"*": {"reviews": [review_json(i, i) for i in range(60)], "cursor": "b"}, "b": {"reviews": [review_json(i, i) for i in range(60, 100)], "cursor": "c"}},
            "2": {"*": {"reviews": [review_json(5, 5)], "cursor": "b"}},
        },
        "summaries": {"1": {"query_summary": {"total_reviews": 110, "total_positive": 100}}},
    }
    client = {"client": "millrace.sources.review_pages:RecordedClient", "client.data": json.dumps(recorded)}
    read = ingest.page_reader(spark, QUICK, **client)
    ingest.ingest_census(warehouse, census(spark, (1, 110), (2, 400), (3, 0), (4, 20000)), NOW)
    m = ingest.ingest_reviews(spark, warehouse, read, QUICK, NOW)
    assert (m.reviews_loaded, m.apps_backfilled, m.apps_incomplete) == (100, 2, 2)
    rows = warehouse.read("raw.reviews")
    assert rows.select("app_id").distinct().collect()[0][0] == 1 and rows.count() == 100
    marks = {r["app_id"]: (r["last_backfill_at"] is not None, r["last_seen_timestamp_updated"]) for r in warehouse.read("raw.review_counts").collect()}
    assert marks == {1: (True, 99), 2: (False, None), 3: (True, 0), 4: (False, None)}
    again = ingest.ingest_reviews(spark, warehouse, read, QUICK, NOW)
    assert again.reviews_loaded == 0 and rows.count() == 100
    log = tmp_path / "wh/raw/review_log"
    assert len(list(log.glob("rows/load=*/part-*.parquet"))) == 2  # the first, empty one and the complete application's; others left nothing
    assert not list(log.glob("*/_pending-*"))
    s = spark.read.format("review_pages").options(**client, apps="[[1, null], [9, null]]", mode="summary").load().orderBy("app_id").collect()
    assert [r["total_reviews"] for r in s] == [110, None]


def loaded(warehouse):
    return sorted((r["app_id"], r["recommendation_id"]) for r in warehouse.read("raw.reviews").collect())


def recorded_pages(*apps, rows=5):
    return json.dumps({"pages": {str(a): {"*": {"reviews": [review_json(i, i) for i in range(rows)], "cursor": "b"}} for a in apps}, "summaries": {}})


def test_a_crash_while_publishing_doubles_nothing(spark, warehouse, tmp_path, monkeypatch):
    read = ingest.page_reader(spark, QUICK, client="millrace.sources.review_pages:RecordedClient", **{"client.data": recorded_pages(1, 2)})
    ingest.ingest_census(warehouse, census(spark, (1, 5), (2, 5)), NOW)
    marks = tmp_path / "wh/raw/review_log/marks"
    marks.chmod(0o500)  # the rows are published, their verdicts can't be: the rows don't count and go with the abort
    if not os.access(marks, os.W_OK):
        with pytest.raises(Exception):
            ingest.ingest_reviews(spark, warehouse, read, QUICK, NOW)
    marks.chmod(0o700)
    assert loaded(warehouse) == []
    # rows of a driver that died between the two renames: nobody sees them
    (tmp_path / "wh/raw/review_log/rows/load=dead").mkdir()
    spark.createDataFrame([(9, 1, "{}", 0, 0, NOW)], schemas.REVIEWS).write.mode("overwrite").parquet(f"{tmp_path}/wh/raw/review_log/rows/load=dead")
    assert loaded(warehouse) == []
    assert ingest.ingest_reviews(spark, warehouse, read, QUICK, NOW).reviews_loaded == 10
    assert len(loaded(warehouse)) == 10 and {r["app_id"] for r in warehouse.read("raw.review_counts").where("last_backfill_at IS NOT NULL").collect()} == {1, 2}
    assert ingest.ingest_reviews(spark, warehouse, read, QUICK, LATER).reviews_loaded == 0
    assert len(loaded(warehouse)) == 10


class DyingClient(RecordedClient):
    """Answers for the first applications, then the task dies."""

    def page(self, app_id, cursor):
        if app_id == 2:
            raise KeyError("killed")
        return super().page(app_id, cursor)


def test_a_task_that_dies_half_way_leaves_nothing(spark, warehouse, tmp_path):
    ingest.ingest_census(warehouse, census(spark, (1, 5), (2, 5)), NOW)
    read = ingest.PageReader(spark, QUICK, lanes=1, client="tests.test_ingest:DyingClient", **{"client.data": recorded_pages(1, 2)})
    with pytest.raises(Exception, match="killed"):
        ingest.ingest_reviews(spark, warehouse, read, QUICK, NOW)
    log = tmp_path / "wh/raw/review_log"
    assert loaded(warehouse) == [] and [p.name for p in log.glob("rows/*load*")] == ["load=none"] and [p.name for p in log.glob("marks/*load*")] == ["load=none"]
    assert warehouse.read("raw.review_counts").where("last_backfill_at IS NOT NULL").count() == 0


def test_sink_streams_heavy_applications_and_drops_the_incomplete(spark, warehouse, tmp_path, monkeypatch):
    rows = spark.range(0, 70_000, 1, 1).selectExpr("id AS recommendation_id", "CASE WHEN id < 30000 THEN 1 WHEN id < 60000 THEN 2 WHEN id < 60010 THEN 3 ELSE 4 END AS app_id", "'{}' AS payload", "id AS timestamp_created", "id AS timestamp_updated", "TIMESTAMP '2024-01-01' AS loaded_at")
    rows = rows.withColumn("app_id", F.col("app_id").cast("bigint"))
    v = {r["app_id"]: r for r in write_load(rows, ingest.review_log(warehouse), "a", [(1, 30000), (2, 90000), (3, 10), (4, None), (5, 10), (6, 900)], marked_at=NOW).collect()}
    assert {a: (r["fetched"], r["complete"]) for a, r in v.items()} == {1: (30000, True), 2: (30000, False), 3: (10, True), 4: (9990, True), 5: (0, True), 6: (0, False)}
    assert v[1]["max_seen"] == 29999 and v[6]["max_seen"] == 0
    assert sorted(map(tuple, warehouse.read("raw.reviews").groupBy("app_id").count().collect())) == [(1, 30000), (3, 10), (4, 9990)]
    # an application that comes from two tasks, or in two stretches of one, is refused and leaves nothing
    for bad in (rows.where("app_id = 3").repartition(2), rows.where("app_id > 2").union(rows.where("app_id = 3")).coalesce(1)):
        with pytest.raises(Exception, match="two tasks|together"):
            write_load(bad, ingest.review_log(warehouse), "b", [(3, 10)])
    assert warehouse.read("raw.reviews").count() == 40_000


class CountingClient(RecordedClient):
    """Notes when a request is made."""

    def __init__(self, config, data, log):
        super().__init__(config, data)
        self.log = log

    def summary(self, app_id):
        open(f"{self.log}/{time.time()}-{app_id}-{os.getpid()}", "w").close()
        return super().summary(app_id)

    page = lambda self, app_id, cursor: self.summary(app_id) and {}


def test_all_tasks_together_keep_the_rate(spark, tmp_path):
    """A thousand applications in eight lanes, and five reads of one application side by side: the interval holds for all requests together."""
    given = {"client": "tests.test_ingest:CountingClient", "client.data": '{"summaries": {}}', "client.log": str(tmp_path)}
    quick = EngineConfig(http_min_interval_seconds=0.004)
    apps = [(a, None) for a in range(1000)]
    read = ingest.PageReader(spark, quick, lanes=8, mode="summary", **given)
    assert read(apps).rdd.getNumPartitions() == 8 and read(apps).count() == 1000
    at = sorted(float(n.split("-")[0]) for n in os.listdir(tmp_path))
    assert len(at) == 1000 and at[-1] - at[0] >= 0.004 * (1000 - 8) * 0.95
    assert at[-1] - at[0] < 4 * 0.004 * 1000  # and the lanes do work side by side
    reader = ReviewPagesReader(read.shared(5).options([(1, None)]))
    [part] = reader.partitions()
    assert part.tasks == 5
    assert [p.tasks for p in ReviewPagesReader(read.options(apps[:3])).partitions()] == [3, 3, 3]


class ChainClient(RecordedClient):
    """Pages p0, p1, ... of three reviews each; dies once at a page, and notes every request."""

    def __init__(self, config, pages, log, dies="-1"):
        self.pages, self.log, self.dies = int(pages), log, int(dies)

    def page(self, app_id, cursor):
        n = 0 if cursor == "*" else int(cursor[1:])
        open(f"{self.log}/{app_id}-{n}-{time.time_ns()}", "w").close()
        if n == self.dies and not os.path.exists(f"{self.log}/died"):
            open(f"{self.log}/died", "w").close()
            raise KeyError("died")
        if n >= self.pages:
            return {"reviews": [], "cursor": cursor}
        return {"reviews": [review_json(1000 * app_id + 3 * n + i, n) for i in range(3)], "cursor": f"p{n + 1}"}


def test_a_stopped_stream_resumes_at_its_page(spark, warehouse, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()
    config = EngineConfig(pages_per_batch=4, heavy_review_threshold=10, stop_tolerance_min=0, stop_backoff_base_seconds=0.0, http_min_interval_seconds=0.0, http_max_retries=0)
    read = ingest.PageReader(spark, config, client="tests.test_ingest:ChainClient", **{"client.pages": "11", "client.log": str(log), "client.dies": "9"})
    ingest.ingest_census(warehouse, census(spark, (7, 33), (8, 33)), NOW)
    one = EngineConfig(**{**config.__dict__, "heavy_workers": 1})
    m = ingest.ingest_reviews(spark, warehouse, read, one, NOW)
    asked = lambda app: [int(p.name.split("-")[1]) for p in sorted(log.glob(f"{app}-*"), key=lambda p: int(p.name.split("-")[2]))]
    assert m.reviews_loaded == 33 and m.apps_backfilled == 1  # the other one died in its third micro-batch
    dead = 7 if len(asked(7)) == 10 else 8
    assert asked(dead) == list(range(10)) and {a for a, _ in loaded(warehouse)} == {15 - dead}
    assert ingest.ingest_reviews(spark, warehouse, read, one, LATER).reviews_loaded == 33
    assert asked(dead) == [*range(10), 8, 9, 10, 11]  # the micro-batch of pages 8 to 11 is repeated, nothing before it
    rows = loaded(warehouse)
    assert len(rows) == len(set(rows)) == 66
    assert not list((tmp_path / "wh/_stage").iterdir())


def test_heavy_applications_load_side_by_side(spark, warehouse):
    heavy = EngineConfig(heavy_review_threshold=3, stop_tolerance_min=0, stop_backoff_base_seconds=0.0, http_min_interval_seconds=0.0, http_backoff_base_seconds=0.0)
    recorded = {"pages": {str(a): {"*": {"reviews": [review_json(i, i) for i in range(5)], "cursor": "b"}} for a in range(1, 7)}, "summaries": {}}
    recorded["pages"]["3"]["*"]["reviews"][1].pop("timestamp_updated")  # its load fails, the others go on
    read = ingest.page_reader(spark, heavy, client="millrace.sources.review_pages:RecordedClient", **{"client.data": json.dumps(recorded)})
    ingest.ingest_census(warehouse, census(spark, *[(a, 5) for a in range(1, 7)]), NOW)
    m = ingest.ingest_reviews(spark, warehouse, read, heavy, NOW)
    assert (m.reviews_loaded, m.apps_backfilled) == (25, 5) and {a for a, _ in loaded(warehouse)} == {1, 2, 4, 5, 6}


def test_versions_and_vacuum(spark, warehouse, tmp_path):
    one = spark.createDataFrame([(1,)], "k bigint")
    assert warehouse.publish("staging.a", one) == 0 and warehouse.publish("staging.a", one.union(one)) == 1
    old, stale = warehouse.snapshot("staging.a"), warehouse.read("staging.a")
    # another writer publishes what we haven't read: our change is refused and leaves nothing
    assert warehouse.publish("staging.a", old.df.limit(0), old.version) == 2
    with pytest.raises(Conflict):
        warehouse.publish("staging.a", one, old.version)
    assert warehouse.read("staging.a").count() == 0 and stale.count() == 2  # a reader keeps the version it began with
    assert not list((tmp_path / "wh/staging/a").glob("_pending-*"))
    for _ in range(6):
        warehouse.publish("staging.a", one)
    assert warehouse.versions("staging.a") == [4, 5, 6, 7, 8]  # older ones are gone
    (tmp_path / "wh/staging/a/_pending-dead").mkdir()
    assert warehouse.vacuum(1.0) == 0 and warehouse.vacuum(-1.0) == 1


def test_concurrent_merges_lose_nothing(spark, warehouse):
    """A census and a mark, or two merges, that read the same version: the slower one merges again."""
    row = lambda k: spark.createDataFrame([(k,)], "k bigint")
    warehouse.publish("staging.m", row(0))
    calls = []

    def slow(old):
        calls.append(1)
        if len(calls) == 1:
            ingest.merge_table(warehouse, "staging.m", lambda o: o.union(row(1)))
        return old.union(row(2))

    ingest.merge_table(warehouse, "staging.m", slow)
    assert sorted(r["k"] for r in warehouse.read("staging.m").collect()) == [0, 1, 2] and len(calls) == 2


def test_tables_are_in_the_catalog(spark, warehouse, tmp_path):
    spark.createDataFrame([(1, "x")], "k bigint, s string").write.mode("overwrite").parquet(f"{tmp_path}/x")
    reg = Registry([Node("t", "gold", lambda d: spark.read.parquet(f"{tmp_path}/x"), doc="it's a table", columns={"k": "the key's comment"}, layout=Layout(bucket_by=("k",), buckets=2))])
    reg.run(warehouse)
    assert [tuple(r) for r in spark.sql("SELECT * FROM gold.t").collect()] == [(1, "x")]
    about = {r["col_name"]: (r["data_type"], r["comment"]) for r in spark.sql("DESCRIBE TABLE EXTENDED gold.t").collect()}
    assert about["k"][1] == "the key's comment" and about["Comment"][0] == "it's a table" and about["Num Buckets"][0] == "2"
    assert {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE TABLE raw.reviews").collect()}["payload"] == "review document, JSON text"
    # a session whose catalog is empty finds everything again
    spark.sql("DROP DATABASE gold CASCADE")
    assert "gold.t" in warehouse.attach_all() and spark.table("gold.t").count() == 1
    assert spark.table("gold.t").schema["k"].metadata["comment"] == "the key's comment"
    # and buckets belong to a version: another writer that knows no layout keeps them, one that gives another changes them
    other = type(warehouse)(spark, warehouse.root)
    buckets = lambda: {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED gold.t").collect()}.get("Num Buckets")
    other.publish("gold.t", spark.createDataFrame([(5, "y")], "k bigint, s string"))
    assert buckets() == "2" and spark.table("gold.t").count() == 1
    assert spark.table("gold.t").schema["k"].metadata["comment"] == "the key's comment"  # nor comments
    other.publish("gold.t", spark.createDataFrame([(5, "y"), (6, "z")], "k bigint, s string"), layout=Layout())
    assert buckets() is None and spark.table("gold.t").where("k = 6").count() == 1


def test_lookups_read_only_the_listed_files(spark, warehouse):
    rows = spark.range(0, 4000, 1, 8).selectExpr("id AS k", "CASE WHEN id % 7 > 0 THEN id div 100 END AS app", "array(concat('g', id div 500), CASE WHEN id = 1234 THEN 'rare' END, 'all') AS genres")
    warehouse.publish("staging.g", rows, layout=Layout(bloom=("app", "genres"), index=("app", "genres")))
    assert len(warehouse.snapshot("staging.g").df.inputFiles()) == 8
    rare = lookup(warehouse, "staging.g", "genres", ["rare"])
    assert len(rare.inputFiles()) == 1 and [r["k"] for r in rare.collect()] == [1234]
    assert scanned_files(rare) == 1
    both = lookup(warehouse, "staging.g", "app", [3, 39])
    assert len(both.inputFiles()) == 2 and both.count() == rows.where("app IN (3, 39)").count()
    assert lookup(warehouse, "staging.g", "genres", ["none"]).count() == 0
    assert lookup(warehouse, "staging.g", "genres", ["all"]).count() == 4000
    assert lookup(warehouse, "staging.g", "k", [5]).count() == 1  # not indexed: scanned
    assert lookup(warehouse, "raw.catalog_games", "genres", ["x"]).count() == 0
    warehouse.publish("staging.g", rows.where("k < 500"))  # the layout stays, the new version has its own index
    assert lookup(warehouse, "staging.g", "genres", ["rare"]).count() == 0


def scanned_files(df):
    """Files of the scan in a plan."""
    return int(re.search(r"InMemoryFileIndex\((\d+) paths\)", df._jdf.queryExecution().executedPlan().toString())[1])


def test_loads_are_nodes_of_the_graph(spark, warehouse, tmp_path):
    for name, text in DUMPS.items():
        (tmp_path / f"{name}.csv").write_text(text)
    recorded = {
        "pages": {"11": {"*": {"reviews": [review_json(i, i) for i in range(3)], "cursor": "b"}}},
        "summaries": {"11": {"query_summary": {"total_reviews": 3, "total_positive": 2, "total_negative": 1}}, "40": {"query_summary": {"total_reviews": 0}}},
    }
    nodes = ingest.ingest_nodes(spark, QUICK, str(tmp_path), NOW, client="millrace.sources.review_pages:RecordedClient", **{"client.data": json.dumps(recorded)})
    graph = nodes.merge(models.review_models(QUICK))
    order = [n.name for n in graph.order()]
    assert order.index("ingest_catalog") < order.index("ingest_census") < order.index("ingest_reviews") < order.index("reviews") < order.index("review")
    report = graph.run(warehouse)
    assert report.loaded["ingest_catalog"].rows_upserted == 3 and report.loaded["ingest_census"] == 3 and report.loaded["ingest_reviews"].reviews_loaded == 3
    stats = {r["steam_app_id"]: r for r in warehouse.read("marts.game_stats").collect()}
    assert stats[11]["pct_positive_reviews"] == 66.7 and stats[40]["total_reviews"] == 0


def test_registry_builds_checks_and_selects(spark, warehouse):
    reg = models.review_models()
    order = [n.name for n in reg.order()]
    assert order.index("review") < order.index("review_agg") < order.index("game_stats")
    assert reg.select("layer:marts") == {"game_stats", "review_highlight", "game_review_trend_daily"}
    assert "reviews" in reg.select("+game_stats") and "game_stats" in reg.select("review_agg+")
    row = (1, 5, json.dumps({"voted_up": True, "review": "x"}), 0, 0, NOW)
    add = lambda df, load: write_load(df.coalesce(1), ingest.review_log(warehouse), load, [])
    add(spark.createDataFrame([row] * 2, schemas.REVIEWS), "a")
    report = reg.run(warehouse)
    assert set(report.built) == {"game", "game_review_count", "review_document", "review", "review_agg", "game_stats", "review_highlight", "game_review_trend_daily"}
    status = {r.check.name: r.status for r in report.checks}
    assert status["unique_combination(reviews: recommendation_id, app_id)"] == "warn"
    assert status["unique_combination(review: recommendation_id, app_id)"] == "warn"
    add(spark.createDataFrame([(2, 5, "{}", 0, 0, NOW)], schemas.REVIEWS), "b")
    report = reg.run(warehouse, full_refresh=True)
    assert "review_agg" in report.skipped and "game_stats" in report.skipped and "game" in report.built
    with pytest.raises(ValueError):
        reg.add(Node("game", "staging"))
    assert database_for("a/b") == "a_b" and database_for("a", " c ") == "c"
    assert models.review_models(databases={"marts": "gold"}).nodes["game_stats"].table == "gold.game_stats"
    assert Check("t", "unique", ("a",), error_above=10000).status(10001) == "error"


def test_stream_upsert(spark, warehouse, tmp_path):
    schema = "k bigint, v bigint, at bigint"
    warehouse.create_if_absent("staging.s", spark.createDataFrame([], schema).schema)
    for i, rows in enumerate([[(1, 1, 1), (1, 2, 2), (2, 5, 1)], [(2, 6, 2), (3, 7, 1)]]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        src = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        stream_upsert(spark, src, warehouse, "staging.s", ["k"], "at", f"{tmp_path}/cp").awaitTermination()
    assert sorted(map(tuple, warehouse.read("staging.s").collect())) == [(1, 2, 2), (2, 6, 2), (3, 7, 1)]
    # an older row that comes late changes nothing
    spark.createDataFrame([(1, 9, 1), (2, 9, 3), (3, 9, None)], schema).write.mode("append").parquet(f"{tmp_path}/in")
    src = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    stream_upsert(spark, src, warehouse, "staging.s", ["k"], "at", f"{tmp_path}/cp").awaitTermination()
    assert sorted(map(tuple, warehouse.read("staging.s").collect())) == [(1, 2, 2), (2, 9, 3), (3, 7, 1)]
