"""Queries over the driver's tables, each with an equivalent in DuckDB SQL.

The operators are the ones the models use; the tables stand in for reviews and
catalogs (events for review documents, documents with labels for votes, parts
and line items for catalog statistics).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.arrays import ordered_distinct
from millrace.functions.json_fields import json_text, typed_fields
from millrace.functions.numeric import exact_ratio, wrap_uint32
from millrace.functions.text import blank_to_null, brace_list, char_length, digits_only, fill_template, has_any_glyph, leading_date, time_text
from millrace.operators.gating import completeness, keep_complete, size_class, stop_tolerance, work_list
from millrace.operators.lookup import attach_lists, last_wins, resolve_names
from millrace.operators.quality import Check, failing_not_null, failing_unique
from millrace.operators.ranking import top_n_wide
from millrace.operators.running import exact_median, global_rank
from millrace.operators.upsert import advance_watermark, upsert_replace, upsert_with_previous
from millrace.plans.models import daily_trend, median_and_rates, renamed
from millrace.plans.stand_ins import CONFIG, COUNT_SQL, GAME_SQL, REVIEW_SQL, built
from millrace.session import configure
from millrace.sources.index import lookup
from millrace.sources.scratch import new_path
from millrace.sources.tables import Layout, Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its SQL."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def half_up(num: str, den: str, scale: int, unit: float) -> str:
    """SQL for a non-negative ratio rounded half up in whole numbers."""
    return f"((2 * {scale} * CAST({num} AS BIGINT) + {den}) // (2 * NULLIF({den}, 0))) / {unit}"


@query(
    f"""SELECT source, review_date, n AS total_reviews, pos AS total_positive, neg AS total_negative,
    {half_up("pos", "n", 10000, 10000.0)} AS pct_positive FROM (
    SELECT user_id AS source, CAST(ts AS DATE) AS review_date, count(*) AS n,
    CAST(sum(CASE WHEN v THEN 1 ELSE 0 END) AS BIGINT) AS pos, CAST(sum(CASE WHEN NOT v THEN 1 ELSE 0 END) AS BIGINT) AS neg
    FROM (SELECT user_id, ts, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value > 50 END AS v FROM events) GROUP BY 1, 2)"""
)
def daily_trend_by_user(t):
    e = t("events").select(F.col("user_id").alias("source"), "ts", F.when(F.col("event_id") % 7 != 0, F.col("value") > 50).alias("vote"))
    return daily_trend(e, "source", "ts", "vote")


@query(
    f"""SELECT user_id, median(value) AS median_value, {half_up("b_true", "b_known", 1000, 10.0)} AS pct_buy, b_known FROM (
    SELECT user_id, median(value) AS mv, CAST(sum(CAST(flag AS INT)) AS BIGINT) AS b_true, count(flag) AS b_known FROM (
    SELECT user_id, value, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type = 'click' END AS flag FROM events) GROUP BY 1)
    JOIN events USING (user_id) GROUP BY user_id, b_true, b_known"""
)
def group_median_and_rates(t):
    e = t("events").withColumn("flag", F.when(F.col("event_id") % 5 != 0, F.col("event_type") == "click"))
    m = median_and_rates(e, "user_id", "value", {"flag": "b"})
    return m.select("user_id", "median_value", exact_ratio(F.col("b_true"), F.col("b_known"), 1, 100).cast("double").alias("pct_buy"), "b_known")


@query(
    """WITH r AS (SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type
    ORDER BY score DESC NULLS FIRST, event_id ASC NULLS LAST) AS rank_in_group
    FROM (SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS score FROM events) WHERE value > 20)
    SELECT r.rank_in_group, e.event_id, e.user_id, e.event_type, e.value, e.props
    FROM r JOIN events e ON e.event_id = r.event_id WHERE rank_in_group <= 3"""
)
def top_n_per_group_highlight(t):
    e = t("events")
    narrow = e.where("value > 20").select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("score"))
    order = [F.col("score").desc_nulls_first(), F.col("event_id").asc_nulls_last()]
    wide = e.select("event_id", "user_id", "event_type", "value", "props")
    return top_n_wide(narrow, wide, ["event_id"], ["user_id", "event_type"], order, 3, "rank_in_group")


@query(
    f"""WITH a AS (SELECT l_partkey, median(l_extendedprice) AS median_price,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS r, count(*) AS n,
    CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS o FROM lineitem WHERE l_quantity > 45 GROUP BY 1)
    SELECT p_partkey, p_name, p_brand, n AS total_lines, {half_up("r", "n", 1000, 10.0)} AS pct_returned,
    {half_up("o", "n", 1000, 10.0)} AS pct_open, median_price FROM part LEFT JOIN a ON l_partkey = p_partkey"""
)
def stats_left_joins(t):
    lines = t("lineitem").where("l_quantity > 45").withColumns({"r": F.col("l_returnflag") == "R", "o": F.col("l_linestatus") == "O"})
    agg = median_and_rates(lines, "l_partkey", "l_extendedprice", {"r": "r", "o": "o"})
    out = t("part").select("p_partkey", "p_name", "p_brand").join(agg, F.col("p_partkey") == F.col("l_partkey"), "left")
    rate = lambda c: exact_ratio(F.col(f"{c}_true"), F.col(f"{c}_known"), 1, 100).cast("double")
    return out.select(
        "p_partkey", "p_name", "p_brand", F.col("r_known").alias("total_lines"), rate("r").alias("pct_returned"), rate("o").alias("pct_open"), F.col("median_value").alias("median_price")
    )


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.k') AS k_text,
    CAST(json_extract_string(props, '$.author.missing') AS BIGINT) AS missing FROM events"""
)
def json_typed_projection(t):
    typed = typed_fields(t("events"), "props", [("k", "k", "int"), ("author.missing", "missing", "bigint")], [F.col("event_id"), json_text(F.col("props"), "k").alias("k_text")])
    return typed.select("event_id", "k", "k_text", "missing")


@query(
    """SELECT source, count(*) AS total, CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive,
    CAST(sum(CASE WHEN NOT quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS negative
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1"""
)
def null_vote_counts(t):
    joined = t("documents").select("doc_id", "source").join(t("labels"), "doc_id", "left")
    v = F.col("quality") == 1
    return joined.groupBy("source").agg(F.count(F.lit(1)).alias("total"), F.count_if(v).alias("positive"), F.count_if(~v).alias("negative"))


_U32 = "(event_id * 2654435761) % 4294967296"


@query(f"SELECT event_id, CAST(CASE WHEN u > 2147483647 THEN u - 4294967296 ELSE u END AS INTEGER) AS signed FROM (SELECT event_id, {_U32} AS u FROM events)")
def uint32_wrap(t):
    return t("events").select("event_id", wrap_uint32(F.expr(_U32)).alias("signed"))


@query(
    """SELECT event_id, CAST(make_timestamp(event_id * 86399 * 1000000) AS DATE) AS day,
    strftime(make_timestamp(event_id * 86399 * 1000000), '%Y-%m-%d %H:%M:%S') AS at FROM events"""
)
def epoch_to_timestamp_date(t):
    at = F.timestamp_seconds(F.col("event_id") * 86399)
    return t("events").select("event_id", F.to_date(at).alias("day"), time_text(at).alias("at"))


@query(
    """SELECT doc_id, CAST(length(text) AS BIGINT) AS n, coalesce(regexp_matches(text, '[✅☐]'), false) AS is_checklist,
    coalesce(regexp_matches(text, '[éß]'), false) AS has_accent FROM documents"""
)
def text_length_and_pattern(t):
    c = F.col("text")
    return t("documents").select("doc_id", char_length(c).cast("bigint").alias("n"), has_any_glyph(c, "✅☐").alias("is_checklist"), has_any_glyph(c, "éß").alias("has_accent"))


@query("SELECT DISTINCT l_partkey AS part_id FROM lineitem WHERE l_partkey IS NOT NULL")
def distinct_keys(t):
    return t("lineitem").where(F.col("l_partkey").isNotNull()).select(F.col("l_partkey").alias("part_id")).distinct()


@query("SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL")
def null_filter(t):
    return t("documents").join(t("labels"), "doc_id", "left").where(F.col("quality").isNull()).select("doc_id", "lang")


@query(
    """SELECT c_custkey, total, row_number() OVER (ORDER BY total ASC NULLS FIRST, c_custkey) AS position
    FROM (SELECT c_custkey, sum_n AS total FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS sum_n FROM orders
    WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey)"""
)
def sort_nulls_first_rank(t):
    """The position of each row in a global sort."""
    counts = t("orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total"))
    rows = t("customer").select("c_custkey").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "total")
    return global_rank(rows, [F.col("total").asc_nulls_first(), F.col("c_custkey").asc()])


@query("SELECT p_partkey AS part_id, p_name AS part_name, p_size AS size FROM part")
def renamed_projection(t):
    return renamed(t("part"), {"p_partkey": "part_id", "p_name": "part_name", "p_size": "size"})


@query(
    """SELECT l_orderkey, string_agg(p_brand, '|' ORDER BY pos, p_brand) AS brands FROM (
    SELECT l_orderkey, p_brand, min(l_linenumber * 1000000 + l_partkey) AS pos FROM lineitem
    JOIN part ON p_partkey = l_partkey WHERE p_size > 10 GROUP BY 1, 2) GROUP BY 1"""
)
def ordered_distinct_names(t):
    items = t("lineitem").select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("pos"), F.col("l_partkey").alias("item"))
    names = t("part").where("p_size > 10").select("p_partkey", "p_brand")
    lists = resolve_names(items, "l_orderkey", names, "p_partkey", "p_brand", {"brands": F.lit(True)})
    return lists.select("l_orderkey", F.array_join("brands", "|").alias("brands"))


@query(
    """SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
    FROM events WHERE user_id IS NOT NULL GROUP BY 1"""
)
def last_wins_lookup(t):
    return last_wins(t("events").select("user_id", "event_type", "value", "event_id"), "user_id", "event_id")


#: Events before this time are what is stored, the others what comes in; a key is a user and an hour of the day.
_SPLIT = "2024-01-16 00:00:00"
_SLICES = f"""keyed AS (SELECT *, user_id * 24 + CAST(extract(hour FROM ts) AS BIGINT) AS slot FROM events),
    old AS (SELECT slot, count(*) AS total, max(value) AS best FROM keyed WHERE ts < TIMESTAMP '{_SPLIT}' GROUP BY 1),
    new AS (SELECT slot, CASE WHEN slot % 5 = 0 THEN NULL ELSE count(*) END AS total, max(value) AS best FROM keyed WHERE NOT ts < TIMESTAMP '{_SPLIT}' GROUP BY 1)"""


def _slices(t):
    """The whole table, cut by time."""
    e = t("events").withColumn("slot", F.col("user_id") * 24 + F.hour("ts"))
    agg, before = [F.count(F.lit(1)).alias("total"), F.max("value").alias("best")], F.col("ts") < F.lit(_SPLIT).cast(e.schema["ts"].dataType)
    new = e.where(~before).groupBy("slot").agg(*agg)
    return e.where(before).groupBy("slot").agg(*agg), new.withColumn("total", F.when(F.col("slot") % 5 != 0, F.col("total")))


@query(
    f"""WITH {_SLICES} SELECT coalesce(n.slot, o.slot) AS slot, CASE WHEN n.slot IS NOT NULL THEN n.total ELSE o.total END AS total,
    CASE WHEN n.slot IS NOT NULL THEN n.best ELSE o.best END AS best FROM new n FULL JOIN old o ON n.slot = o.slot"""
)
def keyed_upsert(t):
    old, new = _slices(t)
    return upsert_replace(old, new, ["slot"])


@query(
    f"""WITH {_SLICES} SELECT coalesce(n.slot, o.slot) AS slot, CASE WHEN n.slot IS NOT NULL THEN n.total ELSE o.total END AS total,
    CASE WHEN n.slot IS NOT NULL THEN n.best ELSE o.best END AS best,
    CASE WHEN n.slot IS NOT NULL AND o.slot IS NOT NULL THEN o.total WHEN o.slot IS NOT NULL THEN o.prev ELSE NULL END AS prev
    FROM new n FULL JOIN (SELECT *, total - 1 AS prev FROM old) o ON n.slot = o.slot"""
)
def upsert_prev_value(t):
    old, new = _slices(t)
    return upsert_with_previous(old.withColumn("prev", F.col("total") - 1), new, ["slot"], "total", "prev")


@query(
    f"""WITH {_SLICES} SELECT o.slot, CASE WHEN m.slot IS NOT NULL THEN greatest(coalesce(o.seen, 0), m.v) ELSE o.seen END AS seen,
    CASE WHEN m.slot IS NOT NULL THEN 'marked' ELSE o.state END AS state
    FROM (SELECT slot, CASE WHEN slot % 2 = 0 THEN total END AS seen, 'open' AS state FROM old) o
    LEFT JOIN (SELECT slot, coalesce(total, 0) AS v FROM new) m ON m.slot = o.slot"""
)
def watermark_mark(t):
    old, new = _slices(t)
    target = old.select("slot", F.when(F.col("slot") % 2 == 0, F.col("total")).alias("seen"), F.lit("open").alias("state"))
    marks = new.select("slot", F.coalesce("total", F.lit(0)).alias("v"))
    return advance_watermark(target, marks, "slot", "seen", "state", "v", F.lit("marked"))


_TOTALS = "SELECT user_id, CASE WHEN user_id % 10 = 0 THEN 0 WHEN user_id % 10 = 1 THEN NULL ELSE user_id * 137 END AS total FROM (SELECT DISTINCT user_id FROM events)"


def _totals(t):
    u = F.col("user_id")
    return t("events").select("user_id").distinct().withColumn("total", F.when(u % 10 == 0, 0).when(u % 10 != 1, u * 137))


@query(
    f"""SELECT user_id, total, CASE WHEN total = 0 THEN 'zero' WHEN coalesce(total, 0) > 10000 THEN 'heavy' ELSE 'light' END AS class,
    greatest(50, CAST(floor(coalesce(total, 0) * CAST(0.15 AS DOUBLE)) AS BIGINT)) AS tolerance FROM ({_TOTALS})"""
)
def size_class_split(t):
    c = F.col("total")
    return _totals(t).select("user_id", "total", size_class(c).alias("class"), stop_tolerance(c).alias("tolerance"))


@query(f"SELECT user_id, total FROM ({_TOTALS}) WHERE total IS NULL")
def work_list_gate(t):
    return work_list(_totals(t).withColumn("loaded", F.col("total")), "loaded", "total").select("user_id", "total")


_GATE = """WITH x AS (SELECT user_id, CASE WHEN user_id % 10 = 1 THEN NULL ELSE user_id * 2 END AS total FROM (SELECT DISTINCT user_id FROM events)),
    f AS (SELECT user_id, count(*) AS n, max(event_id) AS m FROM events GROUP BY 1),
    v AS (SELECT x.user_id, total, coalesce(n, 0) AS fetched, coalesce(m, 0) AS max_seen, total IS NULL OR total - coalesce(n, 0)
    <= greatest(50, CAST(floor(coalesce(total, 0) * CAST(0.15 AS DOUBLE)) AS BIGINT)) AS complete FROM x LEFT JOIN f USING (user_id))"""


def _gate(t):
    u = F.col("user_id")
    expected = t("events").select("user_id").distinct().withColumn("total", F.when(u % 10 != 1, u * 2))
    return completeness(expected, t("events"), "user_id", "total", "event_id")


@query(f"{_GATE} SELECT * FROM v")
def completeness_gate(t):
    return _gate(t)


@query(f"{_GATE} SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM v WHERE complete)")
def completeness_rows(t):
    return keep_complete(t("events").select("event_id", "user_id"), _gate(t), "user_id")


@query("SELECT count(*) AS failures FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
def dq_unique(t):
    return failing_unique(t("orders"), ["o_orderkey"])


@query("SELECT count(*) AS failures FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL")
def dq_not_null(t):
    return failing_not_null(t("documents").join(t("labels"), "doc_id", "left"), "quality")


@query("SELECT count(*) AS failures FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def dq_key_combination(t):
    return failing_unique(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT p_partkey, CASE WHEN i <> '' THEN 'https://img.example/' || i || '.jpg' END AS url FROM
    (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN NULL ELSE p_name END AS i FROM part)"""
)
def url_template(t):
    image = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 2, F.col("p_name"))
    return t("part").select("p_partkey", fill_template("https://img.example/{i}.jpg", "i", image).alias("url"))


@query(
    """SELECT p_partkey, pos, item FROM (SELECT p_partkey, CAST(unnest(range(len(parts))) AS INTEGER) AS pos, unnest(parts) AS item FROM
    (SELECT p_partkey, string_split(trim('{' || p_size || ', ' || p_brand || ',}', '{}'), ',') AS parts FROM part))"""
)
def brace_list_split(t):
    s = F.concat(F.lit("{"), F.col("p_size").cast("string"), F.lit(", "), F.col("p_brand"), F.lit(",}"))
    return t("part").select("p_partkey", F.posexplode(brace_list(s)).alias("pos", "item"))


@query(
    """SELECT p_partkey, CASE WHEN regexp_full_match(s, '[0-9]+') THEN CAST(s AS BIGINT) END AS digits FROM (
    SELECT p_partkey, trim(CASE WHEN p_size % 2 = 0 THEN ' ' || p_size || ' ' WHEN p_size % 3 = 0 THEN '' ELSE p_name END) AS s FROM part)"""
)
def digit_filter(t):
    c = F.col("p_size")
    s = F.when(c % 2 == 0, F.concat(F.lit(" "), c.cast("string"), F.lit(" "))).when(c % 3 == 0, "").otherwise(F.col("p_name"))
    return t("part").select("p_partkey", digits_only(s).alias("digits"))


@query(
    """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 9 <> 0 THEN substr(CAST(o_orderdate AS VARCHAR), 1, 10) END AS DATE) AS day,
    nullif(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END, '') AS status FROM orders"""
)
def blank_and_date(t):
    k = F.col("o_orderkey")
    raw = F.when(k % 9 == 0, "").otherwise(F.col("o_orderdate").cast("string"))
    return t("orders").select("o_orderkey", leading_date(raw).alias("day"), blank_to_null(F.when(k % 2 == 0, "").otherwise(F.col("o_orderstatus"))).alias("status"))


@query("SELECT event_id, CAST(value AS DECIMAL(38, 20)) AS exact, CAST(event_id % 2 = 0 AS INTEGER) AS flag FROM (SELECT event_id, CAST(value AS VARCHAR) AS value FROM events)")
def decimal_and_boolean_casts(t):
    return t("events").select("event_id", F.col("value").cast("string").cast("decimal(38,20)").alias("exact"), (F.col("event_id") % 2 == 0).cast("int").alias("flag"))


@query(
    """SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY p, l_returnflag) AS flags FROM (
    SELECT l_orderkey, l_returnflag, min(l_linenumber * 1000000 + l_partkey) AS p FROM lineitem GROUP BY 1, 2) GROUP BY 1"""
)
def ordered_distinct_flags(t):
    """Flags in the order of their first position, those of one position by name."""
    pos = F.struct((F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("p"), F.col("l_returnflag").alias("f"))
    return t("lineitem").groupBy("l_orderkey").agg(F.array_join(ordered_distinct(F.collect_list(pos), "f"), "").alias("flags"))


@query("SELECT *, o_totalprice > 100000 AS is_large, CAST(o_orderdate AS DATE) AS day FROM orders")
def star_and_derived(t):
    return t("orders").select("*", (F.col("o_totalprice") > 100000).alias("is_large"), F.to_date("o_orderdate").alias("day"))


_DOC = """'{"flag":' || CASE event_id % 3 WHEN 0 THEN '"true"' WHEN 1 THEN 'false' ELSE 'null' END || ',"ratio":"' || CAST(value AS VARCHAR) || '","at":' || CAST(event_id * 86399 AS VARCHAR) || '.25,"sub":' || props || '}'"""


@query(
    f"""SELECT event_id, CAST(json_extract_string(d, '$.flag') AS BOOLEAN) AS flag, CAST(json_extract_string(d, '$.ratio') AS DOUBLE) AS ratio,
    strftime(make_timestamp(CAST(round(CAST(json_extract_string(d, '$.at') AS DOUBLE) * 1000000) AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS at,
    CAST(json_extract(d, '$.sub') AS VARCHAR) AS sub, CAST(json_extract_string(d, '$.gone') AS BOOLEAN) AS gone FROM (SELECT event_id, {_DOC} AS d FROM events)"""
)
def json_typed_fields(t):
    """Text to boolean and double, fractional epoch seconds, a sub-document that stays JSON, a missing field."""
    k = F.col("event_id")
    flag = F.when(k % 3 == 0, '"true"').when(k % 3 == 1, "false").otherwise("null")
    doc = F.concat(F.lit('{"flag":'), flag, F.lit(',"ratio":"'), F.col("value").cast("string"), F.lit('","at":'), (k * 86399).cast("string"), F.lit('.25,"sub":'), F.col("props"), F.lit("}"))
    fields = [("flag", "flag", "boolean"), ("ratio", "ratio", "double"), ("at", "at", "epoch_real"), ("sub", "sub", "json"), ("gone", "gone", "boolean")]
    typed = typed_fields(t("events").select("event_id", doc.alias("doc")), "doc", fields, [k])
    return typed.withColumns({"at": time_text(F.col("at"), "MM-dd HH:mm:ss.SSSSSS"), "sub": F.to_json("sub")})


@query(
    """WITH names AS (SELECT s_suppkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 0),
    hits AS (SELECT l_orderkey, n_name, l_returnflag = 'R' AS r, l_linestatus = 'O' AS o, l_linenumber AS pos FROM lineitem JOIN names ON s_suppkey = l_suppkey),
    r AS (SELECT l_orderkey, string_agg(n_name, '|' ORDER BY p, n_name) AS names, count(*) AS n FROM (SELECT l_orderkey, n_name, min(pos) AS p FROM hits WHERE r GROUP BY 1, 2) GROUP BY 1),
    o AS (SELECT l_orderkey, string_agg(n_name, '|' ORDER BY p, n_name) AS names, count(*) AS n FROM (SELECT l_orderkey, n_name, min(pos) AS p FROM hits WHERE o GROUP BY 1, 2) GROUP BY 1)
    SELECT o_orderkey, coalesce(r.names, '') AS returned, coalesce(o.names, '') AS open, CAST(coalesce(r.n, 0) AS INTEGER) AS n_returned
    FROM orders LEFT JOIN r ON r.l_orderkey = o_orderkey LEFT JOIN o ON o.l_orderkey = o_orderkey"""
)
def chained_lookup_lists(t):
    """Two lookups in a row, routed to two ordered lists; orders without names have empty lists."""
    nations = t("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    names = t("supplier").where("s_acctbal > 0").select("s_suppkey", "s_nationkey").join(nations, "s_nationkey")
    items = t("lineitem").select("l_orderkey", F.col("l_linenumber").alias("pos"), F.col("l_suppkey").alias("item"), "l_returnflag", "l_linestatus")
    lists = resolve_names(items, "l_orderkey", names, "s_suppkey", "n_name", {"returned": F.col("l_returnflag") == "R", "open": F.col("l_linestatus") == "O"})
    out = attach_lists(t("orders").select(F.col("o_orderkey").alias("l_orderkey")), lists, "l_orderkey", ["returned", "open"])
    return out.select(F.col("l_orderkey").alias("o_orderkey"), F.array_join("returned", "|").alias("returned"), F.array_join("open", "|").alias("open"), F.size("returned").alias("n_returned"))


@query(
    """SELECT c_custkey, 'https://img.example/' || n_name || '.jpg' AS url FROM customer
    LEFT JOIN (SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN '' ELSE n_name END AS n_name FROM nation) n ON n_nationkey = c_nationkey AND n_name <> ''"""
)
def left_lookup(t):
    """A left lookup without the blank values; a miss is NULL."""
    images = t("nation").select("n_nationkey", F.when(F.col("n_regionkey") == 0, "").otherwise(F.col("n_name")).alias("n_name"))
    kept = images.where(blank_to_null(F.col("n_name")).isNotNull())
    joined = t("customer").join(kept, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", fill_template("https://img.example/{i}.jpg", "i", F.col("n_name")).alias("url"))


@query(
    """SELECT failures, CASE WHEN failures > 10000 THEN 'error' WHEN failures > 0 THEN 'warn' ELSE 'pass' END AS status FROM (
    SELECT count(*) AS failures FROM (SELECT 1 FROM events GROUP BY user_id, event_type HAVING count(*) > 1))"""
)
def dq_thresholds(t):
    check = Check("events", "unique_combination", ("user_id", "event_type"), error_above=10000)
    return check.failing(t("events")).select("failures", check.status_column(F.col("failures")).alias("status"))


@query("SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars ASC NULLS FIRST, doc_id DESC) AS position FROM documents")
def global_rank_by_length(t):
    return global_rank(t("documents").select("doc_id", "n_chars"), [F.col("n_chars").asc_nulls_first(), F.col("doc_id").desc()])


_HOT = "CASE WHEN doc_id % 3 = 0 THEN -1 ELSE (doc_id - doc_id % 20) // 20 END"


@query(f"SELECT {_HOT} AS key, median(CASE WHEN doc_id % 50 > 0 THEN n_chars + doc_id % 100 END) AS median_chars FROM documents GROUP BY 1")
def median_of_hot_key(t):
    """An exact median per key, where one key has a third of the rows."""
    rows = t("documents").select(F.expr(_HOT.replace("//", "div")).alias("key"), F.expr("CASE WHEN doc_id % 50 > 0 THEN n_chars + doc_id % 100 END").alias("v"))
    return exact_median(rows, "key", "v", "median_chars")


@query("SELECT doc_id, lang, n_chars FROM documents WHERE 'c' || n_chars % 1000 IN ('c77', 'c300', 'c999') OR source || doc_id % 100 = 'none'")
def indexed_array_lookup(t):
    """Rows whose list of tags holds a value, from the files that the inverted index names."""
    documents = t("documents")
    spark = documents.sparkSession
    w = Warehouse(spark, new_path(spark, "indexed"))
    tagged = documents.select("doc_id", "lang", "n_chars", F.expr("array(lang, concat('c', n_chars % 1000), concat(source, doc_id % 100))").alias("tags"))
    w.publish("staging.tagged", tagged.sort(F.expr("n_chars % 1000")), layout=Layout(bloom=("tags", "doc_id"), index=("tags",)))
    return lookup(w, "staging.tagged", "tags", ["c77", "c300", "c999", "none"]).select("doc_id", "lang", "n_chars")


def _readable(df: DataFrame) -> DataFrame:
    """Lists, times and whole texts as text that both engines write alike."""
    out = []
    for f in df.schema:
        kind, c = f.dataType.simpleString(), F.col(f.name)
        if kind == "array<string>":
            c = F.array_join(c, "|")
        elif kind == "timestamp":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "variant":
            c = F.to_json(c)
        elif f.name == "review_text":
            c = F.sha2(c, 256)
        out.append(c.alias(f.name))
    return df.select(out)


def _model(t, name: str, as_sql: bool = False) -> DataFrame:
    return _readable(built(t("documents"), name, as_sql))


_TIMES = lambda *names: ", ".join(f"strftime({n}, '%Y-%m-%d %H:%M:%S.%f') AS {n}" for n in names)


@query(f"WITH {GAME_SQL} SELECT * FROM game")
def model_game(t):
    return _model(t, "game")


@query(f"WITH {COUNT_SQL} SELECT *, '2024-02-01 00:00:00.000000' AS checked_at, CAST(NULL AS BIGINT) AS prev_total_reviews, CASE WHEN false THEN '' END AS last_backfill_at FROM counts")
def model_game_review_count(t):
    return _model(t, "game_review_count")


@query(
    f"""WITH {REVIEW_SQL} SELECT * EXCLUDE (author_last_played_at, app_release_date, created_at, updated_at, loaded_at, review_text), sha256(review_text) AS review_text,
    {_TIMES("author_last_played_at", "app_release_date", "created_at", "updated_at", "loaded_at")} FROM typed"""
)
def model_review(t):
    """All thirty fields of the payload, read from the stored VARIANT, and the two that are derived."""
    return _model(t, "review")


_SHARE = lambda c: f"CAST(round(sum(CAST({c} AS INT)) / CAST(nullif(count({c}), 0) AS DOUBLE), 12) AS DOUBLE)"


@query(
    f"""WITH {REVIEW_SQL} SELECT app_id AS steam_app_id, median(author_playtime_forever_minutes) AS median_playtime_forever_minutes,
    {_SHARE("primarily_steam_deck")} AS pct_primarily_steam_deck, {_SHARE("refunded")} AS pct_refunded FROM typed GROUP BY 1"""
)
def model_review_agg(t):
    share = lambda c: F.round(F.col(c), 12).cast("double").alias(c)
    return _model(t, "review_agg").select("steam_app_id", "median_playtime_forever_minutes", share("pct_primarily_steam_deck"), share("pct_refunded"))


@query(
    f"""WITH {REVIEW_SQL}, {GAME_SQL}, {COUNT_SQL},
    agg AS (SELECT app_id, median(author_playtime_forever_minutes) AS m, CAST(sum(CAST(primarily_steam_deck AS INT)) AS BIGINT) AS d, count(primarily_steam_deck) AS dn,
      CAST(sum(CAST(refunded AS INT)) AS BIGINT) AS r, count(refunded) AS rn FROM typed GROUP BY 1)
    SELECT igdb_id, g.steam_app_id, game_name, genres, developers, publishers, cover_url, first_release_date, total_reviews, {half_up("total_positive", "total_reviews", 1000, 10.0)} AS pct_positive_reviews, review_score,
    m AS median_playtime_forever_minutes, {half_up("d", "dn", 1000, 10.0)} AS pct_primarily_steam_deck, {half_up("r", "rn", 1000, 10.0)} AS pct_refunded
    FROM game g LEFT JOIN counts c ON c.steam_app_id = g.steam_app_id LEFT JOIN agg a ON a.app_id = g.steam_app_id"""
)
def mart_game_stats(t):
    return _model(t, "game_stats")


_HIGHLIGHT = f"""WITH {REVIEW_SQL}, best AS (SELECT recommendation_id, app_id, row_number() OVER (PARTITION BY app_id, voted_up, language
    ORDER BY weighted_vote_score DESC NULLS FIRST, votes_up DESC NULLS FIRST, recommendation_id ASC) AS rank_in_game FROM typed
    WHERE author_playtime_at_review_minutes > {CONFIG.min_playtime_minutes} AND review_text_length > {CONFIG.min_review_length} AND NOT is_generic)
    SELECT CAST(rank_in_game AS INT) AS rank_in_game, recommendation_id, app_id, sha256(review_text) AS review_text, language, voted_up, votes_up, votes_funny, weighted_vote_score, author_personaname, author_avatar, author_profile_url,
    author_playtime_at_review_minutes, {_TIMES("author_last_played_at")} FROM best JOIN typed USING (recommendation_id, app_id) WHERE rank_in_game <= {CONFIG.top_n_reviews}"""


@query(_HIGHLIGHT)
def mart_review_highlight(t):
    return _model(t, "review_highlight")


@query(_HIGHLIGHT)
def mart_review_highlight_sql(t):
    """The same mart from SQL text with named values."""
    return _model(t, "review_highlight", as_sql=True)


@query(
    f"""WITH {REVIEW_SQL} SELECT app_id, review_date, n AS total_reviews, pos AS total_positive, n - pos AS total_negative, {half_up("pos", "n", 10000, 10000.0)} AS pct_positive FROM (
    SELECT app_id, CAST(created_at AS DATE) AS review_date, count(*) AS n, count(*) FILTER (WHERE voted_up) AS pos FROM typed GROUP BY 1, 2)"""
)
def mart_game_review_trend_daily(t):
    return _model(t, "game_review_trend_daily")
