"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import importable, new_path, table
from millrace.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(importable(configure(spark)), sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first pass fills a new cache; the counts come from a second, which finds every digest stored and moves no text."""
    from millrace.llm.token_counts import count_tokens, fill, open_cache

    docs, path, folder = table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), new_path(spark, "token-counts")
    fill(docs, path, open_cache(spark, folder, path))
    counted = count_tokens(docs, path, folder)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query()
def op2_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents"), 40, keep=["doc_id"])


@query()
def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: The query's rules (fixed values).
URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "block"), ("example.net/de/8", "block"), ("org/es/", "block")]


@query(
    f"""WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
    r AS (SELECT * FROM (VALUES {", ".join(f"('{t.partition('/')[0]}', '/{t.partition('/')[2]}', '{v}')" for t, v in URL_RULES)}) t(rhost, rpath, rverdict)),
    m AS (SELECT p.page_id, p.host, p.path, r.*, row_number() OVER (PARTITION BY p.page_id ORDER BY length(rhost) DESC NULLS LAST, length(rpath) DESC) AS k
    FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
    SELECT page_id, host, path, rhost || rpath AS rule, coalesce(rverdict, 'allow') AS verdict FROM m WHERE k = 1"""
)
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.url_rules import Rule, judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), [Rule.parse(t, v) for t, v in URL_RULES])


@query(
    r"""WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
    lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS no FROM split),
    sets AS (SELECT row_number() OVER (ORDER BY doc_id, no) AS id, doc_id, no, line,
      list_distinct(list_filter(regexp_split_to_array(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\r\f\x0b]+'), lambda x: x <> '')) AS w FROM lines),
    words AS (SELECT id, len(w) AS n, unnest(w) AS word FROM sets),
    freq AS (SELECT word, count(*) AS f FROM words GROUP BY 1),
    ranked AS (SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY f, word) AS pos FROM words JOIN freq USING (word)),
    prefix AS (SELECT id, n, word FROM ranked WHERE pos <= n - (4 * n + 4) // 5 + 1),
    pairs AS (SELECT DISTINCT a.id AS a, b.id AS b FROM prefix a JOIN prefix b ON a.word = b.word AND a.id < b.id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
    common AS (SELECT p.b, len(x.w) + len(y.w) AS n, len(list_intersect(x.w, y.w)) AS i FROM pairs p JOIN sets x ON x.id = p.a JOIN sets y ON y.id = p.b),
    gone AS (SELECT DISTINCT b AS id FROM common WHERE 5 * i >= 4 * (n - i)),
    left_over AS (SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(g.id) AS INTEGER) AS n_removed,
      coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE g.id IS NULL), '') AS rest FROM sets s LEFT JOIN gone g ON g.id = s.id GROUP BY 1)
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, CAST(strlen(rest) AS BIGINT) AS n_bytes_left, sha256(rest) AS text_sha256
    FROM documents d LEFT JOIN left_over USING (doc_id)"""
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.line_dedup import dedup_lines

    left = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", F.octet_length("text").cast("bigint").alias("n_bytes_left"), F.sha2("text", 256).alias("text_sha256"))


@query()
def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.order_minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.quality_gam import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.templates import mark_leaks

    return mark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.permutation_index import nearest

    return nearest(table(spark, sf_dir, "embeddings"), lambda c: c % 100 == 0)


@query(
    r"""WITH m AS (SELECT conv_id, turn, role, text, conv_id || '-' || turn AS id FROM conversations),
    raw AS (SELECT conv_id, turn, coalesce(text, '') AS text, length(coalesce(text, '')) AS chars,
      len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda w: w <> '')) AS words, id FROM m WHERE role = 'assistant'),
    shaped AS (SELECT *, CASE WHEN chars < 200 THEN 'short_reply' ELSE 'reply' END AS name,
      CAST(json_object('chars', chars, 'text', text, 'words', words) AS VARCHAR) AS arguments, CAST(json_object('words', words, 'text', text, 'chars', chars) AS VARCHAR) AS sent FROM raw),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY name, sent) AS k, count(*) OVER (PARTITION BY id) AS n_calls FROM shaped WHERE id IS NOT NULL),
    one AS (SELECT * FROM ranked WHERE k = 1),
    runs AS (SELECT *, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run FROM one),
    placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS INTEGER) AS level FROM runs),
    checked AS (SELECT *, CASE WHEN turn >= 2 AND level = 0 THEN 1 ELSE 0 END AS n_missing, array_to_string(list_sort(list_filter(CASE WHEN name = 'reply' THEN
      [CASE WHEN chars < 1 THEN 'chars: below 1' END, CASE WHEN chars < 1 THEN 'text: below 1' END, CASE WHEN words < 1 THEN 'words: below 1' END, CASE WHEN words > 120 THEN 'words: above 120' END]
      ELSE [CASE WHEN chars < 1 THEN 'chars: below 1' END, CASE WHEN chars > 300 THEN 'chars: above 300' END] END, lambda x: x IS NOT NULL)), '; ') AS problems FROM placed),
    answers AS (SELECT conv_id || '-' || (turn - 1) AS id, count(*) AS n_results, min(struct_pack(t := turn, c := text)).c AS content FROM m
      WHERE role = 'user' AND turn > 0 AND conv_id IS NOT NULL GROUP BY 1),
    context AS (SELECT id, role, min(turn) AS turn, count(*) AS n_results, min(text) AS content FROM m WHERE role <> 'assistant' AND (role <> 'user' OR turn <= 0) AND id IS NOT NULL GROUP BY 1, 2),
    j AS (SELECT coalesce(c.id, r.id) AS call_id, c.turn, c.name, c.level, coalesce(c.n_missing, 0) AS n_missing, coalesce(c.n_calls, 0) AS n_calls, coalesce(r.n_results, 0) AS n_results,
      CASE WHEN c.id IS NULL THEN 'orphan_result' WHEN problems <> '' THEN 'invalid' WHEN r.id IS NULL THEN 'unanswered' ELSE 'ok' END AS status, coalesce(c.problems, '') AS problems, c.arguments, r.content
      FROM checked c FULL JOIN answers r ON r.id = c.id)
    SELECT call_id, turn, name, level, CAST(n_missing AS BIGINT) AS n_missing, n_calls, n_results, status, problems,
    '{' || CASE WHEN n_calls > 0 THEN '"arguments":' || arguments || ',' ELSE '' END || '"id":' || CAST(to_json(call_id) AS VARCHAR) ||
    CASE WHEN n_calls > 0 THEN ',"level":' || level || ',"name":"' || name || '"' ELSE '' END ||
    CASE WHEN content IS NOT NULL THEN ',"result":' || CAST(to_json(content) AS VARCHAR) ELSE '' END || ',"status":"' || status || '"}' AS json FROM j
    UNION ALL SELECT id, turn, role, NULL, 0, 0, n_results, 'context', '',
    '{' || CASE WHEN content IS NOT NULL THEN '"content":' || CAST(to_json(content) AS VARCHAR) || ',' ELSE '' END || '"id":' || CAST(to_json(id) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || ',"status":"context"}' FROM context"""
)
def op7_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.tool_calls import TOOLS, conversation_calls, link

    calls, results, context = conversation_calls(table(spark, sf_dir, "conversations"))
    return link(calls, results, TOOLS, context)


#: Masks of the five filters in SQL; all that follows is sums over them.
_MASKS = r"""words AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
      list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
    copies AS (SELECT text, min(doc_id) AS least FROM words GROUP BY 1),
    masks AS (SELECT doc_id, part, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
      + 4 * CAST(100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) AS INT)
      + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > least, false) AS INT) AS m FROM words JOIN copies USING (text))"""


@query(
    f"""WITH {_MASKS},
    known AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS q, max(CAST(toxic = 1 AS INT)) AS x FROM labels GROUP BY 1),
    hist AS (SELECT part, m, count(*) AS n, count(*) FILTER (WHERE q = 1) AS good, count(*) FILTER (WHERE x = 1) AS bad FROM masks LEFT JOIN known USING (doc_id) GROUP BY 1, 2),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit),
    orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS o, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM letters a, letters b, letters c, letters d, letters e
      WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
    steps AS (SELECT o, s, bits[s] AS bit, CAST(coalesce(list_sum(bits[1:s - 1]), 0) AS INT) AS before FROM orders, (SELECT unnest(range(1, 6)) AS s)),
    found AS (SELECT part, o, s, bit, sum(n) FILTER (WHERE m & (before | bit) = 0) AS kept, sum(n) FILTER (WHERE m & before = 0 AND m & bit > 0) AS removed,
      sum(n) FILTER (WHERE m & before > 0 AND m & bit > 0) AS redundant, sum(n) FILTER (WHERE m = bit) AS unique_fails,
      sum(good) FILTER (WHERE m & before = 0 AND m & bit > 0) AS good_lost, sum(bad) FILTER (WHERE m & before = 0 AND m & bit > 0) AS toxic_lost FROM hist, steps GROUP BY 1, 2, 3, 4)
    SELECT part, o AS filter_order, CAST(s AS INT) AS step, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
      CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley FROM found"""
)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.filter_audit import audit, mask_histograms

    return audit(mask_histograms(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


#: crc32 of the digits of an id, a bit at a time (DuckDB has no crc32).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT FOR i IN range(8)]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


@query(
    rf"""WITH h AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-]+'), lambda w: w <> '') AS v, {_CRC} AS h FROM documents),
    a AS (SELECT doc_id, v, h, len(v) AS n, CASE WHEN len(v) > 0 THEN h // 10 % len(v) END AS a, 3 + h // 10 % 8 AS e FROM h),
    w AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN v[:a] || [v[a + 1 + i % (1 + (n - a) // e)] FOR i IN range(n - a)] ELSE v END AS w FROM a),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM w),
    same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 3),
    isles AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM same) GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(24, 3 * q)),
    runs AS (SELECT doc_id, s, len, min(q) AS q FROM isles GROUP BY 1, 2, 3),
    told AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
      list({{'s': s, 'len': len, 'q': q}} ORDER BY CAST(len AS DOUBLE) / q DESC, s, q)[1] AS b FROM runs GROUP BY 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.len AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period, CAST(1000 * b.len // b.q AS BIGINT) AS exponent_milli,
      sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256 FROM documents LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)"""
)
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.periodic_runs import mark_runs, planted, run_digests

    return run_digests(mark_runs(table(spark, sf_dir, "documents"), prepare=planted))


@query()
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
