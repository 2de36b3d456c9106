"""Operator 7, chat formatting by tool-call linking, in DataFrame operations only.

Calls and results meet by identifier in a hash join. Calls are ordered
topologically: a call's level is one more than the highest level among the calls
it depends on. Arguments are checked against the tool's schema, and every linked
call is serialised as canonical JSON (keys sorted, no blanks, absent values left
out). Messages that are neither call nor result (context) are serialised beside them.

Status, the first that holds: unlinked (a null id), context, orphan_result (no call
has the id), cyclic (the call waits for itself), invalid (its arguments break the
schema), unanswered (no result), out_of_order (the result comes no later than the
call), ok.

Repeated ids: the least call (turn, name, arguments) and the least result (turn,
content) count; n_calls and n_results tell how many there were, combined before
the shuffle, so a hot id costs a counter. Ties are equal in all that is shown.
Dependencies without a call don't delay a call; n_missing counts them. Rows with a
null id keep a row each. Null turns sort first and make a pair out of order.
Malformed or null argument text is invalid. Very long texts are carried whole.
Empty tables give empty results; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import discard, stored


@dataclass(frozen=True)
class Field:
    """One argument: JSON type (string, integer, number, boolean, array, object), presence, bounds (of a number, a string's length or an array's size), allowed values (as text), type of an array's items and fields of an object."""

    name: str
    kind: str
    required: bool = True
    least: float | None = None
    most: float | None = None
    values: tuple[str, ...] = ()
    items: str | None = None
    fields: tuple[Field, ...] = ()


#: Variant types that a JSON type allows.
KINDS = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda value: F.coalesce(_kind(value).isin(KINDS[kind]), F.lit(False))


def _of_object(doc: Column, fields: tuple[Field, ...], path: str = "") -> Column:
    """What is wrong with the fields of an object (a variant), in no order."""
    keys = F.coalesce(F.json_object_keys(F.to_json(doc)), F.array().cast("array<string>"))
    found, nested = [], []
    for f in fields:
        name = f"{path}{f.name}"
        value = F.variant_get(doc, f"$.{f.name}", "variant")
        present = F.array_contains(keys, f.name)
        if f.required:
            found.append(F.when(~present, f"{name}: missing"))
        typed = _is_kind(f.kind)(value)
        found.append(F.when(present & ~typed, f"{name}: not a {f.kind}"))
        text = F.try_variant_get(doc, f"$.{f.name}", "string")
        size = {"string": F.length(text), "array": F.size(F.try_variant_get(doc, f"$.{f.name}", "array<variant>"))}.get(f.kind, F.try_variant_get(doc, f"$.{f.name}", "double"))
        if f.least is not None:
            found.append(F.when(typed & (size < f.least), f"{name}: below {f.least:g}"))
        if f.most is not None:
            found.append(F.when(typed & (size > f.most), f"{name}: above {f.most:g}"))
        if f.values:
            found.append(F.when(typed & ~text.isin(*f.values), f"{name}: not an allowed value"))
        if f.items:
            items = F.try_variant_get(doc, f"$.{f.name}", "array<variant>")
            found.append(F.when(typed & ~F.forall(items, _is_kind(f.items)), f"{name}: not all items are {f.items}"))
        if f.fields:
            nested.append(F.when(typed, _of_object(value, f.fields, f"{name}.")).otherwise(F.array().cast("array<string>")))
    extra = F.transform(F.array_except(keys, F.array(*[F.lit(f.name) for f in fields])), lambda k: F.concat(F.lit(path), k, F.lit(": unknown")))
    return F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()), extra, *nested)


def violations(arguments: Column, name: Column, tools: dict[str, list[Field]]) -> Column:
    """Sorted texts of what is wrong with a call's arguments; empty if nothing is."""
    doc = F.try_parse_json(arguments)
    none = F.array().cast("array<string>")
    by_tool = reduce(lambda rest, t: F.when(name == t, F.array_sort(_of_object(doc, tuple(tools[t])))).otherwise(rest), tools, F.array(F.lit("unknown tool")))
    return F.when(doc.isNull() | ~F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False)), F.array(F.lit("arguments: not an object"))).otherwise(F.coalesce(by_tool, none))


def _anchors(chain: DataFrame) -> DataFrame:
    """(call_id, anchor, dist) of chain (call_id, dep), calls with one dependency: the first call up the chain that isn't in it.

    Pointers double, so rounds are the logarithm of the longest chain. Calls in or
    behind a cycle never meet an end: when as many steps are taken as there are
    calls, they are left out.
    """
    ids = chain.select(F.col("call_id").alias("dep"), F.lit(True).alias("inner"))
    begun = chain.join(ids, "dep", "left").select("call_id", F.col("dep").alias("anchor"), F.lit(1).cast("bigint").alias("dist"), F.col("inner").isNull().alias("ended"))
    at = stored(begun, "call-pointers")
    n, steps, ended, used = at.count(), 1, at.where("ended"), [at]
    while steps <= n and at.where("NOT ended").limit(1).count():
        whole = ended.union(at.where("NOT ended"))
        ahead = whole.select(F.col("call_id").alias("anchor"), F.col("anchor").alias("next"), F.col("dist").alias("more"), F.col("ended").alias("last"))
        at = stored(at.where("NOT ended").join(ahead, "anchor").select("call_id", F.col("next").alias("anchor"), (F.col("dist") + F.col("more")).alias("dist"), F.col("last").alias("ended")), "call-pointers")
        ended, steps = ended.union(at.where("ended")), 2 * steps
        used.append(at)
    out = stored(ended.select("call_id", "anchor", "dist"), "call-anchors")
    discard(*used)
    return out


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level, n_missing) of calls (call_id, depends_on), ids unique; level is null for calls in or behind a cycle.

    Only ids move. Chains of calls with one dependency each are shortened to a
    pointer and a distance first; what remains are calls with several dependencies.
    They are placed in rounds, as many as the longest path has of them, and every
    round only passes on the levels that are new.
    """
    wanted = calls.select("call_id", F.explode("depends_on").alias("dep")).where(F.col("dep").isNotNull()).distinct()
    ids = calls.select(F.col("call_id").alias("dep"), F.lit(True).alias("known"))
    edges = stored(wanted.join(ids, "dep", "left"), "call-edges")
    missing = edges.where("known IS NULL").groupBy("call_id").agg(F.count(F.lit(1)).alias("n_missing"))
    edges = edges.where("known").select("call_id", "dep")
    degrees = edges.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("dep").alias("dep"))
    anchors = _anchors(degrees.where("n = 1").select("call_id", "dep"))
    several = stored(degrees.where("n > 1").select("call_id"), "call-junctions")
    placed = calls.select("call_id").join(edges.select("call_id").distinct(), "call_id", "left_anti").withColumn("level", F.lit(0).cast("bigint"))
    if several.limit(1).count():
        # an edge of a call with several dependencies, from its own dependency or from that one's anchor
        links = edges.join(several, "call_id").join(anchors.select(F.col("call_id").alias("dep"), "anchor", "dist"), "dep", "left")
        links = stored(links.select("call_id", F.coalesce("anchor", "dep").alias("anchor"), (F.coalesce("dist", F.lit(0)) + 1).alias("dist")), "call-links")
        fresh = stored(placed, "call-level")
        state = stored(links.groupBy("call_id").agg(F.count(F.lit(1)).alias("waits"), F.lit(0).cast("bigint").alias("level")), "call-waits")
        placed = fresh
        while True:
            got = links.join(fresh.withColumnRenamed("call_id", "anchor"), "anchor").groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("level") + F.col("dist")).alias("new"))
            left = state.where("waits > 0").join(got, "call_id", "left")
            after = stored(left.select("call_id", (F.col("waits") - F.coalesce("n", F.lit(0))).alias("waits"), F.greatest("level", "new").alias("level")), "call-waits")
            fresh = stored(after.where("waits = 0").select("call_id", "level"), "call-level")
            discard(state)
            state = after
            if not fresh.limit(1).count():
                break
            placed = placed.union(fresh)
        placed = stored(placed, "call-levels")
    above = placed.select(F.col("call_id").alias("anchor"), F.col("level").alias("base"))
    followers = anchors.join(above, "anchor").select("call_id", (F.col("base") + F.col("dist")).alias("level"))
    done = placed.union(followers).select("call_id", F.col("level").cast("int").alias("level"))
    return calls.select("call_id").join(done, "call_id", "left").join(missing, "call_id", "left").select("call_id", "level", F.coalesce("n_missing", F.lit(0)).alias("n_missing"))


def link(calls: DataFrame, results: DataFrame, tools: dict[str, list[Field]], context: DataFrame | None = None) -> DataFrame:
    """One row per call id, and per id and role of context: call_id, turn, name, level, n_missing, n_calls, n_results, status, problems and json.

    calls: call_id, turn, name, arguments (JSON text), depends_on (ids). results: call_id, turn, content. context: call_id, turn, role, content.
    """
    known = calls.where(F.col("call_id").isNotNull())
    one = known.groupBy("call_id").agg(F.min(F.struct("turn", "name", "arguments", "depends_on")).alias("c"), F.count(F.lit(1)).alias("n_calls"))
    one = stored(one.select("call_id", "c.*", "n_calls"), "calls")
    answers = results.where(F.col("call_id").isNotNull()).groupBy("call_id").agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results"))
    linked = one.join(levels(one), "call_id").join(answers, "call_id", "full_outer")
    columns = ["call_id", "turn", "name", "arguments", "level", "n_missing", "n_calls", "n_results", "r"]
    single = F.lit(1).cast("bigint")
    nameless = calls.where(F.col("call_id").isNull()).select("call_id", "turn", "name", "arguments", F.lit(0).alias("level"), F.lit(0).cast("bigint").alias("n_missing"), single.alias("n_calls"))
    lost = results.where(F.col("call_id").isNull()).select("call_id", F.struct("turn", "content").alias("r"), single.alias("n_results"))
    both = linked.select(*columns).unionByName(nameless, allowMissingColumns=True).unionByName(lost, allowMissingColumns=True).withColumn("role", F.lit(None).cast("string"))
    if context is not None:
        said = F.struct("turn", "content")
        per_id = context.where(F.col("call_id").isNotNull()).groupBy("call_id", "role").agg(F.min(said).alias("r"), F.count(F.lit(1)).alias("n_results"))
        others = per_id.unionByName(context.where(F.col("call_id").isNull()).select("call_id", "role", said.alias("r"), single.alias("n_results")))
        others = others.withColumns({"turn": F.col("r.turn"), "name": F.col("role")})
        both = both.unionByName(others, allowMissingColumns=True)
    problems = F.when(F.col("n_calls").isNotNull(), violations(F.col("arguments"), F.col("name"), tools)).otherwise(F.array().cast("array<string>"))
    status = (
        F.when(F.col("call_id").isNull(), "unlinked")
        .when(F.col("role").isNotNull(), "context")
        .when(F.col("n_calls").isNull(), "orphan_result")
        .when(F.col("level").isNull(), "cyclic")
        .when(F.size("problems") > 0, "invalid")
        .when(F.col("n_results").isNull(), "unanswered")
        .when(~F.coalesce(F.col("r.turn") > F.col("turn"), F.lit(False)), "out_of_order")
        .otherwise("ok")
    )
    called, bare = F.col("role").isNull(), F.lit(None).cast("string")
    document = F.struct(
        F.try_parse_json("arguments").alias("arguments"), F.when(~called, F.col("r.content")).alias("content"), F.col("call_id").alias("id"), "level",
        F.when(called, F.col("name")).otherwise(bare).alias("name"), F.when(called, F.col("r.content")).alias("result"), "role", "status",
    )
    out = both.withColumn("problems", problems).withColumn("status", status).withColumn("json", F.to_json(document))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select("call_id", "turn", "name", "level", count("n_missing"), count("n_calls"), count("n_results"), "status", F.array_join("problems", "; ").alias("problems"), "json")


#: The tools that conversation turns are read as calls of (fixed values of the query).
TOOLS = {
    "reply": [Field("chars", "integer", least=1), Field("text", "string", least=1), Field("words", "integer", least=1, most=120)],
    "short_reply": [Field("chars", "integer", least=1, most=300), Field("text", "string", False), Field("words", "integer")],
}


def call_id(turn: Column) -> Column:
    return F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))


def conversation_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read a conversation as calls, results and context.

    A turn of the assistant is a call whose arguments are its text and counts; the
    user's turn after it is its result, and it depends on the assistant's turn
    before that. System turns, the user's first turn and turns of other roles are context.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    arguments = F.to_json(F.struct(words.alias("words"), text.alias("text"), F.length(text).alias("chars")))
    name = F.when(F.length(text) < 200, "short_reply").otherwise("reply")
    parent = F.when(F.col("turn") >= 2, call_id(F.col("turn") - 2))
    calls = messages.where("role = 'assistant'").select(
        call_id(F.col("turn")).alias("call_id"), "turn", name.alias("name"), arguments.alias("arguments"), F.filter(F.array(parent), lambda x: x.isNotNull()).alias("depends_on")
    )
    answer = (F.col("role") == "user") & ~F.coalesce(F.col("turn") <= 0, F.lit(False))
    results = messages.where(answer).select(call_id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    rest = messages.where(~F.coalesce((F.col("role") == "assistant") | answer, F.lit(False)))
    context = rest.select(call_id(F.col("turn")).alias("call_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.col("text").alias("content"))
    return calls, results, context
