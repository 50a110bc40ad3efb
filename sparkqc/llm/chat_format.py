"""Chat formatting with linked tool calls.

Calls and results are hash-joined by conversation and call id; calls are ordered topologically (a call may name
the call it comes ``after``); arguments are validated against the schema of their tool; and every message is serialised as
canonical JSON (sorted keys, no spaces).

Levels come from pointer doubling: each round a call's pointer jumps to its pointer's pointer, so a chain of n calls needs
log2(n) joins on unique keys, however long a conversation is. Rows are never gathered by conversation, so one that
holds a third of all rows is spread like any other.

Defined results: of several calls (or results) with one id the smallest by content is linked and its ``n_rows`` tells how many
there were; each other content follows once with the state ``duplicate``, the kind ``duplicate_call`` or ``duplicate_result``, no level
or place, and the number of its own rows; a result without a call is an ``orphan``, a call without a result ``unanswered``; a call that comes after one that does not
exist is a root; calls on or behind a cycle have no level and the state ``cycle``. A null argument counts as missing;
a null result is ``null`` in the JSON. Rows without conversation or call id are linked to nothing:
each is an unanswered call without a level or an orphan of its own, with ``n_rows`` 1. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkqc.llm.common import staged

Schema = Mapping[str, tuple[str, bool]]  # parameter -> (type, required)


def quoted(text: Column) -> Column:
    """A JSON string; null stays null."""
    wrapped = F.to_json(F.struct(text.alias("a")))
    return F.when(text.isNotNull(), F.substr(wrapped, F.lit(6), F.length(wrapped) - 6))


def _fits(value: Column, kind: Column) -> Column:
    return (F.when(kind == "integer", F.regexp_like(value, F.lit(r"^-?(0|[1-9][0-9]*)$")))
            .when(kind == "number", F.regexp_like(value, F.lit(r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$")))
            .when(kind == "boolean", value.isin("true", "false")).otherwise(True))


def levels(calls: DataFrame) -> DataFrame:
    """``(conv, id, level)``: the number of calls before each in its chain; null on and behind cycles."""
    known = calls.select(F.col("conv").alias("_c"), F.col("id").alias("_to"))
    start = calls.join(known, (F.col("conv") == F.col("_c")) & (F.col("after") == F.col("_to")), "left").select(
        "conv", "id", F.col("_to").alias("to"), F.when(F.col("_to").isNull(), 0).otherwise(1).cast("long").alias("level"))
    nodes = staged(start, "chat-levels")
    n = nodes.count()
    while nodes.where(F.col("to").isNotNull() & (F.col("level") <= n)).limit(1).count():
        ahead = nodes.select(F.col("conv").alias("_c"), F.col("id").alias("_i"), F.col("to").alias("_next"), F.col("level").alias("_more"))
        jumped = nodes.join(ahead, (F.col("conv") == F.col("_c")) & (F.col("to") == F.col("_i")), "left")
        nodes = staged(jumped.select("conv", "id", F.col("_next").alias("to"), (F.col("level") + F.coalesce("_more", F.lit(0))).alias("level")), "chat-levels")
    return nodes.select("conv", "id", F.when(F.col("to").isNull(), F.col("level")).alias("level"))


def validate(calls: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """Adds ``errors`` (array) and ``message``; ``schemas`` is a parameter, so its table is small by construction."""
    spark = calls.sparkSession
    rows = [(tool, [(p, k, r) for p, (k, r) in sorted(s.items())]) for tool, s in schemas.items()]
    tools = F.broadcast(spark.createDataFrame(rows, "_tool string, _params array<struct<p:string,kind:string,required:boolean>>"))
    known = calls.join(tools, F.col("name") == F.col("_tool"), "left")
    given = F.coalesce(F.col("arguments"), F.create_map().cast("map<string,string>"))
    params = F.coalesce("_params", F.array().cast("array<struct<p:string,kind:string,required:boolean>>"))
    missing = F.transform(F.filter(params, lambda x: x["required"] & F.try_element_at(given, x["p"]).isNull()), lambda x: F.concat(F.lit("missing:"), x["p"]))
    wrong = F.transform(F.filter(params, lambda x: ~F.coalesce(_fits(F.try_element_at(given, x["p"]), x["kind"]), F.lit(True))), lambda x: F.concat(F.lit("type:"), x["p"]))
    names = F.transform(params, lambda x: x["p"])
    extra = F.transform(F.filter(F.array_sort(F.map_keys(given)), lambda k: ~F.array_contains(names, k)), lambda k: F.concat(F.lit("unknown:"), k))
    no_tool = F.when(F.col("_tool").isNull(), F.array(F.lit("tool"))).otherwise(F.array().cast("array<string>"))
    errors = F.when(F.col("_tool").isNull(), no_tool).otherwise(F.concat(missing, wrong, extra))
    plain = F.transform(F.filter(params, lambda x: x["kind"] != "string"), lambda x: x["p"])
    entries = F.filter(F.array_sort(F.map_entries(given)), lambda e: e["value"].isNotNull())
    pairs = F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit(":"), F.when(
        F.array_contains(plain, e["key"]) & ~F.array_contains(wrong, F.concat(F.lit("type:"), e["key"])), e["value"]).otherwise(quoted(e["value"]))))
    message = F.concat(F.lit('{"arguments":{'), F.array_join(pairs, ","), F.lit('},"id":'), F.coalesce(quoted(F.col("id")), F.lit("null")), F.lit(',"name":'), F.coalesce(quoted(F.col("name")), F.lit("null")), F.lit("}"))
    return known.withColumn("errors", errors).withColumn("message", message).drop("_tool", "_params")


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """``calls``: (conv, id, after, name, arguments map<string,string>); ``results``: (conv, id, content).

    Returns one row per call and per result, per other content of their ids, and per call or result without a key: (conv, id, kind, state, level, place, errors, message, n_rows); ``place`` orders
    the messages of a conversation, ties by id.
    """
    kinds = lambda rows: rows.groupBy("conv", "id", "content").agg(F.count(F.lit(1)).alias("n"))
    named = F.col("conv").isNotNull() & F.col("id").isNotNull()
    unpacked = ["c.name", "c.after", F.map_from_entries("c.entries").alias("arguments")]
    said = staged(calls.select("conv", "id", F.struct("name", "after", F.array_sort(F.map_entries("arguments")).alias("entries")).alias("content")), "chat-said")
    told = staged(results.select("conv", "id", F.struct("content").alias("content")), "chat-told")
    by_call, by_result = staged(kinds(said.where(named)), "chat-calls"), staged(kinds(told.where(named)), "chat-results")
    first = lambda rows: rows.groupBy("conv", "id").agg(F.min("content").alias("c"), F.sum("n").alias("n_rows"))
    asked = staged(first(by_call).select("conv", "id", "n_rows", *unpacked), "chat-calls")
    answered = first(by_result).select(F.col("conv").alias("_conv"), F.col("id").alias("_id"), F.col("c.content").alias("content"), F.col("n_rows").alias("_n"))
    depth = levels(asked.select("conv", "id", "after")).withColumnsRenamed({"conv": "_lc", "id": "_li"})
    checked = validate(asked, schemas).join(depth, (F.col("conv") == F.col("_lc")) & (F.col("id") == F.col("_li")), "left")
    both = checked.join(answered, (F.col("conv") == F.col("_conv")) & (F.col("id") == F.col("_id")), "full")
    is_call, is_result = F.col("n_rows").isNotNull(), F.col("_n").isNotNull()
    cyclic = F.col("_li").isNotNull() & F.col("level").isNull()
    no_errors = F.array().cast("array<string>")
    answer = lambda id_: F.concat(F.lit('{"content":'), F.coalesce(quoted(F.col("content")), F.lit("null")), F.lit(',"tool_call_id":'), F.coalesce(quoted(id_), F.lit("null")), F.lit("}"))
    call = F.struct(
        F.col("conv"), F.col("id"), F.lit("call").alias("kind"),
        F.when(cyclic, "cycle").when(is_result, "linked").otherwise("unanswered").alias("state"), F.col("level"),
        (F.col("level") * 2).alias("place"), F.col("errors"), F.col("message"), F.col("n_rows"))
    result = F.struct(
        F.col("_conv").alias("conv"), F.col("_id").alias("id"), F.lit("result").alias("kind"),
        F.when(~is_call, "orphan").when(cyclic, "cycle").otherwise("linked").alias("state"), F.col("level"),
        (F.col("level") * 2 + 1).alias("place"), no_errors.alias("errors"), answer(F.col("_id")).alias("message"),
        F.col("_n").alias("n_rows"))
    linked = both.select(F.explode(F.filter(F.array(F.when(is_call, call), F.when(is_result, result)), lambda x: x.isNotNull())).alias("m")).select("m.*")

    def others(rows: DataFrame) -> DataFrame:
        least = first(rows).select(F.col("conv").alias("_c"), F.col("id").alias("_i"), "c")
        return rows.join(least, (F.col("conv") == F.col("_c")) & (F.col("id") == F.col("_i"))).where(F.col("content") != F.col("c")).select("conv", "id", F.col("content").alias("c"), F.col("n").alias("n_rows"))

    def alone(rows: DataFrame, kind: str, state: str, errors: Column, message: Column) -> DataFrame:
        none = F.lit(None).cast("long")
        return rows.select("conv", "id", F.lit(kind).alias("kind"), F.lit(state).alias("state"), none.alias("level"), none.alias("place"), errors.alias("errors"), message.alias("message"), "n_rows")

    one = lambda rows: rows.where(~named).select("conv", "id", F.col("content").alias("c"), F.lit(1).cast("long").alias("n_rows"))
    for rows, kind, state in ((others(by_call), "duplicate_call", "duplicate"), (one(said), "call", "unanswered")):
        linked = linked.unionByName(alone(validate(rows.select("conv", "id", "n_rows", *unpacked), schemas), kind, state, F.col("errors"), F.col("message")))
    for rows, kind, state in ((others(by_result), "duplicate_result", "duplicate"), (one(told), "result", "orphan")):
        linked = linked.unionByName(alone(rows.select("conv", "id", "c.content", "n_rows"), kind, state, no_errors, answer(F.col("id"))))
    return linked


# The tools that plain conversations are taken to call.
CONVERSATION_TOOLS: dict[str, Schema] = {
    "reply": {"text": ("string", True), "turn": ("integer", True)},
    "setup": {"text": ("string", True), "turn": ("integer", True)},
}


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: a user turn calls ``reply``, a system turn ``setup``, an assistant turn is the
    result of the turn before it; a call comes after the call before it. Other roles are results too."""
    turns = conversations.select("conv_id", "turn", "role", "text")
    ident = lambda t: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), t.cast("string"))
    asks = F.coalesce(F.col("role").isin("user", "system"), F.lit(False))
    before = turns.where(asks).select(F.col("conv_id").alias("_c"), (F.col("turn") + 1).alias("_t")).distinct()
    calls = turns.where(asks).join(before, (F.col("conv_id") == F.col("_c")) & (F.col("turn") == F.col("_t")), "left").select(
        F.col("conv_id").alias("conv"), ident(F.col("turn")).alias("id"), ident(F.when(F.col("_t").isNotNull(), F.col("turn") - 1).otherwise(F.col("turn") - 2)).alias("after"),
        F.when(F.col("role") == "user", "reply").otherwise("setup").alias("name"),
        F.create_map(F.lit("text"), F.col("text"), F.lit("turn"), F.col("turn").cast("string")).alias("arguments"))
    results = turns.where(~asks).select(F.col("conv_id").alias("conv"), ident(F.col("turn") - 1).alias("id"), F.col("text").alias("content"))
    return calls, results


ORACLE = """
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role IN ('user', 'system'), false) AS asks, role, text FROM conversations),
c0 AS (SELECT conv_id, turn, min(CASE role WHEN 'user' THEN 'reply' ELSE 'setup' END) AS name, count(*) AS n FROM t WHERE asks GROUP BY ALL),
c AS (SELECT c0.*, (SELECT text FROM t WHERE t.conv_id = c0.conv_id AND t.turn = c0.turn AND asks AND (role = 'user') = (c0.name = 'reply') ORDER BY text NULLS FIRST LIMIT 1) AS text,
             CASE WHEN p.turn IS NOT NULL THEN c0.turn - 1 ELSE c0.turn - 2 END AS after
      FROM c0 LEFT JOIN (SELECT DISTINCT conv_id, turn FROM c0) p ON p.conv_id = c0.conv_id AND p.turn = c0.turn - 1),
l AS (SELECT conv_id, turn, 0 AS level FROM c WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.conv_id = c.conv_id AND b.turn = c.after)
      UNION ALL SELECT c.conv_id, c.turn, level + 1 FROM l JOIN c ON c.conv_id = l.conv_id AND c.after = l.turn),
r AS (SELECT conv_id, turn - 1 AS turn, min(text) AS text, bool_or(text IS NULL) AS hollow, count(*) AS n FROM t WHERE NOT asks GROUP BY ALL),
m AS (
  SELECT c.conv_id, c.turn, 'call' AS kind, CASE WHEN r.n IS NULL THEN 'unanswered' ELSE 'linked' END AS state, level, 2 * level AS place,
         CAST((c.text IS NULL) AS BIGINT) AS n_errors, c.n AS n_rows,
         '{"arguments":{' || CASE WHEN c.text IS NULL THEN '' ELSE '"text":' || to_json(c.text) || ',' END || '"turn":' || c.turn || '},"id":"call_' || c.conv_id || '_' || c.turn || '","name":"' || c.name || '"}' AS message
  FROM c JOIN l USING (conv_id, turn) LEFT JOIN r USING (conv_id, turn)
  UNION ALL
  SELECT r.conv_id, r.turn, 'result', CASE WHEN c.n IS NULL THEN 'orphan' ELSE 'linked' END, level, 2 * level + 1, 0, r.n,
         '{"content":' || CASE WHEN r.hollow THEN 'null' ELSE CAST(to_json(r.text) AS VARCHAR) END || ',"tool_call_id":"call_' || r.conv_id || '_' || r.turn || '"}'
  FROM r LEFT JOIN c USING (conv_id, turn) LEFT JOIN l USING (conv_id, turn))
SELECT conv_id, 'call_' || conv_id || '_' || turn AS call_id, kind, state, CAST(level AS BIGINT) AS level, CAST(place AS BIGINT) AS place, n_errors, message, n_rows FROM m
"""
