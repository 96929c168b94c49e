"""Tool-call linking for chat data (DataFrame functions only).

Calls and results are hash-joined by (conversation, call id); calls are ordered so that
a call stands after every call it depends on; arguments are parsed, checked against the
tool's schema and serialised as canonical JSON (sorted keys, no white space).

* Repeated ids: the call (result) of the smallest position under an id is the one that is
  linked; the others are reported.  It is found by a partial aggregate, so no join ever
  pairs all calls with all results of a hot id.
* ``depth`` is the longest chain of dependencies below a call.  Calls with at most one
  dependency, the bulk, are resolved by pointer doubling (log2 of the longest chain
  rounds); the rest layer by layer over the contracted graph, one small job a layer.  Dependencies on ids that
  do not occur are reported and carry no order; calls on a cycle, or behind one, have no
  depth and are reported.
* No conversation is gathered into one row or task: (depth, position) is the topological
  order inside a conversation, and the result is range-partitioned and sorted by it, so a
  conversation holding a third of all rows is split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged

KEY = ["conv_id", "call_id"]
#: Tools up to this many are broadcast with their schemas (some hundred bytes each).
BROADCAST_TOOLS = 50_000


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Shuffled hash join; ``right`` has one row per key and is the side that is built."""
    return left.join(right.hint("shuffle_hash"), on, how)


def _first(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Per (conversation, id) the row of the smallest position, and how many there are.

    Ties on the position go to the smallest of the other columns."""
    return rows.groupBy(*KEY).agg(
        F.min(F.struct("position", *cols)).alias("it"), F.count(F.lit(1)).alias("n"))


def depths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of the nodes that have one.

    ``nodes``: distinct keys.  ``edges``: distinct (conv_id, call_id, parent), both ends
    being nodes.
    """
    fan = edges.groupBy(*KEY).agg(F.count(F.lit(1)).alias("fan"), F.min("parent").alias("parent"))
    kinds = staged(_join(nodes, fan, KEY, "left").select(
        *KEY, F.coalesce("fan", F.lit(0)).alias("fan"),
        # A pointer to itself marks the end of a chain: no dependency, or several.
        F.when(F.col("fan") == 1, F.col("parent")).otherwise(F.col("call_id")).alias("top"),
        F.when(F.col("fan") == 1, 1).otherwise(0).cast("long").alias("hops")), "tool-nodes")
    ends = kinds.where("fan <> 1").select("conv_id", F.col("call_id").alias("top"), F.lit(True).alias("end"))
    chains = kinds.where("fan = 1").select(*KEY, "top", "hops")
    done = chains.where("false")  # chains that have reached their end
    while True:
        marked = staged(_join(chains, ends, ["conv_id", "top"], "left"), "tool-chains")
        there = marked.agg(F.count("end").alias("reached"), F.count(F.lit(1)).alias("all")).first()
        reached = marked.where("end").select(*KEY, "top", "hops")
        left = marked.where("end IS NULL").select(*KEY, "top", "hops")
        # Without any in this round, no longer chain has an end: the rest lies on cycles.
        if not there["reached"]:
            break
        done = done.unionByName(reached)
        if there["reached"] == there["all"]:
            break
        # Follow the pointer of the pointer.
        step = done.unionByName(left).select(
            "conv_id", F.col("call_id").alias("top"), F.col("top").alias("top2"), F.col("hops").alias("hops2"))
        chains = _join(left, step, ["conv_id", "top"]).select(
            *KEY, F.col("top2").alias("top"), (F.col("hops") + F.col("hops2")).alias("hops"))
    done = staged(done, "tool-chains-done")
    # Layers over calls with several dependencies, each dependency replaced by its chain's end.
    solved = kinds.where("fan = 0").select("conv_id", F.col("call_id").alias("top"),
                                           F.lit(0).cast("long").alias("depth"))
    many = kinds.where("fan > 1").select(*KEY)
    if not many.isEmpty():
        hop = done.select("conv_id", F.col("call_id").alias("parent"), F.col("top").alias("p_top"), "hops")
        # Per open edge the depth it gives, once its end is solved.
        edges = _join(_join(edges, many, KEY, "left_semi"), hop, ["conv_id", "parent"], "left").select(
            *KEY, F.coalesce("p_top", "parent").alias("top"),
            (F.coalesce("hops", F.lit(0)) + 1).alias("weight"), F.lit(None).cast("long").alias("gives"))
        parts, fresh = [solved], solved
        while True:
            edges = staged(_join(edges, fresh, ["conv_id", "top"], "left").select(
                *KEY, "top", "weight", F.coalesce("gives", F.col("depth") + F.col("weight")).alias("gives")), "tool-edges")
            judged = staged(edges.groupBy(*KEY).agg(F.max("gives").alias("depth"),
                                                    F.bool_and(F.col("gives").isNotNull()).alias("ready")), "tool-layer")
            there = judged.agg(F.count_if("ready").alias("ready"), F.count(F.lit(1)).alias("all")).first()
            if not there["ready"]:
                break
            fresh = judged.where("ready").select("conv_id", F.col("call_id").alias("top"), "depth")
            parts.append(fresh)
            if len(parts) == 8:  # keeps the final union short
                parts = [staged(reduce(DataFrame.unionByName, parts), "tool-solved")]
            if there["ready"] == there["all"]:
                break
            edges = _join(edges, judged.where("NOT ready").select(*KEY), KEY, "left_semi")
        solved = staged(reduce(DataFrame.unionByName, parts), "tool-solved")
    below = _join(done, solved, ["conv_id", "top"]).select(
        *KEY, (F.col("depth") + F.col("hops")).alias("depth"))
    return solved.select("conv_id", F.col("top").alias("call_id"), "depth").unionByName(below)


def _checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds ``canonical`` (null unless the arguments are one JSON object) and ``errors``."""
    wanted = schemas.groupBy(F.col("tool").alias("s_tool")).agg(
        F.array_sort(F.collect_set(F.struct(
            "param", F.lower("type").alias("type"), "required"))).alias("params"))
    few = wanted.count() <= BROADCAST_TOOLS
    rows = calls.join(F.broadcast(wanted) if few else wanted, F.col("tool") == F.col("s_tool"), "left").drop("s_tool")
    if not few:  # the join has dealt the rows out by tool
        rows = rows.repartitionByRange("conv_id", "depth", "position", "call_id")
    value = F.try_parse_json("arguments")
    is_object = F.schema_of_variant(value).startswith("OBJECT")
    kinds = F.transform_values(
        F.from_json(F.col("canonical"), "map<string,variant>"),
        lambda k, v: F.schema_of_variant(v))
    rows = rows.withColumn("canonical", F.when(is_object, F.to_json(value)))
    rows = rows.withColumn("kinds", F.when(F.col("canonical").isNotNull(), kinds))

    def fits(kind, want):
        return (F.when(want == "any", F.lit(True))
                .when(want == "string", kind == "STRING")
                .when(want == "integer", kind == "BIGINT")
                .when(want == "number", (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"))
                .when(want == "boolean", kind == "BOOLEAN")
                .when(want == "array", kind.startswith("ARRAY"))
                .when(want == "object", kind.startswith("OBJECT"))
                .otherwise(F.lit(False)))

    missing = F.transform(
        F.filter("params", lambda p: p["required"] & ~F.map_contains_key("kinds", p["param"])),
        lambda p: F.concat(F.lit("missing:"), p["param"]))
    wrong = F.transform(
        F.filter("params", lambda p: F.map_contains_key("kinds", p["param"])
                 & ~fits(F.element_at("kinds", p["param"]), p["type"])),
        lambda p: F.concat(F.lit("type:"), p["param"]))
    names = F.transform("params", lambda p: p["param"])
    extra = F.transform(
        F.filter(F.array_sort(F.map_keys("kinds")), lambda k: ~F.array_contains(names, k)),
        lambda k: F.concat(F.lit("unexpected:"), k))
    errors = (F.when(F.col("params").isNull(), F.array(F.lit("unknown_tool")))
              .when(F.col("kinds").isNull(), F.array(F.lit("malformed_arguments")))
              .otherwise(F.concat(missing, wrong, extra)))
    return rows.withColumn("errors", errors).drop("params", "kinds")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per row of ``calls``, ordered by (conv_id, depth, position).

    calls: conv_id, call_id, position, tool, arguments (JSON text), depends_on
    (array<string> of call ids).  results: conv_id, call_id, position, content.
    schemas: tool, param, type (string, integer, number, boolean, array, object, any),
    required.  Further columns stay out.

    Result: conv_id, call_id, position, tool, status, depth, n_results, errors, record.
    status: ``invalid_id`` (null conversation or call id), ``duplicate`` (not the first
    call of its id), ``cyclic``, ``no_result``, ``result_before_call``, ``linked``, in
    this order.  errors: schema errors, then ``dangling:<id>`` for dependencies that do
    not occur.  record: canonical JSON of call and linked result.

    Null arguments are malformed; a null tool is unknown; null dependencies are none.
    Equal rows: the first is linked, every further copy is a duplicate row of its own.
    """
    calls = calls.select(
        F.col("conv_id").cast("string"), F.col("call_id").cast("string"),
        F.col("position").cast("long"), F.col("tool").cast("string"), F.col("arguments").cast("string"),
        F.array_sort(F.array_distinct(F.array_compact(F.coalesce(
            F.col("depends_on").cast("array<string>"), F.array().cast("array<string>"))))).alias("depends_on"))
    results = results.select(
        F.col("conv_id").cast("string"), F.col("call_id").cast("string"),
        F.col("position").cast("long"), F.col("content").cast("string")).dropna(subset=KEY)
    calls = staged(calls, "tool-messages")
    named = calls.dropna(subset=KEY)
    cols = ["tool", "arguments", "depends_on"]
    first = staged(_first(named, cols).select(*KEY, "it.*", F.col("n").alias("copies")), "tool-calls")
    found = _first(results, ["content"]).select(
        *KEY, F.col("it.position").alias("r_position"), F.col("it.content").alias("content"),
        F.col("n").alias("n_results"))

    wanted = first.select(*KEY, F.explode("depends_on").alias("parent"))
    ids = first.select("conv_id", F.col("call_id").alias("parent"), F.lit(True).alias("there"))
    edges = staged(_join(wanted, ids, ["conv_id", "parent"], "left"), "tool-dependencies")
    depth = depths(first.select(*KEY), edges.where("there").select(*KEY, "parent"))
    dangling = edges.where("there IS NULL").groupBy(*KEY).agg(
        F.array_sort(F.collect_set(F.concat(F.lit("dangling:"), "parent"))).alias("dangling"))

    none = F.array().cast("array<string>")
    linked = (_join(_join(_join(first, found, KEY, "left"), depth, KEY, "left"), dangling, KEY, "left")
              .withColumn("status", F.when(F.col("depth").isNull(), "cyclic")
                          .when(F.col("n_results").isNull(), "no_result")
                          .when(F.col("r_position") < F.col("position"), "result_before_call")
                          .otherwise("linked")))
    # Further rows of an id: rows that differ from the linked one, and its exact copies.
    same = first.select(*KEY, "copies", *[F.col(c).alias(f"f_{c}") for c in ["position", *cols]])
    rest = (named.groupBy(*KEY, "position", *cols).agg(F.count(F.lit(1)).alias("n"))
            .join(same.where("copies > 1").hint("shuffle_hash"), KEY))
    is_first = F.lit(True)
    for c in ["position", *cols]:
        is_first = is_first & F.col(c).eqNullSafe(F.col(f"f_{c}"))
    rest = rest.withColumn("n", F.col("n") - F.when(is_first, 1).otherwise(0)).where("n > 0")
    rest = rest.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    blank = [F.lit(None).cast("long").alias("r_position"), F.lit(None).cast("string").alias("content"),
             F.lit(None).cast("long").alias("n_results"), F.lit(None).cast("long").alias("depth"),
             F.lit(None).cast("array<string>").alias("dangling")]
    base = [*KEY, "position", *cols]
    bad = calls.where(F.col("conv_id").isNull() | F.col("call_id").isNull())
    everything = (linked.select(*base, "r_position", "content", "n_results", "depth", "dangling", "status")
                  .unionByName(rest.select(*base, *blank, F.lit("duplicate").alias("status")))
                  .unionByName(bad.select(*base, *blank, F.lit("invalid_id").alias("status"))))
    # Ranges first: their sampling then reads a plain table; the check keeps partitions.
    order = ["conv_id", "depth", "position", "call_id"]
    checked = _checked(staged(everything, "tool-linked").repartitionByRange(*order), schemas)
    raw = F.coalesce(F.col("canonical"), F.to_json(F.struct(F.col("arguments").alias("raw"))))
    head = F.to_json(F.struct("call_id", "depends_on", "status", "tool"), {"ignoreNullFields": "false"})
    tail = F.to_json(F.struct(F.col("content").alias("result")), {"ignoreNullFields": "false"})
    # Keys in order: arguments, call_id, depends_on, result, status, tool.
    text = F.concat(F.lit('{"arguments":'), raw, F.lit(","),
                    F.regexp_extract(head, r'^\{(.*),"status":"[a-z_]+","tool":', 1), F.lit(","),
                    F.regexp_extract(tail, r"(?s)^\{(.*)\}$", 1), F.lit(","),
                    F.regexp_extract(head, r'("status":"[a-z_]+","tool":.*\})$', 1))
    return checked.select("conv_id", "call_id", "position", "tool", "status", "depth",
                          F.coalesce("n_results", F.lit(0)).alias("n_results"),
                          F.concat("errors", F.coalesce("dangling", none)).alias("errors"),
                          text.alias("record")).sortWithinPartitions(*order)


# --- the query: tool traffic derived from ``conversations`` -----------------------------

#: tool, param, type, required
TOOLS = [
    ("lookup", "limit", "integer", True), ("lookup", "strict", "boolean", False),
    ("lookup", "text", "string", True),
    ("rewrite", "limit", "number", False), ("rewrite", "text", "string", True),
    ("translate", "strict", "boolean", True), ("translate", "text", "string", True),
]


def calls_of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every user turn is a call, every assistant turn the result of the turn before it.

    The tool and the faults (unknown tool, wrong type, missing, extra and broken
    arguments) follow from the length of the text; a call depends on the call two turns
    before it, and each fifth one also on the call four turns before."""
    n = F.length(F.coalesce("text", F.lit("")))
    tool = (F.when(n % 19 == 0, "search").when(n % 3 == 0, "lookup").when(n % 3 == 1, "rewrite")
            .otherwise("translate"))
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"),
                                 turn.cast("string"))
    quoted = F.regexp_extract(F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t"))),
                              r'(?s)^\{"t":(.*)\}$', 1)
    text = F.when(n % 11 == 0, F.lit("")).otherwise(F.concat(F.lit('"text" : '), quoted, F.lit(" , ")))
    limit = F.when(n % 7 == 0, F.concat(F.lit('"'), n.cast("string"), F.lit('"'))).otherwise(n.cast("string"))
    extra = F.when(n % 13 == 0, F.lit(', "note": null')).otherwise(F.lit(""))
    close = F.when(n % 17 == 0, F.lit("")).otherwise(F.lit(" }"))
    arguments = F.concat(F.lit("{ "), text, F.lit('"strict": '),
                         F.when(n % 2 == 0, "true").otherwise("false"), F.lit(', "limit": '), limit, extra, close)
    turn = F.col("turn")
    depends = F.when(turn < 2, F.array().cast("array<string>")).when(
        (n % 5 == 0) & (turn >= 4), F.array(name(turn - 2), name(turn - 4))).otherwise(F.array(name(turn - 2)))
    calls = turns.where("role = 'user'").select(
        "conv_id", name(turn).alias("call_id"), turn.alias("position"), tool.alias("tool"),
        arguments.alias("arguments"), depends.alias("depends_on"))
    results = turns.where("role = 'assistant'").select(
        "conv_id", name(turn - 1).alias("call_id"), turn.alias("position"), F.col("text").alias("content"))
    return calls, results


SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id, turn, role, text, length(coalesce(text, '')) AS n FROM conversations),
calls AS (
  SELECT conv_id, 'c' || conv_id || '-' || turn AS call_id, turn AS position, n, text,
    CASE WHEN n % 19 = 0 THEN 'search' WHEN n % 3 = 0 THEN 'lookup' WHEN n % 3 = 1 THEN 'rewrite'
         ELSE 'translate' END AS tool,
    list_sort(CASE WHEN turn < 2 THEN []::VARCHAR[]
         WHEN n % 5 = 0 AND turn >= 4 THEN ['c' || conv_id || '-' || (turn - 2), 'c' || conv_id || '-' || (turn - 4)]
         ELSE ['c' || conv_id || '-' || (turn - 2)] END) AS depends_on,
    to_json(coalesce(text, ''))::VARCHAR AS quoted,
    CASE WHEN n % 7 = 0 THEN '"' || n || '"' ELSE n::VARCHAR END AS lim,
    CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END AS strict
  FROM t WHERE role = 'user'),
edges AS (SELECT c.conv_id, c.call_id, unnest(c.depends_on) AS parent FROM calls c),
good AS (SELECT e.* FROM edges e JOIN calls p ON p.conv_id = e.conv_id AND p.call_id = e.parent),
dangling AS (SELECT e.conv_id, e.call_id, list_sort(list('dangling:' || e.parent)) AS dangling
  FROM edges e WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = e.conv_id AND p.call_id = e.parent)
  GROUP BY ALL),
walk(conv_id, call_id, depth) AS (
  SELECT conv_id, call_id, 0 FROM calls
  UNION
  SELECT g.conv_id, g.call_id, w.depth + 1 FROM walk w JOIN good g ON g.conv_id = w.conv_id AND g.parent = w.call_id),
deep AS (SELECT conv_id, call_id, max(depth) AS depth FROM walk GROUP BY ALL),
results AS (SELECT conv_id, 'c' || conv_id || '-' || (turn - 1) AS call_id, text AS content, count(*) OVER () AS k
  FROM t WHERE role = 'assistant'),
rows AS (
  SELECT c.*, d.depth, r.content, r.call_id IS NOT NULL AS has_result, g.dangling,
    CASE WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
    CASE WHEN n % 17 = 0 THEN '{"raw":' || to_json('{ ' ||
           CASE WHEN n % 11 = 0 THEN '' ELSE '"text" : ' || quoted || ' , ' END || '"strict": ' || strict ||
           ', "limit": ' || lim || CASE WHEN n % 13 = 0 THEN ', "note": null' ELSE '' END)::VARCHAR || '}'
         ELSE '{"limit":' || lim || CASE WHEN n % 13 = 0 THEN ',"note":null' ELSE '' END || ',"strict":' || strict ||
           CASE WHEN n % 11 = 0 THEN '' ELSE ',"text":' || quoted END || '}' END AS args,
    CASE WHEN tool = 'search' THEN 'unknown_tool' WHEN n % 17 = 0 THEN 'malformed_arguments'
         ELSE concat_ws(',',
           CASE WHEN n % 11 = 0 THEN 'missing:text' END,
           CASE WHEN n % 7 = 0 AND tool <> 'translate' THEN 'type:limit' END,
           CASE WHEN tool = 'translate' THEN 'unexpected:limit' END,
           CASE WHEN n % 13 = 0 THEN 'unexpected:note' END,
           CASE WHEN tool = 'rewrite' THEN 'unexpected:strict' END) END AS errs
  FROM calls c JOIN deep d USING (conv_id, call_id) LEFT JOIN results r USING (conv_id, call_id)
  LEFT JOIN dangling g USING (conv_id, call_id))
SELECT conv_id, call_id, position, tool, status, depth::BIGINT AS depth, has_result::BIGINT AS n_results,
  concat_ws(',', nullif(errs, ''), array_to_string(dangling, ',')) AS errors,
  '{"arguments":' || args || ',"call_id":"' || call_id || '","depends_on":' || to_json(depends_on)::VARCHAR ||
  ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"status":"' || status || '","tool":"' || tool || '"}' AS record
FROM rows
"""


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked, ordered and validated tool traffic of all ``conversations``."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    calls, results = calls_of_conversations(turns)
    schemas = spark.createDataFrame(TOOLS, "tool string, param string, type string, required boolean")
    out = link_tool_calls(calls, results, schemas)
    return out.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", "position", "tool", "status",
                      "depth", "n_results", F.concat_ws(",", "errors").alias("errors"), "record")
