"""Chat formatting: links tool calls and results, orders them, checks arguments and writes canonical JSON.

Spark functions only. A conversation is never gathered: every call and every result stays a row, with keys to sort by.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.llm.common import cut

#: Types of a schema and the beginning of the names that Spark gives to such JSON values.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DECIMAL|DOUBLE)", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT"}
#: Schemas with fewer rows are broadcast.
BROADCAST_ROWS = 10_000


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, id, depth (calls above it) and cyclic of each distinct id of a conversation, from conv_id, id and parent.

    Each round joins every call with its ancestor so far and takes that one's ancestor, which doubles the distance; the
    number of rounds is the logarithm of the longest chain. What hasn't reached an end when chains can't be longer is in
    a cycle or below one, and has no depth. An unknown parent counts as none.
    """
    ids = calls.filter(F.col("id").isNotNull()).groupBy("conv_id", "id").agg(F.min("parent").alias("parent"))
    known = ids.select(F.col("conv_id").alias("up_conv"), F.col("id").alias("up"))
    up = F.col("up")
    state = ids.join(known, _same("up_conv") & (F.col("parent") == up), "left")
    state = cut(state.select("conv_id", "id", "up", up.isNotNull().cast("long").alias("depth")))
    rounds = ceil(log2(state.count() + 2)) + 1
    for _ in range(rounds):
        if state.filter(up.isNotNull()).isEmpty():
            break
        above = state.select(F.col("conv_id").alias("a_conv"), F.col("id").alias("a"), up.alias("next"), F.col("depth").alias("more"))
        state = state.join(above, _same("a_conv") & (up == F.col("a")), "left")
        state = cut(state.select("conv_id", "id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
    return state.select("conv_id", "id", F.when(up.isNull(), F.col("depth")).alias("depth"), up.isNotNull().alias("cyclic"))


def _same(conv: str) -> Column:
    """Of one conversation; rows without one are a conversation together."""
    return F.col("conv_id").eqNullSafe(F.col(conv))


def argument_errors(arguments: Column, parameters: Column) -> Column:
    """What is wrong with a JSON text, sorted; parameters: array of parameter, type and required, null for no such tool."""
    values = F.from_json(arguments, "map<string,variant>")
    kinds = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])

    def wrong(p: Column) -> Column:
        value = F.try_element_at(values, p["parameter"])
        shape = F.schema_of_variant(value)
        missing = F.when(p["required"] & (value.isNull() | (shape == "VOID")), F.concat(p["parameter"], F.lit(": missing")))
        bad = ~F.rlike(shape, F.concat(F.lit("^"), F.coalesce(F.try_element_at(kinds, p["type"]), F.lit(""))))
        return F.coalesce(missing, F.when(value.isNotNull() & (shape != "VOID") & bad, F.concat(p["parameter"], F.lit(": not "), p["type"])))

    extra = F.array_except(F.map_keys(values), F.transform(parameters, lambda p: p["parameter"]))
    found = F.concat(F.transform(parameters, wrong), F.transform(extra, lambda k: F.concat(k, F.lit(": not in the schema"))))
    found = F.filter(found, lambda e: e.isNotNull())
    none = F.array(F.lit("no such tool"))
    return F.when(values.isNull() | F.try_parse_json(arguments).isNull(), F.array(F.lit("not a JSON object"))).when(parameters.isNull(), none).otherwise(F.array_sort(found))


def format_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call and each result: conv_id, id, kind, depth, seq, n_results, valid, errors and line.

    calls: conv_id, id, parent, seq, name, arguments (JSON text). results: conv_id, id, call, seq, content. schemas:
    name, parameter, type, required. Sorting by conv_id, depth, kind, seq and id gives an order in which each call comes
    after its parent and each result after its call. line is JSON with sorted keys and no blanks.

    Identifiers count within their conversation: what other conversations call so is something else. Rows without a
    conv_id are a conversation together. Calls are valid without errors; results if their call is known. Arguments that aren't a JSON object (or repeat a
    key, or are null) are kept as raw text. Calls in a cycle of parents, or below one, have an error and no depth; an
    unknown parent is an error and counts as none. Repeated ids: each row is kept and is an error; their least parent
    counts. Null ids are linked to nothing. Empty tables give an empty result.
    """
    by_tool = schemas.groupBy("name").agg(F.collect_set(F.struct("parameter", "type", "required")).alias("parameters"))
    if schemas.count() <= BROADCAST_ROWS:
        by_tool = F.broadcast(by_tool)
    ordered = depths(calls)
    of = F.col("conv_id")
    counts = results.groupBy(of.alias("c_conv"), F.col("call").alias("c")).agg(F.count("*").alias("n_results"))
    times = calls.groupBy(of.alias("i_conv"), F.col("id").alias("i")).agg(F.count("*").alias("times"))
    parents = ordered.select(of.alias("p_conv"), F.col("id").alias("p"))
    above = ordered.select(of.alias("o_conv"), F.col("id").alias("o"), "depth", "cyclic")
    linked = (
        calls.join(above, _same("o_conv") & (F.col("id") == F.col("o")), "left")
        .join(counts, _same("c_conv") & (F.col("id") == F.col("c")), "left")
        .join(times, _same("i_conv") & (F.col("id") == F.col("i")), "left")
        .join(parents, _same("p_conv") & (F.col("parent") == F.col("p")), "left")
        .join(by_tool.withColumnRenamed("name", "tool"), F.col("name") == F.col("tool"), "left")
    )
    object_ = F.try_parse_json("arguments")
    errors = [
        F.when(F.col("id").isNull(), F.lit("id: missing")),
        F.when(F.col("times") > 1, F.lit("id: repeated")),
        F.when(F.col("parent").isNotNull() & F.col("p").isNull(), F.lit("parent: unknown")),
        F.when(F.col("cyclic"), F.lit("parent: cycle")),
    ]
    errors = F.concat(argument_errors(F.col("arguments"), F.col("parameters")), F.filter(F.array(*errors), lambda e: e.isNotNull()))
    is_object = F.schema_of_variant(object_).startswith("OBJECT")
    line = F.to_json(
        F.struct(
            F.when(is_object, object_).alias("arguments"),
            "id",
            "name",
            "parent",
            F.when(~F.coalesce(is_object, F.lit(False)), F.col("arguments")).alias("raw"),
            F.lit("call").alias("type"),
        )
    )
    no_ids = F.col("id").isNull()
    out = linked.select(
        "conv_id",
        "id",
        F.lit("call").alias("kind"),
        F.when(no_ids, F.lit(0)).otherwise(F.col("depth")).cast("long").alias("depth"),
        "seq",
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        errors.alias("errors"),
        line.alias("line"),
    )
    back = results.join(above, _same("o_conv") & (F.col("call") == F.col("o")), "left")
    line = F.to_json(F.struct("call", "content", "id", F.lit("result").alias("type")))
    orphan = F.when(F.col("o").isNull(), F.array(F.lit("call: unknown"))).otherwise(F.array().cast("array<string>"))
    back = back.select("conv_id", "id", F.lit("result").alias("kind"), "depth", "seq", F.lit(0).cast("long").alias("n_results"), orphan.alias("errors"), line.alias("line"))
    both = out.unionByName(back).withColumn("valid", F.size("errors") == 0)
    return both.select("conv_id", "id", "kind", "depth", "seq", "n_results", "valid", "errors", "line")


#: Tools for the shared test table, whose conversations hold no calls of their own.
TOOLS = [
    ("search", "text", "string", True),
    ("search", "limit", "integer", True),
    ("search", "exact", "boolean", False),
    ("translate", "text", "string", True),
    ("translate", "limit", "number", False),
    ("translate", "exact", "boolean", False),
    ("store", "text", "string", False),
    ("store", "limit", "integer", False),
    ("store", "exact", "boolean", True),
]


def calls_and_results(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assistant turns as calls, each below the one two turns before; later user turns as results of the turn before.

    Every conversation numbers its own from the start. The name and faults of a call follow from its text's length:
    limits as text, no text, a lost bracket.
    """
    key = lambda letter, turn: F.concat_ws("-", F.lit(letter), turn.cast("string"))
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.length(text)
    limit, exact = n.alias("limit"), (n % 2 == 0).alias("exact")
    arguments = (
        F.when(n % 11 == 0, F.regexp_replace(F.to_json(F.struct(text.alias("text"), limit, exact)), r"\}$", ""))
        .when(n % 7 == 0, F.to_json(F.struct(limit, exact)))
        .when(n % 5 == 0, F.to_json(F.struct(text.alias("text"), n.cast("string").alias("limit"), exact)))
        .otherwise(F.to_json(F.struct(text.alias("text"), limit, exact)))
    )
    name = F.element_at(F.array(*[F.lit(x) for x in ("search", "translate", "store", "draw")]), (n % 4 + 1).cast("int"))
    turn = F.col("turn")
    calls = turns.filter("role = 'assistant'").select(
        "conv_id", key("c", turn).alias("id"), F.when(turn > 2, key("c", turn - 2)).alias("parent"), turn.alias("seq"), name.alias("name"), arguments.alias("arguments")
    )
    results = turns.filter("role = 'user' AND turn > 0").select(
        "conv_id", key("r", turn).alias("id"), key("c", turn - 1).alias("call"), turn.alias("seq"), text.alias("content")
    )
    return calls, results


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call and result derived from the whole table of conversations, linked, ordered, checked and as JSON."""
    calls, results = calls_and_results(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    schemas = spark.createDataFrame(TOOLS, "name string, parameter string, type string, required boolean")
    out = format_tool_calls(calls, results, schemas)
    return out.withColumn("errors", F.concat_ws("; ", "errors"))


_TOOLS = ", ".join(f"('{n}', '{p}', '{t}', {str(r).lower()})" for n, p, t, r in TOOLS)
OP2_SQL = f"""
WITH RECURSIVE t AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM conversations
), calls AS (
    SELECT conv_id, 'c-' || turn AS id, CASE WHEN turn > 2 THEN 'c-' || (turn - 2) END AS parent,
        turn AS seq, ['search', 'translate', 'store', 'draw'][n % 4 + 1] AS name,
        CASE WHEN n % 11 = 0 THEN rtrim(json_object('text', text, 'limit', n, 'exact', n % 2 = 0)::VARCHAR, '}}')
            WHEN n % 7 = 0 THEN json_object('limit', n, 'exact', n % 2 = 0)::VARCHAR
            WHEN n % 5 = 0 THEN json_object('text', text, 'limit', n::VARCHAR, 'exact', n % 2 = 0)::VARCHAR
            ELSE json_object('text', text, 'limit', n, 'exact', n % 2 = 0)::VARCHAR END AS arguments
    FROM t WHERE role = 'assistant'
), results AS (
    SELECT conv_id, 'r-' || turn AS id, 'c-' || (turn - 1) AS call, turn AS seq, text AS content
    FROM t WHERE role = 'user' AND turn > 0
), tools(name, parameter, type, required) AS (VALUES {_TOOLS}),
unknown AS (
    SELECT conv_id, id FROM calls c WHERE parent IS NOT NULL AND NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.id = c.parent)
), depth(conv_id, id, depth) AS (
    SELECT conv_id, id, 0::BIGINT FROM calls c WHERE parent IS NULL OR EXISTS (SELECT 1 FROM unknown u WHERE u.conv_id = c.conv_id AND u.id = c.id)
    UNION ALL
    SELECT calls.conv_id, calls.id, (depth.depth + 1)::BIGINT FROM calls JOIN depth ON calls.conv_id = depth.conv_id AND calls.parent = depth.id
), checked AS (
    SELECT c.conv_id, c.id, s.parameter, s.type, s.required, CASE WHEN json_valid(arguments) THEN json_type(arguments, '$.' || s.parameter) END AS kind
    FROM calls c JOIN tools s USING (name)
), faults AS (
    SELECT conv_id, id, 1 AS part, 'not a JSON object' AS e FROM calls WHERE NOT json_valid(arguments)
    UNION ALL
    SELECT conv_id, id, 1, 'no such tool' FROM calls WHERE json_valid(arguments) AND name NOT IN (SELECT name FROM tools)
    UNION ALL
    SELECT conv_id, id, 1, parameter || ': missing' FROM checked JOIN calls USING (conv_id, id) WHERE json_valid(arguments) AND required AND kind IS NULL
    UNION ALL
    SELECT conv_id, id, 1, parameter || ': not ' || type FROM checked
    WHERE kind IS NOT NULL AND NOT (
        (type = 'string' AND kind = 'VARCHAR') OR (type IN ('integer', 'number') AND kind IN ('UBIGINT', 'BIGINT')) OR (type = 'boolean' AND kind = 'BOOLEAN'))
    UNION ALL
    SELECT conv_id, id, 2, 'parent: unknown' FROM unknown
), said AS (SELECT conv_id, id, string_agg(e, '; ' ORDER BY part, e) AS errors FROM faults GROUP BY 1, 2),
answered AS (SELECT conv_id, call, count(*) AS n FROM results GROUP BY 1, 2)
SELECT c.conv_id, c.id, 'call' AS kind, d.depth, seq, coalesce(a.n, 0) AS n_results, s.errors IS NULL AS valid, coalesce(s.errors, '') AS errors,
    CASE WHEN json_valid(arguments) THEN '{{"arguments":{{"exact":' || (arguments ->> '$.exact') || ',"limit":' || json_extract(arguments, '$.limit')::VARCHAR
            || CASE WHEN json_extract(arguments, '$.text') IS NULL THEN '' ELSE ',"text":' || json_extract(arguments, '$.text')::VARCHAR END || '}},' ELSE '{{' END
        || '"id":"' || c.id || '","name":"' || name || '"' || CASE WHEN parent IS NULL THEN '' ELSE ',"parent":"' || parent || '"' END
        || CASE WHEN json_valid(arguments) THEN '' ELSE ',"raw":' || to_json(arguments)::VARCHAR END || ',"type":"call"}}' AS line
FROM calls c LEFT JOIN depth d ON c.conv_id = d.conv_id AND c.id = d.id LEFT JOIN said s ON c.conv_id = s.conv_id AND c.id = s.id
    LEFT JOIN answered a ON a.conv_id = c.conv_id AND a.call = c.id
UNION ALL
SELECT r.conv_id, r.id, 'result', d.depth, r.seq, 0, d.id IS NOT NULL, CASE WHEN d.id IS NULL THEN 'call: unknown' ELSE '' END,
    json_object('call', call, 'content', content, 'id', r.id, 'type', 'result')::VARCHAR
FROM results r LEFT JOIN depth d ON r.conv_id = d.conv_id AND r.call = d.id
"""
