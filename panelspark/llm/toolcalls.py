"""Tool calls linked with their results, in dependency order, checked against schemas, as canonical JSON.

Calls have (conv_id, call_id, after, name, arguments), results (conv_id, call_id, content). DataFrame functions only.

- Linking: a hash join on conversation and identifier.
- Order: each ``after`` of a node names one (a call or a result's call) that must come before; a call or a node with several
  has several rows. The depth of a call is the longest way to it, so whatever it needs has a smaller one. Depths come from
  pointer jumping and peeling, so a conversation of n turns takes about log2(n) joins and none is gathered in one place.
- Validation: each schema is compiled into column expressions over the parsed arguments.
- Canonical JSON: keys sorted at every level, no blanks, nulls kept.

Defined results: a null identifier links with nothing; of repeated calls or results with one identifier, the smallest
(name, arguments) or content counts, and ``copies`` and ``answers`` say how many there were; rows of one call that differ in
``after`` alone are one copy that comes after each of them; a result whose identifier has no call is a row without a name,
arguments and depth; a call whose way leads into a cycle has the depth null, and where one leads to an unknown node that
counts as no node (``rooted`` false); arguments that are not JSON, or null, make
the call invalid and are kept as text; a call without a known schema is invalid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.tables import stored

Schema = dict[str, dict]

#: What each tool takes: for every field its type, whether it is required, and its bounds.
SCHEMAS: dict[str, Schema] = {
    "ask": {
        "query": {"type": "string", "required": True, "min_length": 1, "max_length": 1200},
        "words": {"type": "integer", "required": True, "minimum": 1, "maximum": 150},
    },
    "configure": {"prompt": {"type": "string", "required": True, "min_length": 1}},
}
KINDS = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DOUBLE", "DECIMAL"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}


def field_errors(arguments: Column, field: str, rules: dict) -> Column:
    """The faults of one field, null where there is none."""
    path = f"$['{field}']"
    value = F.try_variant_get(arguments, path, "variant")
    kind = F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)
    absent = value.isNull() | (kind == "VOID")
    checks = [(~kind.isin(*KINDS[rules["type"]]), "type")]
    if rules["type"] == "string":
        length = F.length(F.try_variant_get(arguments, path, "string"))
        checks += [(length < rules[k], k) for k in ("min_length",) if k in rules]
        checks += [(length > rules[k], k) for k in ("max_length",) if k in rules]
    if rules["type"] in ("integer", "number"):
        number = F.try_variant_get(arguments, path, "double")
        checks += [(number < rules[k], k) for k in ("minimum",) if k in rules]
        checks += [(number > rules[k], k) for k in ("maximum",) if k in rules]
    if "enum" in rules:
        checks.append((~F.try_variant_get(arguments, path, "string").isin(*rules["enum"]), "enum"))
    out = F.when(absent, F.lit(f"{field}: missing") if rules.get("required") else F.lit(None))
    for fault, what in checks:
        out = out.when(fault, f"{field}: {what}")
    return out


def faults(name: Column, arguments: Column, schemas: dict[str, Schema]) -> Column:
    """All faults of a call as one text, empty if there are none; fields without a rule are faults too."""
    out = F.when(F.col("copies") == 0, F.lit("call: missing")).when(arguments.isNull(), F.lit("arguments: not JSON"))
    keys = F.json_object_keys(F.to_json(arguments))
    out = out.when(keys.isNull(), F.lit("arguments: not an object"))
    for tool, schema in sorted(schemas.items()):
        known = F.array(*map(F.lit, sorted(schema))) if schema else F.array().cast("array<string>")
        extra = F.transform(F.array_sort(F.array_except(keys, known)), lambda k: F.concat(k, F.lit(": unknown")))
        own = F.array(*(field_errors(arguments, f, r) for f, r in sorted(schema.items()))).cast("array<string>")
        out = out.when(name == tool, F.concat_ws("; ", F.array_compact(own), extra))
    return out.otherwise(F.lit("name: unknown"))


def depths(nodes: DataFrame) -> DataFrame:
    """(node, depth, rooted) from edges (node, after): the length of the longest way to a node, null on a way into a cycle.

    ``rooted`` says whether all ways begin at a node without ``after``; others begin at an unknown one. Stretches in
    which each node comes after one other are passed by pointer jumping: each round doubles the distance that a pointer
    spans, and after as many rounds as the number of nodes has binary digits, what still moves is in a cycle. What is
    left are the nodes that come after several; they are peeled off in topological order, in each round those whose nodes
    before are all done. So rounds grow with the logarithm of the longest stretch and with the number of such nodes on a way.
    """
    edges = stored(nodes.filter("node is not null").select("node", "after").distinct(), "edges")
    many = edges.filter("after is not null").groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("node").alias("m"))
    many = stored(many, "joints")
    known = edges.select(F.col("node").alias("k")).distinct()
    one = edges.groupBy("node").agg(F.max("after").alias("after")).join(many, F.col("node") == F.col("m"), "left")
    one = one.select("node", F.when(F.col("m").isNull(), F.col("after")).alias("after"), F.col("m").isNotNull().alias("joint"))
    start = one.join(known, one["after"] == known["k"], "left").select(
        "node",
        F.col("k").alias("up"),
        F.col("node").alias("anchor"),
        F.lit(0).cast("long").alias("depth"),
        F.when(F.col("joint"), "joint").when(F.col("after").isNull(), "root").when(F.col("k").isNull(), "unknown").alias("kind"),
    )
    now = stored(start.withColumn("anchor", F.coalesce("up", "anchor")).withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")), "depths")
    for _ in range(max(1, now.count()).bit_length() + 1):
        if now.filter("up is not null").isEmpty():
            break
        far = now.select(F.col("node").alias("n"), F.col("up").alias("u"), F.col("anchor").alias("a"), F.col("depth").alias("d"), F.col("kind").alias("t"))
        moving, done = now.filter("up is not null"), now.filter("up is null")
        step = moving.join(far, F.col("up") == F.col("n")).select(
            "node", F.col("u").alias("up"), F.col("a").alias("anchor"), (F.col("depth") + F.col("d")).alias("depth"), F.col("t").alias("kind")
        )
        now = stored(done.unionByName(step), "depths")
    ways = now.select("node", F.when(F.col("up").isNull(), F.col("anchor")).alias("anchor"), "depth", "kind")
    joints = stored(ways.filter("kind = 'joint' and node = anchor").select("node"), "joints")
    settled = joints.select("node", F.lit(0).cast("long").alias("depth"), F.lit(True).alias("rooted")).limit(0)
    if not joints.isEmpty():
        settled = _peeled(edges, ways, joints)
    joint = settled.select(F.col("node").alias("j"), F.col("depth").alias("deep"), F.col("rooted").alias("sure"))
    met = ways.join(joint, (F.col("kind") == "joint") & (F.col("anchor") == F.col("j")), "left")
    ended = F.col("anchor").isNotNull() & ((F.col("kind") != "joint") | F.col("j").isNotNull())
    depth = F.when(ended, F.col("depth") + F.coalesce("deep", F.lit(0)))
    rooted = ended & F.when(F.col("kind") == "joint", F.col("sure")).otherwise(F.col("kind") == "root")
    return met.select("node", depth.alias("depth"), F.coalesce(rooted, F.lit(False)).alias("rooted"))


def _peeled(edges: DataFrame, ways: DataFrame, joints: DataFrame) -> DataFrame:
    """(node, depth, rooted) of the nodes that come after several, round by round in topological order."""
    of = edges.filter("after is not null").join(joints, "node", "left_semi")
    way = ways.select(F.col("node").alias("before"), F.col("anchor"), F.col("depth").alias("far"), "kind")
    of = of.join(way, F.col("after") == F.col("before"), "left")
    unknown = F.col("before").isNull()
    of = of.select(
        "node",
        "anchor",
        F.when(unknown, 0).otherwise(F.col("far") + 1).cast("long").alias("far"),
        F.when(unknown, "unknown").otherwise(F.col("kind")).alias("kind"),
        (~unknown & F.col("anchor").isNull()).alias("lost"),
    )
    of, settled = stored(of, "ways"), None
    while True:
        left = of if settled is None else of.join(settled, "node", "left_anti")
        if settled is None:
            met = left.withColumns({"deep": F.lit(None).cast("long"), "sure": F.lit(None).cast("boolean")})
        else:
            done = settled.select(F.col("node").alias("j"), F.col("depth").alias("deep"), F.col("rooted").alias("sure"))
            met = left.join(done, (F.col("kind") == "joint") & (F.col("anchor") == F.col("j")), "left").drop("j")
        open_ = F.col("lost") | ((F.col("kind") == "joint") & F.col("deep").isNull())
        sure = F.coalesce(F.when(F.col("kind") == "joint", F.col("sure")).otherwise(F.col("kind") == "root"), F.lit(False))
        new = met.groupBy("node").agg(
            F.max(open_).alias("open"), F.max(F.col("far") + F.coalesce("deep", F.lit(0))).alias("depth"), F.min(sure).alias("rooted")
        )
        new = stored(new.filter("not open").select("node", "depth", "rooted"), "peeled")
        if new.isEmpty():
            return new if settled is None else settled
        settled = new if settled is None else stored(settled.unionByName(new), "settled")


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, Schema] | None = None, nodes: DataFrame | None = None) -> DataFrame:
    """Rows (conv_id, call_id, name, depth, rooted, copies, answers, linked, valid, faults, json): one for each identifier of
    a call or of a result. ``nodes`` has (node, after) of everything that calls may come after; the calls themselves if
    it is absent."""
    schemas = SCHEMAS if schemas is None else schemas
    given = calls.groupBy("conv_id", "call_id", "name", "arguments", "after").agg(F.count("*").alias("n"))
    given = given.groupBy("conv_id", "call_id", "name", "arguments").agg(F.max("n").alias("n"))  # as often as with one ``after``
    own = given.groupBy("conv_id", "call_id").agg(F.min(F.struct("name", "arguments")).alias("c"), F.sum("n").alias("copies"))
    own = own.select("conv_id", "call_id", "c.name", "c.arguments", "copies")
    answers = results.filter("call_id is not null").groupBy("conv_id", "call_id").agg(F.min("content").alias("content"), F.count("*").alias("answers"))
    answers = answers.select(F.col("conv_id").alias("conv"), F.col("call_id").alias("call"), "content", "answers")
    met = own.join(answers, own["conv_id"].eqNullSafe(answers["conv"]) & (own["call_id"] == answers["call"]), "full")
    met = met.select(
        F.when(F.col("copies").isNull(), F.col("conv")).otherwise(F.col("conv_id")).alias("conv_id"),
        F.coalesce("call_id", "call").alias("call_id"),
        *("name", "arguments", "content"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("copies", "answers")),
    )
    met = met.withColumn("linked", (F.col("copies") > 0) & (F.col("answers") > 0))
    order = depths(calls.select(F.col("call_id").alias("node"), "after") if nodes is None else nodes)
    met = met.join(order, met["call_id"] == order["node"], "left").drop("node")
    parsed = F.try_parse_json("arguments")
    met = met.withColumn("parsed", parsed).withColumn("faults", faults(F.col("name"), F.col("parsed"), schemas))
    kept = F.coalesce(F.to_json("parsed"), F.to_json(F.struct("arguments"), {"ignoreNullFields": "false"}))
    rest = F.to_json(F.struct(F.col("depth"), F.col("call_id").alias("id"), "name", F.col("content").alias("result")), {"ignoreNullFields": "false"})
    json = F.concat(F.lit('{"arguments":'), kept, F.lit(","), F.substring(rest, 2, 2**31 - 1))
    return met.select("conv_id", "call_id", "name", "depth", F.coalesce("rooted", F.lit(False)).alias("rooted"), "copies", "answers", "linked", (F.col("faults") == "").alias("valid"), "faults", json.alias("json"))


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and nodes of a table of turns (conv_id, turn, role, text).

    Every turn of a user is a call of ``ask``, every system turn one of ``configure``; an assistant's turn is the result
    of the call one turn before. Every turn comes after the turn before it. Turns without conversation or number, and
    roles that are none of these, have no identifier or are no calls.
    """
    at = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))
    turn = F.col("turn")
    words = F.size(F.filter(F.split(F.col("text"), r"[ \t\n\r]+"), lambda w: w != ""))
    ask = F.to_json(F.struct(F.col("text").alias("query"), F.when(F.col("text").isNotNull(), words).alias("words")))
    arguments = F.when(F.col("role") == "user", ask).otherwise(F.to_json(F.struct(F.col("text").alias("prompt"))))
    name = F.when(F.col("role") == "user", "ask").otherwise("configure")
    after = F.when(turn > 0, at(turn - 1))
    calls = turns.filter(F.col("role").isin("user", "system")).select(
        "conv_id", at(turn).alias("call_id"), after.alias("after"), name.alias("name"), arguments.alias("arguments")
    )
    results = turns.filter(F.col("role") == "assistant").select("conv_id", at(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results, turns.select(at(turn).alias("node"), after.alias("after"))


#: The same rows by SQL over the table of turns.
ORACLE = """
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, role, min(text) AS text, count(*) AS copies,
         conv_id::VARCHAR || ':' || turn::VARCHAR AS node,
         CASE WHEN turn > 0 THEN conv_id::VARCHAR || ':' || (turn - 1)::VARCHAR END AS after
  FROM conversations GROUP BY ALL
), walk AS (
  SELECT node, 0::BIGINT AS depth, after IS NULL AS rooted FROM turns
  WHERE after IS NULL OR after NOT IN (SELECT node FROM turns)
  UNION ALL
  SELECT t.node, w.depth + 1, w.rooted FROM turns t JOIN walk w ON t.after = w.node
), calls AS (
  SELECT t.conv_id, t.node AS call_id, CASE role WHEN 'user' THEN 'ask' ELSE 'configure' END AS name, t.text, t.copies,
         w.depth, w.rooted, len(list_filter(regexp_split_to_array(t.text, '[ \\t\\n\\r]+'), lambda x: x <> '')) AS words
  FROM turns t JOIN walk w USING (node) WHERE role IN ('user', 'system')
), answers AS (
  SELECT conv_id, conv_id::VARCHAR || ':' || (turn - 1)::VARCHAR AS call_id, min(text) AS content, sum(copies)::BIGINT AS answers
  FROM turns WHERE role = 'assistant' GROUP BY ALL
), checked AS (
  SELECT c.*, a.call_id IS NOT NULL AS linked, content, coalesce(answers, 0) AS answers,
         CASE WHEN name = 'configure' THEN CASE WHEN text = '' THEN 'prompt: min_length' ELSE '' END
              ELSE concat_ws('; ', CASE WHEN text = '' THEN 'query: min_length' WHEN length(text) > 1200 THEN 'query: max_length' END,
                                   CASE WHEN words < 1 THEN 'words: minimum' WHEN words > 150 THEN 'words: maximum' END) END AS faults
  FROM calls c LEFT JOIN answers a USING (call_id)
)
SELECT conv_id, call_id, name, depth, rooted, copies, answers, linked, faults = '' AS valid, faults,
       '{"arguments":' || CASE WHEN name = 'ask' THEN json_object('query', text, 'words', words)
                               ELSE json_object('prompt', text) END::VARCHAR || ',"depth":' || depth || ',"id":"' || call_id ||
       '","name":"' || name || '","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS json
FROM checked
UNION ALL
SELECT conv_id, call_id, NULL, depth, coalesce(rooted, false), 0, answers, false, false, 'call: missing',
       '{"arguments":{"arguments":null},"depth":' || coalesce(depth::VARCHAR, 'null') || ',"id":"' || call_id || '","name":null,"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}'
FROM answers LEFT JOIN walk ON node = call_id WHERE call_id NOT IN (SELECT call_id FROM calls WHERE call_id IS NOT NULL)
"""
