"""Chat formatting: tool calls linked to results, ordered, validated, as canonical JSON.

Calls and results meet in a hash join on (conversation, identifier). Calls that
wait for other calls are ordered by depth, found by pointer doubling, so a
chain of n calls takes about log2 n joins and no conversation is ever gathered
in one task. Arguments are parsed as variants, checked against a schema per
tool, and written back with sorted keys. Only built-in Spark is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.store import discard, save

#: Argument types that a schema can name, and the variant types that satisfy them.
TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "FLOAT"], "boolean": ["BOOLEAN"],
         "array": ["ARRAY"], "object": ["OBJECT"]}


def _kind(value: Column) -> Column:
    """BIGINT, STRING, ARRAY, OBJECT and so on; decimals as DOUBLE; null where the field is missing."""
    return F.regexp_replace(F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0), "^DECIMAL$", "DOUBLE")


def argument_errors(name: Column, arguments: Column, parsed: Column, schemas: dict) -> Column:
    """Sorted array of what is wrong with a call's arguments.

    ``schemas``: tool name -> {field: {"type": ..., "required": bool, "enum": [...],
    "min_length": n}}; fields that a schema doesn't name are errors.
    """
    errors = F.when(~F.coalesce(name, F.lit("")).isin(list(schemas)), F.array(F.lit("unknown tool")))
    none = F.array().cast("array<string>")
    for tool, fields in schemas.items():
        found = [F.when(parsed.isNull(), "not JSON").when(_kind(parsed) != "OBJECT", "not an object")]
        for field, rule in fields.items():
            value = F.try_variant_get(parsed, f"$.{field}", "variant")
            kind = _kind(value)
            missing = value.isNull() | (kind == "VOID")
            if rule.get("required"):
                found.append(F.when(parsed.isNotNull() & missing, f"{field}: missing"))
            if "type" in rule:
                found.append(F.when(~missing & ~kind.isin(TYPES[rule["type"]]), f"{field}: not {rule['type']}"))
            as_text = F.try_variant_get(parsed, f"$.{field}", "string")
            if "enum" in rule:
                found.append(F.when(~missing & ~as_text.isin(rule["enum"]), f"{field}: not allowed"))
            if "min_length" in rule:
                found.append(F.when(~missing & (F.length(as_text) < rule["min_length"]), f"{field}: too short"))
        keys = F.coalesce(F.json_object_keys(arguments), none)
        extra = F.transform(F.array_except(keys, F.array(*[F.lit(f) for f in fields])), lambda k: F.concat(k, F.lit(": unexpected")))
        errors = errors.when(name == tool, F.array_sort(F.concat(F.array_compact(F.array(*found)), extra)))
    return errors


def call_depths(calls: DataFrame, keys: list[str], call_id: str = "call_id", after: str = "after") -> DataFrame:
    """``keys, call_id, depth``: links to the first call of a chain of ``after``; null on a cycle.

    An ``after`` that names no call counts as none. Calls are distinct by keys and id.
    """
    ids = calls.select(*keys, F.col(call_id).alias("p"))
    at = save(calls.select(*keys, F.col(call_id).alias("c"), F.col(after).alias("p")).join(ids, [*keys, "p"], "left_semi")
              .select(*keys, "c", "p", F.lit(1).cast("long").alias("d")), "chains")
    n, reach = at.count(), 1
    while True:  # p: the call d links up, still to be followed where it has one itself
        up = at.select(*keys, F.col("c").alias("p"), F.col("p").alias("p2"), F.col("d").alias("d2"))
        step = save(at.join(up, [*keys, "p"], "left").select(
            *keys, "c", F.coalesce("p2", "p").alias("p"), (F.col("d") + F.coalesce("d2", F.lit(0))).alias("d"),
            F.col("p2").isNotNull().alias("open")), "chains")
        open_ = step.filter("open").limit(1).count()
        discard(at)
        at, reach = step.drop("open"), reach * 2
        if not open_ or reach > 2 * n:  # longer than any chain: a cycle
            break
    open_ids = step.select(*keys, "c", F.when(~F.col("open"), F.col("d")).alias("d"))
    return calls.select(*keys, call_id).join(open_ids.withColumnRenamed("c", call_id).withColumn("linked", F.lit(True)),
                                             [*keys, call_id], "left").select(
        *keys, call_id, F.when(F.col("linked"), F.col("d")).otherwise(0).alias("depth"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row per distinct call, and per distinct result without a call of its own.

    ``calls``: conv_id, call_id, name, arguments (JSON text), after (call_id it
    waits for, or null). ``results``: conv_id, call_id, content. Returns
    conv_id, call_id, depth (place in topological order within the
    conversation; null on a cycle or for a stray result), status (linked,
    unanswered, ambiguous: several results, stray: a result without call),
    n_results, valid, errors, json: the call with canonical arguments and, where
    linked, its result.

    Calls of one id are counted in ``n_calls``, results in ``n_results``. Where they
    differ, the id has a row for each distinct call and each distinct result: the
    first of either in sorted order in one row, the second in the next; where one
    kind has no more, its first is repeated. The smallest call tells what
    the id waits for. Rows with a null conversation or id link with nothing and
    keep a row each: calls are unanswered (depth null), results stray. Empty tables
    give empty parts. Other columns are ignored.
    """
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    call, content = F.struct("name", "arguments", "after"), F.struct("content")
    ids = calls.filter(named).groupBy("conv_id", "call_id").agg(
        F.array_sort(F.collect_set(call)).alias("xs"), F.count(F.lit(1)).alias("n_calls"))
    answers = results.filter(named).groupBy("conv_id", "call_id").agg(
        F.array_sort(F.collect_set(content)).alias("ys"), F.count(F.lit(1)).alias("n_results"))
    deep = call_depths(ids.select("conv_id", "call_id", F.col("xs")[0]["after"].alias("after")), ["conv_id"])
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    pick = lambda c: F.when(F.col("_k") < size(c), F.get(c, F.col("_k"))).otherwise(F.get(c, F.lit(0)))
    linked = (ids.join(deep, ["conv_id", "call_id"], "left").join(answers, ["conv_id", "call_id"], "full_outer")
              .withColumn("_k", F.explode(F.sequence(F.lit(0), F.greatest(size("xs"), size("ys")) - 1)))
              .select("conv_id", "call_id", "depth", "n_calls", "n_results", pick("xs").alias("x"), pick("ys").alias("y")))
    lone = calls.filter(~named).select("conv_id", "call_id", F.lit(1).cast("long").alias("n_calls"), call.alias("x"))
    lost = results.filter(~named).select("conv_id", "call_id", F.lit(1).cast("long").alias("n_results"), content.alias("y"))
    rows = linked.unionByName(lone, allowMissingColumns=True).unionByName(lost, allowMissingColumns=True)
    met = rows.select("conv_id", "call_id", "depth", "n_calls", "n_results", "x.*", "y.*")
    parsed = F.try_parse_json("arguments")
    met = met.withColumn("errors", F.when(F.col("n_calls").isNotNull(), argument_errors(
        F.col("name"), F.col("arguments"), parsed, schemas)))
    met = met.withColumn("canonical", F.coalesce(F.to_json(parsed), F.to_json(F.struct(F.col("arguments").alias("raw")))))
    is_call = F.col("n_calls").isNotNull()
    status = (F.when(~is_call, "stray").when(F.col("n_results").isNull(), "unanswered")
              .when(F.col("n_results") > 1, "ambiguous").otherwise("linked"))

    def value(c: str) -> Column:
        """A column as JSON text: what to_json writes in {"v":...}."""
        whole = F.to_json(F.struct(F.col(c).cast("string").alias("v")))
        return F.when(F.col(c).isNull(), "null").otherwise(F.substring(whole, F.lit(6), F.length(whole) - 6))

    field = lambda key, v: F.concat(F.lit(f'"{key}":'), v)
    call_json = F.concat_ws(",", field("arguments", F.col("canonical")), field("id", value("call_id")), field("name", value("name")))
    body = F.concat_ws(",",
                       F.when(is_call, F.concat(F.lit('"call":{'), call_json, F.lit("}"))),
                       F.when(F.col("n_results").isNotNull(), field("content", value("content"))),
                       field("conversation", F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))),
                       field("id", value("call_id")))
    return met.select(
        "conv_id", "call_id", "depth", status.alias("status"), F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.when(is_call, F.size("errors") == 0).alias("valid"), "errors",
        F.concat(F.lit("{"), body, F.lit("}")).alias("json"))


#: Tools that a plain conversation uses: every prompt asks one of them, the reply answers.
CHAT_TOOLS = {
    "reply": {"prompt": {"type": "string", "required": True, "min_length": 1}, "turn": {"type": "integer", "required": True}},
    "instruct": {"prompt": {"type": "string", "required": True, "min_length": 1}, "turn": {"type": "integer", "required": True}},
}


def turns_as_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain chat messages (conv_id, turn, role, text).

    A user or system message calls ``reply`` or ``instruct`` with identifier
    ``<conversation>-<turn>`` and waits for the exchange two turns before; an
    assistant message is the result of the call one turn before.
    """
    ident = lambda back: F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    known = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    asked = known.filter("role in ('user', 'system')")
    calls = asked.select(
        "conv_id", F.when(F.col("turn").isNotNull(), ident(0)).alias("call_id"),
        F.when(F.col("role") == "user", "reply").otherwise("instruct").alias("name"),
        F.to_json(F.struct(F.col("turn"), F.col("text").alias("prompt"))).alias("arguments"), ident(2).alias("after"))
    results = known.filter("role is null or role not in ('user', 'system')").select(
        "conv_id", F.when(F.col("turn").isNotNull(), ident(1)).alias("call_id"), F.col("text").alias("content"))
    return calls, results
