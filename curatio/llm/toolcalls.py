"""Tool-call linking with DataFrame operations only.

Calls and results meet in a hash join on (conversation, call id).  A call may
name one earlier call whose result it uses; the depth of a call in that forest
is found by pointer doubling (rounds grow with the logarithm of the longest
chain), and (level, turn, call id) is a topological order of a conversation:
calls have even levels, twice their depth, and results follow on the odd ones.
Arguments are checked against the tool's schema, and each entry becomes one
line of canonical JSON: keys sorted, no white space, numbers normalised.

The order is given by columns rather than by a running number, and lines are
rows, so that a conversation of any length needs no single task.

calls: conv_id, turn, call_id, name, arguments (JSON text), parent
results: conv_id, turn, call_id, content
schemas: name, param, type, required - types are string, integer, number,
boolean, array, object, null

Defined results: a call is ``ok``, ``unanswered``, a ``duplicate`` (its id
already belongs to an earlier call of the conversation; smallest turn first),
``cycle`` (it uses its own result, at whatever distance; no level) or
``unnamed`` (null id); a result is ``ok``, ``orphan`` (no such call, or a null
id) or ``cycle``.  All results of a call are linked.  A parent that the
conversation does not have counts as none.  Arguments that are null, no JSON
object or have a repeated key are a problem of their own; unknown tools too.
A null conversation is like any other value; equal rows are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm.common import durable

# Names of Spark's types of JSON values by the types of a schema.
KINDS = {
    "string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$", "boolean": "^BOOLEAN$",
    "array": "^ARRAY.*$", "object": "^OBJECT.*$", "null": "^VOID$",
}


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, parent), unique -> (conv_id, call_id, depth); depth is null on and behind cycles."""
    up = calls.select(F.col("conv_id").alias("pc"), F.col("call_id").alias("pid"))
    met = (F.col("conv_id").eqNullSafe(F.col("pc"))) & (F.col("parent") == F.col("pid"))
    d = calls.join(up, met, "left").select("conv_id", "call_id", F.col("pid").alias("anc"))
    d = durable(d.withColumn("depth", F.when(F.col("anc").isNull(), 0).otherwise(1).cast("long")))
    total, reach = d.count(), 1
    while reach <= 2 * total and not d.where("anc IS NOT NULL").isEmpty():
        above = d.select(F.col("conv_id").alias("pc"), F.col("call_id").alias("pid"), F.col("anc").alias("next"), F.col("depth").alias("more"))
        met = (F.col("conv_id").eqNullSafe(F.col("pc"))) & (F.col("anc") == F.col("pid"))
        d = d.join(above, met, "left").select(
            "conv_id", "call_id", F.col("next").alias("anc"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
        )
        d, reach = durable(d), 2 * reach
    return d.select("conv_id", "call_id", F.when(F.col("anc").isNull(), F.col("depth")).alias("depth"))


def problems(args: Column, params: Column) -> Column:
    """Sorted problems of arguments (JSON text) under the (param, type, required) structs of a tool."""
    types = F.transform_values(F.from_json(args, "map<string,variant>"), lambda k, v: F.schema_of_variant(v))
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(args)).startswith("OBJECT"), F.lit(False))
    names = F.transform(params, lambda p: p["param"])
    missing = F.transform(
        F.filter(params, lambda p: p["required"] & ~F.map_contains_key(types, p["param"])), lambda p: F.concat(F.lit("missing "), p["param"])
    )
    kind = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    wrong = F.transform(
        F.filter(params, lambda p: F.coalesce(~F.regexp(types[p["param"]], kind[p["type"]]), F.lit(False))),
        lambda p: F.concat(F.lit("type "), p["param"]),
    )
    unknown = F.transform(F.array_except(F.map_keys(types), names), lambda k: F.concat(F.lit("unknown "), k))
    return (
        F.when(params.isNull(), F.array(F.lit("unknown tool")))
        .when(~is_object, F.array(F.lit("no object")))
        .otherwise(F.sort_array(F.concat(missing, wrong, unknown)))
    )


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, kind, call_id, turn, level, status, problems, json: one row a call and one a result."""
    c = calls.select("conv_id", "turn", "call_id", "name", "arguments", "parent")
    first = Window.partitionBy("conv_id", "call_id").orderBy("turn", "name", "arguments", "parent")
    c = c.withColumn("nth", F.when(F.col("call_id").isNotNull(), F.row_number().over(first)))
    c = durable(c)
    deep = durable(depths(c.where("nth = 1").select("conv_id", "call_id", "parent")))
    answered = results.where("call_id IS NOT NULL").select(F.col("conv_id").alias("rc"), F.col("call_id").alias("rid")).distinct()
    tools = schemas.where("name IS NOT NULL AND param IS NOT NULL").groupBy(F.col("name").alias("tool")).agg(
        F.sort_array(F.collect_set(F.struct("param", "type", F.coalesce("required", F.lit(False)).alias("required")))).alias("params")
    )
    d = deep.select(F.col("conv_id").alias("dc"), F.col("call_id").alias("did"), "depth")
    same = lambda a, b: F.col("conv_id").eqNullSafe(F.col(a)) & (F.col("call_id") == F.col(b))
    x = c.join(d, same("dc", "did"), "left").join(answered, same("rc", "rid"), "left").join(tools, F.col("name") == F.col("tool"), "left")
    status = (
        F.when(F.col("nth").isNull(), "unnamed").when(F.col("nth") > 1, "duplicate").when(F.col("depth").isNull(), "cycle")
        .when(F.col("rid").isNull(), "unanswered").otherwise("ok")
    )
    level = F.when(F.col("nth") == 1, 2 * F.col("depth"))
    args = F.try_parse_json("arguments")
    # fields in the order of their names
    line = F.to_json(F.struct(args.alias("arguments"), "call_id", "conv_id", F.lit("call").alias("kind"), "name", "parent", "turn"))
    out = x.select("conv_id", F.lit("call").alias("kind"), "call_id", "turn", level.alias("level"), status.alias("status"),
                   problems(F.col("arguments"), F.col("params")).alias("problems"), line.alias("json"))
    r = results.select("conv_id", "turn", "call_id", "content").join(d.withColumn("known", F.lit(True)), same("dc", "did"), "left")
    status = F.when(F.col("known").isNull(), "orphan").when(F.col("depth").isNull(), "cycle").otherwise("ok")
    line = F.to_json(F.struct("call_id", "content", "conv_id", F.lit("result").alias("kind"), "turn"))
    r = r.select("conv_id", F.lit("result").alias("kind"), "call_id", "turn", (2 * F.col("depth") + 1).alias("level"),
                 status.alias("status"), F.array().cast("array<string>").alias("problems"), line.alias("json"))
    return out.union(r)
