"""Tool-call linking: calls and results meet by identifier, get a topological level, are validated and serialised.

Only DataFrame functions. Calls and results are one row per (conversation, identifier) after a combined aggregation, so a
conversation of any size is spread over tasks; the two sides meet in an equi-join. A call's level is one more than the highest
level of the calls it comes after; levels are found round by round, each round placing the calls whose predecessors are placed,
so the number of rounds is the length of the longest chain. Ordering a conversation by level, then turn, then identifier is a
topological order, and a global sort of the output gives it without gathering a conversation in one task. Arguments are parsed
as variants, whose object fields are sorted by name: writing one back gives canonical JSON.

Defined cases: of repeated calls or results of one identifier the first by turn counts and the number is reported; a call
without a result is ``unanswered``, a result without a call ``orphan``, a result of an earlier turn than its call ``early``; null
conversations and identifiers link to nothing and are kept with the status ``unidentified``; unparsable arguments (repeated keys
included) are an error and have null canonical arguments; a predecessor that does not exist is an error and places nothing
behind; calls on a cycle, or behind one, have a null level and the error "cycle". Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.session import cut_lineage

KEY = ["conv_id", "call_id"]
# The schema of a parameter: the variant types that it may have, as a pattern.
TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$",
    "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<.*>$",
    "object": "^OBJECT<.*>$",
}


@dataclass(frozen=True)
class Parameter:
    name: str
    kind: str
    required: bool = True


Schemas = dict[str, tuple[Parameter, ...]]


def _first(df: DataFrame, fields: list[str], prefix: str) -> DataFrame:
    """One row per key: the first by turn, ties by content, and how many there were."""
    first = F.min(F.struct("turn", *fields))
    grouped = df.groupBy(*KEY).agg(first.alias("_first"), F.count("*").alias(f"n_{prefix}s"))
    own = [F.col("_first")[f].alias(f) for f in fields]
    return grouped.select(*KEY, F.col("_first")["turn"].alias(f"{prefix}_turn"), *own, f"n_{prefix}s")


def levels(calls: DataFrame, predecessors: DataFrame) -> DataFrame:
    """Level of every call (distinct keys) by its predecessors (key, after); calls on or behind a cycle have no row."""
    known = calls.select("conv_id", F.col("call_id").alias("after"))
    edges = cut_lineage(predecessors.select(*KEY, "after").distinct().join(known, ["conv_id", "after"]).select(*KEY, "after"))
    placed = [cut_lineage(calls.select(*KEY).join(edges, KEY, "left_anti").withColumn("level", F.lit(0)))]
    while not edges.isEmpty():
        done = placed[-1].select("conv_id", F.col("call_id").alias("after"))
        left = cut_lineage(edges.join(done, ["conv_id", "after"], "left_anti").select(*KEY, "after"))
        ready = edges.select(*KEY).distinct().join(left, KEY, "left_anti").withColumn("level", F.lit(len(placed)))
        placed.append(cut_lineage(ready))
        if placed[-1].isEmpty():
            break
        edges = left
    out = placed[0]
    for part in placed[1:]:
        out = out.unionByName(part)
    return out


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Array of what is wrong with a call's arguments (JSON text) for the tool it names."""
    parsed = F.try_parse_json(arguments)
    out = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, parameters in schemas.items():
        tests = []
        for p in parameters:
            found = F.variant_get(parsed, f"$.{p.name}", "variant")
            absent = found.isNull() | F.is_variant_null(found)
            if p.required:
                tests.append(F.when(absent, F.lit(f"missing {p.name}")))
            wrong = ~absent & ~F.schema_of_variant(found).rlike(TYPES[p.kind])
            tests.append(F.when(wrong, F.lit(f"{p.name} is no {p.kind}")))
        others = F.array_except(F.json_object_keys(arguments), F.array(*(F.lit(p.name) for p in parameters)).cast("array<string>"))
        unknown = F.transform(F.array_sort(F.coalesce(others, F.array().cast("array<string>"))), lambda k: F.concat(F.lit("unknown "), k))
        own = F.concat(F.array_compact(F.array(*tests).cast("array<string>")), unknown)
        out = F.when(name == tool, own).otherwise(out)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(parsed.isNull() | ~is_object, F.array(F.lit("arguments are no JSON object"))).otherwise(out)


def link(calls: DataFrame, results: DataFrame, predecessors: DataFrame, schemas: Schemas) -> DataFrame:
    """calls (conv_id, turn, call_id, name, arguments), results (conv_id, turn, call_id, content) and predecessors (conv_id,
    call_id, after) to one row per identifier, in topological order within each conversation; see the module for the cases."""
    named = "conv_id is not null and call_id is not null"
    first_calls = cut_lineage(_first(calls.where(named), ["name", "arguments"], "call"))
    first_results = _first(results.where(named), ["content"], "result")
    placed = levels(first_calls, predecessors.where(named))
    lost = (
        predecessors.where(named)
        .where("after is not null")
        .join(first_calls.select("conv_id", F.col("call_id").alias("after")), ["conv_id", "after"], "left_anti")
        .groupBy(*KEY)
        .agg(F.count("*").alias("n_lost"))
    )
    met = (
        first_calls.join(placed, KEY, "left")
        .join(lost, KEY, "left")
        .withColumn("is_call", F.lit(True))
        .join(first_results, KEY, "full")
    )
    no_key = "conv_id is null or call_id is null"
    loose = (
        calls.where(no_key)
        .select("conv_id", "call_id", F.col("turn").alias("call_turn"), "name", "arguments", F.lit(True).alias("is_call"))
        .unionByName(
            results.where(no_key).select("conv_id", "call_id", F.col("turn").alias("result_turn"), "content"),
            allowMissingColumns=True,
        )
    )
    every = met.unionByName(loose, allowMissingColumns=True)
    status = (
        F.when(F.expr(no_key), "unidentified")
        .when(F.col("is_call").isNull(), "orphan")
        .when(F.col("n_results").isNull(), "unanswered")
        .when(F.col("result_turn") < F.col("call_turn"), "early")
        .otherwise("linked")
    )
    graph_errors = F.array_compact(
        F.array(
            F.when(F.col("n_lost") > 0, F.lit("missing predecessor")),
            F.when(F.expr(f"level is null and not ({no_key})"), F.lit("cycle")),
        )
    )
    is_call = F.col("is_call").isNotNull()
    errors = F.when(is_call, F.concat(argument_errors(F.col("name"), F.col("arguments"), schemas), graph_errors))
    canonical = F.to_json(F.try_parse_json("arguments"))
    judged = every.select(
        *KEY,
        "level",
        "call_turn",
        "result_turn",
        "name",
        canonical.alias("arguments"),
        "content",
        status.alias("status"),
        F.coalesce("n_calls", is_call.cast("long")).alias("n_calls"),
        F.coalesce("n_results", F.col("content").isNotNull().cast("long")).alias("n_results"),
        F.coalesce(errors, F.array().cast("array<string>")).alias("errors"),
    )
    return judged.withColumn("line", _line()).orderBy("conv_id", "level", "call_turn", "result_turn", "call_id", "line")


def _line() -> Column:
    """Canonical JSON of an exchange: names sorted, no blanks, nulls left out."""
    arguments = F.coalesce(F.concat(F.lit('"arguments":'), "arguments", F.lit(",")), F.lit(""))
    rest = F.to_json(
        F.struct("call_id", "call_turn", "content", "conv_id", "errors", "level", "name", "result_turn", "status")
    )
    return F.concat(F.lit("{"), arguments, F.substring(rest, 2, 1 << 30))


SAMPLE_SCHEMAS: Schemas = {
    "lookup": (Parameter("query", "string"), Parameter("limit", "integer")),
    "count": (Parameter("query", "string"), Parameter("exact", "boolean", required=False)),
    "weigh": (Parameter("values", "array"), Parameter("scale", "number", required=False)),
}


def sample_exchanges(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and predecessors told from plain turns: every assistant turn calls a tool with its whole text in the
    arguments (some of them wrong), the user turn after it is the result, and a call comes after the one at half its place."""
    size, place = F.length("text"), F.floor(F.col("turn") / 2)
    call_id = F.concat_ws("_", F.lit("call"), F.col("conv_id"), F.col("turn"))
    query = F.to_json(F.struct(F.col("text").alias("query")))
    limit = F.when(size % 7 == 0, F.concat(F.lit('"'), size, F.lit('"'))).otherwise(size.cast("string"))
    name = F.element_at(F.array(*(F.lit(n) for n in ("lookup", "count", "weigh", "forget"))), (size % 4 + 1).cast("int"))
    arguments = (
        F.when(name == "lookup", F.concat(F.lit('{ "limit" : '), limit, F.lit(", "), F.substring(query, F.lit(2), F.length(query))))
        # A longer one lacks its closing brace.
        .when(name == "count", F.when(F.length(query) > 30, F.substring(query, F.lit(1), F.length(query) - 1)).otherwise(query))
        .when(name == "weigh", F.concat(F.lit('{"scale": '), (size / 8).cast("string"), F.lit(', "values": ['), size, F.lit("]}")))
        .otherwise(query)
    )
    asked = turns.where("role = 'assistant'")
    calls = asked.select("conv_id", "turn", call_id.alias("call_id"), name.alias("name"), arguments.alias("arguments"))
    before = F.col("turn") - 1
    results = turns.where("role = 'user' and turn > 0").select(
        "conv_id", "turn", F.concat_ws("_", F.lit("call"), F.col("conv_id"), before).alias("call_id"), F.col("text").alias("content")
    )
    parent = F.col("turn") - 2 * (place - F.floor(place / 2))
    after = F.when((place > 0) & (parent > 0), F.concat_ws("_", F.lit("call"), F.col("conv_id"), parent))
    return calls, results, asked.select("conv_id", call_id.alias("call_id"), after.alias("after")).where("after is not null")
