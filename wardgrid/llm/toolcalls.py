"""Tool-call linking in chats: calls and results joined by identifier, ordered, checked and written as JSON.

`calls_of` takes calls and results from messages: JSON objects with "tool_calls" (id, name, arguments,
depends_on) in assistant messages and with "tool_call_id" in tool messages. Calls and results are joined on
conversation and identifier. Calls are ordered topologically over their dependencies: a call's level is the
longest chain of calls it rests on, found round by round along the links, each round joining only what
changed. Calls on a cycle, or resting on one, never settle and are marked. Arguments are checked against the
tool's schema (required and unknown names, JSON types, allowed values, at any depth) and written as canonical
JSON: names in order, no blanks, shortest escapes and numbers.

Nulls: a message without a conversation or text holds no call; a call without an identifier is linked with
nothing and no row of `linked`, but each is a row of its own in `unnamed`; missing arguments are an empty object. Of calls that share an identifier in a conversation the
earliest counts, and the same for results; results without a call are counted as orphans of their
conversation by `orphans`. A dependency on an unknown call is an error of that call but no link. Arguments
that are no JSON object are invalid and written as null; so are those nested deeper than `DEEPEST` and those
with half a surrogate pair, which no UTF-8 text can hold. Empty tables give empty results. A conversation may
hold any share of all calls: joins are on conversation and identifier, never on the conversation alone.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardgrid.llm import common

KINDS = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}
MESSAGE = "tool_calls array<struct<id:string,name:string,arguments:string,depends_on:array<string>>>, tool_call_id string"
KEY = ("conv_id", "call_id")
DEEPEST = 200


def canonical(value: object, depth: int = 0) -> str:
    """JSON with names in order and no blanks; whole floats as integers, exponents without zeros in front.
    ValueError for what JSON or UTF-8 can't hold and for what is nested too deep."""
    if depth > DEEPEST:
        raise ValueError("nested too deep")
    if isinstance(value, dict):
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k], depth + 1)}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(canonical(v, depth + 1) for v in value) + "]"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("no JSON number")
        if value.is_integer() and abs(value) < 2**53:
            return str(int(value))
        return repr(value).replace("e-0", "e-").replace("e+", "e")
    if isinstance(value, str):
        value.encode()
    return json.dumps(value, ensure_ascii=False)


def fits(value: object, kind: str) -> bool:
    """Whether a value is of a JSON type; nothing is of a type that JSON does not have."""
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "integer":
        return not isinstance(value, bool) and (isinstance(value, int) or isinstance(value, float) and value.is_integer())
    return kind in KINDS and isinstance(value, KINDS[kind])


def fault(value: object, schema: dict, at: str = "") -> str | None:
    """The first thing in which a value departs from its schema, `at` being its place in the arguments.
    `type` may be missing, a name or a list of names; types of the outermost value are not looked at."""
    if at and "type" in schema:
        kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        if not any(fits(value, kind) for kind in kinds):
            return f"{at} is no {' or '.join(map(str, kinds))}"
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        return f"{at} is not allowed"
    if isinstance(value, dict):
        inside = f"{at}." if at else ""
        known = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                return f"missing {inside}{name}"
        for name in sorted(value):
            if name in known:
                found = fault(value[name], known[name], inside + name)
            elif isinstance(schema.get("additionalProperties"), dict):
                found = fault(value[name], schema["additionalProperties"], inside + name)
            else:
                found = f"unexpected {inside}{name}" if schema.get("additionalProperties", True) is False else None
            if found:
                return found
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for k, item in enumerate(value):
            found = fault(item, schema["items"], f"{at}[{k}]")
            if found:
                return found
    return None


def checked(text: str | None, schema: dict | None) -> tuple[str | None, str | None]:
    """Canonical arguments, and what is wrong with them."""
    try:
        value = json.loads(text) if text and text.strip() else {}
        written = canonical(value)
    except (ValueError, RecursionError):
        return None, "no JSON"
    if not isinstance(value, dict):
        return None, "no object"
    if schema is None:
        return written, "unknown tool"
    return written, fault(value, schema)


def check_arguments(arguments: Column, tool: Column, schemas: dict[str, dict]) -> Column:
    """A struct (arguments, error): canonical JSON, and null or what is wrong."""
    kind = T.StructType([T.StructField("arguments", T.StringType()), T.StructField("error", T.StringType())])

    @F.pandas_udf(kind)
    def check(texts: pd.Series, names: pd.Series) -> pd.DataFrame:
        rows = [checked(x, schemas.get(n)) for x, n in zip(texts, names, strict=True)]
        return pd.DataFrame(rows, columns=["arguments", "error"], dtype=object)

    return check(arguments, tool)


def calls_of(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (conv_id, call_id, turn, tool, arguments, depends_on) and results (conv_id, call_id, turn, text)
    that messages (conv_id, turn, role, text) state as JSON."""
    read = messages.filter("conv_id is not null and text is not null").withColumn("m", F.from_json("text", MESSAGE))
    calls = read.filter("role = 'assistant'").select("conv_id", "turn", F.explode("m.tool_calls").alias("c"))
    calls = calls.select("conv_id", F.col("c.id").alias("call_id"), "turn", F.col("c.name").alias("tool"), F.col("c.arguments").alias("arguments"), F.coalesce("c.depends_on", F.array().cast("array<string>")).alias("depends_on"))
    results = read.filter("role = 'tool' and m.tool_call_id is not null").select("conv_id", F.col("m.tool_call_id").alias("call_id"), "turn", "text")
    return calls, results


def _earliest(rows: DataFrame) -> DataFrame:
    rest = [c for c in rows.columns if c not in KEY]
    order = F.struct(F.col("turn").isNull().alias("unknown"), "turn", *[c for c in rest if c != "turn"])
    return rows.filter("call_id is not null").groupBy(*KEY).agg(F.min(order).alias("r")).select(*KEY, *[f"r.{c}" for c in rest])


def levels(links: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls that rest on others and settle: the longest chain below each.

    `links` is (conv_id, call_id, needs). A call settles once all it needs have; each round settles those
    whose last need settled in the round before."""
    links = common.stored(links.distinct(), "links")
    counts = links.groupBy(*KEY).agg(F.count("*").alias("needed"))
    free = links.select("conv_id", F.col("needs").alias("call_id")).distinct().join(links.select(*KEY).distinct(), list(KEY), "left_anti")
    settled, level, fresh = None, 0, free
    met = None
    while True:
        arrived = links.join(fresh.select("conv_id", F.col("call_id").alias("needs")), ["conv_id", "needs"]).groupBy(*KEY).agg(F.count("*").alias("met"))
        met = arrived if met is None else met.unionByName(arrived).groupBy(*KEY).agg(F.sum("met").alias("met"))
        met = common.stored(met.join(counts, list(KEY)).select(*KEY, "met", "needed"), "met")
        level += 1
        fresh = common.stored(met.filter("met = needed").select(*KEY, F.lit(level).alias("level")), "settled")
        if fresh.isEmpty():
            break
        settled = fresh if settled is None else settled.unionByName(fresh)
        met = met.filter("met < needed").select(*KEY, "met")
    return settled if settled is not None else free.select(*KEY, F.lit(0).alias("level")).limit(0)


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call: (conv_id, call_id, turn, tool, arguments, error, level, result_turn, result, status).

    `status` is linked, pending (no result), early (its result comes before it) or cycle."""
    calls = common.stored(_earliest(calls.select(*KEY, "turn", "tool", "arguments", "depends_on")), "calls")
    answers = _earliest(results.select(*KEY, "turn", "text")).select(*KEY, F.col("turn").alias("result_turn"), F.col("text").alias("result"))
    needs = calls.select(*KEY, F.explode(F.array_distinct("depends_on")).alias("needs"))
    known = calls.select("conv_id", F.col("call_id").alias("needs"))
    links = needs.join(known, ["conv_id", "needs"])
    unknown = needs.join(known, ["conv_id", "needs"], "left_anti").groupBy(*KEY).agg(F.min("needs").alias("lost"))
    resting = links.select(*KEY).distinct().withColumn("rests", F.lit(True))
    joined = calls.join(answers, list(KEY), "left").join(levels(links), list(KEY), "left").join(resting, list(KEY), "left").join(unknown, list(KEY), "left")
    joined = joined.withColumn("c", check_arguments(F.col("arguments"), F.col("tool"), schemas))
    cycle = F.col("level").isNull() & F.coalesce("rests", F.lit(False))
    status = F.when(cycle, "cycle").when(F.col("result_turn").isNull(), "pending").when(F.col("result_turn") <= F.col("turn"), "early").otherwise("linked")
    return joined.select(
        *KEY,
        "turn",
        "tool",
        F.col("c.arguments").alias("arguments"),
        F.coalesce("c.error", F.when(F.col("lost").isNotNull(), F.concat(F.lit("needs unknown "), "lost"))).alias("error"),
        F.when(cycle, None).otherwise(F.coalesce("level", F.lit(0))).alias("level"),
        "result_turn",
        "result",
        status.alias("status"),
    )


def unnamed(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """The calls without an identifier, one row each with the columns of `linked`: checked and pending. Nothing
    can rest on them; they have a level if they rest on nothing themselves."""
    checked_calls = calls.filter("call_id is null").withColumn("c", check_arguments(F.col("arguments"), F.col("tool"), schemas))
    rests = F.size("depends_on") > 0
    return checked_calls.select(
        *KEY,
        "turn",
        "tool",
        F.col("c.arguments").alias("arguments"),
        F.col("c.error").alias("error"),
        F.when(~rests, 0).alias("level"),
        F.lit(None).cast("long").alias("result_turn"),
        F.lit(None).cast("string").alias("result"),
        F.lit("pending").alias("status"),
    )


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(conv_id, orphans): results that answer no call."""
    return results.join(calls.select(*KEY).distinct(), list(KEY), "left_anti").groupBy("conv_id").agg(F.count("*").alias("orphans"))
