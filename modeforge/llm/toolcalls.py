"""Chat formatting: link tool calls with their results, order and validate them, write canonical JSON.

Calls and results meet in a hash join on conversation and identifier; results are first reduced to one
row per identifier, so repeated identifiers multiply nothing. The order is topological: a call's
level is the length of the longest chain of calls that it waits for. Levels are found in rounds
over the whole table, each a join of the edges that are left with the calls just placed, so no
conversation is gathered in one task; there are as many rounds as levels. Validation and
serialisation are small functions of one row.

Defined cases: a null identifier links with nothing, and its calls and results come back with a status of their
own, as do turns without a number; repeated calls of one identifier all get its
result and are marked; of several results of one identifier the first by turn, then by content, counts; a
dependency that no call has is an error and waits for nothing; calls on a cycle, or behind one, have
no level; arguments that are no JSON object, or null, are invalid and written as null; empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeforge.llm.common import WORD, staged, text_or_empty

#: The tools of the query, with the rules for their parameters.
TOOLS: dict[str, dict[str, dict[str, Any]]] = {
    "convert": {"amount": {"type": "number", "required": True}, "unit": {"type": "string", "required": True, "enum": ["km", "m", "mi"]}},
    "lookup": {"depth": {"type": "integer", "maximum": 3}, "key": {"type": "string", "required": True, "shortest": 1}},
    "search": {"limit": {"type": "integer", "required": True, "maximum": 50}, "query": {"type": "string", "required": True, "shortest": 1}},
}

#: The status of results that name no call.
NAMELESS = "result without identifier"

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}


def _refuse(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def parsed(text: str | None) -> dict[str, Any] | None:
    """The JSON object of a text, or None."""
    try:
        value = json.loads(text, parse_constant=_refuse) if text is not None else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def violations(arguments: dict[str, Any] | None, rules: Mapping[str, Mapping[str, Any]] | None) -> list[str]:
    """What is wrong with the arguments, in the order of their names."""
    if rules is None:
        return ["unknown tool"]
    if arguments is None:
        return ["no object"]
    found = []
    for name in sorted({*arguments, *rules}):
        rule = rules.get(name)
        if rule is None:
            found.append(f"{name}: unknown")
        elif name not in arguments:
            found += [f"{name}: missing"] if rule.get("required") else []
        else:
            value, kind = arguments[name], rule["type"]
            if not isinstance(value, _TYPES[kind]) or (isinstance(value, bool) and kind != "boolean"):
                found.append(f"{name}: not {kind}")
            elif "enum" in rule and value not in rule["enum"]:
                found.append(f"{name}: not listed")
            elif "maximum" in rule and value > rule["maximum"]:
                found.append(f"{name}: above {rule['maximum']}")
            elif "shortest" in rule and len(value) < rule["shortest"]:
                found.append(f"{name}: too short")
    return found


def canonical_json(value: Any) -> str:
    """Sorted keys, no spaces, characters unescaped where JSON allows; lone surrogates become ``?``."""

    def clean(x: Any) -> Any:
        if isinstance(x, float) and not math.isfinite(x):
            return None
        if isinstance(x, dict):
            return {k: clean(v) for k, v in x.items()}
        return [clean(v) for v in x] if isinstance(x, list) else x

    text = json.dumps(clean(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return text.encode("utf-8", "replace").decode()


def levels(calls: DataFrame, waits: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of calls ``(conv_id, call_id)``, distinct; ``waits`` has ``dep`` too."""
    key = ["conv_id", "call_id"]
    edges = staged(waits.join(calls.withColumnRenamed("call_id", "dep"), ["conv_id", "dep"], "left_semi"), "waits")
    done = [staged(calls.join(edges, key, "left_anti").withColumn("level", F.lit(0)), "level-0")]
    while not edges.isEmpty():
        placed = done[-1].select("conv_id", F.col("call_id").alias("dep"))
        left = staged(edges.join(placed, ["conv_id", "dep"], "left_anti"), "waits")
        freed = staged(
            edges.select(*key).distinct().join(left, key, "left_anti").withColumn("level", F.lit(len(done))), f"level-{len(done)}"
        )
        edges = left
        if freed.isEmpty():
            break
        done.append(freed)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def link_calls(calls: DataFrame, results: DataFrame, tools: Mapping[str, Mapping[str, Mapping[str, Any]]] | None = None) -> DataFrame:
    """One row per call, one per identifier of results without a call, and one per result without identifier.

    ``calls(conv_id, call_id, turn, name, arguments, after)``, ``after`` an array of identifiers;
    ``results(conv_id, call_id, turn, content)``. Gives ``conv_id, call_id, turn, name, status, level,
    valid, errors, message``. Order by level, turn and identifier to send a conversation's calls.
    """
    tools = dict(TOOLS if tools is None else tools)
    key = ["conv_id", "call_id"]
    calls = calls.select(*key, "turn", "name", "arguments", "after")
    named = calls.where("conv_id is not null and call_id is not null")
    known = staged(named.groupBy(*key).agg(F.count("*").alias("calls")), "call-ids")
    answers = staged(
        results.where("conv_id is not null and call_id is not null")
        .groupBy(*key)
        .agg(F.count("*").alias("results"), F.min(F.struct("turn", "content")).alias("first")),
        "results",
    )
    waits = named.select(*key, F.explode("after").alias("dep")).where("dep is not null").distinct()
    waits = staged(waits, "dependencies")
    level = staged(levels(known.select(*key), waits), "levels")
    dangling = staged(
        waits.join(known.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"], "left_anti")
        .groupBy(*key)
        .agg(F.count("*").alias("dangling")),
        "dangling",
    )
    facts = staged(known.join(level, key, "left").join(dangling, key, "left").join(answers, key, "left"), "facts")
    linked = calls.join(facts, key, "left").select(
        *key, "turn", "name", "arguments", "level", F.coalesce("dangling", F.lit(0)).alias("dangling"),
        F.when(F.col("calls").isNull(), "no identifier")
        .when(F.col("calls") > 1, "repeated call")
        .when(F.col("results").isNull(), "no result")
        .when(F.col("results") > 1, "repeated result")
        .otherwise("linked").alias("status"),
        F.col("first.content").alias("content"),
    )
    orphans = answers.join(known, key, "left_anti").select(
        *key, F.col("first.turn").alias("turn"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
        F.lit(None).cast("int").alias("level"), F.lit(0).cast("bigint").alias("dangling"), F.lit("no call").alias("status"), F.col("first.content").alias("content"),
    )

    unnamed = results.where("conv_id is null or call_id is null").select(
        *key, "turn", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("int").alias("level"),
        F.lit(0).cast("bigint").alias("dangling"), F.lit(NAMELESS).alias("status"), "content",
    )

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            valid, errors, messages = [], [], []
            for x in rows.itertuples(index=False):
                arguments = parsed(x.arguments)
                no_call = x.status in ("no call", NAMELESS)
                found = [] if no_call else violations(arguments, tools.get(x.name))
                found += [f"{x.dangling} unknown dependencies"] * (x.dangling > 0)
                at = None if pd.isna(x.level) else int(x.level)
                found += ["cycle"] * (at is None and not no_call and x.status != "no identifier")
                valid.append(not no_call and not found)
                errors.append("; ".join(found))
                messages.append(
                    canonical_json({"arguments": arguments, "id": x.call_id, "level": at, "name": x.name, "result": x.content})
                )
            yield rows[["conv_id", "call_id", "turn", "name", "status"]].assign(
                level=rows["level"].astype("Int32"), valid=valid, errors=errors, message=messages
            )[["conv_id", "call_id", "turn", "name", "status", "level", "valid", "errors", "message"]]

    kinds = dict(linked.dtypes)
    return linked.unionByName(orphans).unionByName(unnamed).mapInPandas(
        written,
        f"conv_id {kinds['conv_id']}, call_id {kinds['call_id']}, turn {kinds['turn']}, name string, status string, level int, "
        "valid boolean, errors string, message string",
    )


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from the turns of a conversation table.

    Every assistant turn calls a tool chosen by the length of its text, with arguments from its
    words; it waits for the call some turns before that the lowest bit of its number names, so chains
    are as long as numbers have bits. Every other turn answers the turn before it.
    """
    turns = conversations.select("conv_id", "turn", "role", text_or_empty().alias("text"))
    named = lambda turn: F.when(F.col("turn").isNotNull(), F.format_string("call_%d", turn))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    assistant = turns.where("role = 'assistant'").withColumn("words", words).withColumn("k", F.expr("turn div 2"))
    name = F.element_at(F.array(*(F.lit(x) for x in sorted(TOOLS))), (F.pmod(F.char_length("text"), F.lit(3)) + 1).cast("int"))
    count, points = F.size("words"), F.char_length("text")
    chosen = F.element_at(F.array(*(F.lit(u) for u in ("m", "km", "mi", "yd"))), (F.pmod(points, F.lit(4)) + 1).cast("int"))
    arguments = (
        F.when(F.col("name") == "convert", F.to_json(F.struct(chosen.alias("unit"), (points / 4.0).alias("amount"))))
        .when(F.col("name") == "lookup", F.to_json(F.struct(F.coalesce(F.try_element_at("words", F.lit(1)), F.lit("")).alias("key"), F.pmod(count, F.lit(6)).alias("depth"))))
        .otherwise(F.to_json(F.struct(F.array_join("words", " ").alias("query"), count.alias("limit"))))
    )
    before = F.expr("2 * (k - (k & (-k))) + turn % 2")
    calls = assistant.withColumn("name", name).select(
        "conv_id", named(F.col("turn")).alias("call_id"), "turn", "name", arguments.alias("arguments"),
        F.when(F.col("k") > 0, F.array(F.format_string("call_%d", before))).otherwise(F.expr("cast(array() as array<string>)")).alias("after"),
    )
    results = turns.where("role is null or role <> 'assistant'").select(
        "conv_id", named(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return calls, results
