"""Tool-call linking for chat formatting.

Calls and their results come as separate rows and are joined by identifier. Arguments are
parsed and checked against the schema of their tool, calls are ordered after the calls
whose results they use, and each call leaves as one line of canonical JSON: keys sorted, no spaces.

Ordering: a call's place in its conversation is already a valid order unless it uses a call that stands
after it. Only conversations with such a call are ordered in rounds, each of which places the calls whose
needs are all placed, the conversations side by side; what is left when a round places nothing
is a cycle. No window ever covers a whole conversation, so one may hold any share of the rows.

Nulls and odd cases: null or malformed arguments are ``invalid`` and serialised as null; a call
without result is ``open``, and of several results the first by text counts; a null call_id links with nothing;
calls that repeat an identifier are all kept and linked alike; a need that names no call of the
conversation is ignored; results without a call are left out. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common

CYCLE = -1


@dataclass(frozen=True)
class Field:
    """A field of a tool's arguments: JSON type, whether it is required, and its least number or length."""

    name: str
    kind: str
    required: bool = True
    least: int | None = None


Schemas = dict[str, tuple[Field, ...]]
# JSON types as the variant functions name them.
KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN"}


def _field_ok(value: Column, field: Field) -> Column:
    path = f"$.{field.name}"
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    ok = F.coalesce(kind == KINDS[field.kind], F.lit(False))
    if field.least is not None and field.kind == "string":
        ok = ok & (F.length(F.try_variant_get(value, path, "string")) >= field.least)
    elif field.least is not None:
        ok = ok & (F.try_variant_get(value, path, "bigint") >= field.least)
    missing = kind.isNull() | (kind == "VOID")
    return ok if field.required else ok | missing


def valid(name: Column, value: Column, schemas: Schemas) -> Column:
    """Whether parsed arguments satisfy the schema of the named tool; a tool without schema is not valid."""
    result = F.lit(False)
    for tool, fields in sorted(schemas.items()):
        ok = F.schema_of_variant(value).startswith("OBJECT")
        for field in fields:
            ok = ok & _field_ok(value, field)
        result = F.when(name == tool, F.coalesce(ok, F.lit(False))).otherwise(result)
    return result


def _rounds(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, round) of the calls of conversations that are out of order."""
    late = needs.filter("need_turn >= turn").select("conv_id").distinct()
    late = common.written(late, "late")
    if late.isEmpty():
        return calls.select("conv_id", "call_id").limit(0).withColumn("round", F.lit(0))
    left = common.written(calls.join(late, "conv_id", "left_semi").select("conv_id", "call_id").distinct(), "unplaced")
    edges = common.written(needs.join(late, "conv_id", "left_semi").select("conv_id", "call_id", "need").distinct(), "needs")
    placed, number = [], 0
    while True:
        waiting = edges.join(left.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_semi")
        ready = left.join(waiting, ["conv_id", "call_id"], "left_anti")
        ready = common.written(ready, "placed")
        if ready.isEmpty():
            break
        placed.append(ready.withColumn("round", F.lit(number)))
        left = common.written(left.join(ready, ["conv_id", "call_id"], "left_anti"), "unplaced")
        number += 1
    result = left.withColumn("round", F.lit(CYCLE))
    for one in placed:
        result = result.unionByName(one)
    return result


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call: conv_id, round, turn, call_id, status, json; sorted by the first four they stand in order.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), needs (array of call_id).
    ``results``: conv_id, call_id, content. The round is 0 throughout conversations whose turns are in order.
    """
    edges = calls.select("conv_id", "turn", "call_id", F.explode("needs").alias("need"))
    placed = calls.groupBy("conv_id", F.col("call_id").alias("need")).agg(F.min("turn").alias("need_turn"))
    edges = edges.join(placed, ["conv_id", "need"])
    rounds = _rounds(calls, edges)
    first = results.groupBy("conv_id", "call_id").agg(F.min("content").alias("content"), F.lit(True).alias("answered"))
    rows = calls.join(first, ["conv_id", "call_id"], "left").join(rounds, ["conv_id", "call_id"], "left")
    parsed = F.try_parse_json("arguments")
    rows = rows.withColumn("parsed", parsed)
    ok = valid(F.col("name"), F.col("parsed"), schemas)
    status = F.when(~ok, "invalid").when(F.col("answered").isNull(), "open").otherwise("linked")
    rows = rows.withColumn("status", F.when(F.coalesce("round", F.lit(0)) == CYCLE, "cycle").otherwise(status))
    text = lambda c: F.expr(f"coalesce(substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2), 'null')")
    line = F.concat(
        F.lit('{"arguments":'),
        F.coalesce(F.to_json("parsed"), F.lit("null")),
        F.lit(',"id":'),
        text("call_id"),
        F.lit(',"name":'),
        text("name"),
        F.lit(',"result":'),
        text("content"),
        F.lit("}"),
    )
    return rows.select("conv_id", F.coalesce("round", F.lit(0)).alias("round"), "turn", "call_id", "status", line.alias("json"))


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as a table of plain turns implies them.

    Every turn that is not the assistant's is a call of the tool named by its role, with its text and number of
    words as arguments; it needs the call two turns before. An assistant's turn is the result of the turn before it.
    """
    name = lambda turn: F.concat_ws("-", F.lit("call"), "conv_id", turn)
    asked = turns.filter("role != 'assistant'")
    arguments = F.to_json(F.struct("text", F.size(common.words(F.col("text"))).alias("words")))
    calls = asked.select(
        "conv_id",
        "turn",
        name(F.col("turn")).alias("call_id"),
        F.col("role").alias("name"),
        arguments.alias("arguments"),
        F.array(name(F.col("turn") - 2)).alias("needs"),
    )
    results = turns.filter("role = 'assistant'")
    return calls, results.select("conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
