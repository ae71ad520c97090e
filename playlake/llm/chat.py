"""Chat formatting: tool calls linked to results, ordered by dependency, validated, canonical JSON.

Calls and results are hash-joined by identifier, after several results of one call are reduced
to the first, so a hot identifier is one row when they meet. Conversations are ordered one at
a time inside tasks; one of more than ``IN_TASK`` calls is ordered in rounds of joins instead, so no
task ever holds it: chains of calls with one dependency each are shortened by pointer doubling, in as
many rounds as their length has binary digits, and the calls with several dependencies are then
placed round by round. Steps are numbered from range-dealt rows for the same reason.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import slices, written

ROWS_AT_ONCE = 1000
IN_TASK = 10_000  # calls of a conversation that one task orders
DEEPEST = 200  # levels of nesting that arguments may have
LONE = re.compile("[\ud800-\udfff]")  # halves of surrogate pairs, which no UTF-8 text holds


def escaped(text: str) -> str:
    """Lone surrogates as the JSON escapes they came from."""
    return LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    """JSON with sorted keys and no spaces: equal values give equal text.

    Keys sort by their UTF-16 code units; whole floats are written as integers, other floats
    in their shortest form; lone surrogates stay escapes. Not-a-number and infinities have no
    JSON and raise ValueError.
    """
    if isinstance(value, dict):
        pairs = sorted(value.items(), key=lambda kv: kv[0].encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(v)}" for k, v in pairs) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e21:
        return str(int(value))
    text = escaped(json.dumps(value, ensure_ascii=False, allow_nan=False))
    return text.replace("e-0", "e-") if isinstance(value, float) else text


_KINDS = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: (isinstance(v, int) and not isinstance(v, bool)) or (isinstance(v, float) and v.is_integer()),
}


def schema_errors(value, schema: dict, path: str = "$") -> list[str]:
    """Where a value breaks a JSON schema: type, enum, required, properties, additionalProperties,
    items, minimum, maximum, minLength, maxLength, minItems, maxItems."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_KINDS[k](value) for k in kinds):
        return [f"{path}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):  # true is not 1
        found.append(f"{path}: not among the values allowed")
    if _KINDS["number"](value):
        if value < schema.get("minimum", value):
            found.append(f"{path}: below {schema['minimum']}")
        if value > schema.get("maximum", value):
            found.append(f"{path}: above {schema['maximum']}")
    for kind, least, most in ((str, "minLength", "maxLength"), (list, "minItems", "maxItems")):
        if isinstance(value, kind):
            if len(value) < schema.get(least, 0):
                found.append(f"{path}: shorter than {schema[least]}")
            if most in schema and len(value) > schema[most]:
                found.append(f"{path}: longer than {schema[most]}")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += schema_errors(item, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            found += [f"{path}.{k}: unknown" for k in sorted(value) if k not in known]
        for k in sorted(known):
            if k in value:
                found += schema_errors(value[k], known[k], f"{path}.{k}")
    return found


def _finite(text: str) -> float:
    if math.isinf(number := float(text)):
        raise OverflowError
    return number


def parsed(text: str | None):
    """(arguments, errors) of a JSON text. What cannot be kept stays the text it is, with one error:
    no JSON, a number beyond a double, nesting deeper than ``DEEPEST``."""
    try:
        value = json.loads(text or "", parse_constant=lambda c: 1 / 0, parse_float=_finite)
    except RecursionError:
        return text, ["$: nested too deep"]
    except OverflowError:
        return text, ["$: number out of range"]
    except (ValueError, ZeroDivisionError):
        return text, ["$: not JSON"]
    level, depth = [value], 0
    while level := [v for x in level if isinstance(x, (dict, list)) for v in (x.values() if isinstance(x, dict) else x)]:
        depth += 1
        if depth > DEEPEST:
            return text, ["$: nested too deep"]
    return value, []


def levels_of(depends: dict[str, list[str]]) -> dict[str, int]:
    """Levels of one conversation's calls; calls in or behind a cycle are left out."""
    waits = {call: {d for d in needed if d in depends} for call, needed in depends.items()}
    behind: dict[str, list[str]] = {}
    for call, needed in waits.items():
        for d in needed:
            behind.setdefault(d, []).append(call)
    levels = {call: 0 for call, needed in waits.items() if not needed}
    queue = list(levels)
    for done in queue:  # grows while it is read
        for call in behind.get(done, ()):
            waits[call].discard(done)
            if not waits[call]:
                levels[call] = levels[done] + 1
                queue.append(call)
    return levels


def _levels(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, call_id, depends_on) by conversation -> (conv_id, call_id, level)."""
    current, depends, kind = None, {}, pa.int64()

    def closed() -> pa.RecordBatch:
        levels = levels_of(depends)
        columns = [[current] * len(depends), list(depends), [levels.get(c) for c in depends]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (kind, pa.string(), pa.int32()), strict=True)],
            names=["conv_id", "call_id", "level"],
        )

    for batch in batches:
        kind = batch.column(0).type
        for conv, call, needed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != current and depends:
                yield closed()
                depends = {}
            current = conv
            depends[call] = needed or []
    if depends:
        yield closed()


def topological_levels(calls: DataFrame, in_task: int = IN_TASK) -> DataFrame:
    """(conv_id, call_id, level) of each of ``calls(conv_id, call_id, depends_on)``, ids unique in a conversation.

    Level 0 depends on nothing in its conversation; any other level is one more than the
    highest among its dependencies. A call in a cycle or behind one has no level (null).
    """
    sizes = calls.groupBy("conv_id").agg(F.count("*").alias("n"))
    large = written(sizes.where(F.col("n") > in_task).select("conv_id"), "chat-large")
    some = not large.isEmpty()
    small = calls.join(large, "conv_id", "left_anti") if some else calls
    dealt = small.select("conv_id", "call_id", "depends_on").repartition("conv_id").sortWithinPartitions("conv_id")
    found = dealt.mapInArrow(_levels, f"conv_id {calls.schema['conv_id'].dataType.simpleString()}, call_id string, level int")
    return found.unionByName(_levels_by_rounds(calls.join(large, "conv_id", "left_semi"))) if some else found


def _levels_by_rounds(calls: DataFrame) -> DataFrame:
    """``topological_levels`` by joins: chains by pointer doubling, what is left round by round."""
    name = ["conv_id", "call_id"]
    nodes = calls.select(*name)
    parents = nodes.withColumnRenamed("call_id", "parent")
    wanted = calls.select(*name, F.explode(F.array_distinct("depends_on")).alias("parent"))
    edges = written(wanted.join(parents, ["conv_id", "parent"], "left_semi"), "chat-edges")
    degrees = written(edges.groupBy(*name).agg(F.count("*").alias("n")), "chat-degrees")
    single = degrees.where("n = 1").select(*name)
    # Each call with one dependency points to it, then to that one's, twice as far in every round, up to a
    # call that has none or several.
    chain = written(edges.join(single, name, "left_semi").withColumn("far", F.lit(1)), "chat-chain")
    for _ in range(max(1, chain.count()).bit_length()):
        step = chain.select("conv_id", F.col("call_id").alias("parent"), F.col("parent").alias("next"), F.col("far").alias("more"))
        joined = chain.join(step, ["conv_id", "parent"], "left")
        chain = written(
            joined.select(*name, F.coalesce("next", "parent").alias("parent"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far")),
            "chat-chain",
        )
    # A chain that still points into a chain goes round: its calls have no level.
    ends = chain.select("conv_id", "call_id", F.col("parent").alias("end"), "far")
    reach = ends.withColumnRenamed("call_id", "parent")
    several = edges.join(single, name, "left_anti").join(reach, ["conv_id", "parent"], "left").select(
        *name, F.coalesce("end", "parent").alias("parent"), (F.coalesce("far", F.lit(0)) + 1).alias("far"))
    edges = written(several.groupBy(*name, "parent").agg(F.max("far").alias("far")), "chat-several")
    placed = written(nodes.join(degrees, name, "left_anti").withColumn("level", F.lit(0)), "chat-level")
    frontier = levels = placed
    while not edges.isEmpty() and not frontier.isEmpty():
        done = frontier.withColumnRenamed("call_id", "parent")
        hit = edges.join(done, ["conv_id", "parent"], "left")
        # Of a call whose dependencies are placed in part, the highest so far is kept as an edge of no parent.
        told = hit.withColumn("at", F.coalesce(F.col("level") + F.col("far"), F.when(F.col("parent").isNull(), F.col("far"))))
        per = told.groupBy(*name).agg(F.max("at").alias("at"), F.count_if(F.col("at").isNull()).alias("open"))
        per = written(per, "chat-per")
        frontier = written(per.where("open = 0").select(*name, F.col("at").alias("level")), "chat-level")
        levels = levels.unionByName(frontier)
        waiting = per.where("open > 0")
        left = told.where("at is null").select(*name, "parent", "far")
        carried = waiting.where("at is not null").select(*name, F.lit(None).cast("string").alias("parent"), F.col("at").alias("far"))
        edges = written(left.unionByName(carried), "chat-edges")
    levels = written(levels, "chat-levels")
    by_chain = ends.join(levels.withColumnRenamed("call_id", "end"), ["conv_id", "end"]).select(
        *name, (F.col("level") + F.col("far")).alias("level"))
    return nodes.join(levels.unionByName(by_chain), name, "left")


def numbered(df: DataFrame, group: str, order: list) -> DataFrame:
    """``df`` with ``step``: the rows of each group numbered from 0 in that order, groups of any size."""
    dealt = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt = written(dealt.withColumn("_part", F.spark_partition_id()), "numbered")
    counts = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("_group"), F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    at = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    joined = dealt.withColumn("_at", at).join(
        offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of"))
    )
    return joined.withColumn("step", F.col("_first") + F.col("_at") - 1).drop("_part", "_of", "_group", "_first", "_at")


FORMATTED = (
    "conv_id long, step long, level int, call_id string, name string, n_results long, valid boolean, "
    "errors array<string>, message string"
)


def _messages(schemas: dict[str, dict]):
    def message(row: dict) -> dict:
        arguments, errors = parsed(row["arguments"])
        if row["name"] not in schemas:
            errors.append("no schema of that name")
        elif not errors:
            errors += schema_errors(arguments, schemas[row["name"]])
        if row["level"] is None:
            errors.append("depends on itself")
        errors += [f"depends on {d}, which is missing" for d in row["missing"] or []]
        if not row["n_results"]:
            errors.append("no result")
        body = {
            "arguments": arguments,
            "depends_on": row["depends_on"],
            "id": row["call_id"],
            "name": row["name"],
            "result": row["content"],
            "type": "tool_call",
        }
        return {k: row[k] for k in ("conv_id", "step", "level", "call_id", "name", "n_results")} | {
            "valid": not errors,
            "errors": [escaped(e) for e in errors],
            "message": canonical(body),
        }

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("step", pa.int64()), ("level", pa.int32()), ("call_id", pa.string()), ("name", pa.string()),
             ("n_results", pa.int64()), ("valid", pa.bool_()), ("errors", pa.list_(pa.string())), ("message", pa.string())]
        )
        for batch in slices(batches, ROWS_AT_ONCE):
            yield pa.RecordBatch.from_pylist([message(r) for r in batch.to_pylist()], schema=schema)

    return run


def format_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, in an order where every call follows what it depends on.

    ``calls``: conv_id, call_id, name, arguments (JSON text), depends_on (ids in the same
    conversation), position. ``results``: conv_id, call_id, content, position. Returns
    conv_id, step (0, 1, ... in a conversation), level, call_id, name, n_results, valid, errors
    and the canonical JSON ``message``.

    Calls of a level follow their position, then id; calls in or behind a cycle come last,
    without level. Of several calls of one id in a conversation the first by position (then by
    arguments) holds, and so of several results. Calls without id are dropped, as nothing can
    name them. A null conversation is one of its own, results without a call are ignored.
    ``errors`` names arguments that are not JSON, hold a number beyond a double or nest deeper than
    ``DEEPEST`` (the message then holds their text), or break the schema of that name, missing
    dependencies and results, and cycles.
    """
    in_order = F.struct("position", "arguments", "name", F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"))
    # Ids become text inside, so that a null one has a name no number has.
    conversation = F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("conv_id")
    unique = calls.where("call_id is not null").groupBy(conversation, "call_id")
    calls = written(unique.agg(F.min(in_order).alias("c")).select("conv_id", "call_id", "c.*"), "chat-calls")
    first = results.groupBy(conversation, "call_id").agg(
        F.min(F.struct("position", "content")).alias("r"), F.count("*").alias("n_results")
    )
    linked = calls.join(first.hint("shuffle_hash"), ["conv_id", "call_id"], "left").join(
        topological_levels(calls), ["conv_id", "call_id"]
    )
    wanted = calls.select("conv_id", "call_id", F.explode(F.array_distinct("depends_on")).alias("parent"))
    there = calls.select("conv_id", F.col("call_id").alias("parent"))
    missing = wanted.join(there, ["conv_id", "parent"], "left_anti").groupBy("conv_id", "call_id").agg(
        F.array_sort(F.collect_list("parent")).alias("missing")
    )
    rows = linked.join(missing, ["conv_id", "call_id"], "left").select(
        "conv_id", "call_id", "name", "arguments", "depends_on", "position", "level", "missing",
        F.col("r.content").alias("content"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
    )
    ordered = numbered(rows, "conv_id", [F.col("level").asc_nulls_last(), "position", "call_id"])
    plain = ordered.withColumn("conv_id", F.col("conv_id").try_cast("bigint"))
    return plain.mapInArrow(_messages(schemas), FORMATTED)


#: What the tool of the conversations' calls accepts.
ANSWER_SCHEMA = {
    "type": "object",
    "required": ["prompt", "turn", "words"],
    "additionalProperties": False,
    "properties": {
        "prompt": {"type": "string", "minLength": 1, "maxLength": 2000},
        "turn": {"type": "integer", "minimum": 0},
        "words": {"type": "integer", "minimum": 1, "maximum": 60},
    },
}


def calls_of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) read from plain chat turns: a user turn calls ``answer`` and the
    assistant's next turn is its result.

    The k-th turn of a conversation (k even or odd throughout) depends on the one whose number,
    halved, lacks k/2's lowest bit. Positions are scattered, as of calls logged out of order.
    """
    call_id = lambda turn: F.concat_ws("-", F.lit("call"), F.col("conv_id"), turn)
    half = F.floor(F.col("turn") / 2).cast("bigint")
    before = 2 * half.bitwiseAND(half - 1) + F.col("turn") % 2
    arguments = F.to_json(
        F.struct(
            F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).alias("words"), "turn", F.col("text").alias("prompt")
        )
    )
    calls = turns.where("role = 'user'").select(
        "conv_id",
        call_id(F.col("turn")).alias("call_id"),
        F.lit("answer").alias("name"),
        arguments.alias("arguments"),
        F.when(half > 0, F.array(call_id(before))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
        ((F.col("turn") * 7919 + F.col("conv_id") * 31) % 1009).alias("position"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"), F.col("turn").alias("position")
    )
    return calls, results
