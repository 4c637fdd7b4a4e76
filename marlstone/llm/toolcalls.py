"""Linking of tool calls and their results in conversations.

Calls and results are joined by (conversation, call id). Calls are put in an order in which each follows those it
depends on. A call's place is a pair (turn, level), its own turn and 0 unless it needs a call that is not before
that: then the greatest place of those it needs, one level on. Only calls that are moved so, and those that need
them, are looked at, round by round, until none is left; a level beyond the number of the conversation's calls that
were moved is a cycle. There are about as many rounds as calls in the longest chain of moved ones. Conversations whose
calls need earlier turns alone, however long, take no round.
Arguments are checked against the tools' schemas, and each call is serialised as canonical JSON: keys sorted, no
white space, the same bytes for the same content.

All of it is DataFrame work. A conversation's rows are never gathered: positions are counted in slices of turns.

Defined results: calls with a null conversation or id are left out; calls that share conversation and id count
once (the first by turn, name and arguments) with their number in repeats, as do results; dependencies on calls
that do not exist are errors and do not order; results without a call are not returned; a call without a result
has result null; empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import LONG_MAX, LONG_MIN, save

#: JSON types by the start of a variant's schema.
_KINDS = {
    "string": r"^STRING$", "integer": r"^BIGINT$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": r"^BOOLEAN$",
    "array": r"^ARRAY<.*", "object": r"^OBJECT<.*", "null": r"^VOID$",
}
#: Turns whose calls one task ranks.
SLICE_TURNS = 1024

Schemas = dict[str, dict[str, tuple[str, bool]]]


def json_text(c: Column) -> Column:
    """A string as JSON."""
    inside = F.to_json(F.array(c))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.substring(inside, F.lit(2), F.length(inside) - 2))


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, sorted: array<string>. schemas: {tool: {parameter: (JSON type,
    required)}}; parameters that are not listed are errors."""
    v = F.try_parse_json(arguments)
    is_object = F.schema_of_variant(v).rlike(r"^OBJECT<")
    found = [
        F.when(name.isNull() | ~name.isin(*schemas), F.lit("unknown tool")),
        F.when(v.isNull(), F.lit("not JSON")).when(~is_object, F.lit("not an object")),
    ]
    for tool, parameters in schemas.items():
        mine = (name == tool) & is_object
        for p, (kind, required) in parameters.items():
            value = F.try_variant_get(v, f"$['{p}']", "variant")
            found.append(F.when(mine & value.isNull() & F.lit(required), F.lit(f"missing {p}")))
            found.append(F.when(mine & value.isNotNull() & ~F.schema_of_variant(value).rlike(_KINDS[kind]), F.lit(f"{p} is not {kind}")))
        extra = F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(p) for p in parameters]).cast("array<string>"))
        found.append(F.when(mine & (F.size(extra) > 0), F.concat(F.lit("unexpected "), F.array_join(F.array_sort(extra), ", "))))
    return F.array_sort(F.array_compact(F.array(*found)))


def canonical(arguments: Column) -> Column:
    """The same JSON with sorted keys and no white space; a string where it is not JSON."""
    return F.coalesce(F.to_json(F.try_parse_json(arguments)), json_text(arguments))


def moved(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """edges: conv_id, call_id, turn, needs, their_turn. The calls that do not stay in their turns: conv_id, call_id,
    place (turn, level); the turn is LONG_MAX on cycles and what follows them. An error is raised if max_rounds, where
    it is given, do not settle all."""
    key, own = ["conv_id", "call_id"], F.struct(F.col("turn").alias("at"), F.lit(0).alias("level"))
    place = lambda at, level: F.struct(at.alias("at"), level.cast("int").alias("level"))
    endless = place(F.lit(LONG_MAX), F.lit(0))

    def best(found: DataFrame, done: DataFrame) -> DataFrame:
        # Without a cycle a level counts moved calls, which differ, and all but the last of them are in done.
        top, sizes = found.groupBy(*key).agg(F.max("k").alias("k")), done.groupBy("conv_id").agg(F.count("*").alias("calls"))
        return top.join(sizes, "conv_id").select(*key, F.when(F.col("k.level") > F.col("calls") + 1, endless).otherwise(F.col("k")).alias("k"))

    found = edges.where("their_turn >= turn").withColumn("k", place(F.col("their_turn"), F.lit(1))).groupBy(*key).agg(F.max("k").alias("k"))
    done = None
    for rounds in count():
        if done is not None:
            old = done.select(*key, F.col("place").alias("old"))
            found = found.join(old, key, "left").where(F.col("old").isNull() | (F.col("k") > F.col("old"))).drop("old")
        changed = save(found.select(*key, F.col("k").alias("place")), "moved")
        if changed.isEmpty():
            break
        if rounds == max_rounds:
            raise RuntimeError(f"calls are left unordered after {max_rounds} rounds")
        done = changed if done is None else save(done.join(changed, key, "left_anti").unionByName(changed), "moved-all")
        theirs = changed.select("conv_id", F.col("call_id").alias("needs"), F.col("place").alias("p"))
        after = F.when(F.col("p.at") == LONG_MAX, endless).otherwise(place(F.col("p.at"), F.col("p.level") + 1))
        found = best(edges.join(theirs, ["conv_id", "needs"]).withColumn("k", after).where(F.col("k") > own), done)
    return changed if done is None else done


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """calls: conv_id, call_id, turn, name, arguments (JSON), needs (array of call ids). results: conv_id,
    call_id, turn, content. One row per call: conv_id, call_id, turn, name, position (from 0), level, errors,
    repeats, result_turn, canonical."""
    key = ["conv_id", "call_id"]
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = lambda *cs: F.min(F.struct(*cs)).alias("first")
    # Each text occurs once here: the least row of an id is a struct, combined before the shuffle.
    one = calls.where(known).groupBy(*key).agg(first("turn", "name", "arguments", F.coalesce("needs", F.array().cast("array<string>")).alias("needs")), F.count("*").alias("repeats"))
    one = one.select(*key, "first.*", "repeats").withColumn("turn", F.coalesce("turn", F.lit(LONG_MIN)))  # before all others
    one = save(one, "calls")
    answer = results.where(known).groupBy(*key).agg(first("turn", "content"))
    answer = answer.select(*key, F.col("first.turn").alias("result_turn"), F.col("first.content").alias("content"))
    needs = one.select("conv_id", "call_id", "turn", F.explode(F.array_distinct("needs")).alias("needs"))
    there = one.select("conv_id", F.col("call_id").alias("needs"), F.col("turn").alias("their_turn"))
    edges = save(needs.join(there, ["conv_id", "needs"], "left"), "needs")
    missing = edges.where("their_turn is null").groupBy(*key).agg(F.array_sort(F.collect_set(F.concat(F.lit("no call "), "needs"))).alias("missing"))
    edges = edges.where("their_turn is not null")
    # Conversations that need a call of a later turn, or of the same, which the turns do not order.
    back = save(edges.where("their_turn >= turn").select("conv_id").distinct(), "tangled")
    out = one.join(answer, key, "left").join(missing, key, "left").join(moved(save(edges.join(back, "conv_id", "left_semi"), "needs-tangled")), key, "left")
    out = out.withColumns({
        "at": F.coalesce("place.at", "turn"),
        "level": F.when(F.col("place.at") == LONG_MAX, F.lit(None)).otherwise(F.coalesce("place.level", F.lit(0))).cast("int"),
    })
    cyclic = F.col("level").isNull()
    errors = F.concat(
        argument_errors(F.col("name"), F.col("arguments"), schemas),
        F.coalesce("missing", F.array().cast("array<string>")),
        F.when(cyclic, F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>")),
    )
    text = F.concat(
        F.lit('{"arguments":'), F.coalesce(canonical(F.col("arguments")), F.lit("null")), F.lit(',"id":'), json_text(F.col("call_id")),
        F.lit(',"name":'), json_text(F.col("name")), F.lit(',"result":'), json_text(F.col("content")), F.lit("}"),
    )
    out = out.withColumns({"errors": errors, "canonical": text, "slice": F.floor(F.col("at") / SLICE_TURNS), "turn": F.nullif("turn", F.lit(LONG_MIN))})
    out = save(out.select(*key, "turn", "name", "at", "level", "errors", "repeats", "result_turn", "canonical", "slice"), "linked")
    by = ["conv_id", "slice"]
    counts = out.groupBy(*by).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*by, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("at", F.col("level").asc_nulls_last(), "turn", "call_id")) - 1
    placed = out.withColumn("place", place).join(counts, by)
    return placed.select(*key, "turn", "name", (F.col("place") + F.col("before")).cast("long").alias("position"), "level", "errors", "repeats", "result_turn", "canonical")
