"""Tool calls of conversations: linked to results, ordered by what they wait for, checked and written as canonical JSON.

Canonical JSON has sorted keys, no white space and one form for each number. Spark's variant type
keeps objects that way, so nested arguments need no code of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockpond.operators.ordering import global_row_number
from stockpond.session import materialize

# Variant types that each schema type accepts.
ACCEPTS = {"integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "string": "STRING", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}


def _key(conversation: Column, call: Column) -> Column:
    """Key of a call; null ids are values like any other."""
    return F.md5(F.to_json(F.struct(conversation.cast("string").alias("a"), call.cast("string").alias("b"))))


def levels(calls: DataFrame, waits: DataFrame) -> DataFrame:
    """``key``, ``level`` of ``calls``: 0 if it waits for none, else one more than the highest it waits for.

    ``waits`` (``key``, ``for``) may name calls that do not exist; those are not waited for. Calls on
    a cycle, or behind one, have no row. One round for each level.
    """
    known = calls.select("key")
    left = materialize(waits.distinct().join(known, "key", "left_semi").join(known.withColumnRenamed("key", "for"), "for", "left_semi"), "waits")
    done = materialize(known.join(left, "key", "left_anti").withColumn("level", F.lit(0)), "level")
    out, level = done, 0
    while not left.isEmpty():
        level += 1
        still = materialize(left.join(done.select(F.col("key").alias("for")), "for", "left_anti"), "waits")
        done = materialize(left.select("key").distinct().join(still, "key", "left_anti").withColumn("level", F.lit(level)), "level")
        if done.isEmpty():
            break
        out, left = out.unionByName(done), still
    return out


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``key``, ``errors`` (sorted) of the calls whose arguments break the schema of their tool."""
    parsed = calls.select("key", "name", F.try_parse_json("arguments").alias("value"), "arguments")
    shape = F.schema_of_variant("value")
    whole = parsed.where(F.coalesce(~shape.startswith("OBJECT"), F.lit(True))).select("key", F.lit("arguments are not an object").alias("error"))
    good = parsed.where(shape.startswith("OBJECT"))
    given = good.select("key", "name", F.explode_outer(F.from_json("arguments", "map<string,variant>")).alias("param", "value")).where("param IS NOT NULL")
    given = materialize(given.select("key", "name", "param", F.schema_of_variant("value").alias("type")), "given-arguments")
    tools = schemas.select("name").distinct()
    unknown_tool = calls.join(tools, "name", "left_anti").select("key", F.lit("unknown tool").alias("error"))
    accepted = F.lit(None).cast("string")
    for kind, types in ACCEPTS.items():
        accepted = F.when(F.col("kind") == kind, F.lit(f"^({types})$")).otherwise(accepted)
    wanted = schemas.select("name", "param", F.col("type").alias("kind"))
    checked = given.join(tools, "name", "left_semi").join(wanted, ["name", "param"], "left")
    error = F.when(F.col("kind").isNull(), F.concat(F.lit("unknown argument "), "param")).when(
        ~F.call_function("rlike", F.col("type"), accepted), F.concat(F.lit("argument "), "param", F.lit(" is no "), "kind")
    )
    wrong = checked.select("key", error.alias("error")).where("error IS NOT NULL")
    needed = good.select("key", "name").join(schemas.where("required").select("name", "param"), "name")
    missing = needed.join(given.select("key", "param"), ["key", "param"], "left_anti").select("key", F.concat(F.lit("missing argument "), "param").alias("error"))
    errors = whole.unionByName(unknown_tool).unionByName(wrong).unionByName(missing)
    return errors.groupBy("key").agg(F.array_sort(F.collect_set("error")).alias("errors"))


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call: ``conv_id``, ``call_id``, ``name``, ``position``, ``level``, ``valid``, ``errors``, ``n_calls``, ``n_results``, ``record``.

    ``calls``: ``conv_id``, ``call_id``, ``name``, ``arguments`` (JSON text), ``after`` (array of call ids
    of the conversation). ``results``: ``conv_id``, ``call_id``, ``content``. ``schemas``: ``name``, ``param``,
    ``type``, ``required``. Other columns are ignored.

    ``position`` counts from 0 in each conversation, a call after all it waits for; calls on a cycle
    come last and have no level. Repeated calls with one id are one, with the smallest name and
    arguments, and ``n_calls`` tells how many there were; so it is with results. A call without a result has a null
    one, a result without a call is left out. ``record`` is the canonical JSON of call and result;
    arguments that are no JSON stay the text they are.
    """
    key = _key(F.col("conv_id"), F.col("call_id"))
    # What a call waits for is bounded by its own list, so lists are taken apart before rows of one id meet.
    waits = calls.select("conv_id", key.alias("key"), F.explode_outer("after").alias("other")).where("other IS NOT NULL")
    waits = materialize(waits.select("key", _key(F.col("conv_id"), F.col("other")).alias("for")), "waits")
    one = calls.groupBy(key.alias("key"), "conv_id", "call_id").agg(F.count("*").alias("n_calls"), F.min(F.struct("name", "arguments")).alias("first"))
    one = materialize(one.select("key", "conv_id", "call_id", "n_calls", "first.name", "first.arguments"), "calls")
    answers = results.groupBy(key.alias("key")).agg(F.count("*").alias("n_results"), F.min("content").alias("content"))
    answers = materialize(answers, "results")
    order = materialize(levels(one, waits), "levels")
    errors = materialize(argument_errors(one, schemas), "argument-errors")
    joined = one.join(answers, "key", "left").join(order, "key", "left").join(errors, "key", "left")
    cycle = F.when(F.col("level").isNull(), F.array(F.lit("waits for itself"))).otherwise(F.array().cast("array<string>"))
    found = F.concat(F.coalesce("errors", F.array().cast("array<string>")), cycle)
    value = F.try_parse_json("arguments")
    fields = F.struct(F.col("call_id"), F.col("conv_id"), F.col("name"), F.col("content").alias("result"))
    without = F.to_json(fields, {"ignoreNullFields": "false"})
    written = F.coalesce(F.to_json(value), F.get(F.split(F.to_json(F.struct(F.col("arguments").alias("a")), {"ignoreNullFields": "false"}), '^\\{"a":|\\}$'), F.lit(1)))
    record = F.concat(F.lit('{"arguments":'), written, F.lit(","), F.substring(without, F.lit(2), F.length(without)))
    rows = joined.select("conv_id", "call_id", "name", "level", (F.size(found) == 0).alias("valid"), found.alias("errors"), "n_calls", F.coalesce("n_results", F.lit(0)).alias("n_results"), record.alias("record"))
    placed = global_row_number(rows, [F.col("conv_id").asc_nulls_first(), F.col("level").asc_nulls_last(), F.col("call_id").asc_nulls_first()], "place")
    placed = materialize(placed, "ordered-calls")
    first = materialize(placed.groupBy("conv_id").agg(F.min("place").alias("first")).withColumnRenamed("conv_id", "_conv"), "first-calls")
    return placed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "call_id", "name", (F.col("place") - F.col("first")).alias("position"), "level", "valid", "errors", "n_calls", "n_results", "record"
    )
