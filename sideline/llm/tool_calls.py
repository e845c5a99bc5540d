"""Tool-call linking for chat records: calls, their results, their order and their schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.operators.ranking import number_rows

#: names of schema types to the types that a JSON value can have
TYPES = {
    "integer": ("BIGINT", "INT", "SMALLINT", "TINYINT"), "string": ("STRING",), "boolean": ("BOOLEAN",),
    "null": ("VOID",),
}


def _is_type(kind: Column, value: Column) -> Column:
    """Whether a JSON value (as a variant) has a schema type; an unknown type fits nothing."""
    found = F.schema_of_variant(value)
    number = found.isin(*TYPES["integer"]) | found.startswith("DECIMAL") | found.isin("DOUBLE", "FLOAT")
    known = F.lit(False)
    for name, kinds in TYPES.items():
        known = F.when(kind == name, found.isin(*kinds)).otherwise(known)
    known = F.when(kind == "number", number).otherwise(known)
    known = F.when(kind == "object", found.startswith("OBJECT")).otherwise(known)
    return F.when(kind == "array", found.startswith("ARRAY")).otherwise(known)


def _parsed(text: Column) -> Column:
    """The JSON value of a text as a variant; null for what is not exactly one JSON value.

    The parser passes over what follows a value, so the text is parsed inside an array and inside an
    object: what follows cannot end both.
    """
    array, field = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when(array.isNotNull() & field.isNotNull(), F.try_variant_get(array, "$[0]", "variant"))


def levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(id, level): 0 for a call that needs no other, else one more than the highest it needs.

    ``needs`` has (id, needed). Rounds over the calls that are still waiting: a need is met when its
    call has a level, and a call without open needs gets the round's number. The number of rounds is
    the depth of the graph, and each reads only what still waits. Calls in or behind a cycle get
    null. Needs of calls that do not exist are left out.
    """
    ids = calls.select("id").distinct()
    real = needs.join(ids, "id", "left_semi").join(ids.withColumnRenamed("id", "needed"), "needed", "left_semi").select("id", "needed").distinct()
    waiting = written(real, "needs")
    done = written(ids.join(waiting.select("id").distinct(), "id", "left_anti").withColumn("level", F.lit(0)), "levels")
    out, level, left = done, 0, waiting.count()
    while left:
        level += 1
        still = written(waiting.join(done.select(F.col("id").alias("needed")), "needed", "left_anti"), "needs")
        ready = waiting.select("id").distinct().join(still.select("id").distinct(), "id", "left_anti")
        done = written(ready.withColumn("level", F.lit(level)), "levels")
        out = out.unionByName(done)
        now = still.count()
        if now == left:
            break
        waiting, left = still, now
    return ids.join(out, "id", "left")


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call identifier, and one per result without a call, as a canonical JSON record.

    ``calls``: conv, id, name, arguments (JSON text), needs (array of ids). ``results``: id,
    content. ``schemas``: name, field, type (integer, number, string, boolean, null, object, array),
    required; a tool is known if it has a row, and a row without a field declares one without
    arguments.

    - Calls and results meet in a full outer hash join on the identifier. Of calls or results that
      repeat an identifier the smallest record counts; ``repeats`` is the number of further ones.
      Without an identifier nothing can be linked: each such call is a row of its own, status no_id,
      and each such result one of status no_call.
    - status: linked, no_result, no_call, no_id.
    - level: topological order by ``needs``; rows of a cycle have none. position: from 1 inside the
      conversation by (level, id), rows without level last. Positions come from a range-split sort,
      so one conversation may hold any share of the rows.
    - problems: sorted texts; malformed arguments (no JSON object), unknown tool, field missing,
      wrong type, field not in the schema, cycle.
    - json: keys in code-point order, no white space, at every depth of the arguments; malformed
      arguments are null there. Arguments are compared as JSON values: key order and white space of
      the input do not matter.

    Everything is built-in columns. Other columns are not read; empty inputs give the rows of the
    others.
    """
    record = F.struct("conv", "name", "arguments", F.array_sort(F.array_distinct(F.coalesce("needs", F.array().cast("array<string>")))).alias("needs"))
    known = calls.filter("id IS NOT NULL").groupBy("id").agg(F.min(record).alias("r"), F.count(F.lit(1)).alias("n"))
    known = known.select("id", "r.*", (F.col("n") - 1).alias("repeats"), F.lit(True).alias("called"))
    nameless = calls.filter("id IS NULL").select(
        F.lit(None).cast("string").alias("id"), record.alias("r")).select("id", "r.*", F.lit(0).cast("long").alias("repeats"), F.lit(True).alias("called"))
    answers = results.filter("id IS NOT NULL").groupBy("id").agg(
        F.min("content").alias("content"), (F.count(F.lit(1)) - 1).alias("more"), F.lit(True).alias("answered"))
    unasked = results.filter("id IS NULL").select(F.lit(None).cast("string").alias("id"), "content", F.lit(0).cast("long").alias("more"), F.lit(True).alias("answered"))
    both = known.join(answers, "id", "full").unionByName(nameless, allowMissingColumns=True).unionByName(unasked, allowMissingColumns=True)
    value = _parsed(F.col("arguments"))
    both = both.withColumn("value", F.when(F.schema_of_variant(value).startswith("OBJECT"), value))

    order = levels(known, known.select("id", F.explode("needs").alias("needed")))
    both = both.join(order, "id", "left")
    tools = schemas.groupBy("name").agg(F.sort_array(F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", "type", "required")))).alias("fields"))
    both = both.join(tools, "name", "left")
    args = F.col("value").cast("map<string,variant>")
    checked = F.transform("fields", lambda f: F.when(
        F.map_contains_key("args", f.field),
        F.when(~_is_type(f.type, F.element_at("args", f.field)), F.concat(F.lit("wrong type: "), f.field)),
    ).when(f.required, F.concat(F.lit("missing: "), f.field)))
    extra = F.transform(
        F.array_except(F.map_keys("args"), F.transform("fields", lambda f: f.field)), lambda k: F.concat(F.lit("not in schema: "), k))
    none = F.array().cast("array<string>")
    called = F.coalesce("called", F.lit(False))
    texts = F.array(
        F.when(called & F.col("value").isNull(), "malformed arguments"),
        F.when(called & F.col("fields").isNull(), "unknown tool"),
        F.when(called & F.col("id").isNotNull() & F.col("level").isNull(), "cycle"),
    )
    judged = both.withColumn("args", args).withColumn("problems", F.array_sort(F.array_compact(F.concat(
        texts, F.when(args.isNotNull(), F.coalesce(checked, none)).otherwise(none), F.coalesce(extra, none)))))
    status = F.when(~called, "no_call").when(F.col("id").isNull(), "no_id").when(F.col("answered"), "linked").otherwise("no_result")
    judged = judged.withColumn("status", status).withColumn("repeats", F.coalesce("repeats", F.lit(0)) + F.coalesce("more", F.lit(0)))
    json = F.to_json(F.struct(
        F.col("value").alias("arguments"), F.col("content"), F.col("conv"), F.col("id"), F.col("level"), F.col("name"),
        F.coalesce("needs", none).alias("needs"), F.col("problems"), F.col("status")), {"ignoreNullFields": "false"})
    shown = judged.select("conv", "id", "name", "status", "level", "repeats", "problems", json.alias("json"))
    # rows without a conversation are numbered too
    keyed = shown.withColumns({"_none": F.col("conv").isNull(), "_conv": F.coalesce("conv", F.lit(""))})
    order = [F.col("level").asc_nulls_last(), F.col("id").asc_nulls_last(), F.col("json").asc()]
    placed = number_rows(keyed, order, by=["_none", "_conv"])
    return placed.withColumnRenamed("rank", "position").drop("_none", "_conv")


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from chat turns (conv_id, turn, role, text).

    A user turn is a call: its tool is chosen by the length of its text, its arguments describe the
    text, and it needs the call at about half its turn number. The assistant turn after it is its
    result. Turns of no conversation and turns without a number have no identifier.
    """
    t = turns.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    name = lambda n: F.concat("conv", F.lit("-"), F.when(n.isNotNull(), n.cast("string")))
    size = F.length("text")
    arguments = F.to_json(F.struct(
        F.col("turn").alias("turn"), F.md5("text").alias("query"),
        F.when(size % 7 == 0, F.lit(None)).otherwise(size).alias("limit"), F.when(size % 11 == 0, F.lit(True)).alias("exact")))
    arguments = F.when(size % 13 == 0, F.concat(arguments, F.lit("}"))).otherwise(arguments)
    odd = F.col("turn") % 2
    earlier = odd + 2 * F.floor((F.col("turn") - odd) / 4)
    calls = t.filter("role = 'user'").select(
        "conv", name(F.col("turn")).alias("id"), F.element_at(F.array(F.lit("search"), F.lit("fetch"), F.lit("sum")), (size % 3 + 1).cast("int")).alias("name"),
        arguments.alias("arguments"), F.when(earlier < F.col("turn"), F.array(name(earlier))).alias("needs"))
    results = t.filter("role = 'assistant'").select(name(F.col("turn") - 1).alias("id"), F.md5("text").alias("content"))
    return calls, results
