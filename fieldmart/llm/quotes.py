"""Chat formatting by quotation linking, with DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldmart.llm.common import kept

# lines of a message as (level, text): level counts the marks of the form "> > " that open the line
_LINES = r"""transform(split(text, '\\r?\\n'), x -> struct(
    length(regexp_replace(regexp_extract(x, '^((?:[ \\t]*>)*)', 1), '[^>]', '')) as level,
    regexp_replace(x, '^(?:[ \\t]*>)+ ?', '') as line))"""
# runs of lines of one level above 0, joined by a space: places where the level changes, and the lines up to the next one
_STARTS = "filter(sequence(0, size(lines) - 1), i -> i = 0 or lines[i].level <> lines[i - 1].level)"
_PASSAGES = """filter(transform(starts, (at, i) -> struct(lines[at].level as level,
    array_join(transform(slice(lines, at + 1, coalesce(try_element_at(starts, i + 2), size(lines)) - at), x -> x.line), ' ') as line)), p -> p.level > 0)"""
BLOCK = 1024
"""Turns of one conversation that are put in order together."""


def normalised(column: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(column), r"\s+", " "))


def _key(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def parsed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text_key (of the whole text), body (without quoted lines), keys (of its own lines and of the whole body), quotes (level, key), quoting (level-1 keys)."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lined = rows.withColumn("lines", F.expr(_LINES))
    own = F.filter("lines", lambda x: x["level"] == 0)
    body = F.trim(F.regexp_replace(F.array_join(F.transform(own, lambda x: x["line"]), "\n"), r"\n{3,}", "\n\n"))
    found = lined.withColumn("body", body).withColumn("starts", F.expr(_STARTS)).withColumn("passages", F.when(F.exists("lines", lambda x: x["level"] > 0), F.expr(_PASSAGES)).otherwise(F.expr("cast(array() as array<struct<level:int,line:string>>)")))
    solid = lambda x: normalised(x) != ""
    keys = F.array_distinct(F.concat(F.transform(F.filter(own, lambda x: solid(x["line"])), lambda x: _key(x["line"])), F.when(solid(F.col("body")), F.array(_key(F.col("body")))).otherwise(F.expr("cast(array() as array<string>)"))))
    quoted = F.filter("passages", lambda p: solid(p["line"]))
    lines = F.filter("lines", lambda x: (x["level"] > 0) & solid(x["line"]))
    quotes = F.array_distinct(F.transform(F.concat(quoted, lines), lambda p: F.struct(p["level"].alias("level"), _key(p["line"]).alias("key"))))
    return found.select("conv_id", "turn", "role", F.sha2("text", 256).alias("text_key"), "body", keys.alias("keys"), quotes.alias("quotes"), F.size(quoted).cast("long").alias("n_quotes"))


def _before(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, before): the turn of the message before each one in its conversation; first ones are left out.

    Turns are put in order within blocks, and the blocks, of which there is one row each, within the conversation: one
    conversation of any length isn't one group.
    """
    turns = rows.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct().withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = turns.withColumn("before", F.lag("turn").over(W.partitionBy("conv_id", "block").orderBy("turn")))
    ends = turns.groupBy("conv_id", "block").agg(F.max("turn").alias("last"))
    ends = ends.select("conv_id", "block", F.lag("last").over(W.partitionBy("conv_id").orderBy("block")).alias("earlier"))
    return inside.join(ends, ["conv_id", "block"]).select("conv_id", "turn", F.coalesce("before", "earlier").alias("before")).where("before is not null")


def chat(turns: DataFrame) -> DataFrame:
    """One row per message, in reply order: conv_id, turn, role, reply_to, n_quotes, n_linked, body, formatted.

    A passage is a run of lines of one quote level; it and each of its lines are hashed after normalising case and white
    space, and joined to the earliest message of the conversation that has the same own line or the same whole body. A
    message answers the latest such original of its outermost quotes (turns before its own); without one, the message
    before it in the conversation (null for the first). Sorting by (conv_id, reply_to, turn) puts every answer after what
    it answers and keeps answers to one message together; it is dealt by ranges, so that a conversation of any length is
    split.

    Nulls in conv_id or turn: the message is kept, linked with nothing, and answers nothing. Null texts are empty. Repeated
    rows stay. A message of any length is parsed once, in time linear in its lines; the parsed messages are written.
    Originals are reduced to one row for each hash before the join, so that a line that all messages share costs one row.
    """
    rows = kept(parsed(turns), "messages")
    originals = rows.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode("keys").alias("key")).groupBy("conv_id", "key").agg(F.min("turn").alias("said"))
    asked = rows.where("size(quotes) > 0").select("conv_id", "turn", "text_key", F.inline("quotes")).distinct()
    linked = asked.join(originals, ["conv_id", "key"]).where("said < turn")
    answers = linked.groupBy("conv_id", "turn", "text_key").agg(F.max_by("said", F.struct(-F.col("level"), "said")).alias("answers"), F.countDistinct("key").alias("n_linked"))
    joined = rows.join(answers, ["conv_id", "turn", "text_key"], "left").join(_before(rows), ["conv_id", "turn"], "left")
    formatted = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("body"), F.lit("\n"))
    every = joined.select("conv_id", "turn", "role", F.coalesce("answers", "before").alias("reply_to"), "n_quotes", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "body", formatted.alias("formatted"))
    return every.orderBy("conv_id", F.col("reply_to").asc_nulls_first(), "turn", "role", "body")
