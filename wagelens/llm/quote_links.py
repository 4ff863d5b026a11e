"""Quotation linking (operator 7): quoted passages joined to the messages they come from, DataFrame functions only.

Parse: a line's quote level is the number of leading ``>`` marks; a passage is one quoted line, normalised (marks off,
white space collapsed, lower-cased) and hashed.  A line such as "... wrote:" right above a quote belongs to the quote.

Link: within a conversation, a quoted passage comes from the latest earlier turn that wrote the same line itself; a
window over (conversation, passage) in turn order finds it in one pass, so a passage that everyone quotes makes no
pairs.  What is not found there is looked up in all other conversations (first one in (conv_id, turn) order).

Build: a message answers the turn that most of its shallowest linked passages come from (the latest of equals), else
the turn before it (over gaps in the numbering), else it begins a thread.  Roots and depths come from pointer doubling, so a chain of n replies
takes log2(n) joins.  Parents are earlier turns: (conv_id, thread_root, turn) lists a conversation in reply order.

Defined results: one row per input row; rows that share (conv_id, turn) are one message with the passages of all of
them; null conv_id or turn links to nothing (no reply_to, depth 0); null text has no lines and an empty clean_text;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.shared import written

#: Turn numbers that share a window when the turn before a message is looked up.
TURN_RANGE = 1024
MARKS = "^((?:[ \\t]*>)+)"
# Endings of the line that introduces a quote.
INTRODUCES = "(?i)(wrote|schrieb|a écrit|escribió)[ \\t]*:[ \\t\\r]*$"


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 1)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def _body(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), "[\\x20\\x09-\\x0D]+", " ")))


def parsed(text: Column) -> Column:
    """Array of (level, body, raw) of a text's lines; introducing lines get level -1."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)

    def mark(all_lines: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            following = F.coalesce(F.get(all_lines, i + 1)["level"], F.lit(0))
            level = F.when((x["level"] == 0) & (following > 0) & x["raw"].rlike(INTRODUCES), -1).otherwise(x["level"])
            return F.struct(level.alias("level"), x["body"].alias("body"), x["raw"].alias("raw"))
        return F.transform(all_lines, one)

    each = F.transform(lines, lambda x: F.struct(_level(x).alias("level"), _body(x).alias("body"), x.alias("raw")))
    return F.transform(F.array(each), mark)[0]


def _passages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, passage hash: non-empty lines, once per message and level."""
    each = messages.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select("conv_id", "turn", F.explode("lines").alias("x"))
    kept = each.filter((F.col("x")["body"] != "") & (F.col("x")["level"] >= 0))
    return kept.select("conv_id", "turn", F.col("x")["level"].alias("level"), F.sha1(F.col("x")["body"].cast("binary")).alias("passage")).distinct()


def quote_sources(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, passage with from_conv, from_turn (null if no message wrote it)."""
    lines = written(_passages(messages), "passages")
    quotes, own = lines.filter("level > 0"), lines.filter("level = 0")
    near = own.join(quotes.select("conv_id").distinct(), "conv_id", "left_semi")
    # at one turn quotes sort before the message's own lines, so a message is never its own source
    both = (quotes.select("conv_id", "turn", "level", "passage", F.lit(None).cast("long").alias("wrote"))
            .unionByName(near.select("conv_id", "turn", "level", "passage", F.col("turn").cast("long").alias("wrote"))))
    order = Window.partitionBy("conv_id", "passage").orderBy("turn", F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("from_turn", F.last("wrote", ignorenulls=True).over(order)).filter("level > 0").drop("wrote")
    found = found.withColumn("from_conv", F.when(F.col("from_turn").isNotNull(), F.col("conv_id")))
    missing = found.filter("from_turn is null").select("passage").distinct()
    # the first turns of the two least conversations: one of them is not the quoting one
    wrote = (own.join(missing, "passage", "left_semi").groupBy("passage", "conv_id")
             .agg(F.struct("conv_id", F.min(F.col("turn").cast("long")).alias("turn")).alias("at")).select("passage", "at"))
    wrote = written(wrote, "elsewhere")
    first = wrote.groupBy("passage").agg(F.min("at").alias("first"))
    second = (wrote.join(first, "passage").filter(F.col("at")["conv_id"] != F.col("first")["conv_id"])
              .groupBy("passage").agg(F.min("at").alias("second")))
    elsewhere = written(first.join(second, "passage", "left"), "elsewhere")
    other = F.when(F.col("first")["conv_id"] != F.col("conv_id"), F.col("first")).otherwise(F.col("second"))
    return (found.join(elsewhere, "passage", "left")
            .withColumn("outside", F.when(F.col("from_turn").isNull(), other))
            .select("conv_id", "turn", "level", "passage",
                    F.coalesce("from_conv", F.col("outside")["conv_id"]).alias("from_conv"),
                    F.coalesce("from_turn", F.col("outside")["turn"]).alias("from_turn")))


def _previous(nodes: DataFrame) -> DataFrame:
    """conv_id, turn and the next smaller turn of the conversation, whatever the gaps in its numbering.

    A window holds the turns of one range of ``TURN_RANGE`` numbers, another one the ranges' last turns, so a conversation
    that holds a third of all messages is not one task's work.
    """
    ranged = nodes.withColumn("range", F.floor(F.col("turn") / TURN_RANGE))
    lasts = ranged.groupBy("conv_id", "range").agg(F.max("turn").alias("last"))
    lasts = lasts.select("conv_id", "range", F.lag("last").over(Window.partitionBy("conv_id").orderBy("range")).alias("earlier"))
    within = F.lag("turn").over(Window.partitionBy("conv_id", "range").orderBy("turn"))
    return (ranged.withColumn("within", within).join(lasts, ["conv_id", "range"])
            .select("conv_id", "turn", F.coalesce("within", "earlier").alias("previous")))


def reply_tree(messages: DataFrame, sources: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to, thread_root, depth of every distinct (conv_id, turn)."""
    nodes = messages.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select("conv_id", "turn").distinct()
    inside = sources.filter(F.col("from_conv") == F.col("conv_id")).groupBy("conv_id", "turn", "level", "from_turn").agg(F.count("*").alias("n"))
    best = inside.groupBy("conv_id", "turn").agg(F.max(F.struct((-F.col("level")).alias("level"), "n", "from_turn"))["from_turn"].alias("quoted"))
    before = _previous(nodes)
    now = (nodes.join(best, ["conv_id", "turn"], "left").join(before, ["conv_id", "turn"], "left")
           .select("conv_id", "turn", F.coalesce("quoted", "previous").cast("long").alias("reply_to"))
           .withColumn("up", F.col("reply_to")).withColumn("root", F.coalesce("reply_to", F.col("turn").cast("long")))
           .withColumn("depth", F.when(F.col("reply_to").isNull(), 0).otherwise(1).cast("long")))
    now = written(now, "replies")
    while not now.filter("up is not null").isEmpty():
        further = now.select("conv_id", F.col("turn").cast("long").alias("up"), F.col("up").alias("up2"), F.col("root").alias("root2"), F.col("depth").alias("depth2"))
        # only messages that have not reached their root take part in a further step
        moved = now.filter("up is not null").join(further, ["conv_id", "up"], "left").select(
            "conv_id", "turn", "reply_to", F.col("up2").alias("up"), F.coalesce("root2", "root").alias("root"),
            (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"))
        arrived = now.filter("up is null").select("conv_id", "turn", "reply_to", "up", "root", "depth")
        now = written(arrived.unionByName(moved), "replies")
    return now.select("conv_id", "turn", "reply_to", F.col("root").alias("thread_root"), "depth")


def link(messages: DataFrame) -> DataFrame:
    """Per row: conv_id, turn, role, reply_to, thread_root, depth, n_quoted, n_linked, deepest, sources, clean_text."""
    own = messages.select("conv_id", "turn", "role", parsed(F.col("text").cast("string")).alias("lines"))
    sources = written(quote_sources(own), "sources")
    tree = reply_tree(own, sources)
    found = sources.filter("from_turn is not null")
    quoted = sources.groupBy("conv_id", "turn").agg(
        F.count("*").alias("n_quoted"), F.count("from_turn").alias("n_linked"), F.max("level").alias("deepest"))
    origins = (found.groupBy("conv_id", "turn", "from_conv", "from_turn").agg(F.count("*").alias("n"))
               .groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("from_conv", "from_turn", "n"))).alias("sources")))
    by_message = written(tree.join(quoted, ["conv_id", "turn"], "left").join(origins, ["conv_id", "turn"], "left"), "messages")
    kept = F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["raw"])
    clean = F.regexp_replace(F.array_join(kept, "\n"), "^\\n+|\\n+$", "")
    return (own.join(by_message, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", "reply_to", "thread_root", F.coalesce("depth", F.lit(0)).alias("depth"),
                    F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
                    F.coalesce("deepest", F.lit(0)).alias("deepest"), "sources", clean.alias("clean_text")))
