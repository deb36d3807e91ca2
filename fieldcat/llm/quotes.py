"""Quotation linking, in DataFrame functions only: quoted passages are parsed by level, hashed
after normalisation, joined to the messages they were taken from, and left out of the
conversations, which are put in reply order.

A line's quote level is the number of ``>`` marks it begins with (blanks between them
allowed); a passage is a run of lines of one level. The outermost passages quote the message
replied to, deeper ones what that message quoted. A passage is normalised to its lower-cased
words and hashed, as a whole and by its paragraphs and its lines; a message offers its own
text (without quotes) as a whole, its runs between quotes, their paragraphs and its lines. A
unit (whole, paragraph or line) links to the latest earlier message of its conversation that
offers its hash, else to the earliest message of the least other conversation that does. A
passage links as a whole, else by its paragraphs, else by its lines: to the message of its
conversation that most of these units link to (the latest of several), else elsewhere. A
message replies to the target of its first outermost passage linked in the same conversation.

Reply order: a message follows the first message of its chain of replies (its thread); rows
sorted by (conv_id, thread, turn) give each conversation thread by thread. Chains are
followed by pointer doubling, so their length costs a logarithm of rounds.

Defined results: a null or empty text has no passages and an empty body. Passages without a
word link to nothing. Rows with equal conv_id and turn are one message to link to and stay
separate rows. Null conv_id or turn: the row stays, links to nothing, and nothing links to it.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcat.llm.support import stage

_MARKS = r"^[ \t]*(?:>[ \t]?)+"


def level_of(line: Column) -> Column:
    marks = F.regexp_extract(line, _MARKS, 0)
    return F.length(F.regexp_replace(marks, "[^>]", ""))


def digest(text: Column) -> Column:
    """The hash of a text's lower-cased words; null without words."""
    bare = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(bare != "", F.xxhash64(bare))


def parse(messages: DataFrame) -> DataFrame:
    """The rows with ``body`` (text without quotes), ``between``: its runs if quotes part them,
    and ``passages``: (level, text) runs."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.transform(F.split(text, "\r?\n", -1), lambda x: F.struct(level_of(x).alias("level"), F.regexp_replace(x, _MARKS, "").alias("line")))
    rows = messages.select("conv_id", "turn", "role", F.monotonically_increasing_id().alias("row"), text.alias("text"), lines.alias("lines"))
    body = F.btrim(F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"]), "\n"), F.lit(" \t\r\n"))
    rows = rows.select("*", body.alias("body"), F.expr("filter(sequence(0, size(lines) - 1), i -> not (lines[i].level <=> get(lines, i - 1).level))").alias("starts"))
    runs = F.expr("""transform(starts, (s, k) -> struct(lines[s].level as level, array_join(transform(
        slice(lines, s + 1, coalesce(get(starts, k + 1), size(lines)) - s), x -> x.line), '\n') as text))""")
    rows = rows.select("conv_id", "turn", "role", "row", "body", runs.alias("runs"))
    own = F.transform(F.filter("runs", lambda x: x["level"] == 0), lambda x: x["text"])
    return rows.select("conv_id", "turn", "role", "row", "body", F.when(F.size(own) > 1, own).otherwise(F.array().cast("array<string>")).alias("between"),
                       F.filter("runs", lambda x: x["level"] > 0).alias("passages"))


def paragraphs(text: Column) -> Column:
    return F.split(text, r"\n[ \t]*\n")


def units(text: Column) -> Column:
    """(kind, text) of a passage: itself (0), its paragraphs (1) and its lines (2)."""
    def of(kind: int, parts: Column) -> Column:
        return F.transform(parts, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("text")))
    return F.concat(of(0, F.array(text)), of(1, paragraphs(text)), of(2, F.split(text, "\n")))


def link(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, n_quotes, n_linked, reply_to, thread) of every row of
    ``messages`` (conv_id, turn, role, text)."""
    rows = stage(parse(messages), "messages")
    offers = rows.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode(F.array_distinct(F.concat(
        F.array("body"), paragraphs(F.col("body")), F.split("body", "\n"), "between", F.flatten(F.transform("between", paragraphs))))).alias("part"))
    passages = rows.select("row", "conv_id", "turn", F.posexplode("passages").alias("place", "p")).select(
        "row", "conv_id", "turn", "place", F.col("p.level").alias("level"), F.explode(units(F.col("p.text"))).alias("unit"))
    quoted = passages.withColumn("hash", digest(F.col("unit.text"))).where("hash is not null").groupBy(
        "row", "conv_id", "turn", "place", "level", "hash").agg(F.min("unit.kind").alias("kind"))
    quoted = stage(quoted, "quoted")
    wanted = quoted.select("hash").distinct()
    offers = stage(offers.select("conv_id", "turn", digest(F.col("part")).alias("hash")).join(wanted, "hash", "left_semi").distinct(), "offers")
    # the latest earlier offer of the conversation: a running last value, never a pair of all
    both = quoted.select("conv_id", "hash", "turn", F.lit(0).alias("after"), F.lit(None).cast("long").alias("offer"), "row", "place").unionAll(
        offers.select("conv_id", "hash", "turn", F.lit(1), F.col("turn").cast("long"), F.lit(None).cast("long"), F.lit(None).cast("int")))
    so_far = Window.partitionBy("conv_id", "hash").orderBy("turn", "after").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = both.withColumn("from", F.last("offer", ignorenulls=True).over(so_far)).where("row is not null and `from` is not null").select("row", "place", "hash", "from")
    # the least and the second conversation of each hash, so that another one is always known
    least = Window.partitionBy("hash").orderBy("conv_id")
    first = offers.groupBy("hash", "conv_id").agg(F.min("turn").alias("turn")).withColumn("rank", F.row_number().over(least)).where("rank <= 2")
    first = first.groupBy("hash").agg(F.min("conv_id").alias("one"), F.max("conv_id").alias("two"))
    linked = quoted.join(own, ["row", "place", "hash"], "left").join(first, "hash", "left")
    linked = linked.where("`from` is not null or one <> conv_id or two <> conv_id")
    votes = linked.groupBy("row", "place", "level", "kind", "from").agg(F.count("*").alias("votes"))
    passage = votes.groupBy("row", "place").agg(F.min(F.struct(
        "kind", F.col("from").isNull().alias("elsewhere"), (-F.col("votes")).alias("votes"), (-F.col("from")).alias("back"), "level")).alias("to"))
    summary = passage.groupBy("row").agg(
        F.count("*").alias("n_linked"),
        F.min(F.when(~F.col("to.elsewhere"), F.struct("to.level", "place", (-F.col("to.back")).alias("turn")))).alias("best"))
    rows = rows.join(summary, "row", "left").select(
        "conv_id", "turn", "role", "body", F.size("passages").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.col("best.turn").alias("reply_to"))
    return threads(rows)


def threads(rows: DataFrame) -> DataFrame:
    """``rows`` with ``thread``, the turn at which each message's chain of replies begins."""
    rows = stage(rows, "replies")
    jump = stage(rows.where("reply_to is not null").groupBy("conv_id", "turn").agg(F.min("reply_to").alias("up")), "jump")
    while jump.join(jump.select(F.col("conv_id").alias("c"), F.col("turn").alias("t")), F.expr("conv_id = c and up = t"), "left_semi").limit(1).count():
        higher = jump.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("up").alias("upper"))
        jump = stage(jump.join(higher, F.expr("conv_id = c and up = t"), "left").select("conv_id", "turn", F.coalesce("upper", "up").alias("up")), "jump")
    return rows.join(jump, ["conv_id", "turn"], "left").select(
        *rows.columns, F.coalesce("up", "turn").alias("thread"))
