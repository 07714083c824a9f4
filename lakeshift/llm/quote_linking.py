"""Quotation linking for chats (operator 7), in DataFrame functions only.

Messages that quote are taken apart into lines with their quote level, runs of
lines of one level are passages, and each passage - and each of its paragraphs
and lines, for quotes cut shorter or longer than the original's paragraphs - is
hashed in a normalised form. The same hashes of all messages' own words (whole, paragraphs,
lines) are reduced to the first turn that says them, per conversation, so the
join cannot fan out however common a phrase is. A message replies to the latest
turn that it quotes at its lowest linked level. Replies are followed to the
start of their thread by pointer doubling over the links alone, and the result
is ordered by conversation, thread and turn (a range partitioning, no window).

The result has a row per message: conv_id, thread (turn that began it), turn,
role, reply_to (turn, or null), n_quotes (quoted passages), n_linked (those
found), text without quotes and without the line that announces one.

Defined results: a null text stays null and says nothing; a null conv_id or
turn is never linked; a message quotes only earlier turns of its conversation;
passages without letters or digits link nothing; rows that repeat a turn of a
conversation are one message to their repliers, and reply to the latest of what
they quote; an empty table gives no rows; texts of any length are linked whole; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeshift.llm.common import Stage, table

QUOTED_LINE = r"(?m)^[ \t]{0,3}>"
PARAGRAPHS = r"\n[ \t]*\n"
MARKS = r"^((?:[ \t]{0,3}>)+)"
ANNOUNCEMENT = r"(?m)^On [^\n]* wrote:[ \t]*\n(?=[ \t]{0,3}>)"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def said(text: Column) -> Column:
    """Digest of what a text says; null if it has no letters or digits."""
    plain = normalised(text)
    return F.when(plain != "", F.sha2(plain, 256))


def without_quotes(text: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(text, ANNOUNCEMENT, ""), r"(?m)^[ \t]{0,3}>[^\n]*(?:\n|\z)", "")
    return F.when(text.rlike(QUOTED_LINE), F.regexp_replace(F.regexp_replace(bare, r"\A(?:[ \t]*\n)+", ""), r"\s+\z", "")).otherwise(text)


def passages(quoting: DataFrame) -> DataFrame:
    """(conv_id, turn, key, passage, level, digest): each quoted passage's own digest and those of its paragraphs and lines."""
    line = quoting.select("conv_id", "turn", "key", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    marks = F.regexp_extract("line", MARKS, 1)
    line = line.select("conv_id", "turn", "key", "at", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.regexp_replace("line", MARKS, "").alias("words"))
    of = W.partitionBy("conv_id", "turn", "key").orderBy("at")  # one message's lines
    line = line.withColumn("new", F.coalesce((F.col("level") != F.lag("level").over(of)).cast("int"), F.lit(1)))
    line = line.withColumn("passage", F.sum("new").over(of)).where(F.col("level") > 0)
    runs = line.groupBy("conv_id", "turn", "key", "passage", "level").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("lines"))
    texts = F.transform("lines", lambda x: x["words"])
    whole = F.concat_ws("\n", texts)
    units = runs.select("conv_id", "turn", "key", "passage", "level", F.explode(F.array_distinct(F.concat(F.array(whole), F.split(whole, PARAGRAPHS), texts))).alias("unit"))
    return units.select("conv_id", "turn", "key", "passage", "level", said(F.col("unit")).alias("digest"))


def link(messages: DataFrame) -> DataFrame:
    stage = Stage(messages.sparkSession, "quotes")
    own = messages.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("key"))
    quoting = own.where(F.col("text").rlike(QUOTED_LINE) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    quoted = stage.write(passages(quoting.dropDuplicates(["conv_id", "turn", "key"])), "quoted")
    wanted = quoted.select("conv_id").distinct()
    words = own.where(F.col("turn").isNotNull()).join(wanted, "conv_id", "left_semi").select("conv_id", "turn", without_quotes(F.col("text")).alias("text"))
    units = F.array_distinct(F.concat(F.array("text"), F.split("text", PARAGRAPHS), F.split("text", "\n")))
    sources = words.select("conv_id", "turn", F.explode(units).alias("unit")).select("conv_id", "turn", said(F.col("unit")).alias("digest")).where(F.col("digest").isNotNull())
    first = stage.write(sources.groupBy("conv_id", "digest").agg(F.min("turn").alias("source")), "first")
    hits = quoted.join(first, ["conv_id", "digest"], "left").withColumn("source", F.when(F.col("source") < F.col("turn"), F.col("source")))
    per_passage = hits.groupBy("conv_id", "turn", "key", "passage", "level").agg(F.max("source").alias("source"))
    linked = F.when(F.col("source").isNotNull(), F.struct((-F.col("level")).alias("level"), "source"))
    per_message = per_passage.groupBy("conv_id", "turn", "key").agg(
        F.count("*").alias("n_quotes"), F.count("source").alias("n_linked"), F.max(linked)["source"].alias("reply_to")
    )
    per_message = stage.write(per_message, "per_message")
    threads = roots(per_message.where(F.col("reply_to").isNotNull()).groupBy("conv_id", "turn").agg(F.max("reply_to").alias("parent")), stage)
    out = own.withColumn("text", without_quotes(F.col("text"))).join(per_message, ["conv_id", "turn", "key"], "left").join(threads, ["conv_id", "turn"], "left")
    zero = F.lit(0).cast("long")
    out = out.select("conv_id", F.coalesce("root", "turn").alias("thread"), "turn", "role", "reply_to", F.coalesce("n_quotes", zero).alias("n_quotes"), F.coalesce("n_linked", zero).alias("n_linked"), "text")
    return out.orderBy("conv_id", "thread", "turn", "text")


def roots(links: DataFrame, stage: Stage) -> DataFrame:
    """(conv_id, turn, root) of each replying turn: every round doubles the distance that its pointer has gone."""
    ahead = stage.write(links.select("conv_id", "turn", F.col("parent").alias("root")), "thread0")
    step = 0
    while True:
        further = ahead.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"))
        if ahead.join(further, ["conv_id", "root"], "left_semi").isEmpty():
            return ahead
        step += 1
        ahead = stage.write(ahead.join(further, ["conv_id", "root"], "left").select("conv_id", "turn", F.coalesce("next", "root").alias("root")), f"thread{step}")


def op7_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "conversations"))
