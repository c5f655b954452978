"""Quotation linking: reply-ordered conversations without quotes, from DataFrame functions.

A message is a row (conv_id, turn, role, text). A line belongs to quote level n if it starts
with n marks ``>`` (white space between them is ignored); neighbouring lines of one level are
a block. Blocks and lines are normalised (lower case, white space runs to one space,
trimmed) and hashed. What a message says itself (level 0, without the line that announces a
quote) is hashed the same way, as a whole and line by line.

A quoted passage is joined to the first message of its conversation whose own words hold it:
as a block first, else line by line. Its hash is pre-aggregated to that one message before
the join, so a passage that very many messages share never multiplies, and the join key
holds the hash, so a conversation of very many messages is spread over all tasks.

A message replies to the latest earlier message that its level-one passages come from. Roots
and depths of reply chains come from pointer doubling over linked messages only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.tables import written

# Possessive: a loop in the regular expression engine, where giving back would recurse once per mark.
MARKS = r"^(?:[ \t]*+>)++"
#: Lines before a quote that only say who wrote it.
ANNOUNCES = r"(?i)^\s*(?:on\b.*\bwrote|le\b.*\ba écrit|am\b.*\bschrieb.*|el\b.*\bescribió|.{1,80}\bwrote)\s*:\s*$"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passage_hash(text: Column) -> Column:
    """128 bits of the normalised passage, as text."""
    return F.md5(normalised(text))


def _blocks(messages: DataFrame) -> DataFrame:
    """Each message with ``lines`` (level, body) and ``blocks`` (level, lines of one run)."""
    parsed = messages.withColumn("raw", F.split(F.coalesce("text", F.lit("")), "\r?\n", -1))
    parsed = parsed.withColumn("lines", F.transform("raw", lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), r"[^>]", "")).cast("int").alias("level"),
        F.regexp_replace(x, MARKS + "[ \t]?", "").alias("body")))).drop("raw")
    level = lambda i: F.get("lines", i)["level"]
    first = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: (i == 0) | ~level(i).eqNullSafe(level(i - 1)))
    parsed = parsed.withColumn("first", first)
    return parsed.withColumn("blocks", F.transform("first", lambda i, k: F.struct(
        level(i).alias("level"),
        F.transform(F.slice("lines", i + 1, F.coalesce(F.get("first", k + 1), F.size("lines")) - i), lambda x: x["body"]).alias("body")))).drop("first")


def _own_lines(blocks: str) -> Column:
    """Lines of level 0; the last one before a quote goes if it announces it."""
    def kept(block: Column, k: Column) -> Column:
        quoted_next = F.get(blocks, k + 1).isNotNull()
        trimmed = F.filter(block["body"], lambda x: x.rlike(r"\S"))
        last = F.element_at(F.when(F.size(trimmed) > 0, trimmed), -1)
        announced = quoted_next & F.coalesce(last.rlike(ANNOUNCES), F.lit(False))
        return F.when(block["level"] == 0, F.when(announced, F.filter(block["body"], lambda x: ~x.rlike(ANNOUNCES))).otherwise(block["body"])).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(blocks, kept))


def reply_threads(messages: DataFrame) -> DataFrame:
    """Messages without quotes, with what they reply to.

    ``messages`` has conv_id, turn, role and text; other columns are ignored. Returns one row
    per row: conv_id, turn, role, own_text (without quoted lines and their announcements,
    trimmed), n_quotes (quoted blocks with a word), n_linked (those found in an earlier
    message), max_level, parent_turn (null: replies to nothing quoted), thread_turn (first
    message of the reply chain; its own turn without one) and reply_depth. Reading
    a conversation by (thread_turn, reply_depth, turn) puts every message after the one it
    answers.

    A null or empty text has no quotes and an empty own_text. Messages without conv_id or
    turn are linked with nothing: their thread_turn is their turn and their depth 0. Rows
    that share conv_id and turn (ties, repeats) are one message as origin and as reply:
    the latest parent found for any of them is the parent of all. No rows give no rows.
    """
    base = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    parsed = _blocks(base)
    own = _own_lines("blocks")
    full = lambda x: x.rlike(r"[\p{L}\p{N}]")
    quoted = F.filter("blocks", lambda b: (b["level"] > 0) & F.exists(b["body"], full))
    parsed = parsed.select(
        "conv_id", "turn", "role", own.alias("own"), F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "").alias("own_text"),
        F.coalesce(F.array_max(F.transform("blocks", lambda b: b["level"])), F.lit(0)).alias("max_level"),
        F.transform(quoted, lambda b: F.struct(
            b["level"].alias("level"), passage_hash(F.array_join(b["body"], "\n")).alias("whole"),
            F.transform(F.filter(b["body"], full), passage_hash).alias("lines"))).alias("quotes"))
    named = parsed.where("conv_id is not null and turn is not null")
    # Only conversations that quote anything need origins.
    asked = (
        named.where(F.size("quotes") > 0).select("conv_id", "turn", F.posexplode("quotes").alias("place", "q"))
        .select("conv_id", "turn", "place", F.col("q.level").alias("level"), F.explode(F.array_union(F.array("q.whole"), "q.lines")).alias("hash"),
                F.col("q.whole").alias("whole")))
    asked = written(asked, "quotes")
    hashes = F.array_distinct(F.concat(
        F.array(passage_hash("own_text")), F.transform(F.filter("own", full), passage_hash)))
    origins = (
        named.where(full(F.col("own_text"))).select("conv_id", "turn", F.explode(hashes).alias("hash"))
        .join(asked.select("conv_id").distinct(), "conv_id", "left_semi")
        .groupBy("conv_id", "hash").agg(F.min("turn").alias("origin")))
    met = asked.join(origins, ["conv_id", "hash"]).where("origin < turn")
    passages = met.groupBy("conv_id", "turn", "place", "level").agg(
        F.coalesce(F.max(F.when(F.col("hash") == F.col("whole"), F.col("origin"))), F.max("origin")).alias("origin"))
    replies = written(passages.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("level") == 1, F.col("origin"))).alias("parent_turn"), F.countDistinct("place").alias("n_linked")), "replies")
    roots = _roots(replies.where("parent_turn is not null").select("conv_id", "turn", "parent_turn"))
    out = parsed.join(replies, ["conv_id", "turn"], "left").join(roots, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "own_text", F.size("quotes").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("max_level").cast("long").alias("max_level"), "parent_turn",
        F.coalesce("thread_turn", "turn").alias("thread_turn"), F.coalesce("reply_depth", F.lit(0)).cast("long").alias("reply_depth"))


def _roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn, reply_depth) of replies, by doubling the length of the jumps."""
    jumps = written(replies.select("conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).cast("long").alias("steps")), "jumps")
    while True:
        further = jumps.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        joined = written(jumps.join(further, ["conv_id", "up"], "left"), "jumps")
        moved = joined.where("next is not null").limit(1).count()
        jumps = joined.select("conv_id", "turn", F.coalesce("next", "up").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        if not moved:
            return jumps.select("conv_id", "turn", F.col("up").alias("thread_turn"), F.col("steps").alias("reply_depth"))
