"""Quotations in conversations: who answers whom, with DataFrame functions only.

A line's quote level is the number of ``>`` before its text.  A passage is a run of lines of one level above 0.  Lines
and passages are normalised (lower case, single blanks) and hashed, and joined to the first message of the same
conversation that says them itself, before the message that quotes.  A message answers the message behind its
outermost linked passage, the latest of several.  Threads follow from answers to answers; a conversation in reply
order has thread by thread, each in the order of its turns, with quotes left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace
from tidemark.operators.ordered import along_key, ordinal

_MARKS = r"^(?:[ \t]*>)+"


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _line(line: Column) -> Column:
    marks = F.regexp_extract(line, _MARKS, 0)
    level = F.length(marks) - F.length(F.translate(marks, ">", ""))
    rest = F.substring(line, F.length(marks) + 1, F.length(line))
    return F.struct(level.alias("level"), _normal(rest).alias("norm"), line.alias("raw"))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, body (own lines), n_quoted_lines, own and passages with the hashes of what they say."""
    slim = messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
        F.transform(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1), _line).alias("lines"),
    )
    size = F.size("lines")
    at = lambda i: F.get("lines", i)["level"]
    places = F.sequence(F.lit(0), size - 1)
    edge = lambda i, step: (at(i) > 0) & F.coalesce(at(i + step) != at(i), F.lit(True))
    slim = slim.withColumns({
        "starts": F.filter(places, lambda i: edge(i, -1)), "ends": F.filter(places, lambda i: edge(i, 1)),
    })
    said = lambda lines: F.filter(F.transform(lines, lambda x: x["norm"]), lambda x: x != "")
    whole = lambda texts: F.xxhash64(F.array_join(texts, " "))
    own = F.filter("lines", lambda x: x["level"] == 0)
    passages = F.transform(
        F.arrays_zip("starts", "ends"),
        lambda p: F.struct(
            F.get("lines", p["starts"])["level"].alias("level"),
            said(F.slice("lines", p["starts"] + 1, p["ends"] - p["starts"] + 1)).alias("said"),
        ),
    )
    return slim.select(
        "conv_id", "turn", "role",
        F.trim(F.array_join(F.transform(own, lambda x: x["raw"]), "\n")).alias("body"),
        F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted_lines"),
        said(own).alias("own"), F.filter(passages, lambda p: F.size(p["said"]) > 0).alias("passages"),
    ).select(
        "conv_id", "turn", "role", "body", "n_quoted_lines",
        F.array_distinct(F.array_append(F.transform("own", lambda x: F.xxhash64(x)), whole(F.col("own")))).alias("own"),
        F.transform("passages", lambda p, k: F.struct(
            k.alias("no"), p["level"].alias("level"),
            F.array_append(F.transform(p["said"], lambda x: F.xxhash64(x)), whole(p["said"])).alias("hashes"),
        )).alias("passages"),
    )


def _answers(quoting: DataFrame, messages: DataFrame) -> DataFrame:
    """Per message with a linked passage: n_linked passages, and the turn it answers."""
    first = messages.where("conv_id is not null and turn is not null").select(
        "conv_id", F.explode("own").alias("hash"), "turn"
    ).groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))
    asked = quoting.select("conv_id", "turn", F.explode("passages").alias("p")).select(
        "conv_id", "turn", "p.no", "p.level", F.posexplode("p.hashes").alias("k", "hash")
    ).distinct()
    found = asked.join(first, ["conv_id", "hash"]).where("origin < turn")
    # the hash of a whole passage comes last and counts before those of its lines; of lines the last counts
    best = found.groupBy("conv_id", "turn", "no", "level").agg(F.max(F.struct("k", "origin"))["origin"].alias("origin"))
    return best.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n_linked"), F.max(F.struct(-F.col("level"), "origin"))["origin"].alias("reply_to")
    )


def _threads(answers: DataFrame, space: Workspace) -> DataFrame:
    """conv_id, turn, thread (first turn of the chain of answers) and depth, by doubling the steps."""
    state = space.store(answers.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")), "steps-0")
    turn = 0
    while True:
        up = state.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"), F.col("depth").alias("more"))
        both = state.join(up, ["conv_id", "thread"], "left")
        turn += 1
        longer = space.store(both.select(
            "conv_id", "turn", F.coalesce("above", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("moved"),
        ), f"steps-{turn}")
        state = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return state


def linked_conversations(messages: DataFrame) -> DataFrame:
    """One row per message of ``messages`` (conv_id, turn, role, text), in reply order by ``place``.

    Columns: conv_id, turn, role, body (without quotes; a null text is empty), n_quoted_lines, n_passages, n_linked,
    reply_to (turn that is answered, or null), thread (first turn of the thread), depth (answers up to it), place (1, 2,
    ... by thread, turn, and then role and body).  Rows without conv_id or turn link with nothing and have no thread and
    no place.  Rows that repeat a conv_id and turn are one message of several parts: each gets all its links.  Other
    columns are not looked at.
    """
    space = Workspace(messages.sparkSession, "quotes")
    parts = space.store(parsed(messages), "parsed")
    keyed = parts.where("conv_id is not null and turn is not null")
    answers = space.store(_answers(keyed.where(F.size("passages") > 0), keyed), "answers")
    threads = _threads(answers, space)
    links = answers.join(threads, ["conv_id", "turn"])
    plain = F.size("passages") == 0
    columns = [
        "conv_id", "turn", "role", "body", "n_quoted_lines", F.size("passages").cast("long").alias("n_passages"),
    ]
    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    quoting = keyed.where(~plain).select(*columns).join(links, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "body", "n_quoted_lines", "n_passages", F.coalesce("n_linked", zero).alias("n_linked"),
        "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", zero).alias("depth"),
    )
    rest = keyed.where(plain).select(
        *columns, zero.alias("n_linked"), none.alias("reply_to"), F.col("turn").alias("thread"), zero.alias("depth")
    )
    ready = quoting.union(rest).withColumn("order_key", F.xxhash64("role", "body"))
    ready = space.store(ready, "ready")
    placed = along_key(ready, ["conv_id"], ["thread", "turn", "order_key"], {"place": ordinal()}).drop("order_key")
    lost = parts.where("conv_id is null or turn is null").select(
        *columns, zero.alias("n_linked"), none.alias("reply_to"), none.alias("thread"), zero.alias("depth"), none.alias("place")
    )
    return placed.withColumn("place", F.col("place").cast("long")).unionByName(lost)
