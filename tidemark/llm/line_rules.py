"""Line-first cleaning with DataFrame functions only.

Every line is judged by itself; lines that fail a rule go, and a document that loses too much with them is rejected:

* punctuation: over a tenth of the characters in words are symbols, or over a twentieth are ``!``;
* navigation: two or more menu marks (``|``, ``»``, ``›``, ``•``) that stand alone, or a breadcrumb of ``>``;
* boilerplate: a phrase of licences, notices and site furniture.

Document counts besides: words, characters in words, symbols, repeated lines, and words in repeated 5-word windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SYMBOL = "[#*$%&|<>]"
#: Phrases of boilerplate, in lower case.
PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "accept cookies", "enable javascript", "javascript is disabled", "click here", "sign up for our newsletter",
    "subscribe to our", "powered by", "skip to content", "back to top", "licensed under", "permission is hereby granted",
    "without warranty", "copyright (c)", "copyright ©", "lorem ipsum",
)
#: A document stays while at least half of its characters in words do.
MOST_LOST = 50


def _count(text: Column, sign: str) -> Column:
    """Matches of a one-character pattern."""
    return F.size(F.split(text, sign, -1)) - 1


def _solid(text: Column) -> Column:
    """Characters in words."""
    return F.length(F.translate(text, BLANKS, ""))


def line_fails(line: Column) -> Column:
    """Whether a line that has a word fails a rule; the costly parts are looked at only where a sign calls for them."""
    symbols, calls = _count(line, SYMBOL), _count(line, "!")
    punctuation = ((symbols > 0) & (10 * symbols > _solid(line))) | ((calls > 0) & (20 * calls > _solid(line)))
    padded = F.concat(F.lit(" "), line, F.lit(" "))
    marks = sum((F.size(F.split(padded, f" \\{m}(?= )")) - 1 for m in "|»›•"), F.lit(0))
    some = F.contains(line, F.lit("|")) | F.contains(line, F.lit("»")) | F.contains(line, F.lit("›")) | F.contains(line, F.lit("•"))
    crumbs = F.contains(line, F.lit(">")) & (F.size(F.split(padded, " >(?= )")) - 1 >= 2)
    low = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in PHRASES:
        boilerplate = boilerplate | F.contains(low, F.lit(phrase))
    return punctuation | (some & (marks >= 2)) | crumbs | boilerplate


def _repeated(hashes: Column) -> Column:
    """Hashes with their places, sorted, where one occurs twice; else null."""
    twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(twice, F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i")))))


def _covered(pairs: Column, width: int) -> Column:
    """Words in windows whose hash has an equal neighbour in the sorted pairs."""
    again = F.filter(
        pairs,
        lambda e, k: F.coalesce(F.get(pairs, k - 1)["x"] == e["x"], F.lit(False))
        | F.coalesce(F.get(pairs, k + 1)["x"] == e["x"], F.lit(False)),
    )
    return F.sort_array(F.transform(again, lambda e: e["i"]))


def clean_lines(docs: DataFrame, *, most_lost: int = MOST_LOST, id_column="doc_id", text_column="text") -> DataFrame:
    """One row per row of ``docs`` with its counts, the verdict and the text without failed lines.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines (with a
    word), n_failed_lines, clean_text (null for a null text).  base_failed: fewer than 10 words, or over 20 % of the
    words in repeated windows.  kept: neither base_failed nor over ``most_lost`` % of the characters in words lost
    with failed lines.  Null and empty texts have no words, so they fail.  Ids may be null or repeat; other columns are
    not looked at.  All work is within a row: one pass, no shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    worded = lambda line: F.ltrim(line, F.lit(BLANKS)) != ""
    lines = F.split(text, "\n", -1)
    step = slim.withColumns({"words": words, "lines": F.filter(lines, worded)})
    count = F.size("words")
    hashes = F.when(
        count >= 5, F.transform(F.sequence(F.lit(1), count - 4), lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(-1, 4))))
    ).otherwise(F.array().cast("array<bigint>"))
    step = step.withColumns({"hashes": hashes, "failed": F.filter("lines", line_fails)})
    step = step.withColumn("pairs", _repeated(F.col("hashes")))
    step = step.withColumn("places", _covered(F.col("pairs"), 5))
    gaps = F.transform("places", lambda p, k: F.coalesce(F.least(F.get("places", k + 1) - p, F.lit(5)), F.lit(5)))
    n_words = count.cast("long")
    step = step.select(
        "doc_id", "text", "lines", "failed", n_words.alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), _count(text, SYMBOL).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long").alias("n_repeat_words"),
        _solid(F.array_join("failed", "")).cast("long").alias("lost"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = ~failed & (100 * F.col("lost") <= most_lost * F.col("word_chars"))
    clean = F.array_join(F.filter(F.split("text", "\n", -1), lambda line: ~(worded(line) & line_fails(line))), "\n")
    return step.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"),
        F.size("failed").cast("long").alias("n_failed_lines"), clean.alias("clean_text"),
    )
