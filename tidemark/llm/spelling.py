"""Spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

A replaced letter moves one count down and one up, an inserted letter moves one count up, so the counts of two words
one edit apart differ by at most two in L1.  Words of one length share a tree; a word searches the tree of its own
length and that of the next one, which covers each pair of lengths once.  Boxes that lie further off are pruned, and what
is left in the last boxes is verified letter by letter.

The upper levels of a tree are fitted on a bounded sample of the words and deal all words to leaves of about ``leaf``
words; a query goes to every leaf whose box it can reach, so no pair is lost wherever the planes are.  Each leaf is
a group of its own, indexed and searched there, and returns one row per word it found something for: counts and
the best neighbour, never pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace

#: Words that a leaf of the upper tree aims at, and words that the planes are fitted on.
LEAF, SAMPLE = 8_192, 100_000
#: Words that end the local tree.
BUCKET = 24
#: Characters of a text that are taken apart at once, and words that a task counts before it hands them on.
PIECE, HELD = 1 << 20, 200_000
#: Letters compared at once.
COMPARED = 1 << 24

LETTERS = 26 + 64  # a-z and U+00C0 to U+00FF
RUN = "[A-Za-zÀ-ÿ]+"
_run = re.compile("[a-zÀ-ÿ]+")
_gap = re.compile("[^A-Za-zÀ-ÿ]")


def text_runs(text: str) -> Iterator[list[str]]:
    """The runs of a text with A-Z lower-cased, a list for each piece; no run is cut."""
    low = 0
    while low < len(text):
        end = len(text)
        if end - low > PIECE:
            gap = _gap.search(text, low + PIECE)
            end = gap.start() if gap else end
        yield _run.findall(text[low:end].encode().lower().decode())
        low = end


def typed(run: str, crc: int, every: int) -> str:
    """The run, without one letter where ``every`` divides its hash."""
    if crc % every:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def _counted(shortest: int, every: int):
    def flush(held: dict[str, int]) -> pa.RecordBatch:
        columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                begin = None if doc is None else zlib.crc32(f"{doc}:".encode())
                for runs in text_runs(value.as_py() or ""):
                    for word, n in Counter(runs).items():
                        if len(word) < shortest:
                            continue
                        if begin is not None:
                            crc = zlib.crc32(word.encode(), begin)
                            if crc % every == 0:
                                word = typed(word, crc, every)
                                if len(word) < shortest:
                                    continue
                        held[word] = held.get(word, 0) + n
                    if len(held) >= HELD:
                        yield flush(held)
                        held.clear()
        yield flush(held)

    return run


def word_counts(
    docs: DataFrame, *, shortest: int = 5, least: int = 3, every: int = 97, id_column="doc_id", text_column="text"
) -> DataFrame:
    """Words of at least ``shortest`` letters and ``least`` occurrences: word, n.

    Null and empty texts have none.  Runs of rows without an id are taken as they are.  Repeated rows count again.
    """
    slim = docs.select(F.col(id_column).cast("string").alias("doc"), F.col(text_column).cast("string").alias("text"))
    counted = slim.mapInArrow(_counted(shortest, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def codes_of(words: list[str]) -> np.ndarray:
    """The letters of words of one length as a matrix."""
    length = len(words[0])
    return np.array(words, f"U{length}").view(np.uint32).reshape(len(words), length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each word has each letter."""
    place = np.where(codes < 0xC0, codes - 97, codes - 0xC0 + 26).astype(np.int64)
    out, rows = np.zeros((len(codes), LETTERS), np.int32), np.arange(len(codes))
    for at in range(codes.shape[1]):
        out[rows, place[:, at]] += 1
    return out


def grown(counts: np.ndarray, size: int, members: np.ndarray | None = None):
    """A k-d tree: (letter, value, left, right) with counts up to ``value`` on the left, or an array of rows.

    Nodes are split at the median of the letter that varies most until they hold ``size`` rows or all are alike.
    """
    members = np.arange(len(counts)) if members is None else members
    if len(members) <= size:
        return members
    own = counts[members]
    spread = own.var(axis=0)
    letter = int(spread.argmax())
    if spread[letter] == 0:
        return members
    column = own[:, letter]
    value = int(np.median(column))
    if value >= column.max():
        value = int(column.max()) - 1
    left = column <= value
    return letter, value, grown(counts, size, members[left]), grown(counts, size, members[~left])


def numbered(tree, first: int = 0):
    """The tree with leaf numbers instead of rows, and the number after the last."""
    if not isinstance(tree, tuple):
        return first, first + 1
    left, after = numbered(tree[2], first)
    right, after = numbered(tree[3], after)
    return (tree[0], tree[1], left, right), after


def reached(tree, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[object, np.ndarray]]:
    """(leaf, rows of ``counts``) for each leaf whose box has a point at most ``up`` letters more and ``down`` less."""
    nothing = np.zeros(len(counts), np.int32)
    stack = [(tree, np.arange(len(counts)), nothing, nothing, {})]
    while stack:
        node, rows, more, less, box = stack.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            yield node, rows
            continue
        letter, value, left, right = node
        low, high = box.get(letter, (0, None))
        have = counts[rows, letter]
        # the left side ends at value: what lies above has to come down
        before = 0 if high is None else np.maximum(have - high, 0)
        fewer = less + np.maximum(have - value, 0) - before
        keep = fewer <= down
        stack.append((left, rows[keep], more[keep], fewer[keep], {**box, letter: (low, value)}))
        further = more + np.maximum(value + 1 - have, 0) - np.maximum(low - have, 0)
        keep = further <= up
        stack.append((right, rows[keep], further[keep], less[keep], {**box, letter: (value + 1, high)}))


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words of equal length (last axis) differ in exactly one letter."""
    return (a != b).sum(axis=-1) == 1


def inserted(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether the longer word is the shorter one with one letter put in."""
    length = shorter.shape[-1]
    front = np.logical_and.accumulate(shorter == longer[..., :-1], axis=-1).sum(axis=-1)
    back = np.logical_and.accumulate((shorter == longer[..., 1:])[..., ::-1], axis=-1).sum(axis=-1)
    return front + back >= length


def near_rows(tree, home: np.ndarray, asking: np.ndarray, counts: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``asking`` and of ``home`` that are one edit apart, through the tree over ``home``."""
    verify, down = (replaced, 1) if same else (inserted, 0)
    found_a, found_h = [], []
    for members, rows in reached(tree, counts, 1, down):
        step = max(1, COMPARED // (len(members) * home.shape[1]))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            a, h = np.nonzero(verify(asking[part][:, None, :], home[members][None, :, :]))
            found_a.append(part[a])
            found_h.append(members[h])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_a), np.concatenate(found_h)) if found_a else (none, none)


_ROUTED = "tree int, leaf int, role int, word string, n long"
_HOME, _SAME, _SHORTER = 0, 1, 2


def _routed(trees: dict[int, tuple]):
    """Words to their own leaf, and to all leaves that may hold a neighbour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
            lengths = np.array([len(w) for w in words], np.int64)
            out: list[tuple[int, int, int, np.ndarray]] = []
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                own, longer = trees.get(int(length)), trees.get(int(length) + 1)
                counts = letter_counts(codes_of(words[rows].tolist())) if own or longer else None
                if own:
                    home = np.zeros(len(rows), np.int64)
                    for leaf, some in reached(own, counts, 0, 0):
                        home[some] = leaf
                        out.append((length, leaf, _HOME, rows[some]))
                    for leaf, some in reached(own, counts, 1, 1):
                        out.append((length, leaf, _SAME, rows[some[home[some] != leaf]]))
                else:
                    out.append((length, 0, _HOME, rows))
                if longer:
                    for leaf, some in reached(longer, counts, 1, 0):
                        out.append((length + 1, leaf, _SHORTER, rows[some]))
                else:
                    out.append((length + 1, 0, _SHORTER, rows))
            at = np.concatenate([x[3] for x in out]) if out else np.zeros(0, np.int64)
            sizes = [len(x[3]) for x in out]
            columns = [pa.array(np.repeat(np.array([x[k] for x in out], np.int32), sizes)) for k in range(3)]
            columns += [pa.array(words[at].tolist(), pa.string()), pa.array(n[at])]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "leaf", "role", "word", "n"])

    return run


_FOUND = "word string, n_near long, best_n long, best string"


def _searched(table: pa.Table) -> pa.Table:
    """One row for each word of a leaf that has neighbours there: their number, and the most frequent one."""
    role = table["role"].to_numpy()
    words, n = np.array(table["word"].to_pylist(), object), table["n"].to_numpy()
    home = np.flatnonzero(role == _HOME)
    pairs = []
    if len(home):
        at_home = codes_of(words[home].tolist())
        counts = letter_counts(at_home)
        tree = grown(counts, BUCKET)
        a, h = near_rows(tree, at_home, at_home, counts, True)
        pairs.append((home[a], home[h]))
        for kind in (_SAME, _SHORTER):
            rows = np.flatnonzero(role == kind)
            if len(rows):
                codes = codes_of(words[rows].tolist())
                a, h = near_rows(tree, at_home, codes, letter_counts(codes), kind == _SAME)
                pairs.append((rows[a], home[h]))
                if kind == _SHORTER:
                    pairs.append((home[h], rows[a]))
    me = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    other = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    rank = np.zeros(len(words), np.int64)
    some = np.unique(other)
    rank[some[np.argsort(words[some].astype(str), kind="stable")]] = np.arange(len(some))
    order = np.lexsort((rank[other], -n[other], me))
    me, other = me[order], other[order]
    first = np.flatnonzero(np.diff(me, prepend=-1))
    total = np.diff(first, append=len(me))
    columns = [words[me[first]], total.astype(np.int64), n[other[first]].astype(np.int64), words[other[first]]]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.Table.from_arrays([pa.array(c.tolist(), k) for c, k in zip(columns, kinds)], ["word", "n_near", "best_n", "best"])


def _planes(words: DataFrame, leaf: int, sample: int) -> dict[int, tuple]:
    """The upper tree of each length that has more than ``leaf`` words, fitted on at most about ``sample`` of these words."""
    length = F.length("word")
    large = {r["length"]: r["n"] for r in words.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf).collect()}
    if not large:
        return {}
    share = min(1.0, sample / sum(large.values()))
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))
    by_length: dict[int, list[str]] = {}
    for word in words.where(length.isin(*large) & drawn).select("word").toArrow()["word"].to_pylist():
        by_length.setdefault(len(word), []).append(word)
    found = {}
    for k, some in sorted(by_length.items()):
        tree, leaves = numbered(grown(letter_counts(codes_of(sorted(some))), max(1, int(leaf * share))))
        if leaves > 1:
            found[k] = tree
    return found


def neighbours(words: DataFrame, *, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """For each distinct word of ``words`` (word, n) that has words one edit apart: word, n_near, best_n, best.

    ``best`` is the neighbour of largest n, of these the first in code-point order.  ``words`` should be a stored table.
    """
    routed = words.select("word", "n").mapInArrow(_routed(_planes(words, leaf, sample)), _ROUTED)
    found = routed.groupBy("tree", "leaf").applyInArrow(_searched, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("b"))
        .select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))
    )


def spelling_groups(
    docs: DataFrame,
    *,
    shortest: int = 5,
    least: int = 3,
    every: int = 97,
    times: int = 2,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    **names: str,
) -> DataFrame:
    """Words of a corpus with the spelling they vary: word, form, root, n, n_near, form_n.

    A word's form is its most frequent neighbour where that is at least ``times`` as frequent; root follows forms to
    the last, each step ``times`` as frequent, so chains are short and end.  Null and empty texts have no words; an
    empty table has no rows; other columns don't matter.
    """
    space = Workspace(docs.sparkSession, "spelling")
    words = space.store(word_counts(docs, shortest=shortest, least=least, every=every, **names), "words")
    near = space.store(neighbours(words, leaf=leaf, sample=sample), "near")
    joined = words.join(near, "word", "left")
    taken: Column = F.col("best_n") >= times * F.col("n")
    formed = joined.select(
        "word",
        F.when(taken, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best_n")).alias("form_n"),
    )
    formed = space.store(formed, "formed")
    step = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    turn, open_steps = 0, True
    while open_steps:  # each turn doubles the steps that a root is away
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = step.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        turn += 1
        step = space.store(step, f"roots-{turn}")
        open_steps = not step.where("moved").isEmpty()
        step = step.drop("moved")
    rooted = formed.join(step, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
