"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import spelling


def plain_words(rows, shortest=5, least=3, every=97):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            if doc is not None and (h := zlib.crc32(f"{doc}:{run}".encode())) % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= shortest and k >= least}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, **rules):
    n = plain_words(rows, **rules)
    close = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, some in close.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return out


def found(spark, rows, **rules):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {tuple(r) for r in spelling.spelling_groups(docs, **rules).collect()}


def written(draw, vocabulary, documents):
    weights = [1 / (1 + k) for k in range(len(vocabulary))]
    return [(k, " ".join(draw.choices(vocabulary, weights, k=draw.choice([0, 3, 60, 300])))) for k in range(documents)]


@pytest.mark.parametrize("leaf, sample", [(8192, 100_000), (12, 100_000), (12, 40)])
def test_equals_all_pairs(spark, leaf, sample):
    draw = random.Random(leaf + sample)
    letters = "aabbcdeéÀ×"
    vocabulary = ["".join(draw.choices(letters, k=draw.choice([4, 5, 5, 6, 6, 6, 7]))) for _ in range(300)]
    vocabulary += [w[::-1] for w in vocabulary[:40]] + [w.upper() for w in vocabulary[40:60]]
    rows = written(draw, vocabulary, 60)
    got = found(spark, rows, every=5, leaf=leaf, sample=sample)
    assert got == plain(rows, every=5)
    assert sum(r[1] is not None for r in got) > 25


def test_root_follows_forms_to_the_last(spark):
    rows = [(None, "abcdef " * 40 + "abcdeg " * 18 + "abcxeg " * 8 + "abcxg " * 3 + "zzzzz " * 5)]
    got = found(spark, rows)
    assert got == plain(rows)
    assert {r[0]: (r[1], r[2]) for r in got}["abcxg"] == ("abcxeg", "abcdef")


def test_production_parameters(spark):
    draw = random.Random(2)
    rows = written(draw, ["".join(draw.choices("abcde", k=draw.choice([5, 6, 7]))) for _ in range(400)], 50)
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark, monkeypatch):
    long = "letters" * 30_000
    rows = [
        (1, None), (2, ""), (3, "!?. 123"), (None, "friend friend friend frien frien frien"), (4, f"{long} {long} {long}x {long}"),
        (5, "Friend FRIEND friend frIend Études études études Études études"), (5, "Friend FRIEND friend frIend"),
        (6, "aaaaa " * 9 + "aaaaaa " * 4 + "aaaa " * 9), (7, "abcde-abcde'abcde\nedcba edcba edcba"),
    ]
    assert found(spark, rows) == plain(rows)
    monkeypatch.setattr(spelling, "PIECE", 7)
    monkeypatch.setattr(spelling, "HELD", 3)
    runs = [r for text in ("ab, cdefghij-klmnopqrst u", "", "abcdefghijklmnopq") for part in spelling.text_runs(text) for r in part]
    assert runs == ["ab", "cdefghij", "klmnopqrst", "u", "abcdefghijklmnopq"]


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_groups(empty).collect() == []
    rows = [(k, "winter wintr winter winter wintr wintr winter winter winter", k, "x", 1) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, word string, tree int")
    got = {tuple(r) for r in spelling.spelling_groups(docs).collect()}
    assert got == plain([r[:2] for r in rows])


def test_boxes_lose_nothing():
    """Every word within reach lies in a box that the search visits; boxes out of reach are pruned."""
    draw = np.random.default_rng(3)
    codes = draw.integers(97, 103, (500, 6)).astype(np.uint32)
    counts = spelling.letter_counts(codes)
    tree = spelling.grown(counts, 8)
    visited = 0
    for up, down in ((0, 0), (1, 0), (1, 1)):
        seen = [set() for _ in counts]
        for members, rows in spelling.reached(tree, counts, up, down):
            visited += len(members) * len(rows)
            for r in rows:
                seen[r].update(members.tolist())
        for a in range(len(counts)):
            apart = counts - counts[a]
            inside = (np.maximum(apart, 0).sum(1) <= up) & (np.maximum(-apart, 0).sum(1) <= down)
            assert set(np.flatnonzero(inside)) <= seen[a]
    assert visited < 0.7 * 3 * len(counts) ** 2
