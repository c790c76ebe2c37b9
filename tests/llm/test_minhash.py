"""Near duplicates against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common, minhash
from tidemark.llm.common import Workspace
from tidemark.llm.components import components


def plain_set(text, width):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def plain(rows, width, percent=80):
    """doc_id to (set size, component) over all pairs."""
    sets = {d: plain_set(t, width) for d, t in rows}
    label = {d: d for d in sets}
    changed = True
    near = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed |= (label[a], label[b]) != (low, low)
            label[a] = label[b] = low
    return {d: (len(sets[d]), label[d]) for d in sets}


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("width", [2, 5])
def test_equals_all_pairs(spark, width):
    draw, rows = random.Random(width), []
    for g in range(12):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.choice([1, 3, 8, 40, 150, 600]))]
        rows += [(100 * g + k, edited(draw, base, draw.choice([0, 0, 1, 2, len(base) // 25, len(base) // 10]))) for k in range(14)]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, width=width).collect()}
    assert got == plain(rows, width)


def test_large_group_with_stragglers(spark):
    """More copies than a small bucket has: stars must still find the chains between them."""
    draw = random.Random(9)
    base = [f"w{draw.randrange(300)}" for _ in range(200)]
    rows = [(k, edited(draw, base, draw.choice([1, 2, 4, 6]))) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, width=2).collect()}
    assert got == plain(rows, 2)


def test_large_group_of_many_components(spark):
    """Copies just about as far from each other as a link allows: most links are out of any star's reach."""
    draw = random.Random(4)
    base = [f"w{draw.randrange(300)}" for _ in range(200)]
    rows = [(k, edited(draw, base, draw.choice([7, 8]))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, width=2).collect()}
    want = plain(rows, 2)
    assert 20 < len({label for _, label in want.values()}) < 180
    assert got == want


def test_odd_rows(spark):
    long = " ".join(f"w{k % 7001}" for k in range(200_000))
    rows = [
        (5, None, "a"), (6, "", "a"), (7, " \n\t", "a"), (None, "same text", "a"), (None, "same text", "a"), (1, "one", "b"),
        (2, "ONE", "b"), (3, "same text", None), (3, "same text", None), (4, "Same\n text", "c"), (8, long, "d"), (9, long + " end", "d"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = minhash.near_duplicates(docs, width=2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None) == [
        (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True), (6, 0, 6, True),
        (7, 0, 7, True), (8, 7001, 8, True), (9, 7002, 8, False),
    ]
    assert [(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None] == [(1, None, True)] * 2
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_signature_estimates_similarity():
    draw = np.random.default_rng(1)
    a = np.unique(draw.integers(0, 2**63, 900, dtype=np.uint64) * np.uint64(2))
    for size in (30, 900):
        x, y = np.sort(a[:size]), np.sort(np.concatenate([a[size // 10 : size], a[:0]]))
        same = (minhash.signature(common.mix(x).copy()[np.argsort(common.mix(x))], 512) ==
                minhash.signature(common.mix(y)[np.argsort(common.mix(y))], 512)).mean()
        assert abs(same - 0.9) < 0.08


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, 299)]
    table = spark.createDataFrame(edges, "u long, v long").repartition(6)
    got = {r.id: r.label for r in components(table, Workspace(spark, "test"), "t").collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}, 299: 299, 300: 299}


def test_words_are_those_of_the_pattern(monkeypatch):
    draw = random.Random(3)
    monkeypatch.setattr(common, "PIECE", 40)
    texts = ["".join(draw.choice("aB é\t\n\x0b\x0c\r\x1c\x85 cd") for _ in range(draw.randrange(200))) for _ in range(200)]
    column = pa.array([*texts, None, "x" * 500, "a " * 300], pa.string())
    seen = {}
    for row, hashes, starts, ends in common.batch_words(column):
        raw = (column[row].as_py() or "").encode()
        words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
        assert [raw[a:b] for a, b in zip(starts, ends)] == words
        for w, h in zip(words, hashes.tolist()):
            assert seen.setdefault(w.lower(), h) == h
    assert len(set(seen.values())) == len(seen)
