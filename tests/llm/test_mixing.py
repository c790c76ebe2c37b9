"""Mixes against plain reckoning and their invariants."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import mixing
from tidemark.llm.op_queries import QUERIES

WEIGHTS = lambda names: [(3, 1, 2)[k % 3] for k in range(len(names))]


def plain_targets(sizes, weights, share=1.5, most=2):
    """Give out by weight; take back what is above; give that out again."""
    got, open_sources, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while left > 1e-9 and open_sources:
        weight = sum(weights[k] for k in open_sources)
        for k in open_sources:
            got[k] += left * weights[k] / weight
        left = 0.0
        for k in list(open_sources):
            if got[k] >= most * sizes[k]:
                left += got[k] - most * sizes[k]
                got[k] = most * sizes[k]
                open_sources.remove(k)
    return got


def test_targets():
    draw = random.Random(1)
    for _ in range(300):
        sizes = [draw.choice([0, 1, 10, 1000, 100_000]) * draw.randrange(1, 9) for _ in range(draw.randrange(1, 12))]
        weights = WEIGHTS(sizes)
        got = mixing.source_targets(sizes, weights)
        assert got == pytest.approx(plain_targets(sizes, weights), rel=1e-9, abs=1e-6)
        assert sum(got) == pytest.approx(1.5 * sum(sizes)) and all(t <= 2 * s for t, s in zip(got, sizes))
    assert mixing.source_targets([], []) == [] and mixing.source_targets([0, 0], [3, 1]) == [0, 0]


def test_permutation_is_one_to_one():
    for size in (1, 2, 3, 4, 5, 64, 65, 1000, 4096, 5000):
        key = mixing._key(7, np.full(size, 3), 1)
        got = mixing.permuted(np.arange(size), np.full(size, size), key)
        assert sorted(got) == list(range(size))
    assert got.tolist() != list(range(size))


@pytest.mark.parametrize("shards", [1, 2, 7, 64, 100])
def test_stretches_part_every_stratum(shards):
    quotas = np.array([0, 5, 1000, 33333, 1, 70, 0])
    all_of = list(mixing.shard_stretches(quotas, shards, 5, 0, shards))
    assert [s for s, _, _ in all_of] == list(range(shards))
    at = np.zeros(len(quotas), np.int64)
    total = quotas.sum()
    for shard, first, counts in all_of:
        assert (first == at).all() and (counts >= 0).all()
        assert counts.sum() == total * (shard + 1) // shards - total * shard // shards
        at += counts
    assert (at == quotas).all()
    some = list(mixing.shard_stretches(quotas, shards, 5, shards // 3, shards // 3 + 1))
    assert len(some) == 1 and (some[0][2] == all_of[shards // 3][2]).all()


def test_draws_have_the_law_of_drawing_without_putting_back(monkeypatch):
    counts, size, turns = np.array([30, 50, 20]), 25, 20_000
    random_numbers = np.random.Generator(np.random.Philox(1))
    for limit in (mixing.EXACT, 10):
        monkeypatch.setattr(mixing, "EXACT", limit)
        got = np.array([mixing.drawn_left(counts, size, random_numbers) for _ in range(turns)])
        assert (got.sum(1) == size).all() and (got <= counts).all() and (got >= 0).all()
        p = counts / 100
        assert np.allclose(got.mean(0), size * p, atol=0.1)
        assert np.allclose(got.var(0), size * p * (1 - p) * 75 / 99, rtol=0.1)


def documents(spark, seed=3, n=400):
    draw = random.Random(seed)
    sources = ["Z"] * 12 + ["a"] * 8 + ["b", "ä", None]
    rows = [
        (k, " ".join(f"w{draw.randrange(99)}" for _ in range(draw.choice([0, 1, 40, 64, 128, 200, 900]))), draw.choice(sources))
        for k in range(n)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), rows


def test_mix(spark):
    docs, rows = documents(spark)
    mixed = mixing.mixture(docs, WEIGHTS, shard_words=5000)
    size = {k: len((t or "").split()) for k, t, _ in rows}
    of = defaultdict(int)
    for k, _, s in rows:
        of[s] += size[k]
    names = sorted(of, key=mixing.source_order)
    assert names == ["Z", "a", "b", "ä", None]
    target = dict(zip(names, plain_targets([of[s] for s in names], WEIGHTS(names))))
    got = mixing.taken_words(mixed).collect()
    assert Counter(r.doc_id for r in got) == Counter(k for k, _, _ in rows)
    taken, source = defaultdict(int), {k: s for k, _, s in rows}
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == of[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]]) and 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= mixing.BLOCK_WORDS / 2

    blocks = mixed.blocks.collect()
    assert mixed.shards == -(-int(sum(target.values())) // 5000) > 10
    per_shard, slots = Counter(b.shard for b in blocks), defaultdict(list)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1 and set(per_shard) == set(range(mixed.shards))
    for b in blocks:
        slots[b.shard].append(b.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    times = Counter((b.doc_id, b.first) for b in blocks)
    assert max(times.values()) == 2
    whole = {s for s in names if target[s] >= of[s]}
    for k, _, s in rows:  # nothing comes twice before all came once
        for no in range(0, size[k], mixing.BLOCK_WORDS):
            if times[k, no] == 2:
                assert s in whole
    assert any(s in whole for s in names) and len(whole) < len(names)
    by_shard = defaultdict(Counter)  # every shard has its part of the frequent source
    for b in blocks:
        by_shard[b.shard][source[b.doc_id]] += 1
    part = [c["Z"] / sum(c.values()) for c in by_shard.values()]
    assert max(part) - min(part) < 0.4


def test_texts_of_the_mix(spark):
    docs, rows = documents(spark, n=60)
    mixed = mixing.mixture(docs, WEIGHTS, shard_words=2000, block_words=50)
    text = {k: (t or "").split() for k, t, _ in rows}
    got = mixing.mixed_texts(docs, mixed).collect()
    assert len(got) == mixed.blocks.count() > 50
    for r in got:
        assert r.text.split() == text[r.doc_id][r["first"] : r["first"] + r.words]


def test_reruns_agree_however_rows_are_dealt(spark):
    docs, _ = documents(spark, n=150)
    runs = [
        sorted(map(tuple, mixing.taken_words(mixing.mixture(d, WEIGHTS, shard_words=3000)).collect()))
        for d in (docs, docs.repartition(7, "source"), docs.orderBy("text"))
    ]
    assert runs[0] == runs[1] == runs[2]
    other = sorted(map(tuple, mixing.taken_words(mixing.mixture(docs, WEIGHTS, shard_words=3000, seed=12)).collect()))
    assert other != runs[0]


def test_odd_rows(spark):
    long = "word " * 200_000
    rows = [(1, None, None, 1), (2, "", "x", 1), (None, "one two", "x", 1), (3, "one two", None, 1), (3, "one two", None, 1)]
    rows += [(3, "three four five", None, 1), (4, long, "x", 1), (5, " \t\n", "y", 1), (6, "one word", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    got = [tuple(r)[:5] for r in mixing.taken_words(mixing.mixture(docs, WEIGHTS)).collect()]
    assert len(got) == len(rows)
    # "" weighs 3, x 1, y 2, null 3; x alone has room for what the others leave
    total = 1.5 * 200_011
    want = {"": 4.0, "x": total - 4 - 14, "y": 0.0, None: 14.0}
    for doc, n, of, target, taken in got:
        source = {1: None, 2: "x", None: "x", 3: None, 4: "x", 5: "y", 6: ""}[doc]
        assert target == pytest.approx(want[source]) and of == {"": 2, "x": 200_002, "y": 0, None: 7}[source]
        assert taken <= 2 * n and (source == "x" or taken == 2 * n)
    assert abs(sum(r[4] for r in got if r[0] in (2, 4, None)) - want["x"]) <= 32


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    mixed = mixing.mixture(docs, WEIGHTS)
    assert mixing.taken_words(mixed).collect() == [] and mixing.mixed_texts(docs, mixed).collect() == []
    with pytest.raises(ValueError):
        mixing.mixture(spark.createDataFrame([(1, "a", "b")], docs.schema), lambda names: [0])


def test_query_on_whole_tables(spark, sf):
    rows = {r[0]: r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()}
    got = QUERIES["op12_mixed_sources"](spark, sf).collect()
    of, taken, target = Counter(), Counter(), {}
    for r in got:
        source = rows[r.doc_id].source
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", rows[r.doc_id].text or "")) and r.taken <= 2 * r["size"]
        of[source] += r["size"]
        taken[source] += r.taken
        target[source] = r.target
    assert len(got) == len(rows)
    names = sorted(of, key=mixing.source_order)
    assert [target[s] for s in names] == pytest.approx(plain_targets([of[s] for s in names], WEIGHTS(names)))
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 32 for s in names)
