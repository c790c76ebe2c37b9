"""The quality network, the language model, packing, archives, decontamination and line rules."""

import base64
import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oracle import compare, connect
from tidemark.llm import decontaminate, kneser_ney, op_queries, packing, quality, warc
from tidemark.llm.common import Workspace, batch_words, id_crc32
from tidemark.llm.line_rules import clean_lines

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", list(op_queries.ORACLES))
def test_queries_equal_their_sql(spark, sf, name):
    assert compare(op_queries.QUERIES[name](spark, sf), connect(sf), op_queries.ORACLES[name]) is None


# quality


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(2)
    net = quality.Network(5, 3)
    net.p["c"] = draw.normal(size=5)
    x, first, label = draw.normal(size=(9, quality.FEATURES)), np.array([0, 4, 5]), np.array([1.0, 0, 1])

    def loss():
        out, _ = net.forward(x, first)
        return -np.mean(label * np.log(out) + (1 - label) * np.log(1 - out))

    out, kept = net.forward(x, first)
    for name, grad in net.gradient(out, label, first, kept).items():
        at = tuple(draw.integers(0, n) for n in net.p[name].shape)
        saved = net.p[name][at]
        net.p[name][at] = saved + 1e-5
        up = loss()
        net.p[name][at] = saved - 1e-5
        down = loss()
        net.p[name][at] = saved
        assert math.isclose((up - down) / 2e-5, grad[at], rel_tol=1e-3, abs_tol=1e-7), name


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = op_queries.QUERIES["op7_quality"](spark, "/root/testdata/sf0.01")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert got.count() == docs.count() and all(0 <= r.score <= 1 for r in got.collect())
    odd = spark.createDataFrame([(None, "a b", 1), (1, None, 1), (1, "", 1), (2, "x " * 300_000, 1)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, label int")
    found = quality.quality_scores(odd, none, id_crc32() % 3 == 1).collect()
    assert [r.score for r in found] == [0.5] * 4 and [r.predicted for r in found] == [1] * 4
    some = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None), (99, 1)], "doc_id long, label int")
    assert quality.quality_scores(odd, some, F.lit(False)).count() == 4
    assert quality.quality_scores(odd.limit(0), some, F.lit(False)).count() == 0


def plain_score(net, text):
    """Score of one text passage by passage, with dictionaries and loops."""
    data = (text or "").encode()
    words = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    hashes = [h for _, h, _, _ in batch_words(pa.array([text or ""]))][0]
    rows = [[0.0] * quality.FEATURES]
    for low in range(0, len(words), quality.PASSAGE):
        own = words[low : low + quality.PASSAGE]
        end = words[low + quality.PASSAGE][0] if low + quality.PASSAGE < len(words) else len(data)
        part = data[own[0][0] if low else 0 : end]
        kinds = [0] * (len(quality._KINDS) + 2)
        for byte in part:
            hits = [k for k, signs in enumerate(quality._KINDS) if byte < 128 and chr(byte) in signs]
            kinds[hits[0] if hits else len(quality._KINDS) + (byte > 127)] += 1
        row = [k / len(part) for k in kinds]
        row += [sum(i >= b and words[i][2] == words[i - b][2] for i in range(low, low + len(own))) / len(own) for b in (1, 2, 3, 4)]
        long = [b - a for a, b, _ in own]
        row += [sum(long) / len(own) / 10, sum(min(x, 40) ** 2 for x in long) / len(own) / 100, len(own) / quality.PASSAGE]
        buckets = [0.0] * quality.BUCKETS
        for h in hashes[low : low + len(own)]:
            buckets[int(h) % quality.BUCKETS] += 1 if int(h) >> 40 & 1 else -1
        rows = rows if low else []
        rows.append(row + [b / math.sqrt(len(own)) for b in buckets])
    codes, weights = [], []
    for row in rows:
        x = (np.array(row) - net.mean) / net.scale
        h = [math.tanh(x @ net.p["W"][:, j] + net.p["b"][j]) for j in range(len(net.p["b"]))]
        gate = lambda name, j: sum(a * b for a, b in zip(h, net.p[name][:, j]))
        weights.append(math.exp(sum(
            math.tanh(gate("V", j)) / (1 + math.exp(-gate("U", j))) * w for j, w in enumerate(net.p["w"])
        )))
        codes.append(h)
    mean = [sum(w * h[j] for w, h in zip(weights, codes)) / sum(weights) for j in range(len(codes[0]))]
    return 1 / (1 + math.exp(-(sum(a * b for a, b in zip(mean, net.p["c"])) + net.p["c0"][0])))


def test_scores_by_loops(spark, monkeypatch):
    monkeypatch.setattr(quality, "_BLOCK", 3)  # texts of several blocks
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").selectExpr("doc_id", "quality label")
    net = quality.train(docs, labels)
    texts = [r.text for r in docs.collect()] + [None, "", " \n", "é" * 9, "a a " * 400]
    got = net.score(quality._texts(pa.record_batch([pa.array(texts)], ["text"]), 0))
    assert len(got) == len(texts)
    assert all(math.isclose(a, plain_score(net, t), rel_tol=1e-4, abs_tol=1e-6) for a, t in zip(got, texts))


def test_quality_knows_words(spark):
    """Good and bad texts have the same letters, lengths and marks; only their words differ."""
    draw = random.Random(4)
    stems = ["".join(draw.sample("abcdefghijklmnop", 6)) for _ in range(120)]
    rows = []
    for d in range(900):
        own = stems if d % 2 else [w[::-1] for w in stems]
        rows.append((d, " ".join(draw.choice(own) for _ in range(draw.randint(30, 300))), d % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    held = F.col("doc_id") >= 600
    got = quality.quality_scores(docs.drop("label"), docs.select("doc_id", "label"), held).where("held_out").collect()
    assert sum(r.predicted == r.doc_id % 2 for r in got) >= 0.97 * len(got)


def test_long_texts_are_learnt_from_evenly_and_labels_are_checked(spark):
    text = " ".join(f"w{k}" for k in range(quality.PASSAGE * 50))
    (count, blocks), = quality._texts(pa.record_batch([pa.array([text])], ["text"]), 0)
    whole = np.concatenate(list(blocks))
    (_, blocks), = quality._texts(pa.record_batch([pa.array([text])], ["text"]), 0)
    few = quality._bag(count, blocks, 8)
    assert len(whole) == 50 and np.array_equal(few, whole[[0, 7, 14, 21, 28, 35, 42, 49]])
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="neither 0 nor 1"):
        quality.train(docs, spark.createDataFrame([(1, 2)], "doc_id long, label int"))


def test_all_passages_of_all_labelled_documents_are_learnt_from(spark, monkeypatch):
    draw = random.Random(6)
    good, bad = ([a + b + c for a in x for b in x for c in x] for x in (("ka", "lo", "mi"), ("ru", "se", "to")))
    rows = [(d, " ".join(draw.choice(good if d % 2 else bad) for _ in range(draw.choice([5, 100, 6000]))), d % 2) for d in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    learnt, plain = [], quality._fit_shards
    monkeypatch.setattr(quality, "_fit_shards", lambda net, shards, documents: (
        learnt.append((shards.agg(F.count(F.lit(1)), F.sum(F.length("bag")), F.countDistinct("shard")).first(), documents)),
        plain(net, shards, documents),
    ))
    net = quality.train(docs.drop("label"), docs.select("doc_id", "label"), shard_passages=3000)
    passages = sum(-(-len(t.split()) // quality.PASSAGE) for _, t, _ in rows)
    ((count, size, shards), documents), = learnt
    assert documents == count == 400 and size == passages * quality._PACKED and shards == -(-passages // 3000) > 1
    fresh = [(d, " ".join(draw.choice(good if d % 2 else bad) for _ in range(50))) for d in range(60)]
    got = net.score(quality._texts(pa.record_batch([pa.array([t for _, t in fresh])], ["text"]), 0))
    assert sum((score >= 0.5) == d % 2 for (d, _), score in zip(fresh, got)) >= 57
    again = quality.train(docs.drop("label").repartition(7), docs.select("doc_id", "label"), shard_passages=3000)
    assert np.allclose(net.state(), again.state(), rtol=1e-9, atol=1e-9)


def test_packed_passages_and_gradients_by_blocks(monkeypatch):
    text = " ".join(f"w{k % 37}{'!' * (k % 5)}" for k in range(quality.PASSAGE * 20 + 9))
    raw = pa.record_batch([pa.array([text, "", "a B c"])], ["text"])
    bags = [np.concatenate(list(blocks)) for _, blocks in quality._texts(raw, 0)]
    packed = [quality._packed(b) for b in bags]
    assert all(np.array_equal(quality._unpacked(p), b) for p, b in zip(packed, bags))
    net, label = quality.Network(), np.array([1.0, 0, 1])
    net.p["c"] = np.random.default_rng(1).normal(size=24)
    whole = net._slope(packed, label)
    monkeypatch.setattr(quality, "_BLOCK", 4)
    by_blocks = net._slope(packed, label)
    assert all(np.allclose(whole[k], by_blocks[k]) for k in whole)


# language model


def plain_scores(texts, learn, order):
    """Interpolated modified Kneser-Ney of any order, from dictionaries."""
    tok = lambda t: [*(t or "").encode().lower().split(), "end"]
    grams = lambda words, n: zip(*[([*["begin"] * (n - 1), *words])[k:] for k in range(n)])
    raw = Counter(w for d in learn for w in tok(texts[d]))
    # values of each order: counts at the top, below it how many words stand before
    values = {order: Counter(g for d in learn for g in grams(tok(texts[d]), order))}
    for k in range(order - 1, 0, -1):
        values[k] = Counter(g[1:] for g in values[k + 1])

    def cuts(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) if n[k - 1] else 0.5 for k in (1, 2, 3)]

    cut = {k: cuts(values[k].values()) for k in values}
    total, left = defaultdict(int), defaultdict(float)
    for k, of in values.items():
        for g, c in of.items():
            total[g[:-1]] += c
            left[g[:-1]] += cut[k][min(c, 3)]
    v = len(raw)

    def chance(g):
        k, context = len(g), g[:-1]
        lower = chance(g[1:]) if k > 1 else 1 / (v + 1)
        if not total[context]:
            return lower
        c = values[k][g]
        return max(c - cut[k][min(c, 3)], 0) / total[context] + left[context] / total[context] * lower

    n = sum(raw.values())
    out = {}
    for d, t in texts.items():
        words = tok(t)
        score = sum(math.log10(chance(g)) for g in grams(words, order))
        base = sum(math.log10((raw[w] + 1) / (n + v + 1)) for w in words)
        out[d] = (len(words), sum(raw[w] > 0 for w in words), n, base, score)
    return out


def check_scores(found, texts, learn, order=3):
    want = plain_scores(texts, learn, order)
    assert len(found) == len(texts)
    for r in found:
        size, known, n, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-7), r


def test_scores_equal_dictionaries(spark, sf, monkeypatch):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    learn = [d for d in texts if zlib.crc32(str(d).encode()) % 7 != 2]
    check_scores(op_queries.QUERIES["op8_kneser_ney"](spark, sf).collect(), texts, learn)
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id % 3 = 0")
    some = {d: t for d, t in texts.items() if d % 3 == 0}
    for order in (1, 2, 4):
        found = kneser_ney.language_scores(docs, id_crc32() % 7 != 2, order=order).collect()
        check_scores(found, some, [d for d in learn if d in some], order)


def test_packed_grams_are_small_and_whole():
    """Triples of numbered words come back as they were, in far fewer bytes than three hashes take."""
    draw = np.random.default_rng(3)
    words = [np.minimum(draw.zipf(1.3, 50_000), 1 << 20).astype(np.uint64) for _ in range(3)]
    keys, words, (counts,) = kneser_ney._merged(kneser_ney.gram_hash(words), words, [np.ones(50_000, np.uint64)])
    columns = [counts, draw.integers(0, 1 << 40, len(keys)).astype(np.uint64) * (counts > 2)]
    shards, sizes, blobs = zip(*kneser_ney._dealt(keys, words, columns, 2))
    assert sum(sizes) == len(keys) and sum(map(len, blobs)) < 10 * len(keys)
    back, sums = kneser_ney._opened(list(blobs), list(sizes), 3, 2)
    got, want = sorted(zip(*(x.tolist() for x in [*back, *sums]))), sorted(zip(*(x.tolist() for x in [*words, *columns])))
    assert got == want


def test_each_order_is_looked_up_once_a_chunk(spark, monkeypatch):
    """What stands before a word is what the word before ends: its table is not asked a second time."""
    texts = {d: " ".join(f"w{d * k % 7}" for k in range(40)) for d in range(1, 20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    model = kneser_ney.train(docs.select("text"), Workspace(spark, "look-ups"))
    asked, look_up = [], kneser_ney._Arrays.look_up
    monkeypatch.setattr(kneser_ney._Arrays, "look_up", lambda self, order, *a: asked.append(order) or look_up(self, order, *a))
    monkeypatch.setattr(kneser_ney, "MAPPED", 2)  # files are closed and opened again
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values())), pa.array([True] * len(texts))], ["d", "t", "l"])
    found = pa.Table.from_batches(list(kneser_ney._score(model)(iter([batch])))).to_pylist()
    check_scores([Row(**r) for r in found], texts, list(texts))
    assert sorted(asked) == [0, 1, 2, 3]


def test_hashes_alike_in_leading_bits_are_sorted_and_found(tmp_path):
    draw = np.random.default_rng(5)
    keys = np.unique(draw.integers(0, 1 << 64, 3000, dtype=np.uint64))
    close = np.uint64(0x3123456789ABC000) + np.arange(40, dtype=np.uint64)
    alike = close[0] + np.arange(40, dtype=np.uint64) * np.uint64(1 << 17)  # the same 32 bits behind those of the bucket
    for all_keys in (np.append(keys, close), np.append(keys, alike), close, close[:1], keys[:0]):
        given = draw.permutation(np.append(all_keys, all_keys[::2]))
        got, place = kneser_ney._distinct(given)
        assert (got == np.unique(all_keys)).all() and (got[place] == given).all()
    keys = np.unique(np.append(keys, alike))
    for shard in range(4):
        own = keys[keys >> np.uint64(62) == shard]
        kneser_ney._write_table(tmp_path.as_uri(), f"3-{shard}", own, [own >> np.uint64(16)], 2)
    other = alike + np.uint64(1 << 30)
    for arrays in (kneser_ney._Arrays(kneser_ney.Model(tmp_path.as_uri(), 2, 3, 0, 0, 0, ())) for _ in range(2)):
        assert (arrays.look_up(3, keys)[0][:, 0] == (keys >> np.uint64(16)).astype(np.int64)).all()
        assert not arrays.look_up(3, other)[0].any()
        arrays.mapped = False


def test_grams_too_wide_for_one_number_come_back_whole():
    draw = np.random.default_rng(6)
    for width in (20, 40, 63):
        words = [draw.integers(1, 1 << width, 5000).astype(np.uint64) for _ in range(3)]
        keys, words, (counts,) = kneser_ney._merged(kneser_ney.gram_hash(words), words, [np.ones(5000, np.uint64)])
        _, sizes, blobs = zip(*kneser_ney._dealt(keys, words, [counts], 3))
        back, sums = kneser_ney._opened(list(blobs), list(sizes), 3, 1)
        assert sorted(zip(*(x.tolist() for x in [*back, *sums]))) == sorted(zip(*(x.tolist() for x in [*words, counts])))


def test_small_shards_are_packed_together(monkeypatch):
    """Thousands of shards are put in order at once; small and large values of senders of unlike widths come back whole."""
    draw, sorts, by_words = np.random.default_rng(7), [], kneser_ney._by_words
    monkeypatch.setattr(kneser_ney, "_by_words", lambda *a: sorts.append(1) or by_words(*a))
    rows, sent = [], Counter()
    for width in (5, 12, 30):
        words = [draw.integers(0, 1 << width, 4000).astype(np.uint64) for _ in range(2)]
        values = [draw.choice([0, 1, 2, 3, 4, 255, 256, (1 << 40) + width], 4000).astype(np.uint64) for _ in range(5)]
        keys, words, sums = kneser_ney._merged(kneser_ney.gram_hash(words), words, values)
        sent.update(zip(*(x.tolist() for x in [*words, *sums])))
        rows += kneser_ney._dealt(keys, words, sums, 11)
    assert len(sorts) == 3 and kneser_ney._dealt(keys[:0], [w[:0] for w in words], [c[:0] for c in sums], 11) == []
    got, shards = Counter(), {s for s, _, _ in rows}
    for shard in shards:
        sizes, blobs = zip(*((n, b) for s, n, b in rows if s == shard))
        words, sums = kneser_ney._opened(list(blobs), list(sizes), 2, 5)
        assert (kneser_ney._shard(kneser_ney.gram_hash(words), 11) == shard).all()
        got.update(zip(*(x.tolist() for x in [*words, *sums])))
    assert len(shards) > 1500 and got == sent


def test_scores_of_odd_rows(spark):
    texts = {1: None, 2: "", 3: "a b a b c", 4: "A  b\nnever", 5: "a " * 100_000, 6: "é"}
    docs = spark.createDataFrame([(d, t, 1.0) for d, t in texts.items()], "doc_id long, text string, score double").repartition(3)
    for order in (2, 3):
        check_scores(kneser_ney.language_scores(docs, F.col("doc_id") < 6, order=order).collect(), texts, [1, 2, 3, 4, 5], order)
        check_scores(kneser_ney.language_scores(docs, F.lit(False), order=order).collect(), texts, [], order)
    assert kneser_ney.language_scores(docs.limit(0), F.lit(True)).count() == 0


# packing


def check_packing(rows, texts):
    plain, at = Tokenizer.from_file(PATH), defaultdict(list)
    for d, t in texts:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            at[d].append((k // 2048, k, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in at.items()}
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(n for _, n in parts) <= 2048
    return len(bins), -(-sum(r.length for r in rows) // 2048)


def test_packed_sequences(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bins, least = check_packing(op_queries.QUERIES["op9_packing"](spark, sf).collect(), texts)
    assert bins <= least + 1


def test_packing_of_odd_rows_and_many_tasks(spark):
    draw = random.Random(4)
    texts = [(1, None), (2, ""), (3, "<|endoftext|> it's X́ İ <|STARTOFTEXT|>"), (4, "word " * 5000), (5, "don't.'s ΟΔΟΣ. 12½ _a_!!"), (None, "x"), (None, "x")]
    texts += [(10 + k, "a " * draw.randint(1, 900)) for k in range(400)]
    docs = spark.createDataFrame([(d, t, 7) for d, t in texts], "doc_id long, text string, length int").repartition(3)
    assert len(check_packing(packing.packed_documents(docs, PATH).collect(), texts)) == 2
    pieces = packing.tokenised(docs, PATH, capacity=2048, end=0)
    bins, least = check_packing(packing.pack(pieces, capacity=2048, share=60).collect(), texts)
    assert bins <= least + 3
    assert packing.packed_documents(docs.limit(0), PATH).count() == 0


def test_words_whose_last_letter_brings_a_mark():
    """Letters that decompose or lower to several signs, before each sign that may end a word."""
    whole, encoder = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    odd = [c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x20000)]) if len(unicodedata.normalize("NFC", c).lower()) > 1]
    assert len(odd) > 50 and "\u0130" in odd and "\u0958" in odd
    words = ["VAL\u0130L\u0130\u011e\u0130,", "\u0130STANBUL VAL\u0130L\u0130\u011e\u0130, ANKARA", "e\u0301.", "\u00c9t\u00c9!", "\u1e9e?", "a\u0308,"]
    words += [f"{c}{t}" for c in odd for t in ",.*_"] + [f"x{c}{chr(t)}" for c in odd[:12] for t in packing._TAIL]
    for w in words:
        assert encoder.ids(w) == np.asarray(whole.encode(w, add_special_tokens=False).ids, "<u4").tobytes(), w


def test_remembered_words_are_bounded():
    """Over 300,000 different words: few stay, words that come again do, and forgotten ones get the same ids."""
    encoder = packing.Encoder(PATH)
    letters = [a + b for a in "abcdefghijklmnop" for b in "qrstuvwxyzklmnop"]
    first = encoder.ids("qaqa again, kept")
    for a in letters:
        encoder.ids("again, kept " + " ".join(f"{a}{b}{c}" for b in letters for c in ("a", "e,", "i", "o.", "ox")))
    held = [set(v) for v in vars(encoder).values() if isinstance(v, dict)]
    assert sum(map(len, held)) <= 300_000
    assert any(b"kept" in v for v in held) and not any(b"qaqa" in v for v in held)
    assert encoder.ids("qaqa again, kept") == first


def improving(bins, sizes, capacity):
    """Whether any move or exchange of one or two for one raises squared fill; by trying all."""
    fill = [sum(sizes[k] for k in b) for b in bins]
    for a in range(len(bins)):
        gives = [(sizes[k],) for k in bins[a]] + [(sizes[i], sizes[j]) for i in bins[a] for j in bins[a] if i < j]
        for b in range(len(bins)):
            if a != b:
                for given in gives:
                    for taken in [0] + [sizes[k] for k in bins[b]]:
                        d = sum(given) - taken
                        if 0 < d <= capacity - fill[b] and (fill[a] - d) ** 2 + (fill[b] + d) ** 2 > fill[a] ** 2 + fill[b] ** 2:
                            if len(given) == 1 or taken:
                                return True
    return False


def test_local_search_runs_to_its_end():
    draw = random.Random(12)
    for turn in range(40):
        low, high = draw.choice([(1, 40), (34, 38), (20, 60), (45, 70)])
        sizes = [draw.randint(low, high) for _ in range(draw.randint(2, 40))]
        bins = packing.local_search(packing.best_fit(sizes, 100), sizes, 100)
        assert sorted(k for b in bins for k in b) == list(range(len(sizes)))
        open_bins = [b for b in bins if sum(sizes[k] for k in b) < 99]
        assert not improving(open_bins, sizes, 100)


def test_local_search_only_improves():
    draw = random.Random(1)
    for _ in range(60):
        sizes = [draw.randint(1, 90) for _ in range(draw.randint(1, 60))]
        bad = [[k] for k in range(len(sizes))]
        done = packing.local_search(bad, sizes, 100)
        assert sorted(k for b in done for k in b) == list(range(len(sizes)))
        assert all(sum(sizes[k] for k in b) <= 100 for b in done)
        assert len(done) <= len(sizes) and len(packing.local_search(packing.best_fit(sizes, 100), sizes, 100)) <= len(packing.best_fit(sizes, 100))
    # 45+35+20 and 50+30+20 need exchanges once best fit has put 50 with 45
    assert len(packing.local_search([[0, 1], [2, 3], [4, 5]], [50, 45, 35, 30, 20, 20], 100)) == 2


# archives


def test_archives_of_odd_rows(spark):
    big = "<p>é</p>" * 200_000
    rows = [(1, "http://a b/\n", "x", "u"), (2, None, "x", "u"), (3, "u", None, None), (4, "u", "", None), (None, "u", "x", None), (5, "u", big, None), (9, "u", "x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(3)
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    b32 = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert {k: (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for k, r in got.items()} == {
        1: ("revisit", 9, 1, b32("x")), 2: ("revisit", 9, 1, b32("x")), 9: ("response", None, 1, b32("x")),
        3: ("revisit", 4, 0, b32("")), 4: ("response", None, 0, b32("")), None: ("response", None, 1, b32("x")),
        5: ("response", None, len(big.encode()), b32(big)),
    }
    assert warc.round_trip(pages.limit(0)).count() == 0
    assert {r.record_type for r in warc.round_trip(pages, least=2).collect()} == {"response"}


def test_normaliser_takes_one_stream_or_many(tmp_path):
    records = [warc.record(k, "http://a/", b"body\r\n\r\n" * (k * 40_000), "A" * 32, None, "2024") for k in range(1, 5)]
    one = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = one.compress(b"".join(records)) + one.flush()
    parts = b"".join((lambda z: z.compress(r) + z.flush())(zlib.compressobj(6, zlib.DEFLATED, 31)) for r in records)
    for name, data in (("whole", whole), ("parts", parts)):
        (tmp_path / name).write_bytes(data)
        out = tmp_path / f"{name}.out"
        assert warc.normalise_file(f"file://{tmp_path}/{name}", f"file://{out}") == 4
        for line, want in zip((tmp_path / f"{name}.out.idx").read_text().splitlines(), records):
            offset, length, kind, identity = line.split(" ")
            assert zlib.decompress(out.read_bytes()[int(offset) : int(offset) + int(length)], 31) == want and kind == "response"
    (tmp_path / "cut").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(ValueError):
        warc.normalise_file(f"file://{tmp_path}/cut", f"file://{tmp_path}/cut.out")


# decontamination


def test_subsequence_length_by_bits():
    draw = random.Random(2)
    for _ in range(300):
        a, b = ([draw.randrange(5) for _ in range(draw.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        masks = {w: sum(1 << k for k, x in enumerate(a) if x == w) for w in set(a)}
        assert decontaminate.common_subsequence(masks, b) == table[-1][-1]


def test_leaks_exact_and_paraphrased(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    truth = set(con.execute(
        f"SELECT doc_id, item_id FROM '{sf}/documents.parquet' d JOIN '{sf}/benchmark.parquet' b ON contains(d.text, b.text)"
    ).fetchall())
    got = op_queries.QUERIES["op6_decontaminate"](spark, sf).collect()
    assert len(truth & {(r.doc_id, r.item_id) for r in got}) >= 0.9 * len(truth)
    assert len({(r.doc_id, r.item_id) for r in got} - truth) <= 0.05 * len(truth) + 1
    draw = random.Random(6)
    vocabulary = [f"term{k}" for k in range(3000)]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(30))) for k in range(40)]
    rows, want = [], set()
    for k, text in items[:25]:
        words = text.split()
        for gone in sorted(draw.sample(range(30), 8), reverse=True):
            words[gone : gone + 1] = draw.choice([[], ["other"]])
        noise = [f"noise{draw.randrange(5000)}" for _ in range(400)]
        at = draw.randrange(380)
        rows.append((k, " ".join(noise[:at] + words + noise[at:]), "x"))
        want.add((k, k))
    rows += [(100 + k, " ".join(draw.choice(vocabulary) for _ in range(300)), "x") for k in range(40)]
    rows += [(None, items[30][1], "x"), (500, None, "x"), (501, "", "x"), (502, "noise " * 200_000 + items[31][1], "x"), (502, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*items, (77, None), (78, ""), (79, items[0][1])], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert found == want | {(0, 79), (None, 30), (502, 31)}
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0 == decontaminate.leaks(docs, bench.limit(0)).count()


def plain_leaks(documents, items):
    """All pairs: somewhere in the document, a span of twice the item holds most of it in order."""
    words = {k: re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) for k, t in items}
    texts = [(d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())) for d, t in documents]
    seen = Counter(w for _, ws in texts for w in set(ws))
    out = set()
    for k, own in words.items():
        masks = {w: sum(1 << i for i, x in enumerate(own) if x == w) for w in set(own)}
        answer = set(sorted(masks, key=lambda w: (seen[w], w))[:3])
        for d, ws in texts:
            inside = [(i, w) for i, w in enumerate(ws) if w in masks]
            for at in range(0, max(1, len(ws)), max(1, len(own) // 2)):
                span = [w for i, w in inside if at <= i < at + 2 * len(own)]
                if len(span) >= 0.5 * len(own):
                    lcs = decontaminate.common_subsequence(masks, span)
                    if lcs >= 0.7 * len(own) or lcs >= 0.5 * len(own) and answer <= set(span):
                        out.add((d, k))
                        break
    return out


@pytest.mark.parametrize("share", [decontaminate.SHARE, None])
def test_leaks_against_all_pairs(spark, share):
    """Recall over all document-item pairs, by the cosine alone as well."""
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = plain_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench, share=share).collect()}
    assert len(want) > 20 and len(want & got) >= 0.9 * len(want)
    assert len(got - want) <= 0.1 * len(want) + 1


def test_leaks_of_paraphrases_by_other_words(spark):
    """Every meaning has two words that the corpus uses in the same company; the paraphrase has the other one of most."""
    draw = random.Random(23)
    word = lambda topic, m, form: f"t{topic}m{m}{form}"
    said = lambda topic, n: [word(topic, draw.randrange(25), draw.choice("ab")) for _ in range(n)]
    corpus = [(1000 + k, " ".join(said(k % 20, 160))) for k in range(600)]
    items, rows, want = [], [], set()
    for k in range(20):
        own = [word(k, m, "a") for m in draw.sample(range(25), 25)]
        answer = [f"name{k}x{j}" for j in range(3)]
        text = own[:8] + answer[:1] + own[8:16] + answer[1:2] + own[16:] + answer[2:]
        items.append((k, " ".join(text)))
        other = [w[:-1] + "b" if w[0] == "t" and draw.random() < 0.62 else w for w in text]
        before, after = said((k + 7) % 20, 90), said((k + 11) % 20, 90)
        rows.append((k, " ".join(before + other + after)))
        want.add((k, k))
        rows.append((200 + k, " ".join(said(k, 150))))  # about the same, without the answer
        rows.append((300 + k, " ".join(said((k + 3) % 20, 60) + answer + said((k + 5) % 20, 60))))  # the answer in other company
    docs = spark.createDataFrame(corpus + rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, bench).collect()}
    assert len(want & set(found)) >= 18 and not set(found) - want
    assert sum(r.lcs < 0.5 * r.item_words for r in found.values()) >= 10
    # no plain count of common words would do: most lines of the paraphrase are not the item's
    assert sum(r.lcs for r in found.values()) < 0.55 * sum(r.item_words for r in found.values())


def test_the_space_holds_the_main_directions(spark):
    """Against numpy's decomposition of the same rows."""
    draw = np.random.default_rng(5)
    topics = draw.integers(1, 400, (6, 40))
    rows = np.sort(np.take_along_axis(topics[draw.integers(0, 6, 900)], draw.integers(0, 40, (900, 32)), 1), axis=1).astype("<u2")
    weights = np.concatenate([[0.0], 1 + draw.random(399)])
    df = spark.createDataFrame([(r.tobytes(), 1.0) for r in rows], "words binary, weight double").repartition(5)
    got = decontaminate.latent_space(df, "<u2", weights, 6)
    dense = np.zeros((900, 400))
    np.add.at(dense, (np.repeat(np.arange(900), 32), rows.ravel()), weights[rows.ravel()])
    norms = np.linalg.norm(weights[rows], axis=1)
    _, values, main = np.linalg.svd(dense / norms[:, None], full_matrices=False)
    assert np.allclose(got.T @ got, np.eye(6), atol=1e-3)
    kept = np.linalg.norm((dense / norms[:, None]) @ got, axis=0)
    assert np.allclose(np.sort(kept)[::-1], values[:6], rtol=0.02)


def test_leaks_of_long_items_and_full_blocks(spark):
    draw = random.Random(16)
    items = [(k, " ".join(f"term{draw.randrange(20_000)}" for _ in range(n))) for k, n in enumerate([10, 600, 2000, *[30] * 300])]
    rows = []
    for k, text in items:
        noise = [f"noise{draw.randrange(5000)}" for _ in range(200)]
        at = draw.randrange(200)
        rows.append((k, " ".join([*noise[:at], text, *noise[at:]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {(r.doc_id, r.item_id, r.lcs) for r in decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == {(k, k, len(text.split())) for k, text in items}


@pytest.mark.parametrize("fillers", [100, 20_000])
def test_leaks_of_common_words_at_any_document_count(spark, fillers):
    draw = random.Random(17)
    words = [f"term{k}" for k in range(160)]
    shuffled = draw.sample(words, 160)
    items = [(k, " ".join(shuffled[16 * k : 16 * k + 16])) for k in range(10)]
    items += [(10 + k, " ".join(draw.sample(words, 8))) for k in range(10)]
    noise = lambda n: [f"noise{draw.randrange(5000)}" for _ in range(n)]
    rows = [(k, " ".join([*noise(90 + 3 * k), text, *noise(100)])) for k, text in items]
    rows += [(1000 + k, " ".join(draw.sample([*draw.sample(words, 32), *noise(40)], 72))) for k in range(fillers)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.where("doc_id < 1000").collect()} == {(k, k) for k, _ in items}


# line rules


def test_line_rules_on_odd_rows(spark):
    good = "This is one good line of text that has more than ten words.\nAnd another one."
    rows = [
        (1, None), (2, ""), (3, good), (3, good), (None, good), (4, good + "\nHome | About | News | Contact | Login | Help | More | Even more | And more | Last | One | Two"),
        (5, "THIS!! IS!! A!! LINE!! THAT!! SHOUTS!! AT!! YOU!! ALL!! THE!! TIME!!"), (6, "a b c d e f " * 50_000),
        (7, good + "\nAll rights reserved."), (8, "same line here\n" * 3 + "\n\n x y z w v u t s r q"),
    ]
    got = clean_lines(spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, words string")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert (by[1].n_words, by[1].kept, by[1].clean_text) == (0, False, None) and by[2].clean_text == ""
    assert by[3].kept and by[None].kept and by[3].clean_text == good and not by[5].kept and by[6].base_failed
    assert by[7].kept and by[7].clean_text == good and by[7].n_failed_lines == 1 and by[4].clean_text == good
    assert by[6].n_repeat_words == by[6].n_words == 300_000
    assert (by[8].n_dup_lines, by[8].n_repeat_words) == (2, 9)
    assert clean_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_rules_query_returns_the_cleaning(spark, sf):
    got = {r.doc_id: (r.clean_chars, r.clean_sha256) for r in op_queries.QUERIES["op10_line_rules"](spark, sf).collect()}
    clean = {r.doc_id: r.clean_text for r in clean_lines(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert got == {d: (None, None) if t is None else (len(t), hashlib.sha256(t.encode()).hexdigest()) for d, t in clean.items()}


def test_repeated_words_by_brute_force(spark):
    draw = random.Random(8)
    rows = [(k, " ".join(draw.choice("ab") + draw.choice("cd") for _ in range(draw.randrange(40)))) for k in range(300)]
    got = {r.doc_id: r.n_repeat_words for r in clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        assert got[k] == len(covered)
