"""Alignment of two tokenizers against plain merging of whole encodings."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.op_queries import QUERIES

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
LETTERS = {c: b for c, b in alignment.byte_letters().items()}
plain_a = Tokenizer.from_file(A)
plain_a.encode_special_tokens = True
plain_b = sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(text):
    """Ids and bytes under both, from whole texts; nothing where bytes differ."""
    if not text:
        return [], []
    a = [(k, bytes(LETTERS[c] for c in plain_a.id_to_token(k))) for k in plain_a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for k in plain_b.encode(text):
        piece = plain_b.id_to_piece(k)
        b.append((k, bytes([int(piece[3:5], 16)]) if plain_b.is_byte(k) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    return (a, b) if b"".join(x[1] for x in a) == raw == b"".join(x[1] for x in b) else ([], [])


def spans(tokens):
    at, out = 0, []
    for k, raw in tokens:
        out.append((at, at + len(raw), k))
        at += len(raw)
    return out


def plain(texts):
    """Rows of all documents, by comparing all neighbouring byte ranges."""
    found, documents = [], Counter()
    for text in texts:
        a, b = (spans(t) for t in plain_tokens(text))
        common = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, links, low = [], [], 0
        i = j = 0
        for high in common:
            own_a, own_b = [], []
            while i < len(a) and a[i][1] <= high:
                own_a.append(a[i])
                i += 1
            while j < len(b) and b[j][1] <= high:
                own_b.append(b[j])
                j += 1
            groups.append(",".join(str(x[2]) for x in own_a) + "|" + ",".join(str(x[2]) for x in own_b))
            links += [(x[2], y[2]) for x in own_a for y in own_b if x[0] < y[1] and y[0] < x[1]]
            low = high
        documents.update(set(links))
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    most = defaultdict(int)
    for (a, _), n in documents.items():
        most[a] = max(most[a], n)
    rows = []
    for n_a, n_b, n_groups, links, groups in found:
        best = sum(documents[x] == most[x[0]] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        rows.append((n_a, n_b, n_groups, len(links), best, sum(documents[x] for x in links), digest))
    pairs = {(a, b, n, n == most[a]) for (a, b), n in documents.items()}
    return rows, pairs, [f[4] for f in found]


BITS = [
    "the", "Alignment", "tokenizers", "'s", "don't", " ", "  ", "   ", "\n", "\t", "\r\n", "\n \n", "é", "é", "ß", "漢字", "🙂", " ", " ",
    "　", "1234", "3.14", "==>", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "…", "\x00", "\x1c", "\x1f", "​", "_", "a" * 70, "ﬁ", "\x85", "ŒŒ",
]


def drawn_texts(n, seed):
    draw = random.Random(seed)
    bits = BITS + [" "] * 25
    return ["".join(draw.choice(bits) for _ in range(draw.choice([0, 1, 3, 12, 40]))) for _ in range(n)]


def test_segments_give_the_ids_of_whole_texts():
    tokenizers = alignment.Pair(A, B)
    assert tokenizers.cuts
    texts = drawn_texts(4000, 1)
    check_ids(tokenizers, texts)


def check_ids(tokenizers, texts):
    (a, sizes_a), (b, sizes_b) = tokenizers.encoded(texts)
    a, b = (np.split(x, np.cumsum(sizes)[:-1]) for x, sizes in ((a, sizes_a), (b, sizes_b)))
    for text, got_a, got_b in zip(texts, a, b):
        want_a, want_b = plain_tokens(text)
        assert got_a.tolist() == [k for k, _ in want_a] and got_b.tolist() == [k for k, _ in want_b], text


def test_remembered_segments_are_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    tokenizers = alignment.Pair(A, B)
    for seed in range(8):
        check_ids(tokenizers, drawn_texts(20, seed))
    assert len(tokenizers.known) < 600


def test_whole_texts_where_cutting_is_not_safe():
    tokenizers = alignment.Pair(A, B)
    tokenizers.cuts = False
    texts = drawn_texts(300, 2)
    check_ids(tokenizers, texts)


def test_group_ends_are_the_common_ends():
    draw = random.Random(4)
    for _ in range(3000):
        size = draw.choice([1, 2, 5, 40, 300])
        apart = draw.choice([0.0, 0.02, 0.3, 0.9])
        shared = sorted(draw.sample(range(1, 5 * size + 2), size))
        ends = []
        for _ in range(2):
            own = {e for e in shared if draw.random() >= apart} | {e for e in range(1, shared[-1]) if draw.random() < apart / 5}
            ends.append(np.array(sorted(own | {shared[-1]}), np.int64))
        last_a, last_b = alignment.group_ends(*ends)
        common = np.intersect1d(*ends)
        assert (ends[0][last_a] == common).all() and (ends[1][last_b] == common).all()


def test_packed_numbers():
    for values in ([], [0], [5, -3, 2**62, -(2**62), 0], list(range(1000))):
        assert alignment._unpacked(alignment._packed(np.array(values, np.int64))).tolist() == values


@pytest.mark.parametrize("block_links", [4_000_000, 500])
def test_equals_plain_merging(spark, block_links):
    texts = [*drawn_texts(250, 5), "the same text", "the same text", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = alignment.alignment(docs, A, B, block_links=block_links)
    rows, pairs, groups = plain(texts)
    got = {r.doc_id: tuple(r)[1:] for r in found.documents.collect()}
    assert got == dict(enumerate(rows))
    assert {tuple(r) for r in found.pairs.collect()} == pairs
    assert {r.doc_id: r.groups for r in alignment.token_groups(docs, A, B).collect()} == dict(enumerate(groups))


def test_odd_rows(spark):
    texts = [None, "", " ", "\n\n  \n", "word " * 60_000, "x" * 50_000, "▁ is lost", "copy", "copy", "a  b   c"]
    rows = [(None if k == 7 else k % 9, t, 1, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pair int, block string").coalesce(1)
    want, _, _ = plain(texts)
    got = [tuple(r) for r in alignment.alignment(docs, A, B).documents.collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted([(r[0], *w) for r, w in zip(rows, want)], key=key)
    assert want[6][0] == 0 and want[4][0] > 0
    empty = alignment.alignment(docs.limit(0), A, B)
    assert empty.documents.collect() == [] and empty.pairs.collect() == []


def test_query_on_whole_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows, _, _ = plain([r.text for r in docs])
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_token_alignment"](spark, sf).collect()}
    assert got == {r.doc_id: row for r, row in zip(docs, rows)}
