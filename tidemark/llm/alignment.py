"""Two tokenizers of one text, aligned by diagonal run skipping.

Both tokenizers cut the same bytes, so their tokens are known by where they end.  While both put their ends at the same places,
the two arrays of ends agree at a constant shift of the index; such a stretch is one run on a diagonal.  Runs are
jumped by exponential probing: one memory comparison of 4, 8, 16, ... ends at the current shift, then halving to the
last one that agrees.  Where the ends part, the two arrays are merged up to the next common end, which closes a group of
several tokens on either side and sets the shift anew.

Counts of id pairs need all documents.  Documents are gathered in blocks, each with the distinct pairs of its links, sorted,
and every link as a place in that list.  Only distinct pairs of blocks are shuffled: once to be counted, once to bring
counts back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import Workspace

#: Links of a block of documents, unless texts that are aligned together have more.
BLOCK_LINKS = 4_000_000
#: Characters of texts that are aligned together, and of the segments that a worker remembers.
CHARS, REMEMBERED = 1 << 20, 4_000_000
#: New segments that are encoded as one text.
GROUPED = 64
#: Tokens in a row that agree before probing begins.
WARM = 4

_word = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ÿ]+")  # one word for a byte-level tokenizer
_apart = re.compile(r"^ |\s |\s$")


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies use for each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


class Pair:
    """Two tokenizers: ids of a text under both, its bytes known to be whole.

    ``path_a`` is a byte-level file of tokenizers, ``path_b`` a sentencepiece model that puts a space before the text.
    Neither joins across the border between a visible character and the space behind it, which is asked of the files
    here; so texts are cut there and the ids of segments remembered.  Files of which that is not known encode whole texts.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.letters = {b: c for c, b in letters.items()}
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.bytes_a[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else b""
        self.bytes_b = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        state = self.a.pre_tokenizer.__getstate__() if self.a.pre_tokenizer else b""
        splits = b'"ByteLevel"' in state and b'"use_regex":true' in state and b'"add_prefix_space":false' in state
        joined = any("▁" in p.lstrip("▁") for p in map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self.cuts = splits and not joined and self.a.normalizer is None
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # segment to its place below
        self.chars = 0
        self.lost = np.zeros(0, bool)  # whether a tokenizer loses bytes of the segment
        self.ids, self.starts, self.sizes = ([np.zeros(0, np.int64)] * 2 for _ in range(3))  # where its ids are, and how many

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        if self.b.is_byte(k):
            return bytes([int(piece[1:-1], 16)])
        return b"" if self.b.is_control(k) or self.b.is_unknown(k) else piece.replace("▁", " ").encode()

    def segments(self, text: str) -> list[str]:
        """The text in segments, each to be encoded behind a space that is not in it."""
        if not self.cuts:
            return [text]
        parts = text.split(" ")
        if not _apart.search(text):
            return parts
        out, held = [], None
        for w in parts:
            w = w if held is None else f"{held} {w}"
            if not w or w[-1].isspace():  # spaces in a row stay together
                held = w
            else:
                out.append(w)
                held = None
        if held is not None:  # what ends in spaces stays with the segment before
            out[-1:] = [f"{out[-1]} {held}" if out else held]
        return out

    def _ids_a(self, words: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments and ids of each: ``words`` are letters only, ``others`` may stand one behind the other."""
        of_words = [[t.id for t in self.a.model.tokenize("Ġ" + w.encode().decode("latin-1").translate(self.letters))] for w in words]
        ids, sizes = np.fromiter(chain.from_iterable(of_words), np.int64), np.fromiter(map(len, of_words), np.int64, len(words))
        if not others:
            return ids, sizes
        joined = [" " + " ".join(others[k : k + GROUPED]) for k in range(0, len(others), GROUPED)]
        of_others = [x.ids for x in self.a.encode_batch_fast(joined, add_special_tokens=False)]
        more = np.fromiter(chain.from_iterable(of_others), np.int64)
        at, ends = np.cumsum(self.length_a[more]), np.cumsum([len(s.encode()) + 1 for s in others])
        last = np.minimum(np.searchsorted(at, ends), len(at) - 1)
        if (at[last] != ends).any():
            raise ValueError("the tokenizer joins segments")
        return np.concatenate([ids, more]), np.concatenate([sizes, np.diff(last, prepend=-1)])

    def _learn(self, segments: list[str]) -> None:
        """Remember new segments; and whether a tokenizer loses bytes of them."""
        words = [s for s in segments if self.cuts and _word.fullmatch(s)]
        taken = set(words)
        others = [s for s in segments if s not in taken and self.cuts and s and not s[-1].isspace()]
        taken.update(others)
        alone = [s for s in segments if s not in taken]
        ids_a, sizes_a = self._ids_a(words, others)
        each = [x.ids for x in self.a.encode_batch_fast([" " + s for s in alone], add_special_tokens=False)]
        ids_a = np.concatenate([ids_a, np.fromiter(chain.from_iterable(each), np.int64)])
        sizes_a = np.concatenate([sizes_a, np.fromiter(map(len, each), np.int64, len(each))])
        segments = words + others + alone
        of_b = self.b.encode(segments, num_threads=1)
        ids_b, sizes_b = np.fromiter(chain.from_iterable(of_b), np.int64), np.fromiter(map(len, of_b), np.int64, len(of_b))
        first = len(self.known)
        self.known.update(zip(segments, range(first, first + len(segments))))
        self.chars += sum(map(len, segments))
        raw = [b" " + s.encode() for s in segments]
        lost = np.zeros(len(raw), bool)
        for ids, sizes, letters in ((ids_a, sizes_a, self.bytes_a), (ids_b, sizes_b, self.bytes_b)):
            got = [letters[k] for k in ids.tolist()]
            ends = np.cumsum(sizes).tolist()
            whole = [b"".join(got[low:high]) for low, high in zip([0, *ends], ends)]
            lost |= np.fromiter((x != y for x, y in zip(whole, raw)), bool, len(raw))
        for k, (ids, sizes) in enumerate(((ids_a, sizes_a), (ids_b, sizes_b))):
            self.ids[k] = np.concatenate([self.ids[k], ids])
            self.sizes[k] = np.concatenate([self.sizes[k], sizes])
            starts = np.cumsum(sizes) - sizes + len(self.ids[k]) - len(ids)
            self.starts[k] = np.concatenate([self.starts[k], starts])
        self.lost = np.concatenate([self.lost, lost])

    def encoded(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids of all texts, ids of each text) for both tokenizers; none for a text that is empty or loses bytes."""
        if self.chars > REMEMBERED:
            self._forget()
        cut = [self.segments(t) if t else [] for t in texts]
        new = set().union(*cut).difference(self.known)
        if new:
            self._learn(sorted(new))
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, sizes.sum())
        text = np.repeat(np.arange(len(cut)), sizes)
        lost = np.zeros(len(cut), bool)
        lost[text[self.lost[at]]] = True
        if lost.any():
            at, text = at[~lost[text]], text[~lost[text]]
        out = []
        for ids, starts, own in zip(self.ids, self.starts, (s[at] for s in self.sizes)):
            place = np.arange(own.sum()) + np.repeat(starts[at] - (np.cumsum(own) - own), own)
            out.append((ids[place], np.bincount(text, own, len(cut)).astype(np.int64)))
        return out


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens on either side end a group; both arrays ascend and close with the same end."""
    a, b = ends_a.tolist(), ends_b.tolist()
    raw_a, raw_b = ends_a.astype("<i8").tobytes(), ends_b.astype("<i8").tobytes()
    size_a, size_b = len(a), len(b)
    last_a, last_b = bytearray(size_a), bytearray(size_b)
    i = j = run = 0
    while i < size_a:
        x, y = a[i], b[j]
        if x == y:
            last_a[i] = last_b[j] = 1
            i, j, run = i + 1, j + 1, run + 1
            if run < WARM:
                continue
            step, growing = WARM, True
            while step:
                if i + step <= size_a and j + step <= size_b and raw_a[8 * i : 8 * (i + step)] == raw_b[8 * j : 8 * (j + step)]:
                    last_a[i : i + step] = last_b[j : j + step] = b"\1" * step
                    i, j = i + step, j + step
                    step = 2 * step if growing else step // 2
                else:
                    step, growing = step // 2, False
            run = 0
            continue
        run = 0
        while x != y:  # merge to the next common end
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        last_a[i] = last_b[j] = 1
        i, j = i + 1, j + 1
    return np.frombuffer(last_a, np.uint8).astype(bool), np.frombuffer(last_b, np.uint8).astype(bool)


@dataclass(frozen=True)
class Aligned:
    """Tokens of some texts, one behind the other, under both tokenizers, and which of them end a group.

    ``sizes_a``, ``sizes_b``: tokens of each text.  Every text ends a group, so groups stay within texts.
    """

    a: np.ndarray
    b: np.ndarray
    sizes_a: np.ndarray
    sizes_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray

    def groups(self) -> np.ndarray:
        """Groups of each text."""
        total = np.concatenate([[0], np.cumsum(self.last_a)])
        ends = np.cumsum(self.sizes_a)
        return total[ends] - total[ends - self.sizes_a]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Id pairs, a << 32 | b, of all token pairs that share bytes, text by text, and links of each text.

        Every stretch between neighbouring ends lies in one token of each side and every such pair has one: that up to an
        end of a, or up to an end of b that is none of a.
        """
        under = np.searchsorted(self.ends_b, self.ends_a)
        inner = np.flatnonzero(~self.last_b)
        over = np.searchsorted(self.ends_a, self.ends_b[inner])
        codes = np.concatenate([self.a << 32 | self.b[under], self.a[over] << 32 | self.b[inner]])
        text_a = np.repeat(np.arange(len(self.sizes_a)), self.sizes_a)
        text = np.concatenate([text_a, text_a[over]])
        return codes[np.argsort(text, kind="stable")], np.bincount(text, minlength=len(self.sizes_a))

    def texts(self) -> Iterator[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        close_a, close_b = np.flatnonzero(self.last_a) + 1, np.flatnonzero(self.last_b) + 1
        out = np.empty(len(self.a) + len(self.b), object)
        before_b = np.concatenate([[0], close_b[:-1]])
        for ids, last, ending, place in (
            (self.a, self.last_a, b"|", np.arange(len(self.a)) + before_b[group_a] if len(self.a) else self.a),
            (self.b, self.last_b, b";", np.arange(len(self.b)) + close_a[group_b] if len(self.b) else self.b),
        ):
            table = _numerals(ending, int(ids.max(initial=0)) + 1)
            out[place] = table[ids + last * (len(table) // 2)]
        parts, ends = out.tolist(), np.cumsum(self.sizes_a + self.sizes_b).tolist()
        for low, high in zip([0, *ends], ends):
            yield b"".join(parts[low:high])[:-1]


_made: dict[bytes, np.ndarray] = {}


def _numerals(ending: bytes, least: int) -> np.ndarray:
    """0, 1, 2, ... in decimal, at least ``least`` of them, first with a comma behind, then all with ``ending``."""
    have = _made.get(ending)
    if have is None or len(have) < 2 * least:
        size = 1 << max(16, (least - 1).bit_length())
        have = np.empty(2 * size, object)
        have[:] = [b"%d%s" % (k, end) for end in (b",", ending) for k in range(size)]
        _made[ending] = have
    return have


def align(tokenizers: Pair, texts: list[str | None]) -> Aligned:
    (a, sizes_a), (b, sizes_b) = tokenizers.encoded(texts)
    ends_a, ends_b = np.cumsum(tokenizers.length_a[a]), np.cumsum(tokenizers.length_b[b])
    return Aligned(a, b, sizes_a, sizes_b, ends_a, ends_b, *group_ends(ends_a, ends_b))


def _aligned_rows(batch: pa.RecordBatch, path_a: str, path_b: str) -> Iterator[tuple[list[int | None], Aligned]]:
    """(doc_ids, alignment) of the rows of a batch of (doc_id, text), some texts at a time."""
    tokenizers = pair(path_a, path_b)
    ids, texts, low = batch.column(0).to_pylist(), batch.column(1), 0
    while low < len(ids):
        some, size = [], 0
        while low + len(some) < len(ids) and size < CHARS:
            some.append(texts[low + len(some)].as_py())
            size += len(some[-1] or "")
        yield ids[low : low + len(some)], align(tokenizers, some)
        low += len(some)


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def token_groups(docs: DataFrame, path_a: str, path_b: str, *, id_column="doc_id", text_column="text") -> DataFrame:
    """doc_id and the whole alignment of each text, as groups ``a1,a2|b1;a3|b2,b3``; empty without tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs_here, found in _aligned_rows(batch, path_a, path_b):
                groups = pa.array([x.decode() for x in found.texts()], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(docs_here, pa.int64()), groups], ["doc_id", "groups"])

    return _texts(docs, id_column, text_column).mapInArrow(run, "doc_id long, groups string")


_BLOCK = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs binary, documents binary, links binary"
)
_names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "documents", "links"]
_longs, _blob = pa.list_(pa.int64()), pa.binary()
_kinds = [pa.int64(), *[_longs] * 5, pa.list_(pa.string()), _blob, _blob, _blob]
_codec = "zstd"


def _packed(values: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: small ones leave the upper planes empty."""
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), _codec, asbytes=True)


def _unpacked(blob: bytes) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    planes = pa.decompress(blob[8:], 8 * size, _codec, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, size).T).view("<i8").reshape(-1)


def _block(number: int, rows: list[tuple], links: list[np.ndarray]) -> pa.RecordBatch:
    """A block: a column for each field of its documents, its distinct pairs, how many of its documents have each, and each
    document's links as ascending places among the pairs."""
    codes = np.concatenate(links)
    sizes = np.array([row[4] for row in rows])
    doc = np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(codes, kind="stable")  # documents stay in order within a pair
    codes, of = codes[order], doc[order]
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    fresh = new.copy()
    fresh[1:] |= of[1:] != of[:-1]
    first = np.flatnonzero(new)
    documents = np.add.reduceat(fresh, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    place = np.cumsum(new) - 1
    back = np.argsort(of, kind="stable")  # by document, places ascending
    place = place[back]
    steps = np.diff(place, prepend=0)
    starts = np.cumsum(sizes) - sizes
    head = starts[sizes > 0]
    steps[head] = place[head]
    fields = [list(c) for c in zip(*rows)]
    values = [number, *fields, _packed(np.diff(codes[first], prepend=0)), _packed(documents), _packed(steps)]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, _kinds)], _names)


def _blocks(path_a: str, path_b: str, block_links: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        rows, links, held = [], [], 0
        for batch in batches:
            for docs, found in _aligned_rows(batch, path_a, path_b):
                codes, sizes = found.links()
                if rows and held + len(codes) > block_links:
                    yield _block(number, rows, links)
                    number, rows, links, held = number + 1, [], [], 0
                digests = [hashlib.sha256(x).hexdigest() if x else "" for x in found.texts()]
                counts = (found.sizes_a, found.sizes_b, found.groups(), sizes)
                rows += zip(docs, *(c.tolist() for c in counts), digests)
                links.append(codes)
                held += len(codes)
        if rows:
            yield _block(number, rows, links)

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct pair of a block: its place there, the pair, documents of the block that have it."""
    for batch in batches:
        for block, pairs, documents in zip(*(c.to_pylist() for c in batch.columns)):
            codes = np.cumsum(_unpacked(pairs))
            columns = [np.full(len(codes), block), np.arange(len(codes), dtype=np.int32), codes, _unpacked(documents)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "place", "pair", "documents"])


_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _summed(blocks: pa.Table, counted: pa.Table) -> pa.Table:
    """The documents of a block with what their links count."""
    counts, best = np.zeros(len(counted), np.int64), np.zeros(len(counted), np.int64)
    place = counted["place"].to_numpy()
    counts[place], best[place] = counted["documents"].to_numpy(), counted["best"].to_numpy()
    (row,) = blocks.to_pylist()
    steps, sizes = _unpacked(row["links"]), np.array(row["n_links"], np.int64)
    ends = np.cumsum(sizes)
    walked = np.cumsum(steps)
    starts = ends - sizes
    before = np.where(starts > 0, walked[np.maximum(starts - 1, 0)], 0) if len(walked) else np.zeros(len(sizes), np.int64)
    links = walked - np.repeat(before, sizes)
    sums = []
    for values in (best, counts):
        total = np.concatenate([[0], np.cumsum(values[links])])
        sums.append(pa.array(total[ends] - total[starts]))
    fields = [pa.array(row[c], pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.Table.from_arrays([*fields, *sums, pa.array(row["groups_sha256"], pa.string())], names)


@dataclass(frozen=True)
class Alignment:
    """``documents``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.  ``pairs``: a, b, documents that
    hold a link of the two ids, best (whether no other b has more for this a)."""

    documents: DataFrame
    pairs: DataFrame


def alignment(
    docs: DataFrame, path_a: str, path_b: str, *, block_links: int = BLOCK_LINKS, id_column="doc_id", text_column="text"
) -> Alignment:
    """Align both tokenizers over every text, and count the id pairs of their links over all documents.

    Texts that are null or empty, or of which one tokenizer loses bytes, have no tokens, zeros and an empty digest.  Rows
    are documents of their own; ids may be null or repeat.  An empty table gives empty tables.
    """
    space = Workspace(docs.sparkSession, "alignment")
    blocks = _texts(docs, id_column, text_column).mapInArrow(_blocks(path_a, path_b, block_links), _BLOCK)
    blocks = space.store(blocks, "blocks")
    entries = blocks.select("block", "pairs", "documents").mapInArrow(_entries, "block long, place int, pair long, documents long")
    counts = entries.groupBy("pair").agg(F.sum("documents").alias("documents"))
    # one a has at most as many pairs as the other vocabulary has ids
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    best = (F.col("documents") == F.max("documents").over(of_a)).cast("int").alias("best")
    counts = space.store(counts.select("pair", "documents", best), "pairs")
    counted = entries.select("block", "place", "pair").join(counts, "pair").select("block", "place", "documents", "best")
    rows = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    documents = rows.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_summed, _DOCUMENT)
    pairs = counts.select(
        F.shiftright("pair", 32).cast("int").alias("a"),
        F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"),
        "documents",
        F.col("best").cast("boolean").alias("best"),
    )
    return Alignment(documents, pairs)
