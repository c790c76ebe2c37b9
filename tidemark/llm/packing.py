"""Packing of tokenised documents into sequences: best fit, then swaps between underfull bins.

Every task packs a share of the pieces.  Pieces go, longest first, into the fullest bin that still takes them.
Then documents are exchanged one for one, two for one, or moved between underfull bins wherever that raises the sum
of squared fills, so bins drift to full or empty and empty ones go.  Partners are looked up in a sorted list of
(length to be replaced, free room), so the search goes on until no such step is left between any two bins.  The
bins that stay underfull are dealt out again and packed anew, to as many tasks as their pieces need, while fewer
tasks are needed or fewer bins stay underfull: no task gets more than its share, and the last one sees what is left of all.
"""

from __future__ import annotations

import bisect
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import Workspace

#: Pieces that a task packs together.
SHARE = 20_000
#: Bins with fewer free tokens than this share of the capacity are left as they are.
NEARLY = 0.002
#: Words whose ids a worker remembers at most, half of them in each of two generations.
REMEMBERED = 300_000

_TAIL = b".,;:!?*$%&#|()/+=-\"<>[]{}~^_@`\\"
#: Letters and digits that stay one sign when they are normalised and lower-cased; behind others a mark may
#: come, which the tokenizer takes together with punctuation.
_PLAIN = frozenset(
    c.encode() for c in [*string.digits, *string.ascii_letters, *(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))]
)


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids of whole texts, put together from the remembered ids of their words.

    For tokenizers that never join across white space and drop it.  Texts with ``<|`` are encoded whole, since a
    special token is found before letters are lower-cased.  Words are remembered in two generations: a full one becomes
    the older, whose words come back when they are met again, and those that are not go with it.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return _packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: bytes) -> bytes:
        """Ids of a word that is not remembered; it is split before the ASCII punctuation at its end.

        Only the parts are remembered: there are far fewer of them than of words with all their endings.
        """
        core = word.rstrip(_TAIL)
        if core and len(core) < len(word):
            last = core[-1:] if core[-1] < 0x80 else core[-4:].decode("utf-8", "ignore")[-1:].encode()
            if last in _PLAIN:
                tail = word[len(core) :]
                return (self.known.get(core) or self._whole(core)) + (self.known.get(tail) or self._whole(tail))
        return self._whole(word)

    def _whole(self, word: bytes) -> bytes:
        ids = self.known.get(word) or self.older.get(word)
        if ids:
            return self._keep(word, ids)
        if word.isalpha():  # ASCII letters are one word for the tokenizer, so its model alone will do
            ids = _packed_ids([t.id for t in self.model.tokenize(word.decode())])
        else:
            ids = self._encode(word.decode("utf-8", "replace"))
        return self._keep(word, ids)

    def _keep(self, word: bytes, ids: bytes) -> bytes:
        if len(self.known) >= REMEMBERED // 2:
            self.known, self.older = {}, self.known
        self.known[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if "<|" in text:
            return self._encode(text)
        known, make = self.known.get, self._word
        return b"".join([known(w) or make(w) for w in text.encode().lower().split()])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(path: str, capacity: int, end: int):
    last = np.asarray([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(value.as_py() or "") + last
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def tokenised(docs: DataFrame, path: str, *, capacity: int, end: int, id_column="doc_id", text_column="text") -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32."""
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return slim.mapInArrow(_pieces(path, capacity, end), kind)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions, longest first, each into the fullest bin that takes it."""
    free: list[tuple[int, int]] = []  # (free tokens, bin), sorted
    bins: list[list[int]] = []
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[k]
        at = bisect.bisect_left(free, (size, -1))
        if at < len(free):
            room, b = free.pop(at)
            bins[b].append(k)
        else:
            room, b = capacity, len(bins)
            bins.append([k])
        if room > size:
            bisect.insort(free, (room - size, b))
    return bins


class _Partners:
    """What underfull bins could take, sorted: for each length in a bin (and 0, for nothing) the bin's free room."""

    def __init__(self, capacity: int):
        self.wide = capacity + 1
        self.keys, self.bins = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.count: dict[int, int] = {}  # bins that have the length

    def add(self, b: int, sizes: set[int], room: int) -> None:
        new = np.array(sorted({0, *sizes}), np.int64) * self.wide + room
        at = np.searchsorted(self.keys, new)
        self.keys, self.bins = np.insert(self.keys, at, new), np.insert(self.bins, at, b)
        for y in sizes:
            self.count[y] = self.count.get(y, 0) + 1

    def remove(self, b: int, sizes: set[int], room: int) -> None:
        old = np.array(sorted({0, *sizes}), np.int64) * self.wide + room
        low, high = np.searchsorted(self.keys, old), np.searchsorted(self.keys, old, "right")
        at = [lo + int(np.flatnonzero(self.bins[lo:hi] == b)[0]) for lo, hi in zip(low.tolist(), high.tolist())]
        self.keys, self.bins = np.delete(self.keys, at), np.delete(self.bins, at)
        for y in sizes:
            self.count[y] -= 1
            if not self.count[y]:
                del self.count[y]

    def best(self, given: np.ndarray, taken: np.ndarray) -> tuple[int, int, int, int] | None:
        """(room left, length given, length taken, bin) of the exchange that leaves the least room."""
        x, y = (v.ravel() for v in np.meshgrid(given, taken, indexing="ij"))
        more = x > y
        x, y = x[more], y[more]
        asked = y * self.wide + x - y
        at = np.searchsorted(self.keys, asked)
        fits = at < len(self.keys)
        fits[fits] = self.keys[at[fits]] < (y[fits] + 1) * self.wide
        if not fits.any():
            return None
        x, y, asked, at = x[fits], y[fits], asked[fits], at[fits]
        k = int((self.keys[at] - asked).argmin())
        return int(self.keys[at[k]] - asked[k]), int(x[k]), int(y[k]), int(self.bins[at[k]])


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Moves and exchanges between underfull bins, each raising the sum of squared fills, until there is none.

    A transfer of ``d`` tokens from a bin of fill ``a`` to one of ``b`` gains 2d(b - a) + 2d^2, which is above 0 where the
    other bin then holds more than the first did.  So of all partners the one that is filled best decides whether
    there is a step, and it is taken.  Squared fills are whole numbers with a bound: the search ends.
    """
    fills = [sum(lengths[k] for k in b) for b in bins]
    limit = capacity - max(1, int(capacity * NEARLY))
    items: dict[int, dict[int, list[int]]] = {}  # length to pieces, of each underfull bin
    partners = _Partners(capacity)
    for b, fill in enumerate(fills):
        if fill < limit:
            items[b] = {}
            for k in bins[b]:
                items[b].setdefault(lengths[k], []).append(k)
            partners.add(b, set(items[b]), capacity - fill)

    def step(giver: int) -> bool:
        own, nothing = items[giver], np.zeros(1, np.int64)
        single, held = np.array(sorted(own), np.int64), np.array(sorted(partners.count), np.int64)
        pairs = {}
        for given, taken in ((single, nothing), (single, held), (None, held)):
            if given is None:  # two for one
                sizes = single.tolist()
                pairs = {a + c: (a, c) for i, a in enumerate(sizes) for c in sizes[i:] if a != c or len(own[a]) > 1}
                given = np.array(sorted(pairs), np.int64)
            found = partners.best(given, taken) if len(given) and len(taken) else None
            if found and capacity - found[0] > fills[giver]:
                _, x, y, other = found
                partners.remove(other, set(items[other]), capacity - fills[other])
                _transfer(own, items[other], pairs[x] if x in pairs else (x,))
                _transfer(items[other], own, (y,) if y else ())
                fills[other] += x - y
                fills[giver] -= x - y
                if fills[other] < limit:
                    partners.add(other, set(items[other]), capacity - fills[other])
                return True
        return False

    moved = True
    while moved:
        moved = False
        for giver in sorted((b for b in items if items[b] and fills[b] < limit), key=lambda b: (fills[b], b)):
            if fills[giver] >= limit or not items[giver]:
                continue
            partners.remove(giver, set(items[giver]), capacity - fills[giver])
            while items[giver] and step(giver):
                moved = True
            if items[giver]:
                partners.add(giver, set(items[giver]), capacity - fills[giver])
    for b, held in items.items():
        bins[b] = [k for _, ks in sorted(held.items()) for k in ks]
    return [b for b in bins if b]


def _transfer(mine: dict[int, list[int]], other: dict[int, list[int]], sizes: tuple[int, ...]) -> None:
    for size in sizes:
        other.setdefault(size, []).append(mine[size].pop())
        if not mine[size]:
            del mine[size]


def _packed(capacity: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "start", "ids_crc32", "row"], ignore_index=True)
        lengths, rows = frame["length"].tolist(), frame["row"].to_numpy()
        lead, place, fill = (np.zeros(len(frame), np.int64) for _ in range(3))
        for keys in local_search(best_fit(lengths, capacity), lengths, capacity):
            at = 0
            for k in sorted(keys):
                place[k] = at
                at += lengths[k]
            lead[keys], fill[keys] = rows[min(keys)], at
        return frame.assign(sequence_id=lead, offset=place, fill=fill)

    return run


def pack(pieces: DataFrame, *, capacity: int, share: int = SHARE) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Sequences hold at most ``capacity`` tokens, gapless from 0.  Pieces of full length are sequences of their own.
    Others are dealt to tasks of about ``share`` pieces.  The underfull bins of a turn are opened and dealt out anew in the
    next, to tasks of as many pieces, as long as that takes fewer tasks or has left fewer of them; then they stay.
    """
    space = Workspace(pieces.sparkSession, "packing")
    stored = space.store(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    columns = [*pieces.columns, "sequence_id", "offset"]
    zero = F.lit(0).cast("long").alias("offset")
    out = stored.where(F.col("length") >= capacity).select(*pieces.columns, F.col("row").alias("sequence_id"), zero)
    rest = stored.where(F.col("length") < capacity)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest.schema.fields)
    full = int(capacity * (1 - NEARLY))
    count, tasks, turn, stayed = rest.count(), 0, 0, None
    while count:
        tasks, turn = -(-count // share), turn + 1
        dealt = rest.withColumn("deal", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(tasks)))
        packed = dealt.groupBy("deal").applyInPandas(
            _packed(capacity), f"{kind}, deal long, sequence_id long, offset long, fill long"
        )
        packed = space.store(packed, f"turn-{turn}")
        open_bins = packed.where(F.col("fill") < full)
        facts = open_bins.agg(F.count(F.lit(1)).alias("pieces"), F.count_if(F.col("offset") == 0).alias("bins")).first()
        left = facts["pieces"]
        fewer = -(-left // share) < tasks or stayed is None or facts["bins"] < stayed
        if tasks == 1 or not left or not fewer:
            out = out.unionByName(packed.select(*columns))
            break
        out = out.unionByName(packed.where(F.col("fill") >= full).select(*columns))
        rest, count, stayed = open_bins.select(*rest.columns), left, facts["bins"]
    return out


def packed_documents(docs: DataFrame, path: str, *, capacity: int = 2048, end: int = 0, **names: str) -> DataFrame:
    """Every document as token pieces in sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``path`` is a tokenizers file, the same on every executor.  Null and empty texts are the end id alone; ids may be null
    or repeat, each row is a document of its own.  Documents over ``capacity`` tokens are cut, others never.
    """
    return pack(tokenised(docs, path, capacity=capacity, end=end, **names), capacity=capacity)
