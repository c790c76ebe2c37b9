"""An interpolated modified Kneser-Ney model of word n-grams, counted in Spark and scored from sorted tables.

Words are counted first and numbered, frequent ones first, each in the shard of its hash.  Counting then goes down the
orders, a shuffle each.  Every task counts the n-grams of a chunk and sends them, numbered, sorted and packed, to the
shard of the n-gram's hash; a shard adds them up, writes its sorted keys and what belongs to them to the shared folder,
and sends on to the shards of the next order, by (n-1)-gram: what follows it (sum, and how many values are 1, 2 or
more), and how many different words stand before it.  Hashes are dealt by their leading bits, so shards are even whatever
the words are, and their number follows the size of the input.  What goes from order to order is stored in between, so
that the files of a shuffle can be deleted before the next.

Scoring: workers map the arrays into memory and look up the sorted distinct hashes of a batch by binary search.

P(w | u v) = max(c(u v w) - D, 0) / c(u v) + g(u v) P(w | v), where D depends on c(u v w) being 1, 2 or more and g(u v) is
the mass taken from u v; below the highest order c(v w) is the number of different words before v w, and below the
words it falls back to 1 / (V + 1).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, batch_words, mix

#: Words are known by 56 bits of their hash: at a thousand million words 7 pairs may be one.
LOW = np.uint64(0xFFFFFFFFFFFFFF00)
#: Mark of a text's end; no word has this hash but by a chance of one in 2^56.
END = np.uint64(0x13198A2E03707300)
#: Words of an n-gram.
ORDER = 3
#: Tokens that a task counts at once, and scores at once.
COUNTED, SCORED = 1 << 20, 1 << 19
#: Bytes of input (as stored) for a shard.
SHARD_BYTES = 2 << 20
#: Bytes of arrays that a worker keeps where the shared folder is no file system to map.
KEPT = 256 << 20

#: Columns below the highest order: different words before, and of what follows the sum and the number of values 1, 2
#: and more.  The highest order has its counts only, words have their counts and numbers.
FIELDS = ("types", "after", "n1", "n2", "n3")
#: Numbers of the mark of a begin and of words that training has not seen; the others lie between them.
FIRST, UNKNOWN = np.uint64(0), np.uint64(1 << 63)
#: Keys for a bucket, and of a shard's file: its sections, and numbers in the header.
BUCKET, SECTIONS = 12, ("rows", "first", "high", "rank", "code", "low")
#: Files of shards that a worker keeps mapped; a process may have some 65,000 maps.
MAPPED = 1 << 15
#: Deletes the files of a shuffle as soon as the query is done that made them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = (left ^ np.uint64(0xA4093822299F31D0)) * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hash(numbers: list[np.ndarray]) -> np.ndarray:
    """Hash of n-grams of numbered words, word by word."""
    out = mix(numbers[0])
    for more in numbers[1:]:
        out = pair_hash(out, mix(more))
    return out


def _shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _sequences(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[tuple[list, list[int], np.ndarray]]:
    """Chunks of texts: (batch and row of each, words of each, all words in order)."""
    where, sizes, words, total = [], [], [], 0
    for batch in batches:
        for row, hashes, _, _ in batch_words(batch.column(column)):
            where.append((batch, row))
            sizes.append(len(hashes))
            words.append(hashes & LOW)
            total += len(hashes) + 1
            if total >= most:
                yield where, sizes, np.concatenate(words)
                where, sizes, words, total = [], [], [], 0
    if where:
        yield where, sizes, np.concatenate(words)


def _grams(sizes: list[int], words: np.ndarray, order: int, end: np.uint64) -> list[np.ndarray]:
    """The n-gram of numbers that each token ends, as an array per place; texts one behind the other, each with its end."""
    lengths = np.asarray(sizes, np.int64) + 1
    ends = np.cumsum(lengths) - 1
    last = np.full(int(lengths.sum()), end, np.uint64)
    inner = np.ones(len(last), bool)
    inner[ends] = False
    last[inner] = words
    place = np.arange(len(last)) - np.repeat(ends - lengths + 1, lengths)
    out = [last]
    for back in range(1, order):
        before = np.full(len(last), FIRST, np.uint64)
        before[back:] = last[: len(last) - back]
        before[place < back] = FIRST
        out.insert(0, before)
    return out


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and the place of each before; leading bits and place are sorted as one number, which is faster."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    width = np.uint64((len(keys) - 1).bit_length())
    same = np.uint64(64 - max(1, int(keys.min() ^ keys.max()).bit_length()))  # bits that all begin with
    packed = (((keys << same) >> width) << width) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    place = (packed & ((np.uint64(1) << width) - np.uint64(1))).astype(np.int64)
    out = keys[place]
    if (out[1:] < out[:-1]).any():  # hashes that differ only behind these bits
        place = np.argsort(keys, kind="stable")
        out = keys[place]
    return out, place


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and for each given one its place among them."""
    keys, order = _sorted(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return keys[new], place


def _merged(keys: np.ndarray, words: list[np.ndarray], columns: list[np.ndarray]) -> tuple[np.ndarray, list, list]:
    """Sorted distinct keys, the words of each, and the sums of the columns."""
    keys, order = _sorted(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sums = [np.add.reduceat(c[order], first) if len(first) else c[:0] for c in columns]
    return keys[first], [w[order[first]] for w in words], sums


def _planes(values: np.ndarray) -> np.ndarray:
    """Numbers by bytes of equal weight, as many as the largest takes."""
    width = max(1, -(-int(values.max()).bit_length() // 8))
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T


def _by_words(shards: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """An order of n-grams by shard, first word, and leading bits of the other words as one number holds them."""
    width = (len(shards) - 1).bit_length()
    wide = int(words[0].max()).bit_length()
    left = 64 - width - int(shards.max()).bit_length() - wide
    if left < 0:
        return np.lexsort([*words[::-1], shards])
    key = (shards.astype(np.uint64) << np.uint64(wide)) | words[0]
    for w in words[1:]:
        whole = int(w.max()).bit_length()
        bits = min(left, whole)
        key = (key << np.uint64(bits)) | (w >> np.uint64(whole - bits) if bits else np.uint64(0))
        left -= bits
    key = (key << np.uint64(width)) | np.arange(len(key), dtype=np.uint64)
    key.sort()
    return (key & np.uint64((1 << width) - 1)).astype(np.int64)


def _most(columns: int) -> int:
    """The value that stands for itself and more: one column has a byte for a row, of several four share one."""
    return 255 if columns == 1 else 3


def _large(columns: list[np.ndarray], begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part, column and row of values of ``_most`` and more, in this order; ``begins`` are the first rows of parts."""
    rows = [np.flatnonzero(c == _most(len(columns))) for c in columns]
    column, row = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
    part = np.searchsorted(begins, row, "right") - 1
    order = np.lexsort((row, column, part))
    return part[order], column[order], row[order]


def _dealt(keys: np.ndarray, words: list[np.ndarray], columns: list[np.ndarray], bits: int) -> list[tuple[int, int, bytes]]:
    """Sorted n-grams by shard: (shard, n, their words and columns, packed); equal words stand side by side.

    All shards are laid out at once and only cut and compressed one by one: a chunk may have thousands of small ones.
    """
    if not len(keys):
        return []
    shards = _shard(keys, bits)
    first = np.flatnonzero(np.diff(shards, prepend=-1))
    names = shards[first].tolist()
    by = _by_words(shards, words) if len(words) > 1 else np.arange(len(keys))  # words alone are in the order of their keys
    lead = words[0][by]
    steps = np.diff(lead, prepend=np.uint64(0))
    steps[first] = lead[first]
    planes = [_planes(steps), *(_planes(w[by]) for w in words[1:])]
    head = bytes(map(len, planes))
    columns = [c[by] for c in columns]
    small = [np.minimum(c, np.uint64(_most(len(columns)))).astype(np.uint8) for c in columns]
    part, column, row = _large(small, first)
    small = np.stack([sum(c << 2 * j for j, c in enumerate(small[k : k + 4])) for k in range(0, len(small), 4)])
    large = np.stack(columns)[column, row].astype("<u8")
    cuts = np.searchsorted(part, np.arange(len(first) + 1)).tolist()
    whole, codec, rows = np.concatenate([*planes, small]), pa.Codec("zstd"), []
    for shard, a, b, c, d in zip(names, first.tolist(), [*first[1:].tolist(), len(keys)], cuts, cuts[1:]):
        raw = whole[:, a:b].tobytes() + large[c:d].tobytes()
        rows.append((shard, b - a, len(raw).to_bytes(8, "little") + head + codec.compress(raw, asbytes=True)))
    return rows


def _opened(blobs: list[bytes], rows: list[int], order: int, columns: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Words and columns of n-grams as ``_dealt`` has packed them."""
    heads = [tuple(blob[8 : 8 + order]) for blob in blobs]
    widths = [max(w) for w in zip(*set(heads))]
    ends = np.cumsum(rows)
    begins = ends - rows
    whole, large, codec = np.zeros((sum(widths) - (-columns // 4), int(ends[-1])), np.uint8), [], pa.Codec("zstd")
    places = {}  # of the planes of parts with these widths
    for blob, head, a, b in zip(blobs, heads, begins.tolist(), ends.tolist()):
        if head not in places:
            places[head] = [sum(widths[:k]) + j for k, w in enumerate(head) for j in range(w)] + list(range(sum(widths), len(whole)))
        raw = codec.decompress(memoryview(blob)[8 + order :], int.from_bytes(blob[:8], "little"), asbytes=True)
        size = len(places[head]) * (b - a)
        found = np.frombuffer(raw, np.uint8, size).reshape(-1, b - a)
        if len(found) == len(whole):
            whole[:, a:b] = found
        else:
            whole[places[head], a:b] = found
        if len(raw) > size:
            large.append(raw[size:])
    parts, at = [], 0
    for width in widths:
        part = whole[at].astype(np.uint64)
        for k in range(1, width):
            part |= whole[at + k].astype(np.uint64) << np.uint64(8 * k)
        parts.append(part)
        at += width
    total = np.cumsum(parts[0])
    parts[0] = total - np.repeat(total[begins] - parts[0][begins], rows)
    small = [whole[at]] if columns == 1 else [whole[at + k // 4] >> 2 * (k % 4) & 3 for k in range(columns)]
    _, column, row = _large(small, begins)
    values, wide = np.frombuffer(b"".join(large), "<u8"), []
    for k, c in enumerate(small):
        wide.append(c.astype(np.uint64))
        wide[k][row[column == k]] = values[column == k]
    return parts, wide


def _count_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sizes, words in _sequences(batches, 0, COUNTED):
            keys, counts = np.unique(np.append(words, END), return_counts=True)
            counts[keys == END] += len(sizes) - 1
            yield _rows(_dealt(keys, [keys >> np.uint64(8)], [counts.astype(np.uint64)], bits))

    return run


def _number_words(folder: str, bits: int):
    """Adds up a shard of words and numbers them, frequent ones first; returns the sums of tokens and words.

    Shards take turns, so that small numbers are those of frequent words in all of them.
    """

    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        (words,), (counts,) = _opened(group.column("data").to_pylist(), group.column("n").to_pylist(), 1, 1)
        keys, _, (counts,) = _merged(words << np.uint64(8), [], [counts])
        rank = np.empty(len(keys), np.uint64)
        rank[np.lexsort((keys, -counts.astype(np.int64)))] = np.arange(len(keys), dtype=np.uint64)
        _write_table(folder, f"0-{shard}", keys, [counts], bits, rank)
        return _sums([int(counts.sum()), len(keys)])

    return run


def _numbered(arrays: _Arrays, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count and number of each distinct word, and the place of each token's among them."""
    keys, place = _distinct(tokens)
    values, ranks = arrays.look_up(0, keys)
    bits = np.uint64(arrays.model.bits)
    numbers = (ranks << bits) + _shard(keys, arrays.model.bits).astype(np.uint64) + np.uint64(1)
    return values[:, 0], np.where(values[:, 0] > 0, numbers, UNKNOWN), place


def _count(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model)
        for _, sizes, words in _sequences(batches, 0, COUNTED):
            _, numbers, place = _numbered(arrays, np.append(words, END))
            numbers = numbers[place]
            grams = _grams(sizes, numbers[:-1], model.order, numbers[-1])
            keys, grams, (counts,) = _merged(gram_hash(grams), grams, [np.ones(len(grams[0]), np.uint64)])
            yield _rows(_dealt(keys, grams, [counts], model.bits))

    return run


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    shards, sizes, blobs = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int64()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
        ["shard", "n", "data"],
    )


def _write(folder: str, name: str, parts: list[bytes | memoryview]) -> None:
    fs, path = files.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{np.random.default_rng().integers(1 << 62)}"
    with fs.open_output_stream(draft, compression=None) as out:
        for part in parts:
            out.write(part)
    fs.move(draft, f"{path}/{name}")


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in the smallest unsigned numbers that hold them."""
    return counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0))


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4)]


def _values(column: np.ndarray) -> list[np.ndarray]:
    """Values of more than 2, as the others follow from their numbers, and which values are 1, 2 and more."""
    more = column > 2
    return [column * more, *(x.astype(np.uint64) for x in (column == 1, column == 2, more))]


def _codes(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row, and the rows that the numbers stand for: few differ."""
    code, span = np.zeros(len(columns[0]), np.uint64), 1
    for column in columns:
        wide = int(column.max()) + 1 if len(column) else 1
        if span * wide >= 1 << 63:
            code = np.unique(code, return_inverse=True)[1].astype(np.uint64)
            span = len(code) + 1
        if span * wide >= 1 << 63:
            column = np.unique(column, return_inverse=True)[1].astype(np.uint64)
            wide = len(column) + 1
        code, span = code * np.uint64(wide) + column, span * wide
    if span <= 4 * len(code) + (1 << 16):  # few enough to be listed
        first = np.zeros(span, np.int64)
        first[code] = np.arange(1, len(code) + 1)
        there = np.flatnonzero(first)
        place = np.zeros(span, np.uint64)
        place[there] = np.arange(len(there), dtype=np.uint64)
        first, place = first[there] - 1, place[code]
    else:
        _, first, place = np.unique(code, return_index=True, return_inverse=True)
    return _narrow(place), np.stack([c[first] for c in columns], axis=1).astype("<u8")


def _write_table(
    folder: str, name: str, keys: np.ndarray, columns: list[np.ndarray], bits: int, rank: np.ndarray | None = None
) -> None:
    """Sorted keys of a shard and their columns, in one file of sections behind the width and length of each.

    Leading bits of a key are those of its shard and then its bucket's, of which only the beginnings are written; of what
    follows 40 bits are, so one of about 10^11 unknown keys is taken for a known one.
    """
    lead = (len(keys) // BUCKET).bit_length()
    inner = keys << np.uint64(bits)
    buckets = inner >> np.uint64(64 - lead) if lead else np.zeros(len(keys), np.uint64)
    first = np.searchsorted(buckets, np.arange((1 << lead) + 1, dtype=np.uint64)).astype("<u4")
    code, rows = _codes(columns)
    high, low = _rest(inner, lead)
    found = {"rows": rows.ravel(), "first": first, "high": high, "low": low, "code": code, "rank": _narrow(rank if rank is not None else keys[:0])}
    parts = [np.array([[found[k].itemsize, len(found[k])] for k in SECTIONS], "<u8").tobytes()]
    for k in SECTIONS:
        data = memoryview(np.ascontiguousarray(found[k])).cast("B") if len(found[k]) else b""
        parts += [data, bytes(-len(data) % 8)]
    _write(folder, name, parts)


def _rest(inner: np.ndarray, lead: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 40 bits behind a bucket's: 32 and 8 of them."""
    rest = inner << (np.uint64(lead) if isinstance(lead, int) else lead)
    return (rest >> np.uint64(32)).astype("<u4"), (rest >> np.uint64(24)).astype(np.uint8)


def _below(words: list[np.ndarray], value: np.ndarray, bits: int) -> list[tuple[int, int, bytes]]:
    """What n-grams of these values mean to the order below, dealt to its shards."""
    ahead, behind = words[:-1], words[1:]
    front = _merged(gram_hash(ahead), ahead, _values(value))
    back = _merged(gram_hash(behind), behind, [np.ones(len(value), np.uint64)])
    none = lambda part: np.zeros(len(part[0]), np.uint64)
    columns = [[none(front), back[2][0]], *([c, none(back)] for c in front[2])]
    keys, grams, sums = _merged(
        np.concatenate([front[0], back[0]]), [np.concatenate(w) for w in zip(front[1], back[1])], [np.concatenate(c) for c in columns]
    )
    return _dealt(keys, grams, sums, bits)


def _merge_grams(folder: str, bits: int, order: int, highest: bool):
    """Adds up a shard of n-grams, writes it, and sends on what the order below needs.

    Shard -1 carries the counts of counts of the order, and the sum of its values.
    """

    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        sizes, blobs = group.column("n").to_pylist(), group.column("data").to_pylist()
        words, columns = _opened(blobs, sizes, order, 1 if highest else len(FIELDS))
        keys, words, columns = _merged(gram_hash(words), words, columns)
        if not highest:
            columns[1] += columns[2] + np.uint64(2) * columns[3]  # what follows, now with values of 1 and 2
        _write_table(folder, f"{order}-{shard}", keys, columns, bits)
        real = columns[0] > 0  # others are only what n-grams begin with
        words, value = [w[real] for w in words], columns[0][real]
        facts = (-1, order, np.asarray([*_counts_of_counts(value), int(value.sum())], "<u8").tobytes())
        return pa.Table.from_batches([_rows([facts, *(_below(words, value, bits) if order > 1 else [])])])

    return run


def _added_facts(order: int):
    def run(group: pa.Table) -> pa.Table:
        return _sums(np.sum([np.frombuffer(x, "<u8") for x in group.column("data").to_pylist()], axis=0).astype(int).tolist())

    return run


def _sums(values: list[int]) -> pa.Table:
    return pa.table({f"s{k}": pa.array([v], pa.int64()) for k, v in enumerate(values)})


def _discounts(n: list[int]) -> np.ndarray:
    """What is taken from counts of 1, 2 and more, from the numbers of counts of 1 to 4."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = [k - (k + 1) * y * above / own if own else 0.5 for k, own, above in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(d, 0.0), k) for k, d in zip((1, 2, 3), out))])


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the sums over all training tokens; ``counts`` are the counts of counts from words up."""

    folder: str
    bits: int
    order: int
    tokens: int
    words: int
    types: int
    counts: tuple[tuple[int, ...], ...]


def train(docs: DataFrame, space: Workspace, *, order: int = ORDER, text_column: str = "text") -> Model:
    """Count the n-grams of the texts of ``docs``; null texts count as empty, that is as one end."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > 1 << 60:  # not known for rows that come from no files
        size = docs.agg(F.sum(F.octet_length(F.col(text_column)))).first()[0] or 0
    bits = max(2, (size // SHARD_BYTES).bit_length())
    folder, spark = space.folder("arrays"), docs.sparkSession
    kind = "shard long, n long, data binary"
    texts = docs.select(F.col(text_column).cast("string"))
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        words = texts.mapInArrow(_count_words(bits), kind).repartition(1 << bits, "shard").groupBy("shard")
        sums = words.applyInArrow(_number_words(folder, bits), "s0 long, s1 long").agg(F.sum("s0"), F.sum("s1")).first()
        model = Model(folder, bits, order, sums[0] or 0, sums[1] or 0, 0, ())
        rows, counts = texts.mapInArrow(_count(model), kind), []
        names = ", ".join(f"s{k} long" for k in range(5))
        for k in range(order, 0, -1):
            groups = rows.repartition(1 << bits, "shard").groupBy("shard")
            # stored, so that the shuffle's files can go before the next
            rows = space.store(groups.applyInArrow(_merge_grams(folder, bits, k, k == order), kind), f"below-{k}")
            if k < order:
                space.drop(f"below-{k + 1}")
            facts = rows.where("shard < 0").withColumn("part", F.spark_partition_id()).groupBy("part")
            facts = facts.applyInArrow(_added_facts(k), names).agg(*[F.sum(f"s{i}") for i in range(5)]).first()
            counts.insert(0, tuple(x or 0 for x in facts))
            rows = rows.where("shard >= 0")
        space.drop("below-1")
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return replace(model, types=counts[0][4], counts=tuple(c[:4] for c in counts))


class _Arrays:
    """The files of a model's shards, each mapped when first asked for; of very many the ones used last are kept.

    From a store without files to map they are read; the ones used last are kept, up to ``KEPT`` bytes.
    """

    def __init__(self, model: Model):
        self.model, self.open, self.held = model, {}, 0
        self.fs, self.path = files.FileSystem.from_uri(model.folder)
        self.mapped = isinstance(self.fs, files.LocalFileSystem)

    def get(self, order: int, shard: int) -> dict[str, np.ndarray] | None:
        """Sections of a shard's file by name; None where the shard has no keys."""
        key = (order, shard)
        if key in self.open:
            self.open[key] = self.open.pop(key)  # used last
            return self.open[key][0]
        path = f"{self.path}/{order}-{shard}"
        if self.fs.get_file_info(path).type != files.FileType.File:
            data = b""
        elif self.mapped:
            with pa.memory_map(path) as source:
                data = source.read_buffer()
        else:
            with self.fs.open_input_stream(path, compression=None) as source:
                data = source.read()
            self.held += len(data)
        found, at = {}, 16 * len(SECTIONS)
        for name, (width, n) in zip(SECTIONS, np.frombuffer(data, "<u8", 2 * len(SECTIONS)).reshape(-1, 2).tolist() if len(data) else ()):
            found[name] = np.frombuffer(data, f"<u{width}", n, at)
            at += width * n + -(width * n) % 8
        if found and len(found["high"]):
            found["rows"] = found["rows"].reshape(-1, self.columns(order))
        else:
            found = None
        while self.open and (self.held > KEPT or len(self.open) >= MAPPED):
            self.held -= self.open.pop(next(iter(self.open)))[1]
        self.open[key] = found, 0 if self.mapped else len(data)
        return found

    def columns(self, order: int) -> int:
        return 1 if order in (0, self.model.order) else len(FIELDS)

    def look_up(self, order: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What belongs to each of sorted hashes, a row each, and the ranks of words; 0 for unknown ones."""
        out, ranks = np.zeros((len(wanted), self.columns(order)), np.uint64), np.zeros(len(wanted) if order == 0 else 0, np.uint64)
        shards = _shard(wanted, self.model.bits)
        first = np.flatnonzero(np.diff(shards, prepend=-1))
        names, ends, together = shards[first].tolist(), [*first[1:].tolist(), len(wanted)], MAPPED if self.mapped else 1
        for k in range(0, len(names), together):
            a, b = int(first[k]), ends[min(k + together, len(names)) - 1]
            tables = [self.get(order, s) for s in names[k : k + together]]
            cuts = [*(first[k : k + together] - a).tolist(), b - a]
            self._search(wanted[a:b], tables, cuts, out[a:b], ranks[a:b])
        return out.view(np.int64), ranks

    def _search(self, wanted: np.ndarray, tables: list, cuts: list[int], out: np.ndarray, ranks: np.ndarray) -> None:
        """Looks up in many shards at once: the hashes from one of ``cuts`` to the next are those of a table."""
        parts = [(a, b, t) for a, b, t in zip(cuts, cuts[1:], tables) if t is not None]
        if not parts:
            return
        leads = [0 if t is None else (len(t["first"]) - 1).bit_length() - 1 for t in tables]
        lead = np.repeat(np.array(leads, np.uint64), np.diff(cuts))
        inner = wanted << np.uint64(self.model.bits)
        buckets = ((inner >> np.uint64(1)) >> (np.uint64(63) - lead)).astype(np.int64)
        high, low = _rest(inner, lead)
        at, end = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        for a, b, t in parts:
            at[a:b] = t["first"].take(buckets[a:b])
        buckets += 1
        for a, b, t in parts:
            end[a:b] = t["first"].take(buckets[a:b])

        def read(name: str, place: np.ndarray, kind: type) -> np.ndarray:
            found = np.zeros(len(wanted), kind)
            for a, b, t in parts:
                t[name].take(place[a:b], mode="clip", out=found[a:b])
            return found

        step = 1 << int((end - at).max()).bit_length() >> 1
        while step:  # all buckets at once: past as many keys as are smaller
            to = at + step
            at += step * ((to <= end) & (read("high", to - 1, np.uint32) < high))
            step >>= 1
        while True:  # keys of the same 32 bits follow each other by the last 8
            found = (at < end) & (read("high", at, np.uint32) == high)
            other = read("low", at, np.uint8)
            before = found & (other < low)
            if not before.any():
                break
            at += before
        hit = np.flatnonzero(found & (other == low))
        at, of = at[hit], np.searchsorted(hit, cuts).tolist()
        rows = np.empty((len(hit), out.shape[1]), np.uint64)
        for a, b, t in zip(of, of[1:], tables):
            if a < b:
                t["rows"].take(t["code"].take(at[a:b]), axis=0, mode="clip", out=rows[a:b])
                if len(ranks):
                    ranks[hit[a:b]] = t["rank"].take(at[a:b])
        out[hit] = rows


def _before(values: np.ndarray, begins: np.ndarray, first: np.generic) -> np.ndarray:
    """The value of the token before each token; ``first`` where a text begins."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[begins] = first
    return out


def _chances(model: Model, arrays: _Arrays, numbers: np.ndarray, place: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Probability of each token, from the numbers of the distinct words, each token's place there, and where texts begin.

    What stands before the last word of an n-gram is the (n-1)-gram that the token before ends, so each order is looked
    up once, with the n-gram of begins behind the tokens' own.
    """
    cut = [_discounts(list(c)) for c in model.counts]
    spread = 1.0 / (model.words + 1)
    last, begin = mix(numbers), mix(np.array([FIRST]))
    start = begin
    keys, own = _distinct(np.append(last, start))
    values, _ = arrays.look_up(1, keys)
    if model.types:
        n1, n2 = model.counts[0][:2]
        more = model.words - n1 - n2  # every word of the training tokens stands behind some word
        left_over = (cut[0][1] * n1 + cut[0][2] * n2 + cut[0][3] * more) / model.types
        types = values[:, 0]
        single = np.maximum(types - cut[0][np.minimum(types, 3)], 0) / model.types + left_over * spread
    else:
        single = np.full(len(keys), spread)
    own = np.append(own[place], own[-1])
    chance, last = single[own[:-1]], last[place]
    grams = last
    for order in range(2, model.order + 1):
        ahead = _before(own[:-1], begins, own[-1])
        grams, start = pair_hash(_before(grams, begins, start[0]), last), pair_hash(start, begin)
        after, n1, n2, n3 = values[:, 1:].T
        d = cut[order - 1]
        share = np.where(after > 0, (d[1] * n1 + d[2] * n2 + d[3] * n3) / np.maximum(after, 1), 1.0)[ahead]
        after = after[ahead]
        keys, own = _distinct(np.append(grams, start))
        values, _ = arrays.look_up(order, keys)
        value = values[:, 0]
        direct = np.maximum(value - d[np.minimum(value, 3)], 0)[own[:-1]] / np.maximum(after, 1)
        chance = np.where(after > 0, direct, 0.0) + share * chance
    return chance


def _score(model: Model):
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "learnt"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model)
        for where, sizes, words in _sequences(batches, 1, SCORED):
            counts, numbers, place = _numbered(arrays, *_grams(sizes, words, 1, END))
            begins = np.concatenate([[0], np.cumsum(np.asarray(sizes) + 1)[:-1]]).astype(np.int64)
            chance = _chances(model, arrays, numbers, place, begins)
            base = np.log10((counts + 1) / (model.tokens + (model.words + 1)))[place]
            columns = [
                [batch.column(0)[row].as_py() for batch, row in where], np.asarray(sizes) + 1,
                np.add.reduceat((counts > 0).astype(np.int64)[place], begins), np.full(len(sizes), model.tokens),
                np.add.reduceat(base, begins), np.add.reduceat(np.log10(chance), begins),
                [batch.column(2)[row].as_py() for batch, row in where],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def language_scores(
    docs: DataFrame, learn: Column, *, order: int = ORDER, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Train a model of ``order`` words on the rows where ``learn`` holds (null counts as false) and score every row.

    Columns: doc_id, learnt, n_tokens (words and one end), n_known (tokens seen in training), train_tokens, base_score
    (add-one unigrams), score (log10 probability), perplexity.  Null and empty texts are the end alone; ids may be null
    or repeat; other columns are not looked at.
    """
    space = Workspace(docs.sparkSession, "kneser-ney")
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learnt"),
    )
    model = train(slim.where("learnt").select("text"), space, order=order)
    kind = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    found = slim.mapInArrow(_score(model), f"{kind}, learnt boolean")
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
