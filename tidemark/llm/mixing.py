"""Mixing sources to target weights: exact block quotas, dealt to shards by a multivariate hypergeometric tree.

Documents are cut into blocks of ``block_words`` words and a rest.  Full blocks and rests of a source are two strata,
numbered without gaps; a keyed permutation of the numbers, one for each time round, gives every block a place in the
stratum's order, and the mix takes the places below the stratum's quota.  So no block is taken a second time before
all were taken once, nor more than ``most`` times.

Shards hold equally many blocks.  A node of the tree draws from its blocks, without putting back, those of its left
half; it keeps only how many of each stratum fall there.  Below it both halves go on alone, down to single shards.  Every node
has random numbers of its own, so a task that needs some shards walks down to those only, and every run finds the same.  What a
shard gets of a stratum is a stretch of the permuted order; stretches of different shards never overlap.  Within a
shard the blocks are shuffled.

One row for each source passes through the driver; blocks and documents don't.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, batch_words, mix

#: Words of a block and of a shard.
BLOCK_WORDS, SHARD_WORDS = 64, 1 << 20
#: Places of a stratum that are looked up together, and blocks that a task lays out at once.
CELL, LAID = 256, 1 << 18
#: numpy draws exactly below this many; beyond, the rounded normal draw of same mean and variance is taken.
EXACT = 10**9


def source_targets(sizes: Sequence[int], weights: Sequence[float], *, share: float = 1.5, most: int = 2) -> list[float]:
    """Words to take of each source: ``share`` of all sizes by weight, at most ``most`` times the source's own size.

    What a source can't take goes to the others by weight, until none is above its limit.
    """
    limit = [most * s for s in sizes]
    total = min(share * sum(sizes), sum(limit))
    stopped: set[int] = set()
    while True:
        rest = total - sum(limit[k] for k in stopped)
        weight = sum(w for k, w in enumerate(weights) if k not in stopped)
        over = {k for k, w in enumerate(weights) if k not in stopped and rest * w > limit[k] * weight}
        if not over:
            return [float(limit[k]) if k in stopped else rest * w / weight for k, w in enumerate(weights)]
        stopped |= over


def permuted(at: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0..size-1 at the places ``at``, all arrays of one length.

    Four Feistel rounds permute the next power of four; a value beyond ``size`` is permuted again until it is below.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    value, size, open_rows = at.astype(np.uint64), size.astype(np.uint64), np.arange(len(at))
    while len(open_rows):
        v, h, m, k = value[open_rows], half[open_rows], mask[open_rows], key[open_rows]
        left, right = v >> h, v & m
        for turn in range(4):
            left, right = right, left ^ (mix(right + k + np.uint64(turn) * np.uint64(0x9E3779B97F4A7C15)) & m)
        value[open_rows] = (left << h) | right
        open_rows = open_rows[value[open_rows] >= size[open_rows]]
    return value.astype(np.int64)


def _key(seed: int, stratum: np.ndarray, turn: int) -> np.ndarray:
    return mix(mix(stratum.astype(np.uint64) + np.uint64(seed)) + np.uint64(turn))


def places(seed: int, stratum: np.ndarray, number: np.ndarray, sizes: np.ndarray, quotas: np.ndarray, most: int):
    """For each time round: (rows whose place is below the quota of their stratum, these places)."""
    size, quota = sizes[stratum], quotas[stratum]
    for turn in range(most):
        rows = np.flatnonzero(quota > turn * size)
        found = turn * size[rows] + permuted(number[rows], size[rows], _key(seed, stratum[rows], turn))
        taken = found < quota[rows]
        yield rows[taken], found[taken]


def drawn_left(counts: np.ndarray, size: int, random: np.random.Generator) -> np.ndarray:
    """How many of each kind are among ``size`` drawn from ``counts`` without putting back."""
    out, rest, need = np.zeros(len(counts), np.int64), int(counts.sum()), size
    for k, have in enumerate(counts.tolist()):
        others = rest - have
        low, high = max(0, need - others), min(have, need)
        if low == high:
            got = low
        elif max(have, others) < EXACT:
            got = int(random.hypergeometric(have, others, need))
        else:
            p = have / rest
            spread = math.sqrt(need * p * (1 - p) * ((rest - need) / (rest - 1)))
            got = min(high, max(low, round(random.normal(need * p, spread))))
        out[k], rest, need = got, others, need - got
    return out


def shard_stretches(quotas: np.ndarray, shards: int, seed: int, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first place, blocks) of the shards low..high-1, with an entry for each stratum."""
    total = int(quotas.sum())
    stack = [(0, shards, np.zeros(len(quotas), np.int64), quotas.astype(np.int64))]
    while stack:
        a, b, first, counts = stack.pop()
        if b <= low or high <= a:
            continue
        if b - a == 1:
            yield a, first, counts
            continue
        middle = (a + b) // 2
        size = total * middle // shards - total * a // shards
        random = np.random.Generator(np.random.Philox(key=np.array([seed, (a << 32) | b], np.uint64)))
        left = drawn_left(counts, size, random)
        stack.append((middle, b, first + left, counts - left))
        stack.append((a, middle, first, left))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for row, words, _, _ in batch_words(batch.column("text")):
            size[row] = len(words)
        yield batch.drop_columns("text").append_column("size", pa.array(size))


def _rests(seed: int, block_words: int, sizes: np.ndarray, quotas: np.ndarray, most: int):
    """Words that the rests taken of each source hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(len(sizes) // 2, np.int64)
        for batch in batches:
            source, size, number = (batch.column(c).to_numpy() for c in ("s", "size", "rest_no"))
            some = np.flatnonzero(size % block_words)
            for rows, _ in places(seed, 2 * source[some] + 1, number[some], sizes, quotas, most):
                np.add.at(words, source[some][rows], size[some][rows] % block_words)
        held = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(words[held])], ["s", "words"])

    return run


_DRAWN = "stratum int, place long, row long, first long, words int"


def _taken(seed: int, block_words: int, sizes: np.ndarray, quotas: np.ndarray, most: int):
    """A row for each time that a block is taken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, source, size, full_no, rest_no = (batch.column(c).to_numpy() for c in ("row", "s", "size", "full_no", "rest_no"))
            blocks = -(-size // block_words)
            ends = np.cumsum(blocks)
            for low in range(0, int(ends[-1]) if len(ends) else 0, LAID):
                flat = np.arange(low, min(low + LAID, int(ends[-1])))
                doc = np.searchsorted(ends, flat, "right")
                no = flat - (ends[doc] - blocks[doc])
                first = no * block_words
                words = np.minimum(block_words, size[doc] - first)
                rest = words < block_words
                stratum = 2 * source[doc].astype(np.int64) + rest
                number = np.where(rest, rest_no[doc], full_no[doc] + no)
                for rows, place in places(seed, stratum, number, sizes, quotas, most):
                    columns = [stratum[rows].astype(np.int32), place, row[doc[rows]], first[rows], words[rows].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["stratum", "place", "row", "first", "words"])

    return run


def _stretches(quotas: np.ndarray, shards: int, seed: int):
    """The stretches of the shards of a task, cut at multiples of ``CELL`` places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_numpy()
            # the numbers of a batch follow each other
            for shard, first, counts in shard_stretches(quotas, shards, seed, int(wanted[0]), int(wanted[-1]) + 1) if len(wanted) else ():
                begin, end = first // CELL, -(-(first + counts) // CELL)
                cells = np.where(counts > 0, end - begin, 0)
                stratum = np.repeat(np.arange(len(counts)), cells)
                cell = np.arange(len(stratum)) - np.repeat(np.cumsum(cells) - cells, cells) + begin[stratum]
                columns = [
                    stratum.astype(np.int32), cell, first[stratum], (first + counts)[stratum], np.full(len(stratum), shard, np.int64)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["stratum", "cell", "low", "high", "shard"])

    return run


@dataclass(frozen=True)
class Mix:
    """A mix and what it was made of.

    ``documents``: row, doc_id, mark, source, size, s (number of the source).  ``sources``: source, s, source_size, weight,
    target.  ``blocks``: a row for each time that a block is taken: shard, slot (order within the shard), row, doc_id, mark,
    first (words of the document before it), words.
    """

    documents: DataFrame
    sources: DataFrame
    blocks: DataFrame
    shards: int
    block_words: int


def source_order(source: str | None) -> tuple[bool, str]:
    """Sources by code point, null last."""
    return source is None, source or ""


def mark(id_column: str = "doc_id", text_column: str = "text", source_column: str = "source"):
    """Hash of what a row says, by which its copies are told apart from other rows of its id."""
    return F.xxhash64(F.col(id_column).cast("long"), F.col(source_column).cast("string"), F.col(text_column).cast("string"))


def mixture(
    docs: DataFrame,
    weight: Callable[[list[str | None]], list[float]],
    *,
    share: float = 1.5,
    most: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 11,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> Mix:
    """Mix the words of ``docs`` to ``share`` of their number, sources in proportion to their weights.

    ``weight`` gives the weights, above 0, of the sources in the order of ``source_order``; a null source is a source of its own.  Null
    texts are empty; empty texts give nothing.  Rows may repeat, ids may be null or repeat: each row is a document of
    its own.  An empty table gives an empty mix.  The words taken of a source differ from its target by half a block
    where it has enough full blocks, else by what its rests add up to by chance.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "mixing")
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        mark(id_column, text_column, source_column).alias("mark"),
        F.col(text_column).cast("string").alias("text"),
    )
    sized = slim.mapInArrow(_sizes, "doc_id long, source string, mark long, size long")
    sized = space.store(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")

    # Numbers without gaps: about sqrt(rows) cells a source of about as many rows, each numbered on its own.
    cells = max(1, math.isqrt(sized.count()))
    full, rest = F.floor(F.col("size") / block_words), (F.col("size") % block_words > 0).cast("long")
    sized = sized.withColumn("cell", F.pmod("mark", F.lit(cells)))
    found = sized.groupBy("source", "cell").agg(F.sum("size").alias("size"), F.sum(full).alias("full"), F.sum(rest).alias("rest"))
    found = space.store(found, "cells")
    rows = found.groupBy("source").agg(F.sum("size"), F.sum("full"), F.sum("rest")).collect()
    rows = sorted((tuple(r) for r in rows), key=lambda r: source_order(r[0]))
    names, words = [r[0] for r in rows], [r[1] for r in rows]
    weights = [float(w) for w in weight(names)]
    if len(weights) != len(names) or not all(w > 0 for w in weights):
        raise ValueError("a weight above 0 is needed for each source")
    targets = source_targets(words, weights, share=share, most=most)
    source_rows = [(n, k, w, x, t) for k, (n, w, x, t) in enumerate(zip(names, words, weights, targets))]
    sources = spark.createDataFrame(source_rows, "source string, s int, source_size long, weight double, target double")

    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = found.select(
        F.col("source").alias("c_source"), F.col("cell").alias("c_cell"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("full", "rest")],
    ).join(sources.select(F.col("source").alias("s_source"), "s"), F.col("c_source").eqNullSafe(F.col("s_source")))
    offsets = space.store(offsets.drop("s_source"), "offsets")
    here = Window.partitionBy("source", "cell").orderBy("doc_id", "size", "mark", "row").rowsBetween(Window.unboundedPreceding, 0)
    at = sized.withColumns({"full_here": F.sum(full).over(here) - full, "rest_here": F.sum(rest).over(here) - rest})
    numbered = at.join(offsets, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell"))).select(
        "row", "doc_id", "mark", "source", "size", "s",
        (F.col("full_here") + F.col("full_before")).alias("full_no"), (F.col("rest_here") + F.col("rest_before")).alias("rest_no"),
    )
    numbered = space.store(numbered, "documents")

    sizes, quotas = np.zeros(2 * len(rows), np.int64), np.zeros(2 * len(rows), np.int64)
    sizes[0::2], sizes[1::2] = [r[2] for r in rows], [r[3] for r in rows]
    quotas[1::2] = [round(t / w * r[3]) if w else 0 for t, w, r in zip(targets, words, rows)]
    slots = numbered.select("s", "size", "rest_no").mapInArrow(_rests(seed, block_words, sizes, quotas, most), "s int, words long")
    of_rests = {r["s"]: r["words"] for r in slots.groupBy("s").agg(F.sum("words").alias("words")).collect()}
    for k, target in enumerate(targets):
        quotas[2 * k] = min(most * sizes[2 * k], max(0, round((target - of_rests.get(k, 0)) / block_words)))

    shards = max(1, math.ceil(sum(targets) / shard_words))
    taken = numbered.select("row", "s", "size", "full_no", "rest_no").mapInArrow(_taken(seed, block_words, sizes, quotas, most), _DRAWN)
    numbers = spark.range(0, shards, 1, min(shards, max(1, spark.sparkContext.defaultParallelism)))
    stretches = numbers.mapInArrow(_stretches(quotas, shards, seed), "stratum int, cell long, low long, high long, shard long")
    taken = taken.withColumn("cell", F.floor(F.col("place") / CELL))
    dealt = taken.join(stretches, ["stratum", "cell"]).where("place >= low and place < high")
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64("stratum", "place", F.lit(seed)), "stratum", "place")
    ids = numbered.select("row", "doc_id", "mark")
    slotted = dealt.select("shard", (F.row_number().over(shuffled) - 1).alias("slot"), "row", "first", "words")
    blocks = space.store(slotted, "blocks").join(ids, "row")
    documents = numbered.select("row", "doc_id", "mark", "source", "size", "s")
    return Mix(documents, sources, blocks, shards, block_words)


def taken_words(mixed: Mix) -> DataFrame:
    """What the mix takes of each document.

    doc_id, size, source_size, target (of its source), taken (words, repeats counted), n_blocks (taken), shard and slot
    of the first of them, null without any.
    """
    own = mixed.blocks.groupBy("row").agg(
        F.sum("words").alias("taken"),
        F.count(F.lit(1)).alias("n_blocks"),
        F.min(F.struct("shard", "slot")).alias("at"),
    )
    sources = mixed.sources.select(F.col("s"), "source_size", "target")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return mixed.documents.join(own, "row", "left").join(sources, "s").select(
        "doc_id", "size", "source_size", "target", count("taken"), count("n_blocks"), F.col("at.shard").alias("shard"),
        F.col("at.slot").cast("long").alias("slot"),
    )


def _cut(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, first, parts = batch.column("text"), [], [], []
            for row, words, starts, ends in batch_words(texts):
                raw = texts[row].as_buffer().to_pybytes() if len(words) else b""
                for no in range(0, len(words), block_words):
                    last = min(no + block_words, len(words)) - 1
                    rows.append(row)
                    first.append(no)
                    parts.append(raw[starts[no] : ends[last]].decode())
            out = batch.drop_columns("text").take(pa.array(rows, pa.int64()))
            yield out.append_column("first", pa.array(first, pa.int64())).append_column("text", pa.array(parts, pa.string()))

    return run


def mixed_texts(docs: DataFrame, mixed: Mix, **names: str) -> DataFrame:
    """The mix itself: shard, slot, doc_id, first, words, text (the block as it stands), sorted by shard and slot in each partition.

    ``docs`` and names as given to ``mixture``.
    """
    id_column, text_column, source_column = (names.get(f"{k}_column", d) for k, d in (("id", "doc_id"), ("text", "text"), ("source", "source")))
    slim = docs.select(
        F.col(id_column).cast("long").alias("t_id"),
        mark(id_column, text_column, source_column).alias("t_mark"),
        F.col(text_column).cast("string").alias("text"),
    )
    cut = slim.mapInArrow(_cut(mixed.block_words), "t_id long, t_mark long, first long, text string")
    cut = cut.dropDuplicates(["t_id", "t_mark", "first"]).withColumnRenamed("first", "t_first")
    same = F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("mark") == F.col("t_mark")) & (F.col("first") == F.col("t_first"))
    out = mixed.blocks.join(cut, same).select("shard", "slot", "doc_id", "first", "words", "text")
    return out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
