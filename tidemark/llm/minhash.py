"""Near duplicates by one-permutation hashing with optimal densification.

Every text becomes the set of its word shingles.  The hash range is divided into ``bins``; a bin keeps the
smallest hash that falls in it, and an empty bin borrows from a full one in an order of its own, the same for
every text (optimal densification).  ``rows`` bins in a row form a band, and equal bands form a bucket.  A bucket
proposes a star: its smallest document with every other one, so candidates grow with the bucket and not with its
square.  Candidates are confirmed on the full sets.  Where a bucket then still holds several components, its star may
have hidden a link.  The documents of such buckets are searched once more, exactly: those of different components that
share one of their rarest shingles (prefix filter, with sizes and places) are confirmed as well.  So no link between
documents that share a bucket goes unseen; pairs grow with the documents outside the largest component of a shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, batch_words, chain, mix, shingles
from tidemark.llm.components import components

BINS, ROWS = 512, 8
#: Below this many full bins, ranks of the full bins are compared; above, bins are probed in order.
_FEW = 22


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text with fewer words is one shingle, without words the set is empty."""
    if not len(words):
        return words
    if len(words) < width:
        whole = words[:1]
        for k in range(1, len(words)):
            whole = chain(whole, words[k : k + 1])
        return mix(whole + np.uint64(len(words)))
    return np.unique(shingles(words, width) if width > 1 else mix(words))


@lru_cache(maxsize=4)
def _orders(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bin its order of lenders, and the place of each lender in it."""
    random = np.random.Generator(np.random.PCG64(bins))
    probe = np.stack([random.permutation(bins) for _ in range(bins)]).astype(np.int32)
    rank = np.empty_like(probe)
    np.put_along_axis(rank, probe, np.arange(bins, dtype=np.int32)[None, :].repeat(bins, 0), 1)
    return probe, rank


def signature(found: np.ndarray, bins: int) -> np.ndarray:
    """Least hash per bin of a sorted non-empty set; empty bins borrow."""
    probe, rank = _orders(bins)
    which = (found >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(which, prepend=-1))
    full = which[first]
    out = np.zeros(bins, np.uint64)
    out[full] = found[first]
    if len(full) == bins:
        return out
    has = np.zeros(bins, bool)
    has[full] = True
    empty = np.flatnonzero(~has)
    if len(full) <= _FEW:
        lender = full[np.argmin(rank[empty][:, full], axis=1)]
    else:
        lender, todo, k = np.empty(len(empty), np.int64), np.arange(len(empty)), 0
        while len(todo):
            tried = probe[empty[todo], k]
            good = has[tried]
            lender[todo[good]] = tried[good]
            todo, k = todo[~good], k + 1
    out[empty] = mix(out[lender] + empty.astype(np.uint64))
    return out


def _band_keys(sign: np.ndarray, rows: int) -> np.ndarray:
    bands = sign[: len(sign) // rows * rows].reshape(-1, rows)
    key = np.arange(len(bands), dtype=np.uint64)
    for k in range(rows):
        key = chain(key, bands[:, k])
    return key


def _signed(width: int, bins: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands = [], [], []
            for _, words, _, _ in batch_words(batch.column(1)):
                found = shingle_set(words, width)
                sizes.append(len(found))
                if not len(found):
                    digests.append(None)
                    bands.append(None)
                    continue
                sign = signature(found, bins)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                bands.append(_band_keys(sign, rows).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "bands"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [shingle_set(words, width).view(np.int64) for _, words, _, _ in batch_words(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["id", "found"]
            )

    return run


def _prefixes(sets: DataFrame, labels: DataFrame, space: Workspace, percent: int) -> DataFrame:
    """The rarest shingles of every set, as many as a linked set cannot miss all of: x, id, label, n, place (from 1).

    Shingles are ordered by the number of these sets that hold them, the same for every set.
    """
    each = space.store(sets.select("id", F.explode("found").alias("x")), "each")
    held = space.store(each.groupBy("x").agg(F.count(F.lit(1)).alias("f")), "held")
    ordered = each.join(held, "x").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("f", "x")))["x"].alias("found"))
    n = F.size("found")
    most = (n - F.ceil(percent * n / 100) + 1).cast("int")
    first = ordered.join(labels, "id", "left").select(
        "id", F.coalesce("label", "id").alias("label"), n.alias("n"), F.posexplode(F.slice("found", F.lit(1), most))
    )
    return first.select(F.col("col").alias("x"), "id", "label", "n", (F.col("pos") + 1).alias("place"))


def _across(prefix: DataFrame, space: Workspace, percent: int) -> DataFrame:
    """Pairs (u, v) of different components that share a shingle of their prefixes and may still be linked.

    Of the sets with a shingle all outside its largest component meet all others.  The first shingle that two sets share
    leaves them no more in common than what follows it; both must then hold the overlap that a link takes.
    """
    group = prefix.groupBy("x", "label").agg(F.count(F.lit(1)).alias("c"))
    mixed = group.groupBy("x").agg(
        F.max(F.struct("c", "label"))["label"].alias("most"), F.count(F.lit(1)).alias("k")
    ).where("k > 1").select("x", "most")
    # stored, so that the joins have exchanges of their own on both sides and a frequent shingle can be split
    mixed = space.store(mixed, "mixed")
    centre = space.store(prefix.join(mixed, "x").where("label <> most").select(*prefix.columns), "centre")
    a, b = prefix.alias("a"), centre.alias("b")
    rest = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place")) + 1
    alike = (
        (F.col("a.x") == F.col("b.x")) & (F.col("a.label") != F.col("b.label"))
        & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
        & ((100 + percent) * rest >= percent * (F.col("a.n") + F.col("b.n")))
    )
    return a.join(b, alike).select(F.least("a.id", "b.id").alias("u"), F.greatest("a.id", "b.id").alias("v")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity."""
    left = sets.select(F.col("id").alias("u"), F.col("found").alias("a"), F.size("found").alias("na"))
    right = sets.select(F.col("id").alias("v"), F.col("found").alias("b"), F.size("found").alias("nb"))
    near = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    both = F.size(F.array_intersect("a", "b"))
    return (
        pairs.join(left, "u").join(right, "v").where(near)
        .select("u", "v", "na", "nb", both.alias("both"))
        .where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both")))
        .select("u", "v").distinct()
    )


def near_duplicates(
    docs: DataFrame, *, width: int = 5, percent: int = 80, bins: int = BINS, rows: int = ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable), kept.

    Texts are linked when 100 * intersection >= ``percent`` * union of their ``width``-word shingle sets.
    Null, empty and blank texts have no shingles and are linked with nothing.  Rows without an id are linked with
    nothing either: their component_id is null and they are kept.  Rows that repeat an id are one document.
    Other columns are not looked at; ``bins`` must be a power of two.
    """
    if bins & (bins - 1) or bins < 64:
        raise ValueError("bins must be a power of two, 64 at least")
    spark = docs.sparkSession
    space = Workspace(spark, "minhash")
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = "doc_id long, n_shingles long, digest binary, bands array<long>"
    signed = space.store(slim.mapInArrow(_signed(width, bins, rows), kind), "signed")

    # exact copies of a set stand behind their smallest document
    some = signed.where("digest is not null and doc_id is not null")
    # stored, so that the join has an exchange of its own on both sides and a frequent set can be split
    lead = space.store(some.groupBy("digest").agg(F.min("doc_id").alias("lead")), "leads")
    first = F.col("doc_id") == F.col("lead")
    members = some.join(lead, "digest").select(
        "doc_id", "n_shingles", "lead", F.when(first, F.col("bands")).alias("bands"),
    )
    members = space.store(members, "members")
    alone = signed.where("digest is null or doc_id is null").select("doc_id", "n_shingles")
    alone = space.store(alone, "alone")
    space.drop("signed", "leads")

    leads = members.where("bands is not null")
    banded = leads.select(F.col("lead").alias("id"), F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(
        F.min("id").alias("u"), F.max("id").alias("v"), F.count(F.lit(1)).alias("n")
    ).where("u < v")
    buckets = space.store(buckets, "buckets")
    large = buckets.where("n > 2").select("key", "u").join(banded, "key")
    large = space.store(large.select("key", "u", F.col("id").alias("v")), "large")
    star = buckets.where("n = 2").select("u", "v").union(large.where("u <> v").select("u", "v")).distinct()
    star = space.store(star, "star")
    wanted = star.select(F.col("u").alias("doc_id")).union(star.select("v")).distinct()
    # by merging at every size: a broadcast of the candidates would grow with the corpus
    sets = slim.where("doc_id is not null").join(wanted.hint("merge"), "doc_id", "left_semi")
    sets = space.store(sets.mapInArrow(_sets(width), "id long, found array<long>"), "sets")
    edges = space.store(_confirmed(star, sets, percent), "edges")
    labels = components(edges, space, "labels")

    # documents of buckets that still hold several components: all links between those components
    node = large.select("key", F.col("v").alias("id")).join(labels, "id", "left")
    node = node.select("key", "id", F.coalesce("label", "id").alias("label"))
    several = node.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    several = space.store(several.select("key"), "several")
    unsettled = space.store(node.join(several, "key").select("id").distinct(), "unsettled")
    prefix = _prefixes(sets.join(unsettled, "id", "left_semi"), labels, space, percent)
    prefix = space.store(prefix, "prefix")
    space.drop("several", "unsettled", "each", "held", "buckets", "large")
    fresh = space.store(_across(prefix, space, percent).join(star, ["u", "v"], "left_anti"), "fresh")
    space.drop("prefix", "mixed", "centre")
    more = space.store(_confirmed(fresh, sets, percent), "more")
    if not more.isEmpty():
        labels = components(edges.union(more), space, "relabels")
    space.drop("star", "sets", "edges", "fresh", "more")

    named = members.select("doc_id", "n_shingles", "lead").join(
        labels.select(F.col("id").alias("lead"), "label"), "lead", "left"
    )
    linked = named.select("doc_id", "n_shingles", F.coalesce("label", "lead").alias("component_id"))
    rest = alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
