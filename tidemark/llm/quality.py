"""Document quality by attention over passages (multiple-instance learning with gated attention).

A document is a bag of passages of ``PASSAGE`` words, each described by its words (signed counts in ``BUCKETS`` buckets
of their hashes) and by how it is written (shares of kinds of bytes, repeats, word lengths).  A small network encodes
every passage, learns from document labels how much each passage counts (tanh times sigmoid gates, softmax over the
bag), and scores the weighted mean of the encodings.  It is trained on all passages of all labelled documents, which
are dealt to shards of about ``SHARD_PASSAGES``: in each of ``ROUNDS`` rounds the shards learn ``TURNS`` turns apart
from the same weights, and the mean of theirs by documents is where the next round begins; a single shard learns all
its turns at once.  Scoring is one pass over all passages of all texts, which are encoded block by block, so of a long
text only the encodings are held.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, batch_words, text_bytes

PASSAGE = 64
#: Passages that one task learns from at a time, on average.
SHARD_PASSAGES = 1 << 15
#: Rounds after which the weights of several shards are put together, and turns over the documents in each.
ROUNDS, TURNS = 10, 4
#: Buckets of word hashes; the sign of a word is another bit of its hash.
BUCKETS = 256
#: Strength of the prior that holds the weights of words near zero.
WORD_PRIOR = 0.3
#: Passages that are described and encoded together, and parts that sums over shards are added up in.
_BLOCK, _SLICES = 1 << 13, 16

#: Kinds of bytes whose shares describe a passage.
_KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", "\n", "!", "|",
          "#*$%&<>", ".?", ",;:", "'\"()-", "=+/\\_~^`@[]{}")
_KIND = np.full(256, len(_KINDS) + 1, np.int64)
_KIND[:128] = len(_KINDS)
for _k, _signs in enumerate(_KINDS):
    _KIND[[ord(c) for c in _signs]] = _k
_WIDTH = len(_KINDS) + 2
_BACK = 4
_PLAIN = _WIDTH + _BACK + 3
FEATURES = _PLAIN + BUCKETS
#: Bytes of a passage as it waits to be learnt from: its plain inputs, and the sums of its buckets as whole numbers.
_PACKED = 4 * _PLAIN + BUCKETS


def passages(raw: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of features for the passages of a text, ``_BLOCK`` at a time; a text without words is one row of zeros."""
    if not len(hashes):
        yield np.zeros((1, FEATURES), np.float32)
    step = PASSAGE * _BLOCK
    for low in range(0, len(hashes), step):
        high = min(low + step, len(hashes))
        begin = int(starts[low]) if low else 0
        end = int(starts[high]) if high < len(hashes) else len(raw)
        back = hashes[max(low - _BACK, 0) : low]
        yield _describe(raw[begin:end], hashes[low:high], back, starts[low:high] - begin, ends[low:high] - begin)


def _describe(raw: np.ndarray, hashes: np.ndarray, back: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Features of the passages of a block; ``back`` are the hashes of the words before it."""
    firsts = np.arange(0, len(hashes), PASSAGE)
    count, n = np.diff(np.append(firsts, len(hashes))), len(firsts)
    out = np.zeros((n, FEATURES), np.float32)
    places = np.append(starts[firsts], len(raw))
    places[0] = 0
    sizes = np.diff(places)
    kind = _KIND[raw] + np.repeat(np.arange(n) * _WIDTH, sizes)
    out[:, :_WIDTH] = np.bincount(kind, minlength=n * _WIDTH).reshape(n, _WIDTH) / sizes[:, None]
    known = np.concatenate([back, hashes])
    for k in range(1, _BACK + 1):
        same = np.zeros(len(known))
        same[k:] = known[k:] == known[:-k]
        out[:, _WIDTH + k - 1] = np.add.reduceat(same[len(back) :], firsts) / count
    long = (ends - starts).astype(float)
    out[:, _PLAIN - 3] = np.add.reduceat(long, firsts) / count / 10
    out[:, _PLAIN - 2] = np.add.reduceat(np.minimum(long, 40) ** 2, firsts) / count / 100
    out[:, _PLAIN - 1] = count / PASSAGE
    bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64) + np.arange(len(hashes)) // PASSAGE * BUCKETS
    sign = ((hashes >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
    words = np.bincount(bucket, weights=sign, minlength=n * BUCKETS).reshape(n, BUCKETS)
    out[:, _PLAIN:] = words / np.sqrt(count)[:, None]
    return out


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
    """Number of passages and the blocks of each text of a column."""
    raw, at = text_bytes(batch.column(column))
    for row, hashes, starts, ends in batch_words(batch.column(column)):
        yield max(-(-len(hashes) // PASSAGE), 1), passages(raw[at[row] : at[row + 1]], hashes, starts, ends)


def _bag(count: int, blocks: Iterator[np.ndarray], most: int) -> np.ndarray:
    """All passages of a text, or ``most`` evenly spaced ones."""
    chosen, low, kept = np.linspace(0, count - 1, min(count, most)).astype(np.int64), 0, []
    for block in blocks:
        kept.append(block[chosen[(chosen >= low) & (chosen < low + len(block))] - low])
        low += len(block)
    return np.concatenate(kept)


def _packed(rows: np.ndarray) -> np.ndarray:
    """Passages in ``_PACKED`` bytes each; a bucket's sum is at most the number of words."""
    sums = np.rint(rows[:, _PLAIN:] * np.sqrt(rows[:, _PLAIN - 1 : _PLAIN].astype(np.float64) * PASSAGE)).astype(np.int8)
    plain = np.ascontiguousarray(rows[:, :_PLAIN], "<f4").view(np.uint8).reshape(len(rows), -1)
    return np.concatenate([plain, sums.view(np.uint8)], axis=1)


def _unpacked(packed: np.ndarray) -> np.ndarray:
    """The passages as they were described."""
    out = np.empty((len(packed), FEATURES), np.float32)
    out[:, :_PLAIN] = np.ascontiguousarray(packed[:, : 4 * _PLAIN]).view("<f4")
    count = np.maximum(np.rint(out[:, _PLAIN - 1 : _PLAIN].astype(np.float64) * PASSAGE), 1)
    out[:, _PLAIN:] = packed[:, 4 * _PLAIN :].view(np.int8) / np.sqrt(count)
    return out


class Network:
    """The encoder (W, b), gates (V, U, w) and output (c, c0) as numpy arrays."""

    def __init__(self, hidden: int = 24, gates: int = 12, seed: int = 11):
        draw = np.random.default_rng(seed)
        normal = lambda *shape: draw.normal(0, shape[0] ** -0.5, shape)
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {
            "W": normal(FEATURES, hidden), "b": np.zeros(hidden), "V": normal(hidden, gates), "U": normal(hidden, gates),
            "w": normal(gates), "c": np.zeros(hidden), "c0": np.zeros(1),
        }
        self.p["W"][_PLAIN:] = 0  # a bucket says nothing until it is learnt
        self.m, self.v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        self.step = 0

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Encodings, both gates and weights before the softmax of passages."""
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        return h, t, g, (t * g) @ p["w"]

    def pool(self, h: np.ndarray, s: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Scores, shares and weighted encodings of the bags whose passages begin at ``first``."""
        p, sizes = self.p, np.diff(np.append(first, len(h)))
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, first), sizes))
        a = e / np.repeat(np.add.reduceat(e, first), sizes)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        out = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["c0"], -30, 30)))
        return out, a, z, sizes

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict]:
        """Scores of the bags whose passages begin at ``first``, and what the gradient needs."""
        h, t, g, s = self.encode(x)
        out, a, z, sizes = self.pool(h, s, first)
        return out, {"x": x, "sizes": sizes, "h": h, "t": t, "g": g, "a": a, "z": z}

    def gradient(self, out: np.ndarray, label: np.ndarray, first: np.ndarray, f: dict) -> dict[str, np.ndarray]:
        grads, dh = self._back(out, label, first, f)
        return {"W": f["x"].T @ dh, **grads}

    def _back(self, out: np.ndarray, label: np.ndarray, first: np.ndarray, f: dict) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """The gradient but that of W, and that of the sums that W makes."""
        p, miss = self.p, (out - label) / len(label)
        dz = np.repeat(miss[:, None] * p["c"], f["sizes"], axis=0)
        da = (dz * f["h"]).sum(axis=1)
        ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first), f["sizes"]))
        dtg = ds[:, None] * p["w"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {
            "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ ds,
            "c": f["z"].T @ miss, "c0": miss.sum(keepdims=True),
        }, dh

    def _slope(self, bags: list[np.ndarray], label: np.ndarray) -> dict[str, np.ndarray]:
        """The gradient over packed bags; of long ones only the encodings are held, and the inputs by blocks."""
        first = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
        rows = np.concatenate(bags)
        inputs = lambda low: (_unpacked(rows[low : low + _BLOCK]) - self.mean) / self.scale
        if len(rows) <= _BLOCK:
            out, kept = self.forward(inputs(0), first)
            return self.gradient(out, label, first, kept)
        lows = range(0, len(rows), _BLOCK)
        h, t, g, s = (np.concatenate(x) for x in zip(*[self.encode(inputs(low)) for low in lows]))
        out, a, z, sizes = self.pool(h, s, first)
        grads, dh = self._back(out, label, first, {"sizes": sizes, "h": h, "t": t, "g": g, "a": a, "z": z})
        return {"W": sum(inputs(low).T @ dh[low : low + _BLOCK] for low in lows), **grads}

    def scale_by(self, rows: float, squares: np.ndarray) -> None:
        """Scales of the inputs from the sums of the squares of their distances from ``mean``."""
        self.scale = np.sqrt(squares / rows) + 1e-3
        # words together vary as much as the other inputs together
        self.scale[_PLAIN:] *= np.sqrt(BUCKETS / _PLAIN)

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> None:
        """All turns over packed bags, with means and scales of their own."""
        rows, total = _sums(bags)
        self.mean = total / rows
        self.scale_by(rows, _squares(bags, self.mean))
        self.learn(bags, labels, range(ROUNDS * TURNS), len(bags), np.random.default_rng(3))

    def learn(
        self, bags: list[np.ndarray], labels: np.ndarray, turns: range, documents: int, draw: np.random.Generator,
        *, batch: int = 128, rate: float = 0.01,
    ) -> None:
        """Cross entropy by Adam over shuffled batches in these turns of all, in an order that ``draw`` gives.

        The weights of words are held back by a prior of ``WORD_PRIOR`` of all ``documents``, so few labels teach few
        words.
        """
        hold = {k: np.full(x.shape, 1e-4) for k, x in self.p.items()}
        hold["W"][_PLAIN:] += WORD_PRIOR / documents
        m, v = self.m, self.v
        for turn in turns:
            order = draw.permutation(len(bags))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                slope = self._slope([bags[i] for i in own], labels[own])
                self.step += 1
                pace = rate * (1 - turn / (ROUNDS * TURNS)) + 1e-4
                for k, grad in slope.items():
                    grad = grad + hold[k] * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.99 * v[k] + 0.01 * grad**2
                    self.p[k] = self.p[k] - pace * (m[k] / (1 - 0.9**self.step)) / (np.sqrt(v[k] / (1 - 0.99**self.step)) + 1e-8)

    def state(self) -> np.ndarray:
        """All that is learnt as one array."""
        parts = [self.mean, self.scale, *[x[k].ravel() for x in (self.p, self.m, self.v) for k in self.p], [self.step]]
        return np.concatenate(parts).astype(np.float64)

    def set_state(self, state: np.ndarray) -> None:
        self.mean, self.scale, at = state[:FEATURES], state[FEATURES : 2 * FEATURES], 2 * FEATURES
        for x in (self.p, self.m, self.v):
            for k in x:
                x[k] = state[at : at + x[k].size].reshape(x[k].shape).copy()
                at += x[k].size
        self.step = float(state[at])

    def score(self, texts: Iterator[tuple[int, Iterator[np.ndarray]]]) -> np.ndarray:
        """Scores of texts given as blocks of passages; blocks are dropped once they are encoded."""
        sizes, waiting, held, codes, weights = [], [], 0, [], []

        def encode():
            h, _, _, s = self.encode((np.concatenate(waiting) - self.mean) / self.scale)
            codes.append(h)
            weights.append(s)
            waiting.clear()

        for count, blocks in texts:
            sizes.append(count)
            for block in blocks:
                waiting.append(block)
                held += len(block)
                if held >= _BLOCK:
                    encode()
                    held = 0
        if waiting:
            encode()
        if not sizes:
            return np.zeros(0)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        return self.pool(np.concatenate(codes), np.concatenate(weights), first)[0]


def _sums(bags: list[np.ndarray]) -> tuple[int, np.ndarray]:
    """Number of passages of packed bags, and the sums of their inputs."""
    return sum(len(b) for b in bags), sum(_unpacked(b).sum(axis=0, dtype=np.float64) for b in bags)


def _squares(bags: list[np.ndarray], mean: np.ndarray) -> np.ndarray:
    return sum(((_unpacked(b) - mean) ** 2).sum(axis=0) for b in bags)


def _encode(bag: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes = [], []
            for count, blocks in _texts(batch, 1):
                kept = blocks if bag is None else [_bag(count, blocks, bag)]
                rows.append(b"".join(_packed(block).tobytes() for block in kept))
                sizes.append(len(rows[-1]) // _PACKED)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(rows, pa.binary()), batch.column(2)],
                ["doc_id", "passages", "bag", "label"],
            )

    return run


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(number, packed bags, labels) of the shards of a task, whose rows come one shard after the other."""
    now, bags, labels = None, [], []
    for batch in batches:
        for shard, bag, label in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            if shard != now and bags:
                yield now, bags, np.array(labels)
                bags, labels = [], []
            now = shard
            bags.append(np.frombuffer(bag.as_py(), np.uint8).reshape(-1, _PACKED))
            labels.append(label)
    if bags:
        yield now, bags, np.array(labels)


def _over_shards(shards: DataFrame, fact: Callable[[int, list[np.ndarray], np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of an array that ``fact`` gives for each shard; slices of it are added up by a task each, in order of shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, bags, labels in _shards(batches):
            parts = [x.astype("<f8").tobytes() for x in np.array_split(fact(shard, bags, labels), _SLICES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * _SLICES, pa.int64()), pa.array(range(_SLICES), pa.int32()), pa.array(parts, pa.binary())],
                ["shard", "slice", "part"],
            )

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<f8") for x in parts.sort_by("shard")["part"].to_pylist())
        return pa.table({"slice": pa.array([parts["slice"][0].as_py()], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    kind = "slice int, part binary"
    sums = shards.mapInArrow(run, f"shard long, {kind}").groupBy("slice").applyInArrow(add, kind)
    parts = dict(tuple(r) for r in sums.collect())
    return np.frombuffer(b"".join(bytes(parts[k]) for k in range(_SLICES)), "<f8")


def _fit_shards(network: Network, shards: DataFrame, documents: int) -> None:
    """Rounds in which every shard learns from the same weights and the mean of theirs goes on."""

    def sums(shard, bags, labels):
        rows, total = _sums(bags)
        return np.append(total, rows)

    *total, rows = _over_shards(shards, sums)
    mean = np.array(total) / rows
    network.mean = mean
    network.scale_by(rows, _over_shards(shards, lambda shard, bags, labels: _squares(bags, mean)))
    for k in range(ROUNDS):
        begun = copy.deepcopy(network)

        def learnt(shard, bags, labels, begun=begun, k=k):
            own = copy.deepcopy(begun)
            turns = range(k * TURNS, (k + 1) * TURNS)
            own.learn(bags, labels, turns, documents, np.random.default_rng((3, k, shard)))
            return len(bags) * own.state()

        network.set_state(_over_shards(shards, learnt) / documents)


def _scores(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = network.score(_texts(batch, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:1], pa.array(out), *batch.columns[2:]],
                                             ["doc_id", "score", "held_out"])

    return run


def _good(network: Network, where: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(network.score(_texts(batch, where)) >= 0.5, pa.bool_()))

    return run


def train(
    docs: DataFrame, labels: DataFrame, *, sample: int | None = None, bag: int | None = None, shard_passages: int = SHARD_PASSAGES
) -> Network:
    """A network fitted on all passages of all documents that ``labels`` (doc_id and label) has.

    ``sample`` and ``bag``, if given, bound the documents and the passages of one.  Labels are 1 (good) or 0 (bad);
    another one is an error.  Null labels and ids are left out, of several labels of a document the lowest counts.
    Without labels every score is one half.
    """
    space = Workspace(docs.sparkSession, "quality")
    wrong = F.raise_error(F.concat(F.lit("label neither 0 nor 1: "), F.col("label").cast("string"))).cast("int")
    checked = F.when(F.col("label").isin(0, 1), F.col("label").cast("int")).otherwise(wrong)
    some = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min(checked).alias("label"))
    if sample is not None:
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # labels grow with the texts: they meet by a shuffle at every size, and no text is sorted for it
    chosen = docs.select("doc_id", "text").join(some.hint("shuffle_hash"), "doc_id")
    bags = chosen.select("doc_id", "text", F.col("label").cast("double").alias("label")).mapInArrow(
        _encode(bag), "doc_id long, passages long, bag binary, label double"
    )
    bags = space.store(bags, "bags")
    documents, passages = bags.agg(F.count(F.lit(1)), F.sum("passages")).first()
    network = Network()
    if documents:
        parts = -(-passages // shard_passages)
        dealt = bags.select(F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("shard"), "bag", "label", "doc_id")
        dealt = dealt.repartition(parts, "shard").sortWithinPartitions("shard", "doc_id", "bag", "label")
        shards = space.store(dealt, "shards").select("shard", "bag", "label")
        space.drop("bags")
        if parts == 1:
            network.set_state(_over_shards(shards, _alone))
        else:
            _fit_shards(network, shards, documents)
    space.drop("bags", "shards")
    return network


def _alone(shard: int, bags: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    network = Network()
    network.fit(bags, labels)
    return network.state()


def quality_scores(
    docs: DataFrame, labels: DataFrame, held_out: Column, *, sample: int | None = None, id_column="doc_id", text_column="text"
) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher is better) and predicted (1 from 0.5) of every row of ``docs``.

    ``labels`` has doc_id and label; documents where ``held_out`` (over doc_id) holds are not learnt from.  Only the text
    enters a score.  Null and empty texts are a bag of one empty passage; ids may be null (not held out) or repeat.
    """
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    out = F.coalesce(held_out, F.lit(False))
    network = train(slim.where(~out), labels.where(~out), sample=sample)
    found = slim.select("doc_id", "text", out.alias("held_out")).mapInArrow(
        _scores(network), "doc_id long, score double, held_out boolean"
    )
    return found.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def good_documents(
    docs: DataFrame, labels: DataFrame, held_out: Column, *, sample: int | None = None, id_column="doc_id", text_column="text"
) -> DataFrame:
    """The rows of ``docs`` that score one half or more, with all their columns; trained as in ``quality_scores``."""
    out = F.coalesce(held_out, F.lit(False))
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    network = train(slim.where(~out), labels.where(~out), sample=sample)
    return docs.mapInArrow(_good(network, docs.columns.index(text_column)), docs.schema)
