"""Secrets: all rules compiled into one minimal automaton that reads every byte once.

A rule is a head and a body, a run of bytes of one class.  The automaton reports where a head and the first
``probe`` bytes of its body end; a small automaton of the same rule read backwards gives the leftmost start, and the
body is followed to its end.  Matches of a rule are leftmost and do not overlap; those with a body shorter than
``least`` are dropped and not tried again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.automaton import Automaton, parse, reverse


@dataclass(frozen=True)
class Rule:
    """``probe`` may exceed 1 only where a match with a shorter body cannot hide another match."""

    kind: str
    head: str
    body: str
    least: int
    probe: int = 1
    fold: bool = False


#: Base rules: assign (12 characters of value), access (18 in all), hex (16).
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 12, fold=True),
    Rule("access", "AKIA", "[A-Z0-9]", 14),
    Rule("hex", "", "[0-9a-f]", 16, 16),
)
#: Public formats of issued tokens and keys.
ADDED = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 20),
    Rule("jwt", "eyJ", "[A-Za-z0-9_.-]", 60),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", "[\\x0A\\x0DA-Za-z0-9+/=]", 1),
)
BASE_KINDS = tuple(r.kind for r in BASE)


class Scanner:
    """The rules as transition arrays."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        trees = [parse(f"{r.head}{r.body}{{{r.probe}}}", r.fold) for r in rules]
        self.all = Automaton(trees, search=True)
        self.back = [Automaton([reverse(t)], search=False) for t in trees]
        self.ends = [[k for k in range(len(rules)) if mask >> k & 1] for mask in self.all.masks]
        self.inside = [parse(r.body, r.fold)[1][0][1] for r in rules]

    def _start(self, k: int, data: bytes, end: int, low: int) -> int | None:
        """The leftmost start, not below ``low``, of what the rule has found up to ``end``."""
        back, table = self.back[k], self.back[k].table
        state, at, start = back.start, end, None
        while at > low and state != back.dead:
            at -= 1
            state = table[state + data[at]]
            if state >= back.first:
                start = at
        return start

    def scan(self, data: bytes) -> list[tuple[str, int, int]]:
        """(kind, start, end) in bytes, by start and then rule."""
        table, first, ends, state = self.all.table, self.all.first, self.ends, self.all.start
        done = [0] * len(self.rules)
        out = []
        for at, byte in enumerate(data):
            state = table[state + byte]
            if state >= first:
                for k in ends[state >> 8]:
                    if at < done[k] or (start := self._start(k, data, at + 1, done[k])) is None:
                        continue
                    end, inside = at + 1, self.inside[k]
                    while end < len(data) and data[end] in inside:
                        end += 1
                    done[k] = end
                    if end - (at + 1 - self.rules[k].probe) >= self.rules[k].least:
                        out.append((start, k, end))
        out.sort()
        return [(self.rules[k].kind, a, b) for a, k, b in out]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """The same in code points."""
        data = text.encode("utf-8", "surrogatepass")
        found = self.scan(data)
        if not found or len(data) == len(text):
            return found
        places, at, count = {}, 0, 0
        for p in sorted({x for _, a, b in found for x in (a, b)}):
            count += len(data[at:p].decode("utf-8", "surrogatepass"))
            places[p], at = count, p
        return [(kind, places[a], places[b]) for kind, a, b in found]


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _found(rules: tuple[Rule, ...]):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in batches:
            rows = [
                [{"kind": k, "start": a, "end": b} for k, a, b in scan.spans(text.as_py() or "")]
                for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    return run


def secrets(
    docs: DataFrame, *, rules: tuple[Rule, ...] = BASE + ADDED, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans``, an array of (kind, start, end) by start.

    Offsets count code points, the end is exclusive.  Null and empty texts have no spans; null and repeated ids are
    handed through; other columns are not looked at.  One pass, no shuffle.
    """
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return slim.mapInArrow(_found(rules), "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def _masked(rules: tuple[Rule, ...], where: int, mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in batches:
            texts = []
            for value in batch.column(where):
                text = value.as_py()
                pieces, at = [], 0
                for _, start, end in scan.spans(text or ""):
                    if end > at:
                        if start >= at:
                            pieces += [text[at:start], mark]
                        at = end
                texts.append("".join([*pieces, text[at:]]) if pieces else text)
            yield batch.set_column(where, batch.schema.field(where), pa.array(texts, batch.schema.field(where).type))

    return run


def without_secrets(
    docs: DataFrame, *, rules: tuple[Rule, ...] = BASE + ADDED, mark: str = "[secret]", text_column: str = "text"
) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; other columns, nulls and row count stay."""
    return docs.mapInArrow(_masked(rules, docs.columns.index(text_column), mark), docs.schema)
