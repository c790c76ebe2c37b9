"""Rules as one deterministic byte automaton: regular expressions, subset construction, minimisation."""

from __future__ import annotations

from collections import defaultdict

Node = tuple


class _Parser:
    """Literals, ``\\`` escapes, classes, groups, ``|`` and the repeats ``? * + {n} {n,}`` into a tree over bytes."""

    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold

    def parse(self) -> Node:
        tree = self._either()
        if self.at != len(self.text):
            raise ValueError(f"cannot read {self.text!r} at {self.at}")
        return tree

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self) -> Node:
        options = [self._row()]
        while self._peek() == "|":
            self.at += 1
            options.append(self._row())
        return ("or", options) if len(options) > 1 else options[0]

    def _row(self) -> Node:
        items = []
        while self._peek() not in ("", "|", ")"):
            items.append(self._repeat(self._item()))
        return ("row", items)

    def _repeat(self, item: Node) -> Node:
        sign = self._peek()
        if sign == "{":
            stop = self.text.index("}", self.at)
            low, comma, _ = self.text[self.at + 1 : stop].partition(",")
            self.at = stop + 1
            copies = [item] * int(low)
            return ("row", [*copies, ("many", item)] if comma else copies)
        if sign and sign in "?*+":
            self.at += 1
            return {"?": ("or", [item, ("row", [])]), "*": ("many", item), "+": ("row", [item, ("many", item)])}[sign]
        return item

    def _item(self) -> Node:
        sign = self._peek()
        if sign == "(":
            self.at += 1
            inner = self._either()
            self.at += 1
            return inner
        if sign == "[":
            return ("byte", self._class())
        return ("byte", self._cased({self._code()}))

    def _code(self) -> int:
        sign = self._peek()
        self.at += 1
        if sign != "\\":
            return ord(sign)
        sign = self._peek()
        self.at += 1
        if sign == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(sign)

    def _class(self) -> frozenset[int]:
        self.at += 1
        codes: set[int] = set()
        while self._peek() != "]":
            low = high = self._code()
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self._code()
            codes.update(range(low, high + 1))
        self.at += 1
        return self._cased(codes)

    def _cased(self, codes: set[int]) -> frozenset[int]:
        if self.fold:
            codes = codes | {ord(chr(c).swapcase()) for c in codes if c < 128 and chr(c).isalpha()}
        return frozenset(codes)


def parse(pattern: str, fold: bool = False) -> Node:
    return _Parser(pattern, fold).parse()


def reverse(tree: Node) -> Node:
    kind, value = tree
    if kind == "row":
        return ("row", [reverse(x) for x in reversed(value)])
    if kind == "or":
        return ("or", [reverse(x) for x in value])
    return ("many", reverse(value)) if kind == "many" else tree


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append(None)
        return len(self.free) - 1

    def build(self, tree: Node, start: int) -> int:
        """States for ``tree`` behind ``start``; its end state."""
        kind, value = tree
        if kind == "byte":
            end = self.state()
            fresh = self.state()
            self.free[start].append(fresh)
            self.moves[fresh] = (value, end)
            return end
        if kind == "row":
            for part in value:
                start = self.build(part, start)
            return start
        if kind == "or":
            end = self.state()
            for part in value:
                first = self.state()
                self.free[start].append(first)
                self.free[self.build(part, first)].append(end)
            return end
        loop, end = self.state(), self.state()
        self.free[start].append(loop)
        self.free[loop].append(end)
        self.free[self.build(value, loop)].append(loop)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _classes(nfa: _Nfa) -> list[list[int]]:
    """Bytes that every move treats alike, together."""
    sets = {m[0] for m in nfa.moves if m}
    groups: dict[tuple, list[int]] = defaultdict(list)
    for b in range(256):
        groups[tuple(b in s for s in sets)].append(b)
    return list(groups.values())


def _minimal(steps: list[list[int]], accepts: list[int]) -> list[int]:
    """The block of every state: states are split until those of a block agree in all their steps."""
    block = list(accepts)
    count = len(set(block))
    while True:
        names: dict[tuple, int] = {}
        block = [names.setdefault((block[s], *(block[t] for t in steps[s])), len(names)) for s in range(len(steps))]
        if len(names) == count:
            return block
        count = len(names)


class Automaton:
    """Transition array ``table[state + byte]`` with states as multiples of 256.

    States that accept come last, from ``first`` on; ``masks[state >> 8]`` has a bit for each tree that ends
    there.  With ``search`` a match may begin at every byte.  ``dead`` is the state that nothing leaves, or -1.
    """

    def __init__(self, trees: list[Node], search: bool):
        nfa = _Nfa()
        start = nfa.state()
        ends = {}
        for k, tree in enumerate(trees):
            first = nfa.state()
            nfa.free[start].append(first)
            ends[nfa.build(tree, first)] = 1 << k
        classes = _classes(nfa)
        origin = nfa.closure([start])
        index, order, steps = {origin: 0}, [origin], []
        for current in order:
            row = []
            for group in classes:
                b = group[0]
                moved = {m[1] for s in current if (m := nfa.moves[s]) and b in m[0]}
                target = nfa.closure(moved) | (origin if search else frozenset())
                if target not in index:
                    index[target] = len(order)
                    order.append(target)
                row.append(index[target])
            steps.append(row)
        masks = [sum(bit for end, bit in ends.items() if end in current) for current in order]
        block = _minimal(steps, masks)
        shown = {b: s for s, b in reversed(list(enumerate(block)))}
        ranked = sorted(shown, key=lambda b: (masks[shown[b]] != 0, b))
        place = {b: k for k, b in enumerate(ranked)}
        self.size = len(ranked)
        self.table = [0] * (256 * self.size)
        self.masks = [masks[shown[b]] for b in ranked]
        for b in ranked:
            for group, target in zip(classes, steps[shown[b]]):
                for byte in group:
                    self.table[256 * place[b] + byte] = 256 * place[block[target]]
        self.start = 256 * place[block[0]]
        self.first = 256 * sum(m == 0 for m in self.masks)
        lost = [k for k in range(self.size) if not self.masks[k] and set(self.table[256 * k : 256 * k + 256]) == {256 * k}]
        self.dead = 256 * lost[0] if lost else -1
