"""A small regular-expression compiler: rules to one minimal deterministic automaton over bytes, as transition arrays."""

from __future__ import annotations

from collections import defaultdict

import numpy as np

ALL = (1 << 256) - 1


def _mask(chars) -> int:
    out = 0
    for c in chars:
        out |= 1 << c
    return out


class _Parser:
    """Byte regexes: literals, escapes (also \\\\xHH), classes, groups, |, ?, *, +, {m}, {m,}, {m,n}. Builds an NFA fragment (start, end)."""

    def __init__(self, text: str, nfa: "_Nfa", fold: bool):
        self.s, self.i, self.nfa, self.fold = text, 0, nfa, fold

    def alternatives(self):
        parts = [self.sequence()]
        while self.i < len(self.s) and self.s[self.i] == "|":
            self.i += 1
            parts.append(self.sequence())
        if len(parts) == 1:
            return parts[0]
        return ("or", parts)

    def sequence(self):
        parts = []
        while self.i < len(self.s) and self.s[self.i] not in "|)":
            parts.append(self.repeat())
        return ("and", parts)

    def repeat(self):
        what = self.atom()
        while self.i < len(self.s) and self.s[self.i] in "?*+{":
            c = self.s[self.i]
            if c == "{":
                close = self.s.index("}", self.i)
                low, _, high = self.s[self.i + 1 : close].partition(",")
                bounds = int(low), (int(high) if high else None) if "," in self.s[self.i : close] else int(low)
                self.i = close + 1
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
                self.i += 1
            what = ("rep", what, *bounds)
        return what

    def escape(self) -> int:
        c = self.s[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return 1 << int(self.s[self.i - 2 : self.i], 16)
        if c == "d":
            return _mask(range(48, 58))
        if c == "n":
            return 1 << 10
        return 1 << ord(c)

    def atom(self):
        c = self.s[self.i]
        self.i += 1
        if c == "(":
            if self.s.startswith("?:", self.i):
                self.i += 2
            out = self.alternatives()
            self.i += 1
            return out
        if c == "[":
            return ("set", self.cased(self.charset()))
        if c == ".":
            return ("set", ALL & ~(1 << 10))
        return ("set", self.cased(self.escape() if c == "\\" else 1 << ord(c)))

    def charset(self) -> int:
        negate = self.s[self.i] == "^"
        self.i += negate
        out, last = 0, None
        while self.s[self.i] != "]" or last is None and out == 0 and not negate and self.s[self.i + 1 : self.i + 2] == "]":
            c = self.s[self.i]
            self.i += 1
            one = self.escape() if c == "\\" else 1 << ord(c)
            if last is not None and c == "-" and self.s[self.i] != "]":
                c = self.s[self.i]
                self.i += 1
                end = self.escape() if c == "\\" else 1 << ord(c)
                one = _mask(range(last, end.bit_length()))
                last = None
            else:
                last = one.bit_length() - 1
            out |= one
        self.i += 1
        return ALL & ~out if negate else out

    def cased(self, chars: int) -> int:
        if self.fold:
            for a in range(65, 91):
                if chars >> a & 1 or chars >> (a + 32) & 1:
                    chars |= 1 << a | 1 << (a + 32)
        return chars


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.steps: list[list[tuple[int, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def build(self, node, start: int) -> int:
        """Adds node's states after start; returns the end."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.steps[start].append((node[1], end))
            return end
        if kind == "and":
            for part in node[1]:
                start = self.build(part, start)
            return start
        if kind == "or":
            end = self.state()
            for part in node[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.build(part, first)].append(end)
            return end
        _, what, low, high = node
        for _ in range(low):
            start = self.build(what, start)
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.build(what, loop)].append(loop)
            return loop
        ends = [start]
        for _ in range(high - low):
            start = self.build(what, start)
            ends.append(start)
        end = self.state()
        for x in ends:
            self.empty[x].append(end)
        return end


def _reverse(node):
    """The node that matches the texts of `node` from end to start."""
    kind = node[0]
    if kind == "and":
        return kind, [_reverse(x) for x in reversed(node[1])]
    if kind == "or":
        return kind, [_reverse(x) for x in node[1]]
    return node if kind == "set" else (kind, _reverse(node[1]), *node[2:])


class Automaton:
    """next[state * classes + byte_class[byte]]: the next state, times classes. Accepting states come last, from `accept` on; rules[i] is the set of rules, as bits, of the i-th of them.

    It searches: after any text it is in an accepting state of a rule if a match of that rule ends there. With search=False matches begin at the first byte alone, and with
    reverse=True texts are read from their end.
    """

    def __init__(self, rules: list[tuple[str, bool]], search: bool = True, reverse: bool = False):
        """rules: (byte regex, fold case)."""
        nfa = _Nfa()
        root = nfa.state()
        finals = {}
        for k, (regex, fold) in enumerate(rules):
            first = nfa.state()
            nfa.empty[root].append(first)
            node = _Parser(regex, nfa, fold).alternatives()
            finals[nfa.build(_reverse(node) if reverse else node, first)] = k
        masks = sorted({m for steps in nfa.steps for m, _ in steps})
        signature = defaultdict(list)
        for byte in range(256):
            signature[tuple(m >> byte & 1 for m in masks)].append(byte)
        groups = list(signature.values())
        self.byte_class = np.zeros(256, np.uint8)
        for c, group in enumerate(groups):
            self.byte_class[group] = c
        n = len(groups)
        moves = [[(frozenset(c for c, g in enumerate(groups) if m >> g[0] & 1), to) for m, to in steps] for steps in nfa.steps]
        near: dict[int, frozenset] = {}

        def closure(s: int) -> frozenset:
            if s not in near:
                seen, todo = {s}, [s]
                while todo:
                    for t in nfa.empty[todo.pop()]:
                        if t not in seen:
                            seen.add(t)
                            todo.append(t)
                near[s] = frozenset(x for x in seen if moves[x] or x in finals)
            return near[s]

        start = closure(root)
        index, order, table = {start: 0}, [start], []
        for now in order:  # subset construction; a search may begin anew at each byte, so every set holds the start
            to: list[set] = [set(start) if search else set() for _ in range(n)]
            for s in now:
                for classes, t in moves[s]:
                    for c in classes:
                        to[c] |= closure(t)
            row = []
            for x in map(frozenset, to):
                if x not in index:
                    index[x] = len(order)
                    order.append(x)
                row.append(index[x])
            table.append(row)
        steps = np.array(table)
        hit = np.array([sum(1 << finals[s] for s in x if s in finals) for x in order], object)
        block = np.unique(hit.astype(str), return_inverse=True)[1]
        while True:  # minimisation: states stay together while they agree in rules and in the blocks they go to
            new = np.unique(np.column_stack([block, block[steps]]), axis=0, return_inverse=True)[1].ravel()
            if new.max() == block.max():
                break
            block = new
        first = np.unique(block, return_index=True)[1]
        final = np.array([bool(hit[i]) for i in first])
        place = np.empty(len(first), np.int64)
        ranked = np.argsort(final, kind="stable")
        place[ranked] = np.arange(len(first))
        self.classes, self.states = n, len(first)
        self.next = np.empty((len(first), n), np.int32)
        self.next[place] = place[block[steps[first]]] * n
        self.next = self.next.ravel()
        self.start = np.int32(place[block[0]] * n)
        self.accept = np.int32((len(first) - final.sum()) * n)
        self.rules = [int(hit[first[i]]) for i in ranked[len(first) - final.sum() :]]

        dead = place[block[index[frozenset()]]] * n if frozenset() in index else -1
        self.dead = int(dead)

    def scan(self, texts: list[bytes], before: int = 10) -> list[list[tuple[int, int]]]:
        """For each text its hits in order, (end, rules as bits): the places after which matches end. All texts advance together, a byte each a step; those at their end drop out. Each text is read as if byte `before` stood in front of it."""
        found: list[list[tuple[int, int]]] = [[] for _ in texts]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-size, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        data = self.byte_class[data]
        begin = (np.cumsum(size) - size)[order]
        size = size[order]
        state = np.full(len(texts), self.next[self.start + self.byte_class[before]], np.int32)
        lanes, step = int((size > 0).sum()), 0
        while lanes:
            state, begin = state[:lanes], begin[:lanes]
            last = int(size[lanes - 1])
            if lanes < 4:  # a few long texts: byte by byte
                for k in range(lanes):
                    self._one(data[begin[k] + step : begin[k] + size[k]], int(state[k]), step, found[order[k]])
                return found
            for a in range(step, last, 256):
                b = min(a + 256, last)
                piece = data[begin[None, :] + np.arange(a, b)[:, None]]
                for at, column in enumerate(piece, a + 1):
                    state = self.next[state + column]
                    if state.max() >= self.accept:
                        for k in np.flatnonzero(state >= self.accept).tolist():
                            found[order[k]].append((at, self.rules[(int(state[k]) - int(self.accept)) // self.classes]))
            step = last
            lanes = int((size > step).sum())
        return found

    def _table(self) -> list[int]:
        if not hasattr(self, "_list"):
            self._list = self.next.tolist()
            self._class = self.byte_class.tobytes()
        return self._list

    def _one(self, data: np.ndarray, state: int, at: int, found: list[tuple[int, int]]) -> None:
        step, accept = self._table(), int(self.accept)
        for c in data.tobytes():
            state = step[state + c]
            at += 1
            if state >= accept:
                found.append((at, self.rules[(state - accept) // self.classes]))

    def longest(self, text: bytes, start: int, stop: int, way: int = 1) -> int:
        """The furthest place at which a match ends that begins at `start`, reading towards `stop` by `way`; -1 for none. Reading ends where no match can go on. For automata without search."""
        step, accept = self._table(), int(self.accept)
        state, best = int(self.start), -1
        for i in range(start, stop) if way > 0 else range(start - 1, stop - 1, -1):
            state = step[state + self._class[text[i]]]
            if state == self.dead:
                break
            if state >= accept:
                best = i + 1 if way > 0 else i
        return best
