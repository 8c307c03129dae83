"""One deterministic automaton from several patterns, run over bytes in lockstep.

A small regular-expression language (literals, classes, ``. ? * + {m,n} | ( )``) is compiled to
a nondeterministic automaton and made deterministic over classes of bytes that no pattern tells
apart. The scanner cuts a buffer into chunks that overlap and runs all chunks side by side, one
table look-up per place. The overlap only guesses the state that a chunk starts in: where the chunk
before ends in another state, the true one is carried on, so that a match may be of any length and
its place in the buffer never matters.
"""

from __future__ import annotations

import numpy as np

#: A byte that UTF-8 never uses; it takes the automaton back to its start.
RESET = 0xFF


class _Parser:
    def __init__(self, pattern: str, ignore_case: bool):
        self.p, self.i, self.fold = pattern, 0, ignore_case

    def parse(self):
        tree = self._either()
        if self.i < len(self.p):
            raise ValueError(f"unexpected {self.p[self.i]!r} in {self.p!r}")
        return tree

    def _either(self):
        options = [self._sequence()]
        while self._peek() == "|":
            self.i += 1
            options.append(self._sequence())
        return ("or", options)

    def _sequence(self):
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeated())
        return ("seq", parts)

    def _peek(self):
        return self.p[self.i : self.i + 1]

    def _repeated(self):
        item = self._atom()
        while (c := self._peek()) and c in "?*+{":
            if c == "{":
                end = self.p.index("}", self.i)
                low, _, high = self.p[self.i + 1 : end].partition(",")
                bounds = (int(low), int(high or low) if "," not in self.p[self.i : end] or high else None)
                self.i = end
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            self.i += 1
            item = ("rep", item, *bounds)
        return item

    def _atom(self):
        c = self.p[self.i]
        self.i += 1
        if c == "(":
            inside = self._either()
            self.i += 1
            return inside
        if c == "[":
            return self._class()
        if c == ".":
            return ("set", frozenset(range(256)) - {RESET})
        return ("set", self._case(self._escaped(c)))

    def _escaped(self, c):
        if c != "\\":
            return frozenset([ord(c)])
        c = self.p[self.i]
        self.i += 1
        return frozenset(map(ord, {"s": " \t\r\n", "d": "0123456789", "n": "\n"}.get(c, c)))

    def _class(self):
        negated = self._peek() == "^"
        self.i += negated
        out: set[int] = set()
        while (c := self.p[self.i]) != "]":
            self.i += 1
            some = self._escaped(c)
            if self._peek() == "-" and self.p[self.i + 1] != "]":
                out |= set(range(min(some), ord(self.p[self.i + 1]) + 1))
                self.i += 2
            else:
                out |= some
        self.i += 1
        own = self._case(frozenset(out))
        return ("set", frozenset(range(256)) - own - {RESET} if negated else own)

    def _case(self, some):
        if not self.fold:
            return some
        return some | {b ^ 32 for b in some if chr(b).isascii() and chr(b).isalpha()}


class Automaton:
    """Finds, in one pass, every place where any of the patterns ends; bit ``k`` stands for pattern ``k``."""

    def __init__(self, patterns: list[str], ignore_case: bool = False, reach: int = 64):
        self.reach = reach
        self.steps: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []
        start, ends = self._node(), {}
        for k, pattern in enumerate(patterns):
            a, b = self._build(_Parser(pattern, ignore_case).parse())
            self.free[start].append(a)
            ends[b] = k
        self._determinise(start, ends)
        del self.steps, self.free

    def _node(self):
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _build(self, tree):
        kind = tree[0]
        a, b = self._node(), self._node()
        if kind == "set":
            self.steps[a].append((tree[1], b))
        elif kind == "or":
            for option in tree[1]:
                x, y = self._build(option)
                self.free[a].append(x)
                self.free[y].append(b)
        elif kind == "seq":
            at = a
            for part in tree[1]:
                x, y = self._build(part)
                self.free[at].append(x)
                at = y
            self.free[at].append(b)
        else:
            _, item, low, high = tree
            at = a
            for k in range(low if high is None else high):
                if k >= low:
                    self.free[at].append(b)
                x, y = self._build(item)
                self.free[at].append(x)
                at = y
            if high is None:
                x, y = self._build(item)
                self.free[at].append(x)
                self.free[y].append(x)
                self.free[y].append(b)
            self.free[at].append(b)
        return a, b

    def _closure(self, nodes):
        out, todo = set(nodes), list(nodes)
        while todo:
            for n in self.free[todo.pop()]:
                if n not in out:
                    out.add(n)
                    todo.append(n)
        return frozenset(out)

    def _determinise(self, start, ends):
        sets = {s for steps in self.steps for s, _ in steps}
        mark = [tuple(b in s for s in sorted(sets, key=sorted)) for b in range(256)]
        mark[RESET] = ("reset",)
        kinds = {m: k for k, m in enumerate(dict.fromkeys(mark))}
        self.kind_of = np.array([kinds[m] for m in mark], np.int32)
        samples = {kinds[m]: b for b, m in reversed(list(enumerate(mark)))}
        # Where each node goes on each kind of byte, with what is then free to reach.
        onward = [[(k, self._closure([to])) for some, to in steps for k, b in samples.items() if b in some] for steps in self.steps]
        begin = self._closure([start])
        states, rows, todo = {begin: 0}, [], [begin]
        for now in todo:  # grows while it is read
            reached = [set(begin) for _ in kinds]
            for n in now:
                for k, more in onward[n]:
                    reached[k] |= more
            row = [0] * len(kinds)
            for k, byte in samples.items():
                if byte != RESET:
                    to = frozenset(reached[k])
                    if to not in states:
                        states[to] = len(states)
                        todo.append(to)
                    row[k] = states[to]
            rows.append(row)
        self.width = len(kinds)
        self.table = (np.array(rows, np.int32) * self.width).ravel()
        bits = [sum(1 << ends[n] for n in s if n in ends) for s in states]
        self.final = np.repeat(np.array(bits, np.int64), self.width)  # by state times width
        self.walk = None

    def scan(self, data: np.ndarray, chunk: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Ends of matches in a byte buffer (the place after the last byte), and the patterns' bits."""
        n, reach = len(data), self.reach
        reset = self.kind_of[RESET]
        lanes = -(-n // chunk)
        kinds = np.full(reach + lanes * chunk, reset, np.int32)
        kinds[reach : reach + n] = self.kind_of[data]
        at = np.arange(lanes) * chunk  # a lane begins `reach` places before its chunk
        state, begun = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        places, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k in range(chunk + reach):
            if k == reach:
                begun = state
            state = self.table[state + kinds[at + k]]
            if k >= reach:
                bits = self.final[state]
                hit = np.flatnonzero(bits)
                if len(hit):
                    places.append(at[hit] + k + 1 - reach)
                    found.append(bits[hit])
        places, found = np.concatenate(places), np.concatenate(found)
        wrong = np.flatnonzero(begun[1:] != state[:-1]) + 1
        if len(wrong):
            places, found = self._carried(kinds, chunk, begun, state, wrong, places, found)
        order = np.argsort(places, kind="stable")
        places, found = places[order], found[order]
        inside = places <= n
        return places[inside], found[inside]

    def _carried(self, kinds, chunk, begun, ended, wrong, places, found):
        """Chunks that were begun in a wrong state once more, from the true one, until guess and truth agree."""
        if self.walk is None:
            self.walk = self.table.tolist(), self.final.tolist()
        table, final = self.walk
        again, more = set(), []
        for first in wrong.tolist():
            if first in again:
                continue
            lane, state = first, int(ended[first - 1])
            while lane < len(begun) and state != begun[lane]:
                again.add(lane)
                place = lane * chunk
                for kind in kinds[self.reach + place : self.reach + place + chunk].tolist():
                    state = table[state + kind]
                    place += 1
                    if final[state]:
                        more.append((place, final[state]))
                lane += 1
        keep = ~np.isin((places - 1) // chunk, list(again))
        extra = np.array(more, np.int64).reshape(-1, 2)
        return np.concatenate([places[keep], extra[:, 0]]), np.concatenate([found[keep], extra[:, 1]])
