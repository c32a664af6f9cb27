"""One deterministic automaton for many search rules, compiled from byte regexes.

``compile_rules`` turns the rules' regexes into nondeterministic automata, joins them by
subset construction, minimises the result, and gives transition arrays that a scan reads
once per byte.  A state holds, for every rule, the attempts to match it that are still
alive, the earliest start first; a rule's matches are its leftmost ones, each as
long as can be, without overlaps.  A transition reports the rules whose match ended
before its byte.  Two things that a rule must not do are found while compiling and
raise ``ValueError``: to lose a match by reading on (an accepting attempt must accept
with every byte that it survives), and to accept from a later start while an earlier one is undecided.

``Matcher`` is the same construction for one regex from a given place, forward or, with
the regex reversed, backward; it finds where a reported match begins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as K  # the parse tree of Python's own regex syntax
from re import _parser

import numpy as np

DIGITS, WORDS, SPACES = b"0123456789", bytes(x for x in range(128) if chr(x).isalnum() or x == 95), b" \t\n\r\x0b\x0c"
CATEGORIES = {K.CATEGORY_DIGIT: DIGITS, K.CATEGORY_WORD: WORDS, K.CATEGORY_SPACE: SPACES, K.CATEGORY_NOT_DIGIT: DIGITS, K.CATEGORY_NOT_WORD: WORDS, K.CATEGORY_NOT_SPACE: SPACES}
NEGATED = (K.CATEGORY_NOT_DIGIT, K.CATEGORY_NOT_WORD, K.CATEGORY_NOT_SPACE)
FLAG = 1 << 30
LIMIT = 1 << 15  # states of the joint automaton; beyond it the rules are too entangled


class Nfa:
    """Thompson's automaton of a regex: ``moves[s]`` are (bytes, next state), ``free[s]`` next states without a byte."""

    def __init__(self, regex: bytes, nocase: bool = False, backward: bool = False):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []
        self.nocase, self.backward = nocase, backward
        self.start, self.accept = self._sequence(list(_parser.parse(regex)))

    def _state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def _one(self, of: set[int]) -> tuple[int, int]:
        if self.nocase:
            of = of | {ord(chr(x).swapcase()) for x in of if x < 128 and chr(x).isalpha()}
        a, b = self._state(), self._state()
        self.moves[a].append((frozenset(of), b))
        return a, b

    def _sequence(self, items) -> tuple[int, int]:
        first = last = self._state()
        for item in reversed(items) if self.backward else items:
            a, b = self._item(*item)
            self.free[last].append(a)
            last = b
        return first, last

    def _item(self, op, value) -> tuple[int, int]:
        if op is K.LITERAL:
            return self._one({value})
        if op is K.NOT_LITERAL:
            return self._one(set(range(256)) - {value})
        if op is K.ANY:
            return self._one(set(range(256)) - {10})
        if op is K.IN:
            return self._one(_members(value))
        if op is K.SUBPATTERN:
            return self._sequence(list(value[-1]))
        if op is K.BRANCH:
            a, b = self._state(), self._state()
            for way in value[1]:
                x, y = self._sequence(list(way))
                self.free[a].append(x)
                self.free[y].append(b)
            return a, b
        if op is K.MAX_REPEAT:
            least, most, item = value
            first = last = self._state()
            for _ in range(least):
                a, b = self._sequence(list(item))
                self.free[last].append(a)
                last = b
            end = self._state()
            if most is K.MAXREPEAT:
                a, b = self._sequence(list(item))
                self.free[last] += [a, end]
                self.free[b] += [a, end]
                return first, end
            for _ in range(most - least):
                a, b = self._sequence(list(item))
                self.free[last] += [a, end]
                last = b
            self.free[last].append(end)
            return first, end
        raise ValueError(f"a rule can't use {op}")

    def closed(self, states) -> frozenset[int]:
        out, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return frozenset(s for s in out if self.moves[s] or s == self.accept)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closed({t for s in states for of, t in self.moves[s] if byte in of})


def _members(items) -> set[int]:
    out: set[int] = set()
    for op, value in items:
        if op is K.LITERAL:
            out.add(value)
        elif op is K.RANGE:
            out |= set(range(value[0], value[1] + 1))
        elif op is K.CATEGORY:
            own = set(CATEGORIES[value])
            out |= set(range(256)) - own if value in NEGATED else own
        elif op is not K.NEGATE:
            raise ValueError(f"a rule can't use {op}")
    return set(range(256)) - out if items[0][0] is K.NEGATE else out


def byte_classes(nfas: Sequence[Nfa]) -> np.ndarray:
    """A class number for every byte; bytes of a class are in the same sets of all moves."""
    sets = sorted({of for n in nfas for moves in n.moves for of, _ in moves}, key=sorted)
    kinds: dict[tuple[bool, ...], int] = {}
    return np.array([kinds.setdefault(tuple(b in of for of in sets), len(kinds)) for b in range(256)], np.uint8)


@dataclass
class Automaton:
    """``table[state + class]`` is the next state (already times ``width``), plus ``FLAG`` if matches ended before the byte;
    ``ended[state + class]`` has a bit for each of their rules.  The last class is the end of a text."""

    classes: np.ndarray
    width: int
    table: np.ndarray
    ended: np.ndarray
    states: int
    #: bytes after which every state is the first one, so that texts can be cut there
    cuts: np.ndarray


def search_table(r: int, nfa: Nfa, samples: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Subset construction of one rule's search: next state and whether a match ended, by state and byte class (the end of a
    text last).  A state is a tuple of live attempts."""
    start, accept = nfa.closed({nfa.start}), nfa.accept
    if accept in start:
        raise ValueError(f"rule {r} can match nothing")
    number, todo, rows, ended = {(): 0}, [()], [], []

    def advance(attempts: tuple, byte: int) -> tuple[tuple, bool]:
        over = False
        if attempts and accept in attempts[0]:
            after = nfa.step(attempts[0], byte)
            if after:
                if accept not in after:
                    raise ValueError(f"rule {r}: reading on can lose a match")
                return (after,), False
            attempts, over = (), True
        out, seen = [], frozenset()
        for states in (*attempts, start):
            after = nfa.step(states, byte) - seen
            if after:
                out.append(after)
                seen |= after
        if any(accept in x for x in out[1:]) and accept not in out[0]:
            raise ValueError(f"rule {r}: a later start can match within an undecided earlier one")
        return (tuple(out[:1]) if out and accept in out[0] else tuple(out)), over

    while todo:
        state = todo.pop(0)
        row = [advance(state, byte) for byte in samples]
        for after, _ in row:
            if after not in number:
                number[after] = len(number)
                todo.append(after)
        rows.append([number[after] for after, _ in row] + [0])
        ended.append([over for _, over in row] + [bool(state) and accept in state[0]])
    return np.array(rows), np.array(ended)


def compile_rules(regexes: Sequence[tuple[bytes, bool]]) -> Automaton:
    """The minimal automaton that searches all (regex, whether case is ignored) at once."""
    nfas = [Nfa(*x) for x in regexes]
    classes = byte_classes(nfas)
    samples = [int(np.flatnonzero(classes == c)[0]) for c in range(int(classes.max()) + 1)]
    tables = [search_table(r, n, samples) for r, n in enumerate(nfas)]
    base = np.cumprod([1, *(len(t) for t, _ in tables[:-1])], dtype=object)  # a joint state's number in mixed radix
    if base[-1] * len(tables[-1][0]) >= 1 << 62:
        raise ValueError("too many rules")
    base = base.astype(np.int64)
    known = {0: 0}
    fresh = np.zeros((1, len(tables)), np.int64)
    rows, marks = [], []
    while len(fresh):  # the states that the last ones lead to
        after = sum(t[fresh[:, r]] * base[r] for r, (t, _) in enumerate(tables))
        marks.append(sum(e[fresh[:, r]].astype(np.int64) << r for r, (_, e) in enumerate(tables)))
        codes = [c for c in np.unique(after).tolist() if c not in known]
        known.update(zip(codes, range(len(known), len(known) + len(codes)), strict=True))
        if len(known) > LIMIT:
            raise ValueError("the rules' joint automaton is too large")
        rows.append(after)
        fresh = np.array([[c // base[r] % len(t) for r, (t, _) in enumerate(tables)] for c in codes], np.int64)
    codes = np.array(list(known), np.int64)
    order = np.argsort(codes)
    rows = np.vstack(rows)
    rows, marks = minimised(order[np.searchsorted(codes, rows, sorter=order)], np.vstack(marks))
    width = len(samples) + 1
    cuts = (rows[:, :-1] == rows[0, -1]).all(0)[classes]
    return Automaton(classes, width, (rows * width + np.where(marks > 0, FLAG, 0)).astype(np.int32).ravel(), marks.ravel(), len(rows), cuts)


def minimised(rows: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moore's refinement: states that report alike after every string become one; the first state stays number 0."""
    block = np.unique(marks, axis=0, return_inverse=True)[1].ravel()
    while True:
        new = np.unique(np.column_stack([block, block[rows]]), axis=0, return_inverse=True)[1].ravel()
        if new.max() == block.max():
            break
        block = new
    kinds, pick = np.unique(block, return_index=True)
    order = np.argsort(pick)  # by first appearance, so that the first state is number 0
    name = np.empty(len(kinds), np.int64)
    name[order] = np.arange(len(kinds))
    return name[block[rows[pick[order]]]], marks[pick[order]]


class Matcher:
    """Longest match of a regex from a place, forward or backward."""

    def __init__(self, regex: bytes, nocase: bool = False, backward: bool = False):
        nfa = Nfa(regex, nocase, backward)
        first = nfa.closed({nfa.start})
        number, todo, self.moves, self.accepts = {first: 0}, [first], [], []
        while todo:
            state = todo.pop(0)
            row = {}
            for byte in set().union(*(of for s in state for of, _ in nfa.moves[s])):
                after = nfa.step(state, byte)
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                row[byte] = number[after]
            self.moves.append(row)
            self.accepts.append(nfa.accept in state)
        self.backward = backward

    def longest(self, data: bytes, at: int, limit: int) -> int | None:
        """Where the longest match from ``at`` ends (backward: begins), not beyond ``limit``; None without one."""
        state, best = 0, at if self.accepts[0] else None
        for i in range(at - 1, limit - 1, -1) if self.backward else range(at, limit):
            state = self.moves[state].get(data[i])
            if state is None:
                break
            if self.accepts[state]:
                best = i if self.backward else i + 1
        return best


# ---- scanning

FEW = 48  # pieces still running when they are finished one at a time


def ends(a: Automaton, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, rules) of all ends of matches in the pieces data[first:last], reading each byte once.

    The pieces run side by side, longest first; the last few, whose steps would be short, one by one."""
    order = np.argsort(first - last, kind="stable")
    first, last = first[order], last[order]
    size = last - first
    kind = a.classes[data]
    state = np.zeros(len(first), np.int32)
    at = first.copy()
    places, found = [], []

    def report(pieces: np.ndarray, index: np.ndarray) -> None:
        places.append(at[pieces])
        found.append(a.ended[index])

    step, live = 0, int(np.searchsorted(-size, 0, "left"))
    while live > FEW:
        index = state[:live] + kind[at[:live]]
        after = a.table[index]
        hit = np.flatnonzero(after >= FLAG)
        if len(hit):
            report(hit, index[hit])
            after[hit] -= FLAG
        state[:live] = after
        at[:live] += 1
        step += 1
        live = int(np.searchsorted(-size[:live], -step, "left"))
    table = a.table.tolist() if live else []
    for p in range(live):
        s, begin = int(state[p]), int(at[p])
        for i, k in enumerate(kind[begin : last[p]].tolist(), begin):
            index = s + k
            s = table[index]
            if s >= FLAG:
                at[p] = i
                report(np.array([p]), np.array([index]))
                s -= FLAG
        state[p], at[p] = s, last[p]
    index = state + a.width - 1  # the pieces' ends
    hit = np.flatnonzero(a.ended[index])
    report(hit, index[hit])
    return np.concatenate(places), np.concatenate(found)
