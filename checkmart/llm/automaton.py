"""Regular expressions compiled together into one minimal deterministic automaton over bytes.

Supported: literals, escapes (`\\x20`, `\\.`), classes, groups, `|`, `?`, `*`, `+`, `{n}` and `{n,}`. `compile_rules` searches:
after each byte the state tells which rules end there. `compile_backward` reads the rules from their ends towards their
starts, so that `starts_of` finds where a match that ends at a known byte may begin.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class _Nfa:
    """States with epsilon moves and moves on sets of bytes."""

    def __init__(self) -> None:
        self.epsilon: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.epsilon.append([])
        self.moves.append([])
        return len(self.epsilon) - 1

    def closure(self, states: set[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for nxt in self.epsilon[todo.pop()]:
                if nxt not in found:
                    found.add(nxt)
                    todo.append(nxt)
        return frozenset(found)


class _Rule:
    """One rule read left to right into NFA fragments."""

    def __init__(self, nfa: _Nfa, text: str, fold_case: bool):
        self.nfa, self.text, self.at, self.fold_case = nfa, text, 0, fold_case

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def choice(self, start: int) -> int:
        """Adds alternatives from `start`, returns their common end."""
        end = self.nfa.state()
        while True:
            self.nfa.epsilon[self.sequence(start)].append(end)
            if self.peek() != "|":
                return end
            self.take()

    def sequence(self, start: int) -> int:
        while self.peek() not in ("", "|", ")"):
            start = self.repeated(start)
        return start

    def repeated(self, start: int) -> int:
        begin = self.at
        entry = self.nfa.state()
        self.nfa.epsilon[start].append(entry)
        end = self.atom(entry)
        after = self.at
        sign = self.peek()
        if sign == "{":
            close = self.text.index("}", self.at)
            least, _, most = self.text[self.at + 1 : close].partition(",")
            unbounded = self.text[self.at + 1 : close].endswith(",")
            if most and most != least:
                raise ValueError("only {n} and {n,} are supported")
            for _ in range(int(least) - 1):  # the atom once more for each count
                self.at, entry = begin, end
                fresh = self.nfa.state()
                self.nfa.epsilon[entry].append(fresh)
                entry = fresh
                end = self.atom(fresh)
            if unbounded:
                self.nfa.epsilon[end].append(entry)
            self.at = close + 1
            return end
        self.at = after
        if sign and sign in "?*+":
            self.take()
            if sign in "*+":
                self.nfa.epsilon[end].append(entry)
            if sign in "?*":
                out = self.nfa.state()
                self.nfa.epsilon[entry].append(out)
                self.nfa.epsilon[end].append(out)
                return out
        return end

    def atom(self, start: int) -> int:
        char = self.take()
        if char == "(":
            if self.text.startswith("?:", self.at):
                self.at += 2
            end = self.choice(start)
            self.take()
            return end
        accepted = self.bracket() if char == "[" else {self.escaped(char)}
        if self.fold_case:
            letters = {b for b in accepted if chr(b).isascii() and chr(b).isalpha()}
            accepted = accepted | {b ^ 0x20 for b in letters}
        end = self.nfa.state()
        self.nfa.moves[start].append((frozenset(accepted), end))
        return end

    def escaped(self, char: str) -> int:
        if char != "\\":
            return ord(char)
        char = self.take()
        if char == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(char)

    def bracket(self) -> set[int]:
        accepted: set[int] = set()
        negated = self.peek() == "^"
        if negated:
            self.take()
        while self.peek() != "]":
            low = self.escaped(self.take())
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.escaped(self.take())
            accepted.update(range(low, high + 1))
        self.take()
        return set(range(256)) - accepted if negated else accepted


class Automaton(NamedTuple):
    """State 0 is the start. `steps[state * n_classes + classes[byte]]` is the next state, `accepts[state]` a rule mask.

    Bytes in `resets` lead from every state to the start.
    """

    steps: np.ndarray
    classes: np.ndarray
    n_classes: int
    accepts: np.ndarray
    resets: np.ndarray


class Backward(NamedTuple):
    """Rule k begins in state `firsts[k]`; state `dead` has no way on. `steps` and `accepts` as in `Automaton`."""

    steps: np.ndarray
    classes: np.ndarray
    n_classes: int
    accepts: np.ndarray
    firsts: np.ndarray
    dead: int


def _read(rules: list[tuple[str, bool]]) -> tuple[_Nfa, list[int], list[int]]:
    """All rules in one NFA, with the first and the last state of each."""
    nfa = _Nfa()
    entries, ends = [], []
    for pattern, fold_case in rules:
        entries.append(nfa.state())
        reader = _Rule(nfa, pattern, fold_case)
        ends.append(reader.choice(entries[-1]))
        if reader.at != len(pattern):
            raise ValueError(f"unbalanced rule {pattern!r}")
    return nfa, entries, ends


def compile_rules(rules: list[tuple[str, bool]]) -> Automaton:
    """One searching automaton for (pattern, fold case) rules; rule k has bit k."""
    nfa, entries, ends = _read(rules)
    classes, examples = _byte_classes(nfa)
    start = nfa.closure(set(entries))
    subsets, steps, accepts = _subsets(nfa, [start], start, ends, examples)
    block, steps, accepts = _minimal(steps, accepts)
    resets = np.array([bool((steps[:, c] == 0).all()) for c in range(len(examples))])[classes]
    resets &= accepts[0] == 0
    return Automaton(steps.ravel().astype(np.int32), classes, len(examples), accepts, resets)


def compile_backward(rules: list[tuple[str, bool]]) -> Backward:
    """One automaton that reads every rule from its end to its start; rule k has bit k."""
    ahead, entries, ends = _read(rules)
    nfa = _Nfa()
    for _ in ahead.moves:
        nfa.state()
    for state, (epsilon, moves) in enumerate(zip(ahead.epsilon, ahead.moves, strict=True)):
        for target in epsilon:
            nfa.epsilon[target].append(state)
        for accepted, target in moves:
            nfa.moves[target].append((accepted, state))
    classes, examples = _byte_classes(nfa)
    firsts = [nfa.closure({end}) for end in ends]
    subsets, steps, accepts = _subsets(nfa, [frozenset(), *firsts], frozenset(), entries, examples)
    block, steps, accepts = _minimal(steps, accepts)
    return Backward(
        steps.ravel().astype(np.int32),
        classes,
        len(examples),
        accepts,
        block[[subsets[first] for first in firsts]].astype(np.int32),
        int(block[subsets[frozenset()]]),
    )


def _byte_classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    """Bytes that no rule tells apart share a class; an example byte of each class."""
    sets = sorted({accepted for moves in nfa.moves for accepted, _ in moves}, key=sorted)
    known: dict[tuple[bool, ...], int] = {}
    classes, examples = np.zeros(256, np.int32), []
    for byte in range(256):
        sign = tuple(byte in s for s in sets)
        if sign not in known:
            known[sign] = len(known)
            examples.append(byte)
        classes[byte] = known[sign]
    return classes, examples


def _subsets(
    nfa: _Nfa, firsts: list[frozenset[int]], again: frozenset[int], ends: list[int], examples: list[int]
) -> tuple[dict[frozenset[int], int], np.ndarray, np.ndarray]:
    """The sets of states reachable from `firsts`, numbered; `again` is entered after every byte."""
    numbers: dict[frozenset[int], int] = {}
    for first in firsts:
        numbers.setdefault(first, len(numbers))
    todo, rows, accepts = list(numbers), [], []
    at = 0
    while at < len(todo):
        states = todo[at]
        at += 1
        accepts.append(sum(1 << k for k, end in enumerate(ends) if end in states))
        row = []
        for byte in examples:
            reached = {target for s in states for accepted, target in nfa.moves[s] if byte in accepted}
            nxt = nfa.closure(reached) | again
            if nxt not in numbers:
                numbers[nxt] = len(numbers)
                todo.append(nxt)
            row.append(numbers[nxt])
        rows.append(row)
    return numbers, np.array(rows), np.array(accepts, np.int64)


def _minimal(steps: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges states by splitting blocks until every block steps alike; state 0 stays so. The first result numbers them."""
    block = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:
        _, finer = np.unique(np.column_stack([block, block[steps]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    order = np.full(block.max() + 1, -1)
    order[block[0]] = 0
    rest = [b for b in range(block.max() + 1) if b != block[0]]
    order[rest] = np.arange(1, len(rest) + 1)
    block = order[block]
    _, chosen = np.unique(block, return_index=True)
    return block, block[steps[chosen]], accepts[chosen]


LANE_BYTES = 1024
#: Lanes longer than this have no reset byte where one is needed; they are cut anyway, by composed maps of all states.
LONG_LANE_BYTES = 8 * LANE_BYTES


def scan(automaton: Automaton, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, rule masks) of all bytes at which a rule ends, in one pass.

    The data is cut after reset bytes into lanes of about `LANE_BYTES`, which step side by side. Where no reset byte comes
    for long, each piece of `LANE_BYTES` is first stepped from every state, and the maps of the pieces are composed in
    order: that gives the state in which each piece begins.
    """
    n = len(data)
    marks = np.flatnonzero(automaton.resets[data]) + 1
    wanted = np.searchsorted(marks, np.arange(LANE_BYTES, n, LANE_BYTES))
    cuts = np.unique(np.concatenate([[0], marks[wanted[wanted < len(marks)]], [n]]))
    classes = automaton.classes[data]
    begins, entering = _cut_long(automaton, classes, cuts)
    lengths = np.diff(np.append(begins, n))
    order = np.argsort(-lengths, kind="stable")
    begins, lengths, state = begins[order], lengths[order], entering[order]
    alive = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
    accepting = automaton.accepts != 0
    positions, masks = [], []
    for step, k in enumerate(alive):
        at = begins[:k] + step
        now = automaton.steps[state[:k] * automaton.n_classes + classes[at]]
        state[:k] = now
        hit = accepting[now]
        if hit.any():
            positions.append(at[hit])
            masks.append(automaton.accepts[now[hit]])
    if not positions:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(positions), np.concatenate(masks)


def _cut_long(automaton: Automaton, classes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes begin, and in which state."""
    begins = cuts[:-1]
    long = np.flatnonzero(np.diff(cuts) > LONG_LANE_BYTES)
    if not len(long):
        return begins, np.zeros(len(begins), np.int32)
    pieces = [np.arange(cuts[lane], cuts[lane + 1], LANE_BYTES) for lane in long]
    maps = _state_maps(automaton, classes, np.concatenate([p[:-1] for p in pieces]))
    entering = []
    at = 0
    for p in pieces:
        states = np.zeros(len(p), np.int32)
        for k in range(1, len(p)):
            states[k] = maps[at, states[k - 1]]
            at += 1
        entering.append(states)
    short = np.delete(begins, long)
    begins = np.concatenate([short, *pieces])
    states = np.concatenate([np.zeros(len(short), np.int32), *entering])
    order = np.argsort(begins, kind="stable")
    return begins[order], states[order]


def _state_maps(automaton: Automaton, classes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each piece of `LANE_BYTES` and each state before it, the state after it. Equal states go on as one."""
    n_states = len(automaton.accepts)
    piece = np.repeat(np.arange(len(begins)), n_states)
    state = np.tile(np.arange(n_states), len(begins))
    where = np.arange(len(piece))
    for step in range(LANE_BYTES):
        state = automaton.steps[state * automaton.n_classes + classes[begins[piece] + step]].astype(np.int64)
        if step & (step + 1) == 0:  # after 1, 2, 4, 8, ... bytes
            keys, merged = np.unique(piece * n_states + state, return_inverse=True)
            where, piece, state = merged.ravel()[where], keys // n_states, keys % n_states
    return state[where].reshape(len(begins), n_states)


def starts_of(
    automaton: Backward, data: np.ndarray, ends: np.ndarray, rules: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(number, start) pairs: where a match of rule `rules[number]` that ends before byte `ends[number]` may begin.

    All ends step back side by side until none has a way on.
    """
    number, at, state = np.arange(len(ends)), ends.astype(np.int64), automaton.firsts[rules]
    wanted = np.int64(1) << rules.astype(np.int64)
    numbers, starts = [], []
    while len(number):
        hit = automaton.accepts[state] & wanted[number] != 0
        if hit.any():
            numbers.append(number[hit])
            starts.append(at[hit])
        on = (state != automaton.dead) & (at > 0)
        number, at, state = number[on], at[on] - 1, state[on]
        state = automaton.steps[state * automaton.n_classes + automaton.classes[data[at]]]
    if not numbers:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(numbers), np.concatenate(starts)
