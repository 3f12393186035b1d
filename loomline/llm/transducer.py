"""Weighted finite-state machines over strings of one-letter symbols, determinised as they run.

Patterns are written as ``|`` alternatives of symbols, sets ``[..]`` and ``[^..]``, with ``?``, ``*`` and ``{m,n}`` after each; they become
automata without empty moves. A grammar holds weighted patterns: their union gives the greatest weight of those that occur in a string, their
product the sum. A transducer rewrites symbols by its state; composed with a grammar it is one machine again. Moves of the determinised
machines are worked out once and remembered; as patterns only have bounded gaps or absorbing ends, there are few.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable

Test = Callable[[str], bool]


def parsed(pattern: str) -> list[list[tuple[Test, int, int | None]]]:
    """Alternatives of (test of a symbol, least, most times); None for any number of times."""
    out: list[list[tuple[Test, int, int | None]]] = [[]]
    k = 0
    while k < len(pattern):
        c = pattern[k]
        if c == "|":
            out.append([])
            k += 1
            continue
        if c == "[":
            end = pattern.index("]", k)
            body, k = pattern[k + 1 : end], end + 1
            test = (lambda s, b=body[1:]: s not in b) if body[0] == "^" else (lambda s, b=body: s in b)
        else:
            test, k = (lambda s, b=c: s == b), k + 1
        least, most = 1, 1
        if k < len(pattern) and pattern[k] in "?*{":
            if pattern[k] == "{":
                end = pattern.index("}", k)
                a, b = pattern[k + 1 : end].split(",")
                least, most, k = int(a), int(b), end + 1
            else:
                least, most, k = 0, 1 if pattern[k] == "?" else None, k + 1
        out[-1].append((test, least, most))
    return out


class Pattern:
    """Whether a pattern occurs anywhere in a string: states are sets of places in it, and ``None`` once it has occurred."""

    def __init__(self, text: str):
        # places of each alternative: tests in order, with a loop for any number of times; a place may be skipped where it is not wanted
        self.moves: list[list[tuple[Test, bool, bool]]] = []
        for alternative in parsed(text):
            line: list[tuple[Test, bool, bool]] = []
            for test, least, most in alternative:
                line += [(test, False, False)] * least
                line += [(test, True, True)] if most is None else [(test, True, False)] * (most - least)
            self.moves.append(line)
        self.start = self.closed({(a, 0) for a in range(len(self.moves))})

    def closed(self, places: set[tuple[int, int]]) -> frozenset | None:
        """With all places that skipping leads to."""
        todo, seen = list(places), set(places)
        while todo:
            a, k = todo.pop()
            if k == len(self.moves[a]):
                return None
            if self.moves[a][k][1] and (a, k + 1) not in seen:
                seen.add((a, k + 1))
                todo.append((a, k + 1))
        return frozenset(seen)

    def step(self, state: frozenset | None, symbol: str) -> frozenset | None:
        if state is None:
            return None
        out = set(self.start)
        for a, k in state:
            test, _, loop = self.moves[a][k]
            if test(symbol):
                out.add((a, k if loop else k + 1))
        return self.closed(out)


class Grammar:
    """Weighted patterns at once. ``total`` makes one weight of those that occurred: max for their union, sum for their product."""

    def __init__(self, weighted: list[tuple[str, float]], total: Callable[[list[float]], float]):
        self.patterns = [(Pattern(p), w) for p, w in weighted]
        self.total = total
        self.start: Hashable = tuple(p.start for p, _ in self.patterns)

    def step(self, state: tuple, symbol: str) -> tuple:
        return tuple(p.step(s, symbol) for (p, _), s in zip(self.patterns, state, strict=True))

    def weight(self, state: tuple) -> float:
        return self.total([w for (_, w), s in zip(self.patterns, state, strict=True) if s is None] or [0.0])


class Scope:
    """A transducer from symbols to symbols: ``arcs`` maps (state, symbol) to (state, symbol); ``others`` does so for symbols without an arc."""

    def __init__(self, arcs: dict[tuple[str, str], tuple[str, str]], others: Callable[[str, str], tuple[str, str]], start: str):
        self.arcs, self.others, self.start = arcs, others, start

    def step(self, state: str, symbol: str) -> tuple[str, str]:
        return self.arcs.get((state, symbol)) or self.others(state, symbol)


class Machine:
    """A chain of scopes composed with a grammar, as one deterministic machine whose moves are remembered."""

    def __init__(self, grammar: Grammar, *scopes: Scope):
        self.grammar, self.scopes = grammar, scopes
        self.number: dict[Hashable, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[tuple[int, str], int] = {}
        self.weights: list[float] = []
        self.start = self.known((*(s.start for s in scopes), grammar.start))

    def known(self, state: tuple) -> int:
        k = self.number.get(state)
        if k is None:
            k = self.number[state] = len(self.states)
            self.states.append(state)
            self.weights.append(self.grammar.weight(state[-1]))
        return k

    def move(self, at: int, symbol: str) -> int:
        state, out = self.states[at], []
        written = symbol
        for scope, s in zip(self.scopes, state, strict=False):
            s, written = scope.step(s, written)
            out.append(s)
        return self.known((*out, self.grammar.step(state[-1], written)))

    def score(self, symbols: str) -> float:
        at, moves = self.start, self.moves
        for s in symbols:
            to = moves.get((at, s))
            if to is None:
                to = moves[at, s] = self.move(at, s)
            at = to
        return self.weights[at]
