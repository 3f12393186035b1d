"""Lines read once for all of p2's models: texts are cut at blanks, every different piece is looked at once, and words, pairs and whole lines are
known by 64-bit numbers, so that they are counted and looked up without their texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .boilerplate import FOLD, INVISIBLE, KIND, LIMIT, Lines, ends, folded, measured, points_of
from .ngram import Tokens, pieces

WORD, FIRST, LAST, PAIR, LINE, ALL = range(6)
#: Lines that hold a token, below which it says nothing.
LEAST = 4


def scattered(x: np.ndarray) -> np.ndarray:
    """64-bit numbers well mixed (the finalizer of splitmix64), one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLACES = scattered(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def numbered(points: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A number for each of some texts, given as code points one after another."""
    last = np.cumsum(size)
    at = np.arange(len(points)) - np.repeat(last - size, size)
    total = np.r_[np.uint64(0), np.cumsum(_PLACES.take(at, mode="wrap") * (points.astype(np.uint64) + np.uint64(1)))]
    return scattered(total[last] - total[last - size] + size.astype(np.uint64))


def numbers_of(texts: list[str]) -> np.ndarray:
    return numbered(points_of(texts), np.fromiter((len(x) + 1 for x in texts), dtype=np.int64, count=len(texts))) if texts else np.zeros(0, dtype=np.uint64)


def keyed(kind: int, a: np.ndarray, b: np.ndarray | None = None) -> np.ndarray:
    """Keys of tokens of a kind: of a word or line, or of two words in order."""
    x = a * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x9E3779B97F4A7C15 * (kind + 1) & 0xFFFFFFFFFFFFFFFF)
    return scattered(x if b is None else x + scattered(b) * np.uint64(0xA0761D6478BD642F))


@dataclass
class Words:
    """The words of some lines: places among ``names`` (numbers of different words), how many each line has, and the number of the whole line."""

    ids: np.ndarray
    size: np.ndarray
    names: np.ndarray
    line: np.ndarray

    @classmethod
    def of(cls, lines: Lines) -> Words:
        number = {w: k for k, w in enumerate(dict.fromkeys(lines.words))}
        ids = np.fromiter(map(number.__getitem__, lines.words), dtype=np.int64, count=len(lines.words))
        return cls(ids, lines.size, numbers_of(list(number)), numbers_of(lines.keys))

    def take(self, which: np.ndarray) -> Words:
        size = self.size[which]
        at = np.repeat((np.cumsum(self.size) - self.size)[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return Words(self.ids[at], size, self.names, self.line[which])

    def tokens(self) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
        """(kind, keys, the line of each use, the key of each use, none where each key is used once in order), lines in order in each kind."""
        n = len(self.size)
        line = np.repeat(np.arange(n), self.size)
        v = max(1, len(self.names))
        head, tail, both, pairs = ends(self.ids, line, self.size, v)
        names = self.names
        return [
            (WORD, keyed(WORD, names), line, self.ids), (FIRST, keyed(FIRST, names), line[head], self.ids[head]), (LAST, keyed(LAST, names), line[tail], self.ids[tail]),
            (PAIR, keyed(PAIR, names[pairs // v], names[pairs % v]), both, None), (LINE, keyed(LINE, self.line), np.arange(n), None),
        ]

    def counts(self, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and in how many lines of each of four cells they stand."""
        keys, tables = [keyed(ALL, np.zeros(1, dtype=np.uint64))], [np.bincount(cell, minlength=4)[None]]
        for _, key, line, at in self.tokens():
            if at is None:
                key, at = np.unique(key, return_inverse=True)
            if not len(at):
                continue
            once = np.sort(at * len(self.size) + line)
            once = once[np.r_[True, once[1:] != once[:-1]]]
            table = np.bincount(once // len(self.size) * 4 + cell[once % len(self.size)], minlength=4 * len(key)).reshape(-1, 4)
            some = np.flatnonzero(table.any(axis=1))
            keys.append(key[some])
            tables.append(table[some])
        return np.concatenate(keys), np.concatenate(tables)


@dataclass
class Keyed:
    """Log-odds as of ``boilerplate.Odds``, of tokens by their keys in order; a column for each of some counts."""

    key: np.ndarray
    value: np.ndarray

    @classmethod
    def counted(cls, key: np.ndarray, table: np.ndarray, uses: list[tuple[int, ...]]) -> Keyed:
        """``table`` holds lines by key, without and with the label in one half and in the other; ``uses`` are the halves counted."""
        order = np.argsort(key)
        key, table = key[order], table[order]
        every = np.flatnonzero(key == keyed(ALL, np.zeros(1, dtype=np.uint64)))
        value = []
        for use in uses:
            n, p = table[:, [2 * h for h in use]].sum(axis=1), table[:, [2 * h + 1 for h in use]].sum(axis=1)
            odds = np.log((p + 0.5) / (n + 0.5)) - np.log((0.5 + p[every].sum()) / (0.5 + n[every].sum()))
            value.append(np.where(n + p < LEAST, np.nan, odds))
        return cls(key, np.stack(value, axis=1))

    def column(self, k: int) -> Keyed:
        some = ~np.isnan(self.value[:, k])
        return Keyed(self.key[some], self.value[some, k : k + 1])

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Of keys; one past the end for those unknown."""
        if not len(self.key):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.searchsorted(self.key, keys)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == keys, at, len(self.key))

    def told(self, words: Words, column: np.ndarray) -> np.ndarray:
        """As ``boilerplate.Odds.of``, for each line by the column given."""
        n = len(words.size)
        value = np.vstack([self.value, np.full((1, self.value.shape[1]), np.nan)])
        total, known, tokens = np.zeros(n), np.zeros(n), np.zeros(n)
        most, least = np.full(n, np.nan), np.full(n, np.nan)
        out = np.zeros((n, 5))
        for kind, key, line, at in words.tokens():
            place = self.places(key)
            x = value[place if at is None else place[at], column[line]]
            here = ~np.isnan(x)
            if kind == LINE:
                out[:, 3] = np.where(here, x, 0.0)
                continue
            tokens += np.bincount(line, minlength=n)
            x, line = x[here], line[here]
            if not len(x):
                continue
            total += np.bincount(line, weights=x, minlength=n)
            known += np.bincount(line, minlength=n)
            begin = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
            some = line[begin]
            most[some], least[some] = np.fmax(most[some], np.maximum.reduceat(x, begin)), np.fmin(least[some], np.minimum.reduceat(x, begin))
        some = known > 0
        out[some, 0], out[some, 1], out[some, 2] = total[some] / known[some], most[some], least[some]
        out[some, 4] = known[some] / tokens[some]
        return out

    def of(self, lines: Lines) -> np.ndarray:
        return self.told(Words.of(lines), np.zeros(len(lines.size), dtype=np.int64))


@dataclass
class Read:
    """What all models need of some lines: numbers and shapes as of ``Lines``, words, tokens, and places of equal ones among them."""

    numbers: np.ndarray
    shape: np.ndarray
    words: Words
    tokens: Tokens
    same: np.ndarray

    @classmethod
    def describe(cls, lines: list[str], cache: dict[str, int]) -> Read:
        """Of non-blank lines without newlines."""
        if not lines:
            none = np.zeros(0, dtype=np.int64)
            return cls(np.zeros((0, 21)), none, Words(none, none, none.astype(np.uint64), none.astype(np.uint64)), Tokens.of([], cache), none)
        text = [x.strip() for x in lines]
        points = points_of(text)
        at = np.minimum(points, LIMIT)
        kept = KIND[at] != INVISIBLE
        plain = np.where(points < LIMIT, FOLD[at], points)[kept]
        length = np.fromiter(map(len, text), dtype=np.int64, count=len(text)) + 1
        line = numbered(plain, np.add.reduceat(kept, np.cumsum(length) - length, dtype=np.int64))
        names, ids, size = pieces(text)
        # words of different pieces, then of all
        per = [x.split() for x in folded(points_of(names))] if names else []
        flat = [w for x in per for w in x]
        number = {w: k for k, w in enumerate(dict.fromkeys(flat))}
        local = np.fromiter(map(number.__getitem__, flat), dtype=np.int64, count=len(flat))
        count = np.fromiter(map(len, per), dtype=np.int64, count=len(per))
        n = count[ids]
        begun = np.r_[0, np.cumsum(n)]
        word = local[np.repeat((np.cumsum(count) - count)[ids] - begun[:-1], n) + np.arange(begun[-1])]
        last = np.cumsum(size)
        words = begun[last] - begun[last - size]
        v = max(1, len(number))
        once = np.sort(np.repeat(np.arange(len(text)), words) * v + word)
        once = once[np.r_[True, once[1:] != once[:-1]]] if len(once) else once
        numbers, shape, _ = measured(lines, text, points, words, np.bincount(once // v, minlength=len(text)))
        same = pa.array([x.lower() for x in text], pa.string()).dictionary_encode().indices.to_numpy().astype(np.int64)
        return cls(numbers, shape, Words(word, words, numbers_of(list(number)), line), Tokens.within(names, ids, size, cache), same)
