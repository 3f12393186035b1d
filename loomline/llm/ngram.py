"""N-gram models over function words and word classes."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKEN = re.compile(r"https?://\S+|www\.\S+|[#@][\w-]+|[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,:]\d+)*|[^\w\s]|_", re.UNICODE)
#: The same, and newlines.
APART = re.compile(TOKEN.pattern + r"|\n", re.UNICODE)
#: Words kept as themselves.
FUNCTION_WORDS = 400
#: A word counts as repeated when it stood among so many tokens before.
WINDOW = 16
# Classes of all other tokens; each also in a repeated form.
CLASSES = ["<s>", "</s>", "url", "tag", "number", "price", "lower", "Title", "UPPER", "mixed", "stop", "comma", "pipe", "dash", "mark", "symbol"]
_OF_SYMBOL = {"url": "", "stop": ".!?…", "comma": ",;", "pipe": "|/·•»>", "dash": "-–—", "mark": "()[]\"'«»“”„:¿¡%&"}
_SYMBOL = {c: CLASSES.index(name) for name, chars in _OF_SYMBOL.items() for c in chars}
BITS = 10


def class_of(token: str) -> int:
    c = token[0]
    if c.isalpha():
        if token.startswith(("http://", "https://", "www.")):
            return 2
        return 6 if token.islower() else 8 if token.isupper() and len(token) > 1 else 7 if token[1:].islower() or len(token) == 1 else 9
    if c.isdigit():
        return 5 if "." in token or "," in token else 4
    if len(token) > 1:
        return 3
    return _SYMBOL.get(token, 15)


def pieces(lines: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different pieces between blanks, the place of each piece among them, and the number of pieces of each line."""
    if "" not in lines:
        # Arrow takes the same characters for blanks as Python; where blanks stand at an end it gives empty pieces
        cut = pc.utf8_split_whitespace(pa.array(lines, pa.string()))
        told = cut.flatten().dictionary_encode()
        names = told.dictionary.to_pylist()
        if "" not in names:
            return names, told.indices.to_numpy().astype(np.int64), cut.value_lengths().to_numpy().astype(np.int64)
    per = [x.split() for x in lines]
    flat = list(chain.from_iterable(per))
    number = {x: k for k, x in enumerate(dict.fromkeys(flat))}
    return list(number), np.fromiter(map(number.__getitem__, flat), dtype=np.int64, count=len(flat)), np.fromiter(map(len, per), dtype=np.int64, count=len(per))


@dataclass
class Tokens:
    """The tokens of some lines as any vocabulary reads them: their classes by shape, the repeated form where they repeat, the places of words among
    ``names`` (-1 for what is none), and the number of tokens of each line with its start and end."""

    code: np.ndarray
    word: np.ndarray
    size: np.ndarray
    names: list[str]

    @classmethod
    def of(cls, lines: list[str], cache: dict[str, int]) -> Tokens:
        """``cache`` holds classes of tokens met."""
        return cls.within(*pieces(lines), cache)

    @classmethod
    def within(cls, names: list[str], ids: np.ndarray, pieces: np.ndarray, cache: dict[str, int]) -> Tokens:
        """Of lines as pieces: no token reaches over a blank, so that every different piece is cut once."""
        found = APART.findall("\n".join(names) + "\n") if names else []
        local = {t: k for k, t in enumerate(dict.fromkeys(found))}
        codes, lowered, named = np.zeros(len(local), dtype=np.uint8), np.arange(len(local)), np.full(len(local), -1, dtype=np.int32)
        first: dict[str, int] = {}
        words: dict[str, int] = {}
        for t, k in local.items():
            low = t.lower()
            lowered[k] = first.setdefault(low, k)
            code = cache.get(t)
            if code is None:
                code = cache[t] = class_of(t)
            codes[k] = code
            if t[0].isalpha():
                named[k] = words.setdefault(low, len(words))
        at = np.fromiter(map(local.__getitem__, found), dtype=np.int64, count=len(found))
        cut = at == local.get("\n", -1)
        count = np.diff(np.r_[-1, np.flatnonzero(cut)]) - 1
        at, n = at[~cut], count[ids]
        begun = np.r_[0, np.cumsum(n)]
        at = at[np.repeat((np.cumsum(count) - count)[ids] - begun[:-1], n) + np.arange(begun[-1])]
        last = np.cumsum(pieces)
        size = begun[last] - begun[last - pieces] + 2
        end = np.cumsum(size) - 1
        inner = np.ones(size.sum(), dtype=bool)
        inner[end - size + 1] = inner[end] = False
        code, word, name = np.zeros(len(inner), dtype=np.uint8), np.full(len(inner), len(local)), np.full(len(inner), -1, dtype=np.int32)
        code[end] = 1
        code[inner], word[inner], name[inner] = codes[at], lowered[at], named[at]
        # words of different lines are different
        word = word.astype(np.int32 if len(size) * (len(local) + 1) < 1 << 31 else np.int64)
        word += np.repeat((np.arange(len(size)) * (len(local) + 1)).astype(word.dtype), size)
        again = np.zeros(len(word), dtype=bool)
        for k in range(1, min(WINDOW, len(word) - 1) + 1):
            again[k:] |= word[k:] == word[:-k]
        again &= (code >= 2) & (code < 10)
        return cls(code + again.astype(np.uint8) * np.uint8(len(CLASSES)), name, size.astype(np.int32), list(words))

    def line(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.size)), self.size)

    def again(self) -> np.ndarray:
        return self.code >= len(CLASSES)

    def sequence(self, vocabulary: Vocabulary) -> np.ndarray:
        """Classes: function words are kept as themselves."""
        own = np.fromiter(chain(map(vocabulary.words.get, self.names, repeat(0)), (0,)), dtype=np.int64, count=len(self.names) + 1)[self.word]
        return np.where(own > 0, own, self.code)

    def take(self, lines: np.ndarray) -> Tokens:
        """Of some lines, in the order given."""
        size = self.size[lines]
        begin = (np.cumsum(self.size) - self.size)[lines]
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return Tokens(self.code[at], self.word[at], size, self.names)


@dataclass
class Vocabulary:
    """Function words in order; their classes follow the shapes."""

    words: dict[str, int]

    @classmethod
    def fit(cls, lines: list[str], size: int = FUNCTION_WORDS) -> Vocabulary:
        counts = Counter(t for line in lines for t in {x.lower() for x in TOKEN.findall(line) if x[0].isalpha()})
        common = [w for w, n in counts.most_common(size) if n > 1]
        return cls({w: 2 * len(CLASSES) + i for i, w in enumerate(common)})

    def sequence(self, lines: list[str], cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(classes, line of each token, whether it repeats) with a start and an end for each line. ``cache`` holds classes of tokens met."""
        told = Tokens.of(lines, cache)
        return told.sequence(self), told.line(), told.again()


@dataclass
class Ngrams:
    """Trigrams with Witten-Bell interpolation down to a uniform base, as sorted keys and their probabilities' parts."""

    keys: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    kinds: list[np.ndarray]
    classes: int

    @classmethod
    def fit(cls, sequence: np.ndarray, classes: int) -> Ngrams:
        return cls.counted([np.unique(grams(sequence, n), return_counts=True) for n in (1, 2, 3)], classes)

    @classmethod
    def counted(cls, parts: list[tuple[np.ndarray, np.ndarray]], classes: int) -> Ngrams:
        """Of sorted grams of one, two and three with their counts."""
        keys, counts, contexts, totals, kinds = [], [], [], [], []
        for k, c in parts:
            ctx, at = np.unique(k >> BITS, return_inverse=True)
            keys.append(k)
            counts.append(np.r_[c, 0].astype(float))
            contexts.append(ctx)
            totals.append(np.r_[np.bincount(at, weights=c, minlength=len(ctx)), 0])
            kinds.append(np.r_[np.bincount(at, minlength=len(ctx)), 0].astype(float))
        return cls(keys, counts, contexts, totals, kinds, classes)

    def bits(self, trigrams: np.ndarray) -> np.ndarray:
        """Code length of the last class of each trigram after the two before it."""
        p = np.full(len(trigrams), 1.0 / max(1, self.classes))
        for n in (1, 2, 3):
            g = trigrams & ((1 << (BITS * n)) - 1)
            c = self.counts[n - 1][_find(self.keys[n - 1], g)]
            at = _find(self.contexts[n - 1], g >> BITS)
            total, kind = self.totals[n - 1][at], self.kinds[n - 1][at]
            p = np.where(total > 0, (c + kind * p) / np.maximum(total + kind, 1), p)
        return -np.log2(np.maximum(p, 1e-12))


def grams(sequence: np.ndarray, n: int) -> np.ndarray:
    out = sequence.astype(np.int64).copy()
    for k in range(1, n):
        out[k:] |= (sequence[:-k].astype(np.int64) + 1) << (BITS * k)
    return out


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return np.where(table[at] == keys, at, len(table))
