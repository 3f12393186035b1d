"""Personal data in free text, by a linear-chain conditional random field over word-shape features.

The model is trained on the small labelled table of ``pii_table`` by maximum likelihood. Features look at a token's word, shape, ends and
length, at the same of the tokens around it and at the last words before it, each in a role of its own. A token's emission is the sum of one
row per role, so that a batch needs each different token only once per role; Viterbi then decodes whole batches in numpy, padded by length.

What comes out is checked exactly: an address needs a figure, an e-mail an at sign in any form, a phone and an identity number figures enough,
a name two parts without figures. Known given names are a feature of the field and no condition.
Null and empty texts hold nothing. Every line, of any length, is cut at the same ends of sentences and decoded piece by piece, as in training.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from . import pii_table
from .pages import Bounded, annotate

KINDS = ["email", "phone", "id_number", "address", "name"]
# O, then B and I of each kind
N = 1 + 2 * len(KINDS)
TOKEN = re.compile(r"[^\W\d_]+|\d+|_|[^\w\s]", re.UNICODE)
WITH_BLANKS = re.compile(r" ?[^\W\d_]+| ?\d+| ?_| ?[^\w\s]|\s+", re.UNICODE)
ROLES = ["own", "p1", "p2", "n1", "n2", "a1", "a2", "a3", "next"]
PLACEHOLDER = {k: f"[{k.upper()}]" for k in KINDS}
#: Ends of sentences, before a letter; a dot ends one only after a word of four letters that is no title or abbreviation.
BREAK = re.compile(r"[.!?…]\s+(?=[^\W\d_])")
TITLES = {"prof", "mlle", "srta", "avda", "dipl", "dott", "betr"}
AT = re.compile(r"(?i)@|＠|&#64;|[\[({]\s*at\s*[\])}]|\sat\s")
_GIVEN = {g.lower() for g in pii_table.GIVEN}
_NO_NAME = re.compile(r"[^\w\s.,'’-]|_")
#: Figures beside a word for a street.
_STREET = re.compile(r"(?i)\d.*\b(?:street|st|road|rd|lane|ave|avenue|close|hill|drive|court|square|rue|place|bd|boulevard|impasse|chemin)\b|(?:stra(?:ß|ss)e|str\.|gasse|allee|weg|platz|brücke|katu|tie|polku|kuja) \d|\b(?:calle|c/|avenida|av\.|plaza|paseo|rua|travessa|largo)\b.*\d")
#: Words that introduce a person.
_INTRODUCED = re.compile(r"(?i)\b(?:name is|talked to|written by|posted by|ask|signed|sincerely|mrs?|herr|frau|mein name|fragen sie nach|geschrieben|m'appelle|demandez|écrit par|mme|me llamo|pregunte por|escrito por|señora?|meu nome|pergunte por|senhora?|nimeni|kysy|kirjoittanut|rouva|herra|lisätietoja antaa)\b")
#: Sentences a worker remembers.
KNOWN = 60_000
#: Share of features left out at a step of training, and how often a word must be met to be a feature.
DROP, RARE = 0.3, 8


def shape(token: str) -> str:
    c = token[0]
    if c.isdigit():
        return f"d{min(len(token), 9)}"
    if not c.isalpha():
        return token
    if len(token) == 1:
        return "A" if c.isupper() else "a"
    return "AA" if token.isupper() else "Aa" if c.isupper() else "aa"


#: Roles in which the ends, beginning and length of a word count too.
NEAR = ("own", "p1", "n1")


def facts(token: str, given: set[str] = frozenset(_GIVEN)) -> tuple[list[str], list[str], list[str]]:
    """Names of the features of a token: in every role, in those near, and in its own."""
    s = shape(token)
    if token[0].isdigit():
        return [f":{s}", ":d"], [], [f":0{token[0]}"]
    if not token[0].isalpha():
        return [f":{token}"], [], []
    low = token.lower()
    near = [f">{low[-2:]}", f">{low[-3:]}", f"<{low[:3]}", f">{low[-4:]}{s}", f"#{s}{min(len(low), 8)}"]
    return [f":{s}", f"={low}"], [*near, "^given"] if low in given else near, []


@dataclass
class Tokens:
    """The tokens of some sentences one after another: numbers in a vocabulary per role (0 for none), gaps before (none, a blank, more), lengths."""

    index: np.ndarray
    blank: np.ndarray
    length: np.ndarray
    #: Number of the run of figures and their separators that a token is in, and of the kinds of tokens around it.
    run: np.ndarray
    wide: np.ndarray
    shape: np.ndarray


class Words:
    """Tokens met, with what they are like: a number each. 0 is none, and white space."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.names: list[str] = [""]
        self.number: dict[str, int] = {}
        # kind, shape, figures, part of a run of figures, what a run begins with, whether it is a word
        self.like = np.zeros((1024, 6), dtype=np.int16)

    def learn(self, raw: str) -> int:
        """Twice the number of a token, one more if a blank led it."""
        bare = raw.lstrip(" ")
        if not bare or bare.isspace():
            k = 0
        elif (k := self.number.get(bare, 0)) == 0:
            k = self.number[bare] = len(self.names)
            self.names.append(bare)
            if k == len(self.like):
                self.like = np.concatenate([self.like, np.zeros_like(self.like)])
            figure = bare[0].isdigit()
            begin = 0 if bare[0] == "+" else 1 if bare[0] == "0" else 2 if bare[0] == "(" else 3
            self.like[k] = (kind_of(bare), shape_code(bare), len(bare) if figure else 0, figure or bare in "+-./()", begin, bare[0].isalpha() and len(bare) > 1)
        out = self.known[raw] = 2 * k + (raw[0] == " " and k > 0)
        return out

    def tokens(self, texts: list[str]) -> Tokens:
        found = list(map(WITH_BLANKS.findall, texts))
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = list(chain.from_iterable(found))
        for t in set(flat).difference(self.known):
            self.learn(t)
        raw = np.fromiter(map(self.known.__getitem__, flat), dtype=np.int64, count=len(flat))
        every = raw >> 1
        sentence = np.repeat(np.arange(len(found)), size)
        if len(every):
            start = np.r_[True, sentence[1:] != sentence[:-1]]
            gap = np.where(np.r_[False, every[:-1] == 0], 2, start | (raw & 1 > 0))
        else:
            gap = every
        keep = every > 0
        own, sentence, gap = every[keep], sentence[keep], gap[keep]
        length = np.bincount(sentence, minlength=len(found))
        total = len(own)
        first, last = np.repeat(np.cumsum(length) - length, length), np.repeat(np.cumsum(length), length)
        at = np.arange(total)
        top = max(0, total - 1)
        rows = [own]
        for by in (-1, -2, 1, 2):
            k = at + by
            rows.append(np.where((k >= first) & (k < last), own[np.clip(k, 0, top)], 0) if total else own)
        like = self.like[own]
        # the last three words before, and the next one, whatever figures and marks stand between
        words = like[:, 5] > 0
        seen = np.maximum.accumulate(np.where(words, at, -1)) if total else at
        one = np.r_[-1, seen[:-1]] if total else at
        back = one
        for _ in range(3):
            ok = back >= first
            rows.append(np.where(ok, own[np.clip(back, 0, top)], 0) if total else own)
            back = np.where(ok & (back > 0), one[np.clip(back, 0, top)], -1) if total else back
        ahead = np.minimum.accumulate(np.where(words, at, total)[::-1])[::-1] if total else at
        ahead = np.r_[ahead[1:], total] if total else at
        rows.append(np.where(ahead < last, own[np.clip(ahead, 0, top)], 0) if total else own)
        kinds, shapes = self.like[:, 0].astype(np.int64), self.like[:, 1].astype(np.int64)
        wide = np.zeros(total, dtype=np.int64)
        for k in (2, 1, 0, 3, 4):
            wide = wide * 6 + kinds[rows[k]]
        shape3 = (shapes[rows[1]] * SHAPES + shapes[own]) * SHAPES + shapes[rows[3]]
        return Tokens(np.stack(rows, axis=1), gap.astype(np.int64), length, runs(like, gap, sentence), wide, shape3)


def kind_of(token: str) -> int:
    """Figures, capitalised, small or all-capital words, marks."""
    return 1 if token[0].isdigit() else 5 if not token[0].isalpha() else 4 if len(token) > 1 and token.isupper() else 2 if token[0].isupper() else 3


RUNS = 1 + 17 * 8 * 4


def runs(like: np.ndarray, gap: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """What each token's run of figures is like: how many figures in how many groups, and what it begins with; 0 outside any."""
    if not len(like):
        return np.zeros(0, dtype=np.int64)
    figures, part = like[:, 2].astype(np.int64), like[:, 3] > 0
    new = ~part | (gap > 1) | np.r_[True, sentence[1:] != sentence[:-1]] | np.r_[True, ~part[:-1]]
    run = np.cumsum(new) - 1
    total, groups = np.bincount(run, weights=figures).astype(np.int64), np.bincount(run, weights=figures > 0).astype(np.int64)
    code = 1 + (np.minimum(total, 16) * 8 + np.minimum(groups, 7)) * 4 + like[:, 4][new]
    return np.where(part & (total[run] > 0), code[run], 0)


SHAPES = 24


def shape_code(token: str) -> int:
    s = shape(token)
    table = {"A": 1, "a": 2, "AA": 3, "Aa": 4, "aa": 5, ".": 16, ",": 17, "-": 18, "@": 19, "(": 20, ")": 21, "/": 22}
    return table[s] if s in table else 6 + min(8, int(s[1:]) - 1) if s[0] == "d" and s[1:].isdigit() else 23


@dataclass
class Crf:
    #: Places of the features, and for each of them a row of weights per role; the last row is that of no token at all.
    places: dict[str, int]
    weights: np.ndarray
    trigram: np.ndarray
    gap: np.ndarray
    run: np.ndarray
    wide: np.ndarray
    move: np.ndarray
    begin: np.ndarray
    #: Words known as given names: those of the table, and what stands for one in addresses of the corpus.
    given: set[str]

    def row(self, token: str) -> np.ndarray:
        """Emissions of a token in every role."""
        if not token:
            return self.weights[-1]
        at = [k for k in map(self.places.get, chain(*facts(token, self.given))) if k is not None]
        return self.weights[at].sum(axis=0) if at else np.zeros_like(self.weights[-1])

    def emissions(self, found: Tokens, rows: np.ndarray) -> np.ndarray:
        """Of tokens, from the rows of all words."""
        different, at = np.unique(found.index[:, 0], return_inverse=True)
        place = np.zeros(len(rows), dtype=np.int64)
        place[different] = np.arange(1, len(different) + 1)
        table = rows[np.r_[0, different]]
        e = table[at + 1, 0]
        for k in range(1, len(ROLES)):
            e += table[place[found.index[:, k]], k]
        e += self.trigram[found.shape]
        e += self.gap[found.blank]
        e += self.run[found.run]
        e += self.wide[found.wide]
        return e

    def decode(self, texts: list[str], memory: Memory) -> list[np.ndarray | None]:
        """Best labels of each sentence, None where all are O; Viterbi over batches of like length.

        A sentence needs no search when no span can gain on O anywhere: what a label that begins one gains at most, with all that labels inside
        one could gain after it and leaving it could, is negative for every token.
        """
        out: list[np.ndarray | None] = [None] * len(texts)
        found = memory.words.tokens(texts)
        length = found.length
        if not len(found.index):
            return out
        e = self.emissions(found, memory.rows())
        start = np.cumsum(length) - length
        base = self.move[0, 0]
        enter = np.maximum(self.move[:, 1::2].max(axis=0), self.begin[1::2]) - base
        stay, leave = self.move[1:, 2::2].max(axis=0) - base, max(0.0, float(self.move[1:, 0].max() - base))
        lead = (e[:, 1::2] + enter).max(axis=1) - e[:, 0]
        inside = np.maximum(0, (e[:, 2::2] + stay).max(axis=1) - e[:, 0])
        some = np.flatnonzero(length > 0)
        total = np.cumsum(inside)
        behind = np.repeat(total[start[some] + length[some] - 1], length[some]) - total
        order = some[np.maximum.reduceat(lead + behind + leave, start[some]) >= 0]
        order = order[np.argsort(length[order], kind="stable")]
        sorted_length = length[order]
        k = 0
        while k < len(order):
            # a batch holds lengths up to an eighth over its shortest
            most = int(sorted_length[k]) + max(3, int(sorted_length[k]) // 8)
            end = min(int(np.searchsorted(sorted_length, most, side="right")), k + 2048)
            batch = order[k:end]
            k = end
            width = int(length[batch].max())
            at = np.minimum(start[batch][:, None] + np.arange(width), len(e) - 1)
            emit = e[at]
            inside = np.arange(width) < length[batch][:, None]
            score = emit[:, 0] + self.begin
            back = np.zeros((width, len(batch), N), dtype=np.int8)
            for t in range(1, width):
                step = score[:, :, None] + self.move
                best = step.argmax(axis=1)
                back[t] = best
                new = np.take_along_axis(step, best[:, None, :], axis=1)[:, 0] + emit[:, t]
                score = np.where(inside[:, t : t + 1], new, score)
            label = score.argmax(axis=1)
            path = np.zeros((len(batch), width), dtype=np.int64)
            for t in range(width - 1, -1, -1):
                path[:, t] = np.where(inside[:, t], label, 0)
                label = np.where(inside[:, t], back[t][np.arange(len(batch)), label], label)
            for row, i, any_ in zip(path, batch, path.any(axis=1), strict=True):
                if any_:
                    out[i] = row[: length[i]]
        return out


def gold(text: str, spans: list[tuple[int, int, str]]) -> np.ndarray:
    start = [m.start() for m in TOKEN.finditer(text)]
    y = np.zeros(len(start), dtype=np.int64)
    for a, b, kind in spans:
        first = True
        for i, s in enumerate(start):
            if a <= s < b:
                y[i] = 1 + 2 * KINDS.index(kind) + (not first)
                first = False
    return y


def legal() -> np.ndarray:
    """Moves that make sense: an inside only after its own kind."""
    ok = np.ones((N, N), dtype=bool)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        ok[:, inside] = False
        ok[[inside - 1, inside], inside] = True
    return ok


def train(rows: list[tuple[str, list[tuple[int, int, str]]]], rounds: int = 7, batch: int = 200, rate: float = 0.25, ridge: float = 1e-5, drop: float = DROP, rare: int = RARE, seed: int = 3, given: set[str] = frozenset(_GIVEN)) -> Crf:
    """Maximum likelihood by adaptive gradient steps over padded batches.

    Words met fewer than ``rare`` times have no feature of their own, and at each step a share ``drop`` of the features is left out, so that
    no single word decides.
    """
    rng = np.random.default_rng(seed)
    rows = [r for r in cut(rows) if TOKEN.search(r[0])]
    y = np.concatenate([gold(t, marks) for t, marks in rows])
    words = Words()
    found = words.tokens([t for t, _ in rows])
    index, blank, length = found.index, found.blank, found.length
    number: dict[tuple[str, str], int] = {}
    met = np.bincount(index[:, 0], minlength=len(words.names))
    features = [facts(t, given) if t else ([":none"], [], []) for t in words.names]
    lists = []
    for role in ROLES:
        per = []
        for i, (every, near, own) in enumerate(features):
            some = [f for f in every if met[i] >= rare or f[0] != "="] + (near if role in NEAR else []) + (own if role == "own" else [])
            per.append([number.setdefault((role, f), len(number)) for f in dict.fromkeys(some)])
        lists.append(per)
    width = max(sum(max(len(x) for x in per) for per in lists), 1)
    feats = np.full((len(y), width), -1, dtype=np.int32)
    col = 0
    for k, per in enumerate(lists):
        w = max(len(x) for x in per)
        padded = np.array([x + [-1] * (w - len(x)) for x in per], dtype=np.int32)
        feats[:, col : col + w] = padded[index[:, k]]
        col += w
    nf = len(number)
    feats[feats < 0] = nf  # a row that stays zero
    parts = {"trigram": (found.shape, SHAPES**3), "gap": (blank, 3), "run": (found.run, RUNS), "wide": (found.wide, 6**5)}
    first = np.cumsum([nf + 1, *(n for _, n in parts.values())])
    size = int(first[-1])
    everything = np.concatenate([feats, *((a + x)[:, None].astype(np.int32) for a, (x, _) in zip(first, parts.values(), strict=False))], axis=1)
    w, g2 = np.zeros((size, N), dtype=np.float32), np.full((size, N), 1e-2, dtype=np.float32)
    ok = legal()
    move, gm = np.where(ok, 0, -30).astype(np.float64), np.full((N, N), 1e-2)
    begin, gb = np.where(np.arange(N) % 2 == 0, -30.0, 0.0), np.full(N, 1e-2)
    begin[0] = 0
    free = begin > -1
    start = np.cumsum(length) - length
    for _ in range(rounds):
        order = rng.permutation(len(rows))
        order = order[np.argsort(length[order] // 6, kind="stable")]
        parts = [order[i : i + batch] for i in range(0, len(order), batch)]
        for j in rng.permutation(len(parts)):
            b = parts[j]
            n, width_ = length[b], int(length[b].max())
            at = np.minimum(start[b][:, None] + np.arange(width_), len(y) - 1)
            inside = np.arange(width_) < n[:, None]
            f = everything[at]
            f = np.where(rng.random(f.shape) < drop, nf, f)
            emit = w[f].sum(axis=2).astype(np.float64)
            a = np.zeros((len(b), width_, N))
            a[:, 0] = emit[:, 0] + begin
            for t in range(1, width_):
                a[:, t] = np.where(inside[:, t : t + 1], _lse(a[:, t - 1][:, :, None] + move, 1) + emit[:, t], a[:, t - 1])
            z = _lse(a[:, -1], 1)
            bwd = np.zeros((len(b), width_, N))
            pair = np.zeros((N, N))
            for t in range(width_ - 2, -1, -1):
                nxt = emit[:, t + 1] + bwd[:, t + 1]
                s = move + nxt[:, None, :]
                bwd[:, t] = np.where(inside[:, t + 1 : t + 2], _lse(s, 2), 0)
                p = np.exp(a[:, t][:, :, None] + s - z[:, None, None]) * inside[:, t + 1][:, None, None]
                pair += p.sum(axis=0)
            prob = np.exp(np.minimum(0, a + bwd - z[:, None, None])) * inside[:, :, None]
            truth = y[at]
            resid = prob.copy()
            rows_, cols_ = np.nonzero(inside)
            resid[rows_, cols_, truth[rows_, cols_]] -= 1
            gold_pair = np.zeros((N, N))
            both = inside[:, 1:]
            np.add.at(gold_pair, (truth[:, :-1][both], truth[:, 1:][both]), 1)
            flat_f, flat_r = f[inside], resid[inside].astype(np.float32)
            used, slot = np.unique(flat_f, return_inverse=True)
            slot = slot.reshape(flat_f.shape)
            grad = np.zeros((len(used), N), dtype=np.float32)
            for c in range(flat_f.shape[1]):
                np.add.at(grad, slot[:, c], flat_r)
            grad = grad / len(b) + ridge * w[used]
            grad[used == nf] = 0
            g2[used] += grad**2
            w[used] -= rate * grad / np.sqrt(g2[used])
            gmove = (pair - gold_pair) / len(b)
            gm += gmove**2
            move -= np.where(ok, rate * gmove / np.sqrt(gm), 0)
            gbegin = resid[:, 0].sum(axis=0) / len(b)
            gb += gbegin**2
            begin -= np.where(free, rate * gbegin / np.sqrt(gb), 0)
    w *= 1 - drop
    kept = {f for (_, f), k in number.items() if np.abs(w[k]).max() > 1e-3} - {":none"}
    places = {f: k for k, f in enumerate(sorted(kept))}
    weights = np.zeros((len(places) + 1, len(ROLES), N), dtype=np.float32)
    for (role, f), k in number.items():
        weights[places.get(f, -1) if f != ":none" else -1, ROLES.index(role)] += w[k] if f in places or f == ":none" else 0
    return Crf(places, weights, *(w[a:b].copy() for a, b in zip(first, first[1:], strict=False)), move.astype(np.float32), begin.astype(np.float32), given)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


#: Pages and lines of the corpus taken at most as rows without personal data.
PAGES, PLAIN = 3000, 4500
_HINT = re.compile(r"(?i)@|＠|&#64;|\bat\b|\btel|\bpuh|phone|fax|dr\.|prof\.|\+\d|\(0")


def plain_lines(texts: list[str], labels: list[list[str]], first: Crf, most: int = PLAIN) -> list[tuple[str, list]]:
    """Lines that surely hold no personal data, to show the model the tables, lists and menus of the corpus at hand, which a small table cannot.

    Tables, menus, spam and other junk stand among lines of their own kind, so their labels are believed where a neighbour has the same one.
    Of prose, only lines in which the ``first`` model, of the table alone, sees nothing are taken. Words that introduce a person, streets and
    any hint of contact rule a line out.
    """
    kinds: dict[str, list[str]] = {}
    for text, page in zip(texts, labels, strict=True):
        lines = [(x, (q or "").strip().lower()[:4]) for x, q in zip(text.split("\n"), page, strict=False) if x.strip()]
        for k, (line, short) in enumerate(lines):
            if short not in ("tech", "navi", "prom", "form", "clea") or len(line) > 400 or _HINT.search(line) or _INTRODUCED.search(line) or _STREET.search(line):
                continue
            if short == "clea" and not line.rstrip().endswith((".", "!", "?")):
                continue
            if short == "clea" or short in (q for _, q in (*lines[max(0, k - 1) : k], *lines[k + 1 : k + 2])):
                kinds.setdefault(short, []).append(line)
    rng = np.random.default_rng(5)
    out = []
    for short, lines in sorted(kinds.items()):
        some = sorted(set(lines))
        some = [some[i] for i in rng.permutation(len(some))[: 2 * most // 5]]
        if short == "clea":
            some = [x for x, found in zip(some, Finder(first)(some), strict=True) if not found]
        out += [(x, []) for x in some[: most // 5]]
    return out


_USER = re.compile(r"(?<![\w.@-])([^\W\d_]{3,})[._-]([^\W\d_]{3,}(?:-[^\W\d_]{3,})?)(?:\+\w+)?\d*(?:[@＠]|&#64;| ?[\[({] ?at ?[\])}] ?| at )", re.I)


def given_in_addresses(texts: list[str]) -> set[str]:
    """First words of personal mail addresses (first.last@) of which both words stand on the page by themselves too."""
    given: set[str] = set()
    for text in texts:
        words = set(re.findall(r"[^\W\d_]+", _USER.sub(" ", text).lower()))
        for first, last in {(a.lower(), b.lower()) for a, b in _USER.findall(text)}:
            if re.split("-", last)[0] in words and first in words:
                given.add(first)
    return given


def fit(texts: list[str], labels: list[list[str]], rows: int = pii_table.ROWS) -> Crf:
    """The labelled table, and lines of the corpus without personal data."""
    table, given = pii_table.table(rows), _GIVEN | given_in_addresses(texts)
    return train(table + plain_lines(texts, labels, train(table, rounds=4, given=given)), given=given)


def exact(kind: str, text: str) -> bool:
    """The exact check of what was decoded."""
    figures = sum(c.isdigit() for c in text)
    if kind == "email":
        return bool(AT.search(text)) and len(text) > 5
    if kind == "phone":
        return figures >= 7
    if kind == "id_number":
        return figures >= 6 and len(text) >= 7
    if kind == "address":
        return figures >= 1 and any(c.isalpha() for c in text) and len(text) > 4
    # a name of two parts at least; what starts small and goes on with a capital is an article before something
    parts = re.findall(r"[^\W\d_]+", text)
    return figures == 0 and len(parts) > 1 and max(map(len, parts)) > 2 and not _NO_NAME.search(text) and not (text[0].islower() and parts[-1][0].isupper())


def spans(text: str, labels: np.ndarray) -> list[tuple[int, int, str]]:
    """Checked spans of a decoded sentence."""
    found = list(TOKEN.finditer(text))
    out, i = [], 0
    while i < len(labels):
        if labels[i] == 0:
            i += 1
            continue
        kind = KINDS[(labels[i] - 1) // 2]
        j = i + 1
        inside = 2 + 2 * KINDS.index(kind)
        while j < len(labels) and labels[j] == inside:
            j += 1
        a, b = found[i].start(), found[j - 1].end()
        if exact(kind, text[a:b]):
            out.append((a, b, kind))
        i = j
    return out


def pieces(line: str) -> list[tuple[int, str]]:
    """A line as (offset, sentence)."""
    out, at = [], 0
    for m in BREAK.finditer(line):
        k = m.start()
        if line[k] == ".":
            before = line[max(0, k - 4) : k]
            if len(before) < 4 or not before.isalpha() or before.lower() in TITLES:
                continue
        out.append((at, line[at : k + 1]))
        at = m.end()
    out.append((at, line[at:]))
    return out


def cut(rows: list[tuple[str, list[tuple[int, int, str]]]]) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Labelled rows by their pieces."""
    return [(p, [(a - o, b - o, kind) for a, b, kind in marks if o <= a and b <= o + len(p)]) for text, marks in rows for o, p in pieces(text)]


class Memory:
    """Words met and their emissions, for one batch after another; it starts afresh when it holds too many."""

    def __init__(self, model: Crf, limit: int = 60_000):
        self.model, self.limit = model, limit
        self.words, self.table, self.filled = Words(), np.zeros((1024, len(ROLES), N), dtype=np.float32), 0

    def rows(self) -> np.ndarray:
        names = self.words.names
        if len(names) > len(self.table):
            grown = np.zeros((2 * len(names), len(ROLES), N), dtype=np.float32)
            grown[: self.filled] = self.table[: self.filled]
            self.table = grown
        for k in range(self.filled, len(names)):
            self.table[k] = self.model.row(names[k])
        self.filled = len(names)
        return self.table

    def trim(self) -> None:
        if len(self.words.known) > self.limit:
            self.words, self.filled = Words(), 0


class Finder:
    """A model with its memories."""

    def __init__(self, model: Crf):
        self.model, self.memory, self.known = model, Memory(model), Bounded(KNOWN)

    def __call__(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """Spans of each text."""
        self.memory.trim()
        self.known.trim()
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        parts: list[tuple[int, int, str]] = []
        for k, text in enumerate(texts):
            at = 0
            for line in text.split("\n") if text else ():
                parts.extend((k, at + o, s) for o, s in pieces(line))
                at += len(line) + 1
        new = list({s for _, _, s in parts}.difference(self.known))
        for s, labels in zip(new, self.model.decode(new, self.memory), strict=True):
            self.known[s] = spans(s, labels) if labels is not None else []
        for k, o, s in parts:
            if found := self.known[s]:
                out[k].extend((o + a, o + b, kind) for a, b, kind in found)
        return out


def personal_data(df: DataFrame, model: Crf, text: str = "text") -> DataFrame:
    """``df`` with ``found``, an array of (pii_type, pii_text) in order of place, repeats kept, in place of the text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work():
        finder = Finder(shared.value)
        return lambda texts: [[[{"pii_type": k, "pii_text": t[a:b]} for a, b, k in page] for t, page in zip(texts, finder(texts), strict=True)]]

    return annotate(df, work, "found array<struct<pii_type: string, pii_text: string>>", text)


def masked_text(df: DataFrame, model: Crf, text: str = "text") -> DataFrame:
    """``df`` with ``masked``, the text with a typed placeholder for each span and otherwise unchanged; null for a null text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def put(t: str | None, page: list[tuple[int, int, str]]) -> str | None:
        if t is None:
            return None
        out, at = [], 0
        for a, b, kind in page:
            out += [t[at:a], PLACEHOLDER[kind]]
            at = b
        return "".join([*out, t[at:]])

    def work():
        finder = Finder(shared.value)
        return lambda texts: [[put(t, page) for t, page in zip(texts, finder(texts), strict=True)]]

    return annotate(df, work, "masked string", text)
