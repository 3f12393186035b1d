"""The main body of a page, by boosted trees over the nodes of a page tree.

Extracted text has lost its markup, so the tree is rebuilt from the layout: a page holds blocks, runs of lines of one shape (bullets, short
lines, separated entries, figures, sentences); a block holds lines. A node is described by its own text (length, density, ends, separators),
its attribute tokens (log-odds of its words and of the whole line between boilerplate and body), its depth (bullet, indentation), its place
among its siblings and on the page, and the same of its neighbours and its block. Two rounds of trees: the second one also sees what the
first said about the lines around.

Hierarchical decoding then settles each block as a whole: all body, all boilerplate, or one change inside it at a price, so that no line
contradicts its block without strong evidence of its own.

Trained from line labels of a bounded sample of pages (``PAGES``); labels are noisy, so token statistics are taken from one half of the
sample and used on the other, and trees average over the noise. Labels that fit both menus and body (spam) are left out of training.

Null and empty texts have no lines. Blank lines belong to nothing and are never given out. Lines are cut at newlines only.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import chain, compress, repeat

import numpy as np

from pyspark.sql import DataFrame

from . import boosting
from .pages import annotate, sample_pages

#: Pages the model is trained on at most.
PAGES = 3000
#: Trees of the second round; the first has half as many.
TREES = 60
POSITIVE = ("navi", "lega", "cont")
SKIPPED = ("prom",)

#: Word pairs are tokens in lines of at most so many words; menus and notices are short.
PAIRED = 12

# Code points: marks between entries when blanks stand around them, bullets, ends of sentences, what may follow those, what markup, links, addresses
# and broken encodings are made of.
BETWEEN, ALONE, BULLETS, ENDS, CLOSING, ODD = ((1 << k, x) for k, x in enumerate(("|/·»>•-", ",;\t", "*•>»-–·", ".!?…", "\"'»”)", "<&@#[(ÃÂÐÑâ")))
# Classes of characters: plain letters and the newline between lines, figures, capitals, marks, blanks, invisible ones.
PLAIN, FIGURE, CAPITAL, MARK, BLANK, INVISIBLE = range(6)
#: Characters from here on are taken for letters as they are: ideographs and what lies beyond.
LIMIT = 0x3100


def _characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its class, and what stands for it in tokens (small letters, figures alike, blanks for marks but those that tell something)."""
    kind, fold = np.zeros(LIMIT + 1, dtype=np.uint8), np.arange(LIMIT + 1, dtype=np.uint32)
    for c in range(LIMIT):
        x = chr(c)
        if x == "\n":
            continue
        group = unicodedata.category(x)
        if group == "Nd":
            kind[c], fold[c] = FIGURE, 48
        elif group in ("Cf", "Mn", "Me", "Mc"):
            kind[c] = INVISIBLE if group == "Cf" else PLAIN
        elif x.isspace() or group in ("Cc", "Zs"):
            kind[c], fold[c] = BLANK, 32
        elif x.isalnum():
            kind[c], fold[c] = CAPITAL if x.isupper() or x.istitle() else PLAIN, ord(x.lower()[0])
        else:
            kind[c], fold[c] = MARK, c if x in "@#" else 32
    return kind, fold


KIND, FOLD = _characters()
USES = np.zeros(LIMIT + 1, dtype=np.uint8)
for _bit, _marks in (BETWEEN, ALONE, BULLETS, ENDS, CLOSING, ODD):
    for _c in _marks:
        USES[ord(_c)] |= _bit


def points_of(lines: list[str]) -> np.ndarray:
    """Code points of some lines with a newline after each."""
    return np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le", "replace"), dtype=np.uint32)


def folded(points: np.ndarray) -> list[str]:
    """The lines again: small letters, figures alike, blanks for marks but at signs and hashes, invisible characters left out."""
    at = np.minimum(points, LIMIT)
    return np.where(points < LIMIT, FOLD[at], points)[KIND[at] != INVISIBLE].tobytes().decode("utf-32-le").split("\n")[:-1]


def spells(points: np.ndarray, word: str) -> np.ndarray:
    """Whether a word begins at each place."""
    out = np.zeros(len(points), dtype=bool)
    n = len(points) - len(word) + 1
    if n > 0:
        out[:n] = points[:n] == ord(word[0])
        for k, c in enumerate(word[1:], 1):
            out[:n] &= points[k : k + n] == ord(c)
    return out


def measured(lines: list[str], text: list[str], points: np.ndarray, words: np.ndarray, different: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, shape, whether it is odd) of non-blank lines, given without outer blanks, as code points, and with how many words and different words they have."""
    at = np.minimum(points, LIMIT)
    kind, uses = KIND[at], USES[at]
    are = lambda use, where=slice(None): (uses[where] & use[0]) > 0
    n = np.fromiter(map(len, text), dtype=np.int64, count=len(text))
    after = np.cumsum(n + 1)
    starts, last = after - n - 1, after - 2
    count = lambda mask: np.add.reduceat(mask, starts, dtype=np.int64)
    space, dot = points == 32, are(ENDS)
    ended = last.copy()
    while (closed := are(CLOSING, ended) & (ended > starts)).any():
        ended -= closed
    end = dot[ended]
    between = are(BETWEEN)
    between[1:-1] &= space[:-2] & space[2:]
    double = np.r_[space[:-1] & space[1:], False]
    separators = count(between | double | are(ALONE))
    sentences = count(np.r_[dot[:-1] & space[1:], False]) + end
    figure = kind == FIGURE
    digits, symbols, capital = count(figure), count(kind == MARK), count(kind == CAPITAL)
    letters = n - digits - symbols - count(kind == BLANK)
    # a bullet, or up to three figures with a dot or bracket, and a blank
    top = len(points) - 1
    lead = np.zeros(len(text), dtype=np.int64)
    for k in range(3):
        lead += (lead == k) & figure[np.minimum(starts + k, top)]
    behind = np.minimum(starts + lead, top)
    mark, gap = points[behind], kind[np.minimum(behind + 1, top)] == BLANK
    bullet = gap & np.where(lead > 0, (mark == 46) | (mark == 41), are(BULLETS, behind))
    indent = np.fromiter((len(x) - len(x.lstrip()) if x[0].isspace() else 0 for x in lines), dtype=np.int64, count=len(lines))
    link = count(spells(points, "http") | spells(points, "www.")) > 0
    has = lambda c: count(points == ord(c)) > 0
    some, chars = np.maximum(1, words), np.maximum(1, n)
    numbers = np.stack([
        np.log1p(n), words, letters / some, digits / chars, end, separators, separators / some, bullet,
        capital / some, points[ended] == ord(":"), has("©") | spells(points, "(c)")[starts], has("@"), link, sentences,
        symbols / chars, indent, kind[starts] == CAPITAL, different / some,
        figure[last] | (points[last] == ord(")")), figure[starts], has("#"),
    ], axis=1).astype(float)
    shape = np.where((sentences > 0) & (words > 5), 4, np.where(bullet, 0, np.where(digits > 0.3 * n, 3, np.where(separators >= 2, 2, 1))))
    return numbers, shape, (count(are(ODD) | spells(points, " AT ")) > 0) | link


@dataclass
class Lines:
    """What lines show by themselves: numbers (a row each), shapes, the words of each with their number, and the lines as folded.

    ``odd`` tells which may hold markup, links, addresses or a broken encoding.
    """

    numbers: np.ndarray
    shape: np.ndarray
    words: list[str]
    size: np.ndarray
    keys: list[str]
    odd: np.ndarray

    @classmethod
    def describe(cls, lines: list[str]) -> Lines:
        """Of non-blank lines without newlines."""
        if not lines:
            return cls(np.zeros((0, 21)), np.zeros(0, dtype=np.int64), [], np.zeros(0, dtype=np.int64), [], np.zeros(0, dtype=bool))
        text = [x.strip() for x in lines]
        points = points_of(text)
        keys = folded(points)
        per = [x.split() for x in keys]
        words = np.fromiter(map(len, per), dtype=np.int64, count=len(per))
        different = np.fromiter((len(set(x)) for x in per), dtype=np.int64, count=len(per))
        numbers, shape, odd = measured(lines, text, points, words, different)
        return cls(numbers, shape, list(chain.from_iterable(per)), words, keys, odd)

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, lines) of the words of some lines, lines numbered among the chosen ones."""
        first = np.cumsum(self.size) - self.size
        size = self.size[which]
        line = np.repeat(np.arange(len(which)), size)
        return first[which][line] + np.arange(len(line)) - (np.cumsum(size) - size)[line], line


@dataclass
class Odds:
    """Log-odds of words, of first and last words, of pairs of words in short lines, and of whole lines, positive for boilerplate."""

    number: dict[str, int]
    word: np.ndarray
    first: np.ndarray
    last: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray
    line: dict[str, float]

    @classmethod
    def count(cls, lines: Lines, y: np.ndarray, weight: np.ndarray, least: int = 4) -> Odds:
        """What stands in fewer than ``least`` lines says nothing."""
        use = np.flatnonzero(weight > 0)
        at, line = lines.of(use)
        words = [lines.words[k] for k in at]
        names = sorted(set(words))
        number = {w: k for k, w in enumerate(names, 1)}
        ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
        label = y[use] > 0
        a, b = 0.5 + label.sum(), 0.5 + (~label).sum()
        prior = np.log(a / b)

        def odds(keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Different keys in at least ``least`` lines, with their odds; a key counts once a line."""
            if not len(keys):
                return np.zeros(0, dtype=np.int64), np.zeros(0)
            once = np.unique(np.stack([keys, of]), axis=1)
            found, back = np.unique(once[0], return_inverse=True)
            p = np.bincount(back, weights=label[once[1]], minlength=len(found))
            total = np.bincount(back, minlength=len(found))
            keep = total >= least
            return found[keep], (np.log((p + 0.5) / (total - p + 0.5)) - prior)[keep]

        def table(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
            out = np.full(len(names) + 1, np.nan)
            found, value = odds(keys, of)
            out[found] = value
            return out

        head, tail, both, pairs = ends(ids, line, lines.size[use], len(names) + 1)
        kinds, value = odds(pairs, both)
        whole: dict[str, list[int]] = {}
        for k, q in zip(use, label, strict=True):
            whole.setdefault(lines.keys[k], [0, 0])[int(q)] += 1
        line_odds = {k: float(np.log((p + 0.5) / (n + 0.5)) - prior) for k, (n, p) in whole.items() if n + p >= least}
        return cls(number, table(ids, line), table(ids[head], line[head]), table(ids[tail], line[tail]), kinds, value, line_odds)

    def of(self, lines: Lines, which: np.ndarray | None = None) -> np.ndarray:
        """Mean, greatest and least odds of a line's tokens, the whole line's, and the share of its tokens that are known: a row each."""
        ids = np.fromiter(map(self.number.get, lines.words, repeat(0)), dtype=np.int64, count=len(lines.words))
        which = np.arange(len(lines.size)) if which is None else which
        at, line = lines.of(which)
        ids, n = ids[at], len(which)
        head, tail, both, pairs = ends(ids, line, lines.size[which], len(self.word))
        met = np.searchsorted(self.pairs, pairs)
        met[met == len(self.pairs)] = 0
        pair = np.where(self.pairs[met] == pairs, self.pair[met], np.nan) if len(self.pairs) else np.full(len(pairs), np.nan)
        value = np.concatenate([self.word[ids], self.first[ids[head]], self.last[ids[tail]], pair])
        owner = np.concatenate([line, line[head], line[tail], both])
        tokens = np.bincount(owner, minlength=n)
        known = ~np.isnan(value)
        value, owner = value[known], owner[known]
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
        out = np.zeros((n, 5))
        if len(value):
            begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            some = owner[begin]
            met = np.diff(np.r_[begin, len(value)])
            out[some, 0] = np.add.reduceat(value, begin) / met
            out[some, 1], out[some, 2] = np.maximum.reduceat(value, begin), np.minimum.reduceat(value, begin)
            out[some, 4] = met / tokens[some]
        out[:, 3] = [self.line.get(lines.keys[k], 0.0) for k in which]
        return out


def ends(ids: np.ndarray, line: np.ndarray, size: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of first and of last words of lines; lines and numbers of the pairs of neighbours in short ones."""
    last = np.cumsum(size) - 1
    some = size > 0
    near = np.flatnonzero((line[1:] == line[:-1]) & (size[line[1:]] <= PAIRED)) if len(ids) else np.zeros(0, dtype=np.int64)
    return (last - size + 1)[some], last[some], line[near], ids[near] * names + ids[near + 1] if len(ids) else near


def shifted(a: np.ndarray, by: int, page: np.ndarray, fill: float = -9.0) -> np.ndarray:
    """Values of the line ``by`` places on, where it is on the same page."""
    out = np.full_like(a, fill)
    n = len(a)
    if abs(by) >= n:
        return out
    if by > 0:
        same = page[:-by] == page[by:]
        out[:-by][same] = a[by:][same]
    else:
        same = page[-by:] == page[:by]
        out[-by:][same] = a[:by][same]
    return out


def grouped(a: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Mean of the values of each row's group; groups are numbered without gaps."""
    return (np.bincount(group, weights=a) / np.maximum(1, np.bincount(group)))[group]


def runs(*keys: np.ndarray) -> np.ndarray:
    """Numbers of runs of equal keys."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(len(keys[0]), dtype=bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.cumsum(change)


def node_features(lines: Lines, odd: np.ndarray, page: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, block numbers) of the non-blank lines of some pages; ``gap`` tells whether a blank line stands before."""
    own, shape = lines.numbers, lines.shape
    n = len(shape)
    start = np.flatnonzero(np.r_[True, page[1:] != page[:-1]])
    size = np.diff(np.r_[start, n])
    which = np.repeat(np.arange(len(start)), size)
    pos = np.arange(n) - start[which]
    back = size[which] - 1 - pos
    block = runs(page, shape)
    bstart = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    bsize = np.diff(np.r_[bstart, n])
    inb = np.arange(n) - bstart[block]
    bpage = which[bstart]
    bfirst = np.searchsorted(bpage, np.arange(len(start)))
    border = np.arange(len(bstart)) - bfirst[bpage]
    bcount = np.bincount(bpage, minlength=len(start))[bpage]
    mean, line = odd[:, 0], odd[:, 3]
    strength = np.where(line != 0, line, 2 * mean)
    # sums of the lines before and after on the page
    total = np.cumsum(strength)
    before = total - strength - np.r_[0, total][start[which]]
    after = total[start[which] + size[which] - 1] - total
    sentence = (shape == 4).astype(float)
    scum = np.cumsum(sentence)
    sbefore = scum - sentence - np.r_[0, scum][start[which]]
    safter = scum[start[which] + size[which] - 1] - scum
    # the strongest line so far in the run of lines that are no sentences
    run = runs(page, sentence)
    rstart = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    inrun = np.arange(n) - rstart[run]
    rsize = np.diff(np.r_[rstart, n])[run]
    head = strength[rstart][run]
    colon = own[:, 9]
    ccum = np.cumsum(colon)
    colons = ccum - np.r_[0, ccum][rstart][run]
    local = np.maximum.accumulate(strength + 1000 * run) - 1000 * run
    chars = np.expm1(own[:, 0])
    parts = [
        own, odd, shape[:, None],
        np.stack([
            pos, back, pos / np.maximum(1, size[which] - 1), size[which], gap,
            bsize[block], inb, border[block], bcount[block] - 1 - border[block], grouped(chars, block), grouped(strength, block), grouped(own[:, 1], block), grouped(own[:, 8], block),
            before / np.maximum(1, pos), after / np.maximum(1, back), sbefore, safter, sentence.sum() * 0 + grouped(sentence, which), grouped(strength, which), grouped(chars, which),
            inrun, rsize, head, colons, local, strength[np.maximum(0, rstart - 1)][run],
        ], axis=1),
    ]
    for by in (-3, -2, -1, 1, 2, 3):
        parts.append(np.stack([shifted(a.astype(float), by, page) for a in (strength, own[:, 0], own[:, 4], shape, own[:, 9])], axis=1))
    return np.concatenate(parts, axis=1).astype(np.float32), block


def around(p: np.ndarray, page: np.ndarray, block: np.ndarray) -> np.ndarray:
    """What the first round said about a line, its neighbours and its block."""
    cols = [p, *(shifted(p, by, page, 0.0) for by in (-3, -2, -1, 1, 2, 3)), grouped(p, block)]
    start = np.flatnonzero(np.r_[True, page[1:] != page[:-1]])
    which = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(page)]))
    total = np.cumsum(p)
    size = np.diff(np.r_[start, len(page)])
    pos = np.arange(len(p)) - start[which]
    cols += [(total - p - np.r_[0, total][start[which]]) / np.maximum(1, pos), (total[start[which] + size[which] - 1] - total) / np.maximum(1, size[which] - 1 - pos)]
    return np.stack(cols, axis=1).astype(np.float32)


def decode(raw: np.ndarray, block: np.ndarray, price: float = 0.6) -> np.ndarray:
    """Boilerplate or not, settled block by block: whole, or with one change inside at a price.

    The value of a labelling is the sum of the log-odds of the lines given out; one cumulative sum per block finds the best change.
    """
    raw = np.clip(raw, -4, 4)
    out = np.zeros(len(raw), dtype=bool)
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(raw) else np.zeros(0, int)
    positive = np.add.reduceat(raw > 0, starts) if len(raw) else starts
    size = np.diff(np.r_[starts, len(raw)])
    out[np.repeat(positive == size, size)] = True
    # only blocks whose lines disagree leave a choice
    for i in np.flatnonzero((positive > 0) & (positive < size)):
        a, b = starts[i], starts[i] + size[i]
        c = np.cumsum(raw[a:b])
        options = [(0.0, 0, 0), (c[-1], 0, b - a)]
        k = int(np.argmax(c[:-1]))
        options.append((c[k] - price, 0, k + 1))
        tail = c[-1] - c[:-1]
        k = int(np.argmax(tail))
        options.append((tail[k] - price, k + 1, b - a))
        _, lo, hi = max(options)
        out[a + lo : a + hi] = True
    # evidence of its own lets a line differ from its block
    out[raw > 2.5] = True
    out[raw < -2.5] = False
    return out


class Pages:
    """The non-blank lines of some texts, with their pages, line numbers and descriptions."""

    def __init__(self, texts: list[str | None], describe: Callable[[list[str]], object] = Lines.describe):
        per = [text.split("\n") if text else [] for text in texts]
        every, size = list(chain.from_iterable(per)), np.fromiter(map(len, per), dtype=np.int64, count=len(per))
        some = np.fromiter(map(bool, map(str.strip, every)), dtype=bool, count=len(every))
        at, page = np.flatnonzero(some), np.repeat(np.arange(len(per)), size)
        self.text = list(compress(every, some.tolist()))
        self.page = page[at]
        self.no = at - (np.cumsum(size) - size)[self.page]
        self.gap = ((self.no > 0) & ~some[at - 1]).astype(float)
        self.lines = describe(self.text)


@dataclass
class Boilerplate:
    """A trained model; ``mark`` tells of each non-blank line of some pages whether it is boilerplate."""

    odds: Odds
    first: boosting.Trees
    second: boosting.Trees

    def mark(self, pages: Pages) -> np.ndarray:
        return self.scored(pages)[1]

    def scored(self, pages: Pages) -> tuple[np.ndarray, np.ndarray]:
        if not pages.text:
            return np.zeros(0), np.zeros(0, dtype=bool)
        x, block = node_features(pages.lines, self.odds.of(pages.lines), pages.page, pages.gap)
        bins: dict[int, np.ndarray] = {}
        p = self.first.proba(x, bins)
        raw = self.second.raw(np.concatenate([x, around(p, pages.page, block)], axis=1), bins)
        return raw, decode(raw, block)


def targets(pages: Pages, labels: list[list[str] | None]) -> tuple[np.ndarray, np.ndarray]:
    """(label, weight) of each line; pages whose labels are missing or of another number than the lines have weight 0."""
    y, w = np.zeros(len(pages.text)), np.zeros(len(pages.text))
    for k, (p, i) in enumerate(zip(pages.page, pages.no, strict=True)):
        page = labels[p]
        label = page[i] if page is not None and i < len(page) else None
        if label:
            short = label.strip().lower()[:4]
            y[k], w[k] = short in POSITIVE, short not in SKIPPED
    return y, w


def train(texts: list[str | None], labels: list[list[str] | None], trees: int = TREES) -> Boilerplate:
    """Fits on texts with their line labels; whole pages go to one half or the other."""
    usable = [k for k, (t, q) in enumerate(zip(texts, labels, strict=True)) if t and q is not None and len(q) == t.count("\n") + 1]
    pages = Pages([texts[k] for k in usable])
    y, w = targets(pages, [labels[k] for k in usable])
    odds = Odds.count(pages.lines, y, w)
    if not pages.text:
        empty = np.zeros((0, 1))
        return Boilerplate(odds, boosting.fit(empty, y, w), boosting.fit(empty, y, w))
    half = pages.page % 2
    odd = np.zeros((len(y), 5))
    for h in (0, 1):
        # repeated texts must not meet their own statistics: halves are by text as far as pages are different
        some = np.flatnonzero(half == h)
        odd[some] = Odds.count(pages.lines, y, np.where(half != h, w, 0)).of(pages.lines, some)
    x, block = node_features(pages.lines, odd, pages.page, pages.gap)
    p = np.zeros(len(y))
    for h in (0, 1):
        p[half == h] = boosting.fit(x[half != h], y[half != h], w[half != h], trees=trees // 2).proba(x[half == h])
    first = boosting.fit(x, y, w, trees=trees // 2)
    second = boosting.fit(np.concatenate([x, around(p, pages.page, block)], axis=1), y, w, trees=trees)
    return Boilerplate(odds, first, second)


class Marker:
    """A model for one batch after another."""

    def __init__(self, model: Boilerplate):
        self.model = model

    def __call__(self, texts: list[str | None]) -> tuple[Pages, np.ndarray]:
        pages = Pages(texts)
        return pages, self.model.mark(pages)


def labelled(rows: Iterable[tuple[str, list[str] | None]]) -> tuple[list[str], list[list[str]]]:
    """Different texts whose labels are as many as their lines."""
    found: dict[str, list[str]] = {}
    for t, q in rows:
        if q is not None and len(q) == t.count("\n") + 1:
            found.setdefault(t, list(q))
    return list(found), list(found.values())


def labelled_sample(df: DataFrame, rows: int = PAGES, text: str = "text", labels: str = "line_quality_labels") -> tuple[list[str], list[list[str]]]:
    """At most ``rows`` different texts with labels: what models are fitted on. The table is counted by its footers and read once."""
    return labelled(tuple(r) for r in sample_pages(df.where(df[text].isNotNull() & df[labels].isNotNull()), [text, labels], rows, df.count()))


def fit(df: DataFrame, rows: int = PAGES) -> Boilerplate:
    return train(*labelled_sample(df, rows))


def boilerplate_lines(df: DataFrame, model: Boilerplate, text: str = "text") -> DataFrame:
    """``df`` with ``boilerplate``, the numbers of the lines outside the main body, in place of the text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work():
        marker = Marker(shared.value)

        def each(texts: list[str | None]) -> list[list]:
            pages, mark = marker(texts)
            out: list[list[int]] = [[] for _ in texts]
            for p, i in zip(pages.page[mark].tolist(), pages.no[mark].tolist(), strict=True):
                out[p].append(i)
            return [out]

        return each

    return annotate(df, work, "boilerplate array<int>", text)


def main_text(df: DataFrame, model: Boilerplate, text: str = "text") -> DataFrame:
    """``df`` with ``body``, the main body alone (blank lines stay between its lines), in place of the text; null for a null text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work():
        marker = Marker(shared.value)

        def each(texts: list[str | None]) -> list[list]:
            pages, mark = marker(texts)
            gone: list[set[int]] = [set() for _ in texts]
            for p, i in zip(pages.page[mark].tolist(), pages.no[mark].tolist(), strict=True):
                gone[p].add(i)
            return [[None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in g).strip("\n") for t, g in zip(texts, gone, strict=True)]]

        return each

    return annotate(df, work, "body string", text)
