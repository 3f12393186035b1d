"""Pages of repeated keywords, link lists and product tags, by n-gram models over function words and word classes.

A trigram model of prose gives every line of a page's body a perplexity; on spam it is abnormally high (no sentence runs like that) or, for
the same phrase over and over, its repeats stand out. What is abnormal may also be an ordinary list, a table or junk, so the same classes are
scored under a model of spam lines and one of all other lines that are no prose; trees over the page's perplexities and the shares of
repeated words, links and tags decide, and nothing is flagged whose perplexity is that of prose.

Models are trained on the line labels of a bounded sample of pages. Null and empty texts, and pages without a body, are never flagged.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from . import boosting
from .boilerplate import Boilerplate, Marker, Pages
from .ngram import CLASSES, Ngrams, Tokens, Vocabulary, grams
from .pages import Bounded, annotate

PROSE, SPAM, OTHER = ("clea", "bibl"), ("prom",), ("tech", "form")
#: Share of prose pages whose perplexity is taken for normal.
NORMAL = 0.9


def short(label: str | None) -> str:
    return (label or "").strip().lower()[:4]


@dataclass
class Spam:
    words: Vocabulary
    prose: Ngrams
    spam: Ngrams
    other: Ngrams
    trees: boosting.Trees
    low: float
    high: float

    def features(self, lines: list[str], page: np.ndarray, n_pages: int, cache: dict[str, int]) -> np.ndarray:
        """One row per page, of its body lines."""
        if not lines:
            return np.zeros((n_pages, 16))
        return self.described(Tokens.of(lines, cache), page, repeats(lines, page, n_pages), n_pages)

    def described(self, tokens: Tokens, page: np.ndarray, same: np.ndarray, n_pages: int) -> np.ndarray:
        """Of lines as tokens; ``page`` is the page of each line, ``same`` the number of lines of a page that stood on it before."""
        seq, line, again = tokens.sequence(self.words), tokens.line(), tokens.again()
        owner = page[line]
        told = pa.array(grams(seq, 3)).dictionary_encode()
        different, at = told.dictionary.to_numpy(), told.indices.to_numpy()
        # looked up in order, which is faster
        order = np.argsort(different)
        different, at = different[order], np.argsort(order)[at]
        models = [m.bits(different)[at] for m in (self.prose, self.spam, self.other)]
        n = np.maximum(1, np.bincount(owner, minlength=n_pages))
        sums = [np.bincount(owner, weights=m, minlength=n_pages) / n for m in models]
        # lines vote too: a few long ones must not hide the rest
        length = np.maximum(1, np.bincount(line, minlength=len(page)))
        per_line = np.stack([np.bincount(line, weights=m, minlength=len(page)) / length for m in models])
        n_lines = np.maximum(1, np.bincount(page, minlength=n_pages))
        best = per_line.argmin(axis=0)
        votes = [np.bincount(page, weights=best == k, minlength=n_pages) / n_lines for k in range(3)]
        base = seq % len(CLASSES) * (seq < 2 * len(CLASSES)) + (seq >= 2 * len(CLASSES)) * -1
        share = lambda mask: np.bincount(owner, weights=mask, minlength=n_pages) / n
        function = share(seq >= 2 * len(CLASSES))
        return np.stack(
            [*sums, sums[0] - sums[1], sums[1] - sums[2], *votes, share(again), share(base == 2), share(base == 3), share(base == 10), function, same / n_lines, np.log1p(n), n_lines],
            axis=1,
        )

    def flag(self, lines: list[str], page: np.ndarray, n_pages: int, cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flagged, probability, bits a token under the prose model) of each page."""
        return self.decide(self.features(lines, page, n_pages, cache), np.bincount(page, minlength=n_pages) > 0 if len(lines) else np.zeros(n_pages, dtype=bool))

    def decide(self, x: np.ndarray, has: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of features; ``has`` tells which pages have a body."""
        p = self.trees.proba(x)
        abnormal = (x[:, 0] < self.low) | (x[:, 0] > self.high)
        return has & abnormal & (p > 0.5), p, x[:, 0]


def repeats(lines: list[str], page: np.ndarray, n_pages: int) -> np.ndarray:
    """Lines of each page that stood on it before."""
    different = Counter(p for p, _ in set(zip(page.tolist(), (x.strip().lower() for x in lines), strict=True)))
    return np.bincount(page, minlength=n_pages) - np.array([different[p] for p in range(n_pages)], dtype=float)


def body_lines(pages: Pages, mark: np.ndarray) -> tuple[list[str], np.ndarray]:
    keep = np.flatnonzero(~mark)
    return [pages.text[k] for k in keep], pages.page[keep]


def labelled_body(texts: list[str], labels: list[list[str]], body: Boilerplate) -> tuple[list[str], np.ndarray, list[str]]:
    """Body lines of labelled pages with their pages and labels."""
    pages = Pages(texts)
    keep = np.flatnonzero(~body.mark(pages))
    return [pages.text[k] for k in keep], pages.page[keep], [short(labels[pages.page[k]][pages.no[k]]) for k in keep]


def train(texts: list[str], labels: list[list[str]], body: Boilerplate) -> Spam:
    lines, page, label = labelled_body(texts, labels, body)
    label = np.array(label, dtype=object)
    n = len(texts)
    per = {k: np.bincount(page, weights=np.isin(label, v), minlength=n) if len(lines) else np.zeros(n) for k, v in (("prose", PROSE), ("spam", SPAM), ("other", OTHER))}
    total = np.maximum(1, sum(per.values()))
    kind = np.array(["prose", "spam", "other"])[np.argmax(np.stack([per["prose"], per["spam"], per["other"]]), axis=0)]
    # a line counts for a model when its page agrees: single labels are noisy
    half = np.arange(n) % 2
    of = lambda k, h=None: [x for x, p, q in zip(lines, page, label, strict=True) if kind[p] == k and (h is None or half[p] == h) and (k != "prose" or q in PROSE)]
    words = Vocabulary.fit(of("prose"))
    classes = 2 * len(CLASSES) + len(words.words)
    fit = lambda k, h=None: Ngrams.fit(words.sequence(of(k, h), {})[0] if of(k, h) else np.zeros(0, dtype=np.int64), classes)
    y = (kind == "spam").astype(float)
    sure = np.stack(list(per.values())).max(axis=0) / total
    weight = np.where((np.bincount(page, minlength=n) if len(lines) else np.zeros(n)) > 0, sure, 0)
    x = np.zeros((n, 16))
    empty = boosting.fit(np.zeros((0, 16)), np.zeros(0))
    for h in (0, 1):
        # perplexities that trees learn from come from models of the other half
        model = Spam(words, fit("prose", 1 - h), fit("spam", 1 - h), fit("other", 1 - h), empty, 0, 0)
        x[half == h] = model.features(lines, page, n, {})[half == h]
    prose = x[(kind == "prose") & (weight > 0.8), 0]
    low, high = np.quantile(prose, [(1 - NORMAL) / 2, (1 + NORMAL) / 2]) if len(prose) > 10 else (0.0, 0.0)
    trees = boosting.fit(x, y, weight, trees=40, depth=4, share=0.8)
    return Spam(words, fit("prose"), fit("spam"), fit("other"), trees, float(low), float(high))


def spam_pages(df: DataFrame, model: Spam, body: Boilerplate, text: str = "text") -> DataFrame:
    """``df`` with ``spam`` (flag), ``spam_score`` and ``prose_bits`` (bits a token under the prose model) in place of the text."""
    shared = df.sparkSession.sparkContext.broadcast((model, body))

    def work():
        spam, marker, cache = shared.value[0], Marker(shared.value[1]), Bounded(100_000)

        def each(texts: list[str | None]) -> list[list]:
            cache.trim()
            lines, page = body_lines(*marker(texts))
            flag, p, bits = spam.flag(lines, page, len(texts), cache)
            return [flag.tolist(), p.tolist(), bits.tolist()]

        return each

    return annotate(df, work, "spam boolean, spam_score double, prose_bits double", text)
