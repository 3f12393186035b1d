"""Statistics of a page's text, and whether it is natural prose.

Beside the usual ratios (words, word length, symbols, figures, punctuated lines, common words) three measures of layout tell lists and tables:
vertical delimiter alignment (whether delimiters and wide gaps stand in the same columns, or the same delimiters come in the same numbers, from
line to line), indentation periodicity (how often the lead of a line comes again at a fixed step) and line-length autocorrelation over several lags.

Trees over the statistics of the body decide between prose and everything else, trained on line labels of a bounded sample of pages.
A null text has null statistics; an empty or blank one has zeros. Neither is ever found to be no prose.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np

from pyspark.sql import DataFrame

from . import boosting
from .boilerplate import CAPITAL, FIGURE, KIND, LIMIT, Boilerplate, Marker, Pages, points_of
from .pages import annotate

WORD = re.compile(r"[^\W\d_]+", re.UNICODE)
STOPS = frozenset(".!?…")
LEAD = re.compile(r"^\s*(?:[^\w\s]+\s*|\d+[.)]?\s*)?")
DELIMITERS = "\t|;,·>/-:"
#: Ends of delimiters and of gaps of two blanks or more: where a column begins.
COLUMN = re.compile(r"[\t|;,·>/:]\s*|(?<=\S)\s{2,}(?=\S)")
NO_PROSE = ("tech", "form", "prom")
PROSE = ("clea", "bibl", "offe")
# Statistics in order; the first REPORTED are given out.
REPORTED = 9
STATS = [
    "n_words", "mean_word_length", "symbol_ratio", "punctuated_lines", "common_words", "digit_ratio", "delimiter_alignment", "indent_periodicity", "length_autocorrelation",
    "words_per_line", "different_words", "upper_ratio", "repeated_lines", "longest_word", "vowel_ratio", "links", "tags", "n_lines", "sentence_words", "line_spread", "bullets",
]


def alignment(lines: list[str]) -> float:
    """Mean likeness of neighbouring lines in where their delimiters stand: 1 for the same two or more delimiters in the same numbers, else the
    share of columns, of delimiters and of what follows wide gaps, that both have."""
    if len(lines) < 2:
        return 0.0
    counts = [tuple(map(line.count, DELIMITERS)) for line in lines]
    total = 0.0
    columns: dict[int, set[int]] = {}
    for k in range(len(lines) - 1):
        if counts[k] == counts[k + 1] and sum(counts[k]) > 1:
            total += 1
            continue
        a, b = (columns[i] if i in columns else columns.setdefault(i, {m.end() for m in COLUMN.finditer(lines[i])}) for i in (k, k + 1))
        if a and b:
            total += len(a & b) / len(a | b)
    return total / (len(lines) - 1)


def periodicity(lines: list[str], steps: int = 4) -> float:
    """Greatest share of lines whose lead (blanks, bullet or numbering, figures alike) comes again so many lines on; words have no lead."""
    leads = ["" if line[:1].isalpha() else re.sub(r"\d+", "0", LEAD.match(line).group()) for line in lines]
    best = 0.0
    for step in range(1, min(steps, len(leads) - 1) + 1):
        pairs = len(leads) - step
        best = max(best, sum(a == b and a != "" for a, b in zip(leads, leads[step:], strict=False)) / pairs)
    return best


def autocorrelation(lengths: np.ndarray, lags: int = 4) -> float:
    """Greatest normalised autocorrelation of line lengths at lags up to four (and a third of the lines), which sees layouts of several lines too; 1
    for lines of one length."""
    n = len(lengths)
    if n < 2:
        return 0.0
    x = lengths - lengths.mean()
    power = float(np.dot(x, x))
    if power < 1e-9:
        return 1.0
    return max(float(np.dot(x[:-k], x[k:])) / power * n / (n - k) for k in range(1, max(1, min(lags, n // 3)) + 1))


def statistics(lines: list[str], common: set[str]) -> list[float]:
    """STATS of some non-blank lines."""
    if not lines:
        return [0.0] * len(STATS)
    text = "\n".join(lines)
    low = text.lower()
    words = WORD.findall(low)
    kind = KIND[np.minimum(points_of([text]), LIMIT)]
    n, chars = len(words), max(1, len(text) - text.count(" ") - text.count("\n"))
    letters = len("".join(words))
    digits, upper = int(np.count_nonzero(kind == FIGURE)), int(np.count_nonzero(kind == CAPITAL))
    per = np.array([len(x) for x in lines], dtype=float)
    ends = [x.rstrip(" \t\r\"'»”)")[-1:] in STOPS for x in lines]
    spoken = sum(len(x.split()) for x, e in zip(lines, ends, strict=True) if e)
    vowels = sum(map(low.count, "aeiouyäöüáéíóúàèìòùâêîôûãõåø"))
    mean = per.mean()
    return [
        n, letters / max(1, n), (chars - letters - digits) / chars, sum(ends) / len(lines), sum(map(common.__contains__, words)) / max(1, n), digits / chars,
        alignment(lines), periodicity(lines), autocorrelation(per),
        n / len(lines), len(set(words)) / max(1, n), upper / max(1, letters), 1 - len({x.strip() for x in lines}) / len(lines),
        max(map(len, words), default=0), vowels / max(1, letters), (text.count("http") + text.count("www.")) / len(lines), text.count("#") / len(lines), len(lines),
        spoken / max(1, n), float(np.sqrt(np.dot(per, per) / len(per) - mean * mean + 1e-9) / max(1, mean)), sum(x.lstrip()[:1] in "*•-–»>" for x in lines) / len(lines),
    ]


def common_words(lines: list[str], size: int = 300) -> set[str]:
    """Words that stand in most lines of prose."""
    counts = Counter(w for x in lines for w in {w.lower() for w in WORD.findall(x)})
    return {w for w, _ in counts.most_common(size)}


@dataclass
class Quality:
    common: set[str]
    trees: boosting.Trees

    def page_stats(self, pages: Pages, mark: np.ndarray, n_pages: int) -> np.ndarray:
        """STATS of the body of each page."""
        lines: list[list[str]] = [[] for _ in range(n_pages)]
        for text, p, m in zip(pages.text, pages.page, mark, strict=True):
            if not m:
                lines[p].append(text)
        return np.array([statistics(x, self.common) for x in lines]).reshape(n_pages, len(STATS))

    def no_prose(self, stats: np.ndarray) -> np.ndarray:
        """Probability that a body is no prose; 0 for an empty body."""
        return np.where(stats[:, STATS.index("n_lines")] > 0, self.trees.proba(stats), 0.0)


def train(texts: list[str], labels: list[list[str]], body: Boilerplate) -> Quality:
    from .spam import labelled_body

    lines, page, label = labelled_body(texts, labels, body)
    n = len(texts)
    label = np.array(label, dtype=object)
    bad = np.bincount(page, weights=np.isin(label, NO_PROSE), minlength=n) if len(lines) else np.zeros(n)
    good = np.bincount(page, weights=np.isin(label, PROSE), minlength=n) if len(lines) else np.zeros(n)
    share = bad / np.maximum(1, bad + good)
    common = common_words([x for x, p, q in zip(lines, page, label, strict=True) if share[p] < 0.5 and q == "clea"])
    per: list[list[str]] = [[] for _ in range(n)]
    for x, p in zip(lines, page, strict=True):
        per[p].append(x)
    stats = np.array([statistics(x, common) for x in per]).reshape(n, len(STATS))
    weight = np.where(bad + good > 0, np.abs(share - 0.5) * 2, 0)
    return Quality(common, boosting.fit(stats, (share > 0.5).astype(float), weight, trees=60, depth=4, share=0.8))


def text_statistics(df: DataFrame, model: Quality, body: Boilerplate, text: str = "text") -> DataFrame:
    """``df`` with ``stats`` of the whole text (nulls for a null text), ``no_prose`` (probability, of the body) and ``is_prose`` in its place."""
    shared = df.sparkSession.sparkContext.broadcast((model, body))

    def work():
        quality, marker = shared.value[0], Marker(shared.value[1])

        def each(texts: list[str | None]) -> list[list]:
            pages, mark = marker(texts)
            p = quality.no_prose(quality.page_stats(pages, mark, len(texts)))
            whole = quality.page_stats(pages, np.zeros(len(mark), dtype=bool), len(texts))
            has = [t is not None for t in texts]
            stats = [[float(x) for x in row] if h else None for row, h in zip(whole, has, strict=True)]
            columns = [[row[k] if row is not None else None for row in stats] for k in range(REPORTED)]
            return [*columns, p.tolist(), [bool(x <= 0.5) if h else None for x, h in zip(p, has, strict=True)]]

        return each

    names = ", ".join(f"{x} double" for x in STATS[:REPORTED])
    return annotate(df, work, f"{names}, no_prose double, is_prose boolean", text)


def junk_pages(df: DataFrame, model: Quality, body: Boilerplate, text: str = "text") -> DataFrame:
    """``df`` with ``no_prose`` alone in place of the text."""
    shared = df.sparkSession.sparkContext.broadcast((model, body))

    def work():
        quality, marker = shared.value[0], Marker(shared.value[1])
        return lambda texts: [quality.no_prose(quality.page_stats(*marker(texts), len(texts))).tolist()]

    return annotate(df, work, "no_prose double", text)
