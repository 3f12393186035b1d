"""Languages of pages and of passages, by prediction by partial matching.

Each language has a variable-order byte model (contexts of up to ``ORDER`` bytes, escapes by method C) with frozen statistics: the code length
of a byte is that of its symbol in the longest context that saw it, plus the escapes on the way there. A line's code length under a language
is the sum over the bytes of its words; figures, marks, links and codes belong to no language and are left out, so that the rows of a table
are told by their words alone. The shortest code wins. Its confidence is the posterior under equal priors from code lengths per character,
sharpened as held-out lines want it. A line that no model codes shorter than letters drawn at random would be is no language.

Rows of code lengths of all windows seen in training are worked out once, when the model is fitted; tasks look windows up in one sorted table.

Trained from the line languages of a bounded sample of pages (``PAGES`` plain ones, about ``MORE`` for each further language). Labels are noisy,
and of rare languages mostly wrong: languages of at least ``MAIN`` of all pages are taken as given; lines labelled otherwise only count for
another language if those can't explain them and other such lines can.

Null and empty texts have no language. Without any labelled line to train on no text has one. Lines of fewer than ``WORDS`` words have none of their own.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boilerplate import PAGES, Boilerplate, Marker, folded, labelled, points_of
from .boilerplate import train as train_body
from .pages import annotate, share_of, uniform

ORDER = 5
WORDS = 5
#: Pages sampled for each language beside the main ones.
MORE = 600
#: Share of all pages from which on a language is taken as given; others must prove that they are no wrong labels.
MAIN = 0.02
#: Bytes of different lines that a language's model is made of at most: models of unequal text could not be compared.
BYTES = 250_000
#: Bits a character of letters drawn at random, and of the six that figures in base 16 have.
RANDOM, HEX = 4.7, 2.6
#: Bits a character under which a line of a rare language must be told by other lines of it.
EASY = 3.2
#: A passage must save so many bits over the page's language, as few lines are passages, beyond what held-out lines of that language ever
#: save under another: the share of them that may save more.
PRIOR, STRAY = 10.0, 0.001
#: Order of the models that know no phrases by heart.
LOW = 2
#: Bytes looked up at once.
CHUNK = 1 << 21
#: Bytes that make a word of letters: a vowel or a letter beyond ASCII; runs of consonants are no language.
VOWEL = np.array([chr(c) in "aeiouy" or c > 127 for c in range(256)])
#: Words of one consonant, by the languages that have them.
SHORT = {"ces_Latn": b"ksvz", "slk_Latn": b"ksvz", "pol_Latn": b"wz", "slv_Latn": b"hksvz", "hrv_Latn": b"ks", "bos_Latn": b"ks"}
HEXES = re.compile(rb"(?<= )[a-f]+(?= )")
MARKUP = re.compile(r"<[^<>]*>|&#?\w+;|https?://\S+|www\.\S+|\S+@\S+|[#@]\w+")
_DOT = r"(?:\.| ?[\[(] ?(?i:dot) ?[\])] ?| DOT )"
DISGUISED = re.compile(rf"[\w.+-]+(?: ?[\[(] ?(?i:at) ?[\])] ?| AT )[\w-]+(?:{_DOT}[\w-]+)+")
#: UTF-8 that was read as Windows-1252.
BROKEN = re.compile("[Â-ô][\x80-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸŒœŠšŽžƒˆ˜]{1,3}")


def _mended(match: re.Match) -> str:
    try:
        return b"".join(bytes([ord(c)]) if ord(c) < 256 else c.encode("cp1252") for c in match.group()).decode()
    except UnicodeError:
        return match.group()


def plain(line: str) -> str:
    """Without tags, entities, links and addresses, which belong to no language, and with its encoding mended."""
    if "Ã" in line or "â€" in line or "Ð" in line or "Ñ" in line:
        line = BROKEN.sub(_mended, line)
    if "[" in line or "(" in line or " AT " in line:
        line = DISGUISED.sub(" ", line)
    return MARKUP.sub(" ", line) if "<" in line or "&" in line or "@" in line or "#" in line or "http" in line or "www." in line else line


def prepared(line: str) -> bytes:
    """The words of a line in lower case with single blanks around them; what holds a figure is no word."""
    return coded(folded(points_of([plain(line).replace("\n", " ")]))[0])


def coded(key: str) -> bytes:
    """The same of a line as folded."""
    some = key.split()
    if "0" in key:
        some = [w for w in some if "0" not in w]
    return (" " + " ".join(some) + " ").encode()


def counts(lines: list[bytes]) -> np.ndarray:
    """Number of words of each prepared line."""
    if not lines:
        return np.zeros(0, dtype=np.int64)
    data = np.frombuffer(b"".join(lines), dtype=np.uint8)
    begin = np.flatnonzero((data[:-1] == 32) & (data[1:] != 32)) + 1
    if not len(begin):
        return np.zeros(len(lines), dtype=np.int64)
    real = np.logical_or.reduceat(VOWEL[data], begin)
    ends = np.cumsum(np.fromiter(map(len, lines), dtype=np.int64, count=len(lines)))
    return np.bincount(np.searchsorted(ends, begin, side="right")[real], minlength=len(lines))


def words(line: bytes, lang: str | None = None) -> int:
    """Number of words of a prepared line in a language that may have words of one consonant, up to WORDS: more are not asked for."""
    short = SHORT.get(lang or "", b"")
    return min(WORDS, int(counts([line])[0]) + sum(len(w) == 1 and w in short for w in line.split()))


def noise(line: bytes) -> float:
    """Bits of a prepared line if its letters were drawn at random."""
    return RANDOM * (len(line) if line.isascii() else len(line.decode())) - (RANDOM - HEX) * sum(map(len, HEXES.findall(line)))


def windows(data: np.ndarray) -> np.ndarray:
    """For every byte the number made of it and the ORDER bytes before it."""
    out = np.zeros(len(data), dtype=np.uint64)
    for k in range(ORDER + 1):
        out[k:] |= data[: len(data) - k].astype(np.uint64) << np.uint64(8 * k)
    return out


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table; len(table) where there is none."""
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return np.where(table[at] == keys, at, len(table))


class Index:
    """Places of different keys, by open addressing: a lookup is one probe or a few for all keys together."""

    def __init__(self, keys: np.ndarray):
        self.bits, self.none = max(4, int(np.ceil(np.log2(4 * max(1, len(keys)))))), len(keys)
        self.keys, self.place = np.full(1 << self.bits, ~np.uint64(0)), np.full(1 << self.bits, len(keys), dtype=np.int64)
        at, todo = self.slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.place[at[todo]] == self.none]
            self.place[at[free]] = free  # of several for one slot the last stays
            self.keys[at[free]] = keys[self.place[at[free]]]
            todo = todo[self.place[at[todo]] != todo]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys; the number of keys where there is none."""
        at = self.slot(keys)
        out = self.place[at]
        open_ = np.flatnonzero((self.keys[at] != keys) & (out != self.none))
        out[open_] = self.none
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            got, place = self.keys[at[open_]], self.place[at[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = place[hit]
            open_ = open_[~hit & (place != self.none)]
        return out


@dataclass
class Languages:
    """Frozen statistics of all languages: by order the grams with counts, and the contexts with totals and numbers of symbols."""

    names: list[str]
    grams: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    hit: list[np.ndarray]
    escape: list[np.ndarray]
    #: Bits by the root of the characters that held-out lines of a language (row) hardly ever save under another one (column).
    stray: np.ndarray | None = None
    #: Models of the same languages that know no phrases by heart.
    low: Languages | None = None
    #: Windows seen in training with their rows of code lengths.
    known: Index | None = None
    rows: np.ndarray | None = None
    #: By which code lengths per character are sharpened.
    sharpness: float = 12.0

    @classmethod
    def fit(cls, texts: dict[str, list[bytes]], order: int = ORDER) -> Languages:
        names = sorted(texts)
        grams, counts, contexts, hit, escape = [], [], [], [], []
        seen = []
        for name in names:
            data = np.frombuffer(b"\n" * ORDER + b"\n".join(texts[name])[:BYTES], dtype=np.uint8)
            seen.append(windows(data)[ORDER:])
        for k in range(order + 1):
            mask = np.uint64((1 << (8 * (k + 1))) - 1)
            per = [np.unique(w & mask, return_counts=True) for w in seen]
            keys = np.unique(np.concatenate([p[0] for p in per]))
            c = np.zeros((len(keys) + 1, len(names)), dtype=np.float32)
            for j, (u, n) in enumerate(per):
                c[np.searchsorted(keys, u), j] = n
            ctx, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(ctx) + 1, len(names)), dtype=np.float32), np.zeros((len(ctx) + 1, len(names)), dtype=np.float32)
            np.add.at(total, at, c[:-1])
            np.add.at(kinds, at, (c[:-1] > 0).astype(np.float32))
            grams.append(keys)
            counts.append(np.where(c > 0, np.log2(np.maximum(c, 1)), -1).astype(np.float32))
            contexts.append(ctx)
            hit.append(np.where(total > 0, np.log2(np.maximum(total + kinds, 1)), 0).astype(np.float32))
            escape.append(np.where(total > 0, np.log2(np.maximum(total + kinds, 1)) - np.log2(np.maximum(kinds, 1)), 0).astype(np.float32))
        return cls(names, grams, counts, contexts, hit, escape)

    def codes(self, w: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each window under each language."""
        bits = np.zeros((len(w), len(self.names)), dtype=np.float32)
        open_ = np.ones(bits.shape, dtype=bool)
        for k in range(len(self.grams) - 1, -1, -1):
            key = w & np.uint64((1 << (8 * (k + 1))) - 1)
            count = self.counts[k][find(self.grams[k], key)]
            at = find(self.contexts[k], key >> np.uint64(8))
            met = count >= 0
            bits += np.where(open_, np.where(met, self.hit[k][at] - count, self.escape[k][at]), 0)
            open_ &= ~met
        return bits + np.where(open_, np.float32(8), np.float32(0))

    def settled(self) -> Languages:
        """With the code lengths of all windows of training worked out."""
        self.known, self.rows = Index(self.grams[-1]), self.codes(self.grams[-1])
        return self

    def lengths(self, lines: list[bytes]) -> np.ndarray:
        """Bits of each line under each language."""
        out = np.zeros((len(lines), len(self.names)), dtype=np.float32)
        size = np.array([len(x) for x in lines], dtype=np.int64)
        ends = np.cumsum(size + ORDER)
        k = 0
        while k < len(lines):
            j = max(k + 1, int(np.searchsorted(ends, ends[k] - size[k] + CHUNK, side="right")))
            out[k:j] = self._lengths(lines[k:j], size[k:j])
            k = j
        return out

    def _lengths(self, lines: list[bytes], size: np.ndarray) -> np.ndarray:
        # every line starts in the same context, so its code does not depend on what stands before
        frame = b"\n" * ORDER
        data = np.frombuffer(frame + frame.join(lines), dtype=np.uint8)
        ends = np.cumsum(size + ORDER)
        starts = ends - size
        inside = np.zeros(len(data) + 1, dtype=np.int32)
        np.add.at(inside, starts, 1)
        np.add.at(inside, ends, -1)
        w = windows(data)[np.cumsum(inside)[:-1] > 0]
        if self.known is not None:
            at = self.known.find(w)
            new = np.flatnonzero(at == self.known.none)
            different, back = np.unique(w[new], return_inverse=True)
            at[new] = self.known.none + back
            codes = np.concatenate([self.rows, self.codes(different)])
        else:
            different, at = np.unique(w, return_inverse=True)
            codes = self.codes(different)
        out = np.zeros((len(lines), len(self.names)), dtype=np.float32)
        ends = np.cumsum(size)
        # some lines at a time: their rows of codes stay in the processor's cache
        k = 0
        while k < len(lines):
            base = ends[k] - size[k]
            j = max(k + 1, int(np.searchsorted(ends, base + 16_384, side="right")))
            starts = ends[k:j] - size[k:j] - base
            full = size[k:j] > 0
            if full.any():
                out[k:j][full] = np.add.reduceat(codes[at[base : ends[j - 1]]], starts[full], axis=0)
            k = j
        return out


def posterior(bits_per_char: np.ndarray, sharpness: float) -> np.ndarray:
    """Posterior of each language from bits per character."""
    z = -sharpness * (bits_per_char - bits_per_char.min(axis=-1, keepdims=True))
    e = np.exp2(z)
    return e / e.sum(axis=-1, keepdims=True)


def held_out(texts: dict[str, list[bytes]]) -> tuple[np.ndarray, float]:
    """``Languages.stray`` and ``sharpness``, each half of every language's lines held out from the models of the other half."""
    names = sorted(texts)
    out = np.zeros((len(names), len(names)), dtype=np.float32)
    saved: list[list[np.ndarray]] = [[] for _ in names]
    per: list[np.ndarray] = []
    truth: list[int] = []
    for h in (0, 1):
        model = Languages.fit({x: texts[x][1 - h :: 2] for x in names})
        for i, x in enumerate(names):
            held = texts[x][h::2]
            size = np.array([max(1, len(c.decode())) for c in held])
            bits = model.lengths(held)
            saved[i].append((bits[:, i : i + 1] - bits) / np.sqrt(size)[:, None])
            per.append(bits / size[:, None])
            truth += [i] * len(held)
    for i, some in enumerate(saved):
        every = np.concatenate(some)
        if len(every):
            out[i] = np.maximum(0, np.quantile(every, 1 - STRAY, axis=0))
    every, at = np.concatenate(per), np.array(truth)
    # the sharpness under which held-out lines are likeliest
    loss = lambda k: -np.log(np.maximum(posterior(every, k)[np.arange(len(at)), at], 1e-12)).mean()
    return out, float(min((1, 1.5, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48), key=loss))


def train(pages: list[tuple[str, list[str] | None, str | None]], more: list[tuple[str, list[str] | None]] = (), main: list[str] | None = None) -> Languages:
    """Fits from (text, line languages, document language) of a plain sample of pages, and ``more`` pages chosen for their rare languages.

    The ``main`` languages (by default those of at least MAIN of the plain sample) come first, then those left over.
    """
    votes: dict[bytes, Counter] = {}
    own: dict[str, int] = {}
    whole: list[tuple[str, list[bytes]]] = []
    for text, langs, document in pages:
        if document:
            own[document] = own.get(document, 0) + 1
        wordy = [(c, lang) for c, lang in ((prepared(x), lang) for x, lang in zip(text.split("\n"), langs or [None] * (text.count("\n") + 1), strict=False)) if words(c) >= WORDS]
        whole.append((document or "und", [x for x, _ in wordy]))
        for x, lang in wordy:
            votes.setdefault(x, Counter())[lang or "und"] += 1
    own.pop("und", None)
    main = [x for x in own if own[x] >= MAIN * sum(own.values())] if main is None else main
    for text, langs in more:
        for line, lang in zip(text.split("\n"), langs or (), strict=False):
            if lang and words(c := prepared(line), lang) >= WORDS:
                votes.setdefault(c, Counter())[lang] += 1
    texts = cleaned([(d, some) for d, some in whole if some], main)
    if not texts:
        return Languages.fit({"und": [b" "]}).settled()
    base = Languages.fit(texts)
    # Lines labelled with a rare language are mostly mislabelled ones of the main languages, or belong to no language at all. Those that are
    # its own are hard for the main languages and easy for a model made of other such lines: each half is judged by the other one.
    rare: dict[str, list[bytes]] = {}
    lines: dict[str, list[bytes]] = {}
    for x in sorted(votes):
        lines.setdefault(votes[x].most_common(1)[0][0], []).append(x)
    for lang in sorted(lines):
        if lang in main or lang == "und":
            continue
        coded = lines[lang]
        size = np.maximum(1, [len(c.decode()) for c in coded])
        hard = base.lengths(coded).min(axis=1) / size
        coded = [c for c, h in zip(coded, hard, strict=True) if h > 2.5]
        hard = hard[hard > 2.5]
        if len(coded) >= 4:
            # nor may a model without phrases take them for a main language
            low = Languages.fit(texts | {lang: coded}, order=LOW)
            bits = low.lengths(coded)
            keep = bits.argmin(axis=1) == low.names.index(lang)
            coded, hard = [c for c, k in zip(coded, keep, strict=True) if k], hard[keep]
        for _ in range(2):
            if len(coded) < 4:
                break
            size = np.array([len(c.decode()) for c in coded])
            per = np.zeros(len(coded))
            for h in (0, 1):
                other = Languages.fit({lang: coded[1 - h :: 2]})
                per[h::2] = other.lengths(coded[h::2])[:, 0] / size[h::2]
            keep = (per < hard - 1) & (per < EASY)
            coded, hard = [c for c, k in zip(coded, keep, strict=True) if k], hard[keep]
        if len(coded) >= 4:
            rare[lang] = coded
    every = texts | rare
    low = Languages.fit(every, order=LOW)
    # lines of rare languages were not known when the others were cleaned
    for j, lang in enumerate(low.names):
        per = low.lengths(every[lang]) / np.array([max(1, len(c.decode())) for c in every[lang]])[:, None]
        own = [c for c, k in zip(every[lang], per[:, j] < per.min(axis=1) + (0.7 if lang in texts else 0.0001), strict=True) if k]
        every[lang] = own or every[lang]
    model = Languages.fit(every)
    model.low = Languages.fit(every, order=LOW)
    model.stray, model.sharpness = held_out(every)
    return model.settled()


def cleaned(pages: list[tuple[str, list[bytes]]], main: list[str], rounds: int = 3) -> dict[str, list[bytes]]:
    """Lines by language, from pages whose language may be wrong and that may hold passages in another one.

    Each page goes as a whole to the language whose low-order model codes it shortest: a high-order model would know the phrases of wrongly
    labelled pages by heart, one of short contexts, which all languages share, gives them the weight of the few they are. Lines much shorter
    under another language are left out.
    """
    names = [d for d, _ in pages]
    texts: dict[str, list[bytes]] = {}
    every = sorted({x for _, some in pages for x in some})
    size = np.array([len(x.decode()) for x in every])
    number = {x: k for k, x in enumerate(every)}
    at = [np.array([number[x] for x in some]) for _, some in pages]
    for _ in range(rounds):
        texts = {m: [] for m in main}
        for name, k in zip(names, at, strict=True):
            if name in texts:
                texts[name].extend(every[i] for i in k)
        texts = {m: bounded(some) for m, some in texts.items() if some}
        if not texts:
            return {}
        model = Languages.fit(texts, order=2)
        bits = model.lengths(every)
        names = [model.names[int(bits[k].sum(axis=0).argmin())] for k in at]
    per = bits / size[:, None]
    out: dict[str, list[bytes]] = {}
    for name, k in zip(names, at, strict=True):
        own = per[k, model.names.index(name)]
        out.setdefault(name, []).extend(every[i] for i in k[own < per[k].min(axis=1) + 0.7])
    return {m: bounded(some) for m, some in out.items() if some}


def bounded(lines: list[bytes]) -> list[bytes]:
    """Different lines up to BYTES: those of several pages first, the others evenly out of all of them."""
    counts = Counter(lines)
    often = [x for x, n in counts.most_common() if n > 1]
    taken = np.searchsorted(np.cumsum([len(x) for x in often]), BYTES // 2) if often else 0
    rest = sorted(counts.keys() - set(often[:taken]))
    return often[:taken] + rest[:: max(1, -(-sum(map(len, rest)) // (BYTES // 2)))]


def fit(df: DataFrame, rows: int = PAGES, more: int = MORE) -> tuple[Languages, Boilerplate]:
    """Languages and the model of the main body, from one sample.

    One pass over the language columns counts pages by language; one over the sampled rows takes a plain sample, and of every language that
    is no main one about ``more`` pages with lines labelled so, or all there are.
    """
    entries = F.concat(F.array(F.concat(F.lit("d"), F.coalesce("document_lang", F.lit("")))), F.transform(F.array_distinct(F.filter("langs", lambda x: x.isNotNull())), lambda x: F.concat(F.lit("l"), x)))
    counts = {r["k"]: r["count"] for r in df.select(F.explode(F.coalesce(entries, F.array(F.lit("d")))).alias("k")).groupBy("k").count().collect()}
    own = {k[1:]: n for k, n in counts.items() if k[0] == "d"}
    total = sum(own.values())
    known = {k: n for k, n in own.items() if k not in ("", "und")}
    main = [x for x, n in known.items() if n >= MAIN * sum(known.values())]
    shares = {k[1:]: min(1.0, more / n) for k, n in counts.items() if k[0] == "l" and k[1:] not in (*main, "und")}
    wanted = F.lit(0.0)
    if shares:
        table = F.create_map(*(F.lit(x) for pair in sorted(shares.items()) for x in pair))
        wanted = F.coalesce(F.array_max(F.transform("langs", lambda x: F.coalesce(F.element_at(table, x), F.lit(0.0)))), F.lit(0.0))
    some = df.where(F.col("text").isNotNull()).select("text", "langs", "document_lang", "line_quality_labels", (uniform("id", "text", seed=7) < share_of(rows, total)).alias("plain"), (uniform("id", "text", seed=11) < wanted).alias("rare"))
    taken = sorted(some.where("plain or rare").collect(), key=lambda r: r["text"])
    pages = {r["text"]: (r["text"], r["langs"], r["document_lang"]) for r in taken if r["plain"]}
    odd = {r["text"]: (r["text"], r["langs"]) for r in taken if r["rare"]}
    body = train_body(*labelled((r["text"], r["line_quality_labels"]) for r in taken if r["plain"]))
    return train(list(pages.values()), list(odd.values()), main), body


class Teller:
    """Languages of pages and their lines."""

    def __init__(self, model: Languages, body: Boilerplate):
        self.model, self.marker = model, Marker(body)

    def __call__(self, texts: list[str | None]) -> list[list[tuple[int, str, float]]]:
        """(line, language, confidence) per page: line -1 for the main language of the body, then lines in another one."""
        pages, mark = self.marker(texts)
        out: list[list[tuple[int, str, float]]] = [[] for _ in texts]
        n = len(pages.text)
        if not n:
            return out
        number: dict[str, int] = {}
        keys, odd = pages.lines.keys, pages.lines.odd.tolist()
        at = np.fromiter((number.setdefault(x if o else k, len(number)) for x, k, o in zip(pages.text, keys, odd, strict=True)), dtype=np.int64, count=n)
        first = np.zeros(len(number), dtype=np.int64)
        first[at[::-1]] = np.arange(n)[::-1]
        lines = [prepared(x) if odd[k] else coded(x) for x, k in zip(number, first.tolist(), strict=True)]
        of_words = counts(lines)
        worded = np.flatnonzero(of_words)
        code = np.zeros((len(lines), len(self.model.names)), dtype=np.float32)
        code[worded] = self.model.lengths([lines[k] for k in worded])
        chars = np.array([max(1, len(x) if x.isascii() else len(x.decode())) for x in lines])
        short = code.min(axis=1)
        language = of_words > 0
        # only lines that are coded at some length can be letters at random
        for k in np.flatnonzero(language & (short > HEX * chars)):
            language[k] = short[k] < noise(lines[k])
        bits, size, count, natural = code[at], chars[at], of_words[at], language[at]
        per = bits / size[:, None]
        best = per.argmin(axis=1)
        for j in [j for j, x in enumerate(self.model.names) if x in SHORT]:
            for k in np.flatnonzero((best == j) & (count > 0) & (count < WORDS)):
                count[k] = words(lines[at[k]], self.model.names[j])
        start = np.flatnonzero(np.r_[True, pages.page[1:] != pages.page[:-1]])
        use = natural & ~mark
        sums = np.add.reduceat(np.where(use[:, None], bits, 0), start)
        chars = np.add.reduceat(np.where(use, size, 0), start)
        total = np.add.reduceat(np.where(use, count, 0), start)
        # a page without a body of its own is told by all its lines, to judge passages by
        every = np.add.reduceat(np.where(natural[:, None], bits, 0), start)
        main = np.where(total > 0, sums.argmin(axis=1), every.argmin(axis=1))
        sure = posterior(sums / np.maximum(1, chars)[:, None], self.model.sharpness)
        which = np.repeat(np.arange(len(start)), np.diff(np.r_[start, n]))
        for k in np.flatnonzero(total >= WORDS):
            out[pages.page[start[k]]].append((-1, self.model.names[main[k]], float(sure[k, main[k]])))
        row = np.arange(n)
        saved = bits[row, main[which]] - bits[row, best]
        stray = 0 if self.model.stray is None else self.model.stray[main[which], best]
        other = natural & (count >= WORDS) & (best != main[which]) & (saved > PRIOR + stray * np.sqrt(size))
        if self.model.low is not None:
            # a phrase known by heart from a wrongly labelled page is not enough
            some = np.flatnonzero(other)
            low = self.model.low.lengths([lines[at[k]] for k in some])
            each = np.arange(len(some))
            other[some] = low[each, best[some]] < low[each, main[which[some]]]
        told = posterior(per, self.model.sharpness)
        for k in np.flatnonzero(other):
            out[pages.page[k]].append((int(pages.no[k]), self.model.names[best[k]], float(told[k, best[k]])))
        return out


def languages(df: DataFrame, model: Languages, body: Boilerplate, text: str = "text") -> DataFrame:
    """``df`` with ``languages``, an array of (line_no, lang, confidence), in place of the text; empty for null and blank texts."""
    shared = df.sparkSession.sparkContext.broadcast((model, body))

    def work():
        teller = Teller(*shared.value)
        return lambda texts: [[[{"line_no": i, "lang": x, "confidence": c} for i, x, c in page] for page in teller(texts)]]

    return annotate(df, work, "languages array<struct<line_no: int, lang: string, confidence: double>>", text, rows=1024)
