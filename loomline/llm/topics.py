"""Subject areas of documents, by latent Dirichlet topic models.

The units of a document are the sentences, items and rows of its main body. A topic model is fitted over all documents by distributed
variational expectation-maximisation: tasks gather expected counts of their documents, one aggregation by word sums them, and a round of it
moves the topics. Topics start from a bounded sample of labelled documents, in which a document's words come from the topics of its labels or
from common ground; hand labels may be wrong or missing, so they only start the topics and never bind a document.

Topics are mapped to subjects through their top terms: a topic is given to the subject with whose labelled documents its top terms go, or to
none where they go with no subject in particular (``inspect`` lists the terms). A document treats a subject when the units that its topic
proportions and words give to that subject are at least a quarter of all its units: a unit goes to the topic of greatest posterior, which is
the document's proportion of the topic times the likelihood of the unit's words, against the document's common ground.

Null and empty texts, and texts without words, treat nothing. Repeated label rows count once. Null subjects mean none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, checkpointed
from .boilerplate import Boilerplate, Marker
from .pages import Bounded, annotate, run, sample_pages

#: Labelled documents that start the topics at most.
LABELLED = 6000
#: Words with a place of their own, and places that all other words share by hash, so that every word counts.
WORDS, SHARED = 30_000, 4096
#: Rounds over all documents end when the likelihood of their words rises by less than this part of it, at the latest after so many.
SETTLED, ROUNDS = 0.002, 20
#: Places met fewer times than this in all documents say nothing of topics.
LEAST = 3
#: A document is explained by topics of the languages that hold at least this part of its words.
PART = 0.05
#: Expected counts of a word in a topic that a task's documents leave below this are not sent on.
FAINT = 1e-3
#: Share of a topic that stays as labelled documents started it.
ANCHOR = 0.3
#: Languages in a smaller part of the labelled documents share topics with each other.
OWN = 0.02
SHARE = 0.25
#: Documents worked on at once; those of the same languages are one piece of numpy work.
CHUNK = 2048
#: Part of a unit's words that its topic is taken to give.
MIXED = 0.25
TOP = 60
WORD = re.compile(r"[^\W\d_]{2,}")
SENTENCE = re.compile(r"(?<=[.!?…])[\"'»”)]*\s+(?=[\"'«“(¿¡]*[^\W\d_a-zà-ÿ])")


def split_units(line: str) -> list[str]:
    """Sentences of a line; items and rows are one unit."""
    return [x for x in SENTENCE.split(line) if WORD.search(x)] if len(line) > 60 else ([line] if WORD.search(line) else [])


def units(df: DataFrame, body: Boilerplate, text: str = "text") -> DataFrame:
    """``df`` with ``units``, the words of each unit of the body with blanks between, in place of the text."""
    shared = df.sparkSession.sparkContext.broadcast(body)

    def work():
        marker, known = Marker(shared.value), Bounded(30_000)

        def cut(line: str) -> list[str]:
            if line not in known:
                known[line] = [" ".join(WORD.findall(x.lower())) for x in split_units(line)]
            return known[line]

        def each(texts: list[str | None]) -> list[list]:
            known.trim()
            pages, mark = marker(texts)
            out: list[list[str]] = [[] for _ in texts]
            for p, k in zip(pages.page[~mark].tolist(), np.flatnonzero(~mark), strict=True):
                out[p].extend(cut(pages.text[k]))
            return [out]

        return each

    return annotate(df, work, "units array<string>", text)


def vocabulary(docs: DataFrame, most: int = WORDS) -> list[str]:
    """The words that stand in most documents. Tasks count before the shuffle; ``most`` bounds what comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        give = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        for batch in batches:
            for page in batch.column(0).to_pylist():
                counts.update(set(" ".join(page).split()))
            if len(counts) > 300_000:
                yield give()
                counts.clear()
        if counts:
            yield give()

    rows = docs.select("units").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return sorted(r["word"] for r in rows.orderBy(F.desc("n"), "word").limit(most).collect())


@dataclass
class Coded:
    """Documents as places of words: all words one after another with the bounds of documents, sizes of all units with theirs."""

    word: np.ndarray
    bound: np.ndarray
    size: np.ndarray
    unit_bound: np.ndarray

    def __len__(self) -> int:
        return len(self.bound) - 1

    def part(self, i: int, j: int) -> Coded:
        j = min(j, len(self))
        return Coded(self.word[self.bound[i] : self.bound[j]], self.bound[i : j + 1] - self.bound[i], self.size[self.unit_bound[i] : self.unit_bound[j]], self.unit_bound[i : j + 1] - self.unit_bound[i])

    @classmethod
    def read(cls, batch: pa.RecordBatch) -> Coded:
        """From the columns ``ids`` and ``sizes``."""
        ids, sizes = batch.column("ids"), batch.column("sizes")
        ends = lambda x: np.r_[0, np.cumsum(pc.list_value_length(x).to_numpy(zero_copy_only=False))].astype(np.int64)
        return cls(ids.flatten().to_numpy().astype(np.int64), ends(ids), sizes.flatten().to_numpy().astype(np.int64), ends(sizes))


@dataclass
class Topics:
    """Topic-word probabilities (topics x words), the last topics being common ground, and the subject of each topic."""

    words: dict[str, int]
    beta: np.ndarray
    alpha: np.ndarray
    subjects: list[str | None]
    #: Likelihood of all words, in bits, before each round over all documents.
    history: list[float] = field(default_factory=list)
    #: Number of the language that each topic belongs to.
    block: np.ndarray | None = None
    _odds: tuple | None = None
    _of_word: np.ndarray | None = None

    def place(self, word: str) -> int:
        """A word's own place, or the one it shares by hash."""
        k = self.words.get(word)
        return k if k is not None else len(self.words) + crc32(word.encode()) % SHARED

    def coded(self, pages: list[list[str]]) -> Coded:
        split = [u.split() for page in pages for u in page]
        size = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        tokens = list(chain.from_iterable(split))
        word = np.fromiter(map(self.words.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
        for k in np.flatnonzero(word < 0):
            word[k] = self.place(tokens[k])
        unit_bound = np.r_[0, np.cumsum(np.fromiter(map(len, pages), dtype=np.int64, count=len(pages)))].astype(np.int64)
        return Coded(word, np.r_[0, np.cumsum(size)][unit_bound].astype(np.int64), size, unit_bound)

    def pairs(self, docs: Coded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, word, count) of all words."""
        width = self.beta.shape[1]
        key, n = np.unique(np.repeat(np.arange(len(docs)), np.diff(docs.bound)) * width + docs.word, return_counts=True)
        return key // width, key % width, n.astype(float)

    def parts(self, doc: np.ndarray, word: np.ndarray, n: np.ndarray, docs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(documents, their rows, topics): documents by the languages that hold at least PART of their words, with the topics of those."""
        if self.block is None or self.block.max() == 0:
            yield np.arange(docs), np.arange(len(doc)), np.arange(len(self.alpha))
            return
        languages = int(self.block.max()) + 1
        if self._of_word is None:
            grounds = np.stack([self.beta[self.block == j][-1] for j in range(languages)])
            self._of_word = grounds.argmax(axis=0)
        held = np.bincount(doc * languages + self._of_word[word], weights=n, minlength=docs * languages).reshape(docs, languages)
        uses = held >= np.maximum(PART * held.sum(axis=1, keepdims=True), 1e-9)
        uses[np.arange(docs), held.argmax(axis=1)] = True
        sets, of = np.unique(uses, axis=0, return_inverse=True)
        for k, some in enumerate(sets):
            own = np.flatnonzero(of == k)
            yield own, np.flatnonzero((of == k)[doc]), np.flatnonzero(some[self.block])

    def infer(self, docs: Coded, rounds: int = 6, allowed: np.ndarray | None = None) -> tuple[np.ndarray, list[tuple], float]:
        """Topic proportions of each document; (words, topics, count x responsibilities, a row a topic) of its parts; bits of all words.

        ``allowed`` bars topics of documents, and looks at all languages.
        """
        doc, word, n = self.pairs(docs)
        k = len(self.alpha)
        theta = np.zeros((len(docs), k), dtype=np.float32)
        theta[:] = self.alpha / self.alpha.sum()
        found, bits = [], 0.0
        parts = self.parts(doc, word, n, len(docs)) if allowed is None else [(np.arange(len(docs)), np.arange(len(doc)), np.arange(k))]
        for own, rows, topics in parts:
            if not len(rows):
                continue
            prior = (np.broadcast_to(self.alpha[topics], (len(own), len(topics))) * (1 if allowed is None else allowed)).astype(np.float32)
            share = prior / prior.sum(axis=1, keepdims=True)
            at, w, count = np.searchsorted(own, doc[rows]), word[rows], n[rows].astype(np.float32)
            # a row a topic, so that the words of a document lie together; its proportion of a topic is the same for all its words
            b = np.take(self.beta[topics], w, axis=1)
            begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            has, logs = at[begin], None
            for _ in range(rounds):
                mine = np.ascontiguousarray(share.T)
                r = np.take(mine, at, axis=1)
                r *= b
                logs = np.maximum(r.sum(axis=0), 1e-30)
                r *= count / logs
                gamma = prior.copy()
                gamma[has] += np.add.reduceat(r, begin, axis=1).T
                share = gamma / gamma.sum(axis=1, keepdims=True)
            theta[own] = 0
            theta[np.ix_(own, topics)] = share
            bits -= float((count * np.log2(logs)).sum())
            found.append((w, topics, r))
        return theta, found, bits

    def expected(self, docs: Coded, rounds: int = 6, allowed: np.ndarray | None = None, chunk: int = CHUNK) -> tuple[np.ndarray, float]:
        """Expected counts of each topic's words in some documents, a few documents at a time, and the bits of their words."""
        total, bits = np.zeros(self.beta.shape, dtype=np.float32), 0.0
        for i in range(0, len(docs), chunk):
            _, found, more = self.infer(docs.part(i, i + chunk), rounds, None if allowed is None else allowed[i : i + chunk])
            bits += more
            for word, topics, r in found:
                order = by_word(word, total.shape[1])
                first = np.flatnonzero(np.r_[True, np.diff(word[order]) > 0])
                total[np.ix_(topics, word[order][first])] += np.add.reduceat(np.take(r, order, axis=1), first, axis=1)
        return total, bits

    def odds(self) -> tuple[list[int], np.ndarray]:
        """(common grounds, log-odds by ground, word and topic): a unit on a topic mixes the topic's words with the ground's."""
        if self._odds is None:
            grounds = [j for j, s in enumerate(self.subjects) if s is None]
            mean = self.beta.mean(axis=0)
            base = [np.log(0.98 * self.beta[g] + 0.02 * mean) for g in grounds]
            self._odds = grounds, np.ascontiguousarray(np.stack([np.log(MIXED * self.beta + (1 - MIXED) * self.beta[g]) - b for g, b in zip(grounds, base, strict=True)]).astype(np.float32).transpose(0, 2, 1))
        return self._odds

    def shares(self, coded: Coded) -> np.ndarray:
        """Share of each document's units given to each topic.

        A unit's odds against the document's common ground, with the document's topic proportions as prior, decide.
        """
        theta, _, _ = self.infer(coded)
        grounds, logs = self.odds()
        docs = len(coded)
        out = np.zeros((docs, len(self.alpha)))
        size, word = coded.size, coded.word
        unit_doc = np.repeat(np.arange(docs), np.diff(coded.unit_bound))
        if not len(size) or not grounds:
            return out
        unit = np.repeat(np.arange(len(size)), size)
        main = theta[:, grounds].argmax(axis=1)
        used = theta > 0
        sets, of = np.unique(used, axis=0, return_inverse=True)
        for k, some in enumerate(sets):
            topics = np.flatnonzero(some)
            units = np.flatnonzero((of == k)[unit_doc])
            at = np.flatnonzero((of == k)[unit_doc][unit])
            if not len(units):
                continue
            local, w = np.searchsorted(units, unit[at]), word[at]
            rows = logs[main[unit_doc[unit[at]]][:, None], w[:, None], topics]
            score = np.zeros((len(units), len(topics)))
            if len(at):
                begin = np.flatnonzero(np.r_[True, local[1:] != local[:-1]])
                score[local[begin]] = np.add.reduceat(rows, begin, axis=0)
            owner = unit_doc[units]
            score += np.log(np.maximum(theta[np.ix_(owner, topics)], 1e-3)) - np.log(np.maximum(theta[:, grounds].sum(axis=1)[owner], 1e-2))[:, None]
            score[:, np.isin(topics, grounds)] = 0
            best = score.argmax(axis=1)
            hit = score[np.arange(len(units)), best] > 1.0
            np.add.at(out, (owner[hit], topics[best[hit]]), 1)
        return out / np.maximum(1, np.bincount(unit_doc, minlength=docs))[:, None]


def by_word(word: np.ndarray, width: int) -> np.ndarray:
    """The order of words by place, equal ones as they stood: numbers of 16 bits are sorted by digits."""
    return np.argsort(word.astype(np.uint16) if width <= 1 << 16 else word, kind="stable")


def smoothed(counts: np.ndarray, least: float = LEAST, eta: float = 0.002) -> np.ndarray:
    """Word probabilities of topics. What was met fewer than ``least`` times says nothing: it is as likely under all topics, whatever their size."""
    size, met = counts.sum(axis=1, keepdims=True), counts.sum(axis=0)
    even = size / max(float(size.sum()), 1e-30)
    beta = np.where(met < least - 1e-6, (met + 1e-6) * even, counts + eta)
    total = beta.sum(axis=1, keepdims=True)
    return np.where(total > 0, beta / np.maximum(total, 1e-30), 1 / counts.shape[1]).astype(np.float32)


def start(words: list[str], pages: list[list[str]], labels: list[set[str]], langs: list[str | None], subjects: list[str], rounds: int = 10) -> Topics:
    """Topics from labelled documents: one per subject and language, and one of common ground per language; rare languages count as one together.

    A subject's topic starts with the words that its documents hold beyond what their language lets expect; a document's words then come from
    the topics of its labels or from the grounds. Topics are apart by language because a word's weight would otherwise fall with the share of
    its language in the corpus.
    """
    index = {w: k for k, w in enumerate(words)}
    width = len(words) + SHARED
    often = Counter(x for x in langs if x)
    own = [x for x, n in often.items() if n >= OWN * sum(often.values())]
    rest = set(often) - set(own)
    main: list[str | None] = [*own, "other"] if rest else own or [None]
    n_s, n_l = len(subjects), len(main)
    k = n_l * (n_s + 1)
    alpha = np.r_[np.full(n_l * n_s, 0.1), np.full(n_l, 0.3)]
    # topics by language then subject, the grounds last
    model = Topics(index, np.full((k, width), 1.0 / width), alpha, [*subjects * n_l, *[None] * n_l], block=np.r_[np.repeat(np.arange(n_l), n_s), np.arange(n_l)])
    coded = model.coded(pages)
    doc, word, n = model.pairs(coded)
    allowed = np.zeros((len(pages), k))
    allowed[:, n_l * n_s :] = 1
    for d, some in enumerate(labels):
        for s in some:
            if s in subjects:
                allowed[d, subjects.index(s) : n_l * n_s : n_s] = 1
    if not len(doc):
        return model
    tokens = np.bincount(doc, weights=n, minlength=len(pages))
    of = np.array([own.index(x) if x in own else len(own) if x in rest else -1 for x in langs])
    counts = np.zeros((k, width))
    for j in range(n_l):
        at = of[doc] == j
        counts[n_l * n_s + j] = np.bincount(word[at], weights=n[at], minlength=width)
    ground = smoothed(counts[n_l * n_s :])
    for j in range(n_l):
        for i in range(n_s):
            mine = (allowed[:, j * n_s + i] > 0) & (of == j)
            at = mine[doc]
            counts[j * n_s + i] = np.maximum(0, np.bincount(word[at], weights=n[at], minlength=width) - 1.3 * tokens[mine].sum() * ground[j])
    model.beta = smoothed(counts, 1)
    for _ in range(rounds):
        model.beta = smoothed(model.expected(coded, 4, allowed)[0], 1e-3)
    return model


def refine(docs: DataFrame, model: Topics, rounds: int = ROUNDS, settled: float = SETTLED, anchor: float = ANCHOR) -> Topics:
    """Rounds of expectation-maximisation over all documents until the likelihood of their words settles.

    The topics that labelled documents started are the prior: a share ``anchor`` of each topic stays with its start, so that it goes on being
    about its subject. What comes to the driver in a round is a number per word and topic, bounded by the vocabulary.
    """
    k, begin, width = len(model.alpha), model.beta, model.beta.shape[1]
    history: list[float] = []
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            topics = shared.value
            total, bits = np.zeros(topics.beta.shape), 0.0
            for batch in batches:
                counts, more = topics.expected(Coded.read(batch))
                total += counts
                bits += more
            # only cells that got something; the bits of all words travel as cell -1
            at = np.flatnonzero(total.ravel() > FAINT)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1]), pa.array(np.r_[total.ravel()[at], bits])], names=["cell", "n"])

        summed = docs.select("ids", "sizes").mapInArrow(expect, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        cell, n = summed.column("cell").to_numpy(), summed.column("n").to_numpy()
        counts = np.zeros(k * width)
        counts[cell[cell >= 0]] = n[cell >= 0]
        history.append(float(n[cell < 0].sum()))
        beta = ((1 - anchor) * smoothed(counts.reshape(k, width)) + anchor * begin).astype(np.float32)
        model = Topics(model.words, beta, model.alpha, model.subjects, history, model.block)
        if history[-1] == 0 or len(history) > 1 and history[-2] - history[-1] < settled * history[-2]:
            break
    return model


def top_terms(model: Topics, n: int = TOP) -> list[list[str]]:
    """The terms of each topic that stand out most against all topics."""
    words = np.array(list(model.words), dtype=object)
    beta = model.beta[:, : len(words)]
    lift = beta * np.log(beta / np.maximum(beta.mean(axis=0), 1e-30))
    return [words[[k for k in np.argsort(-row, kind="stable")[:n] if row[k] > 0]].tolist() for row in lift]


def map_topics(model: Topics, pages: list[list[str]], labels: list[set[str]], subjects: list[str], n: int = TOP) -> Topics:
    """Gives each topic to the subject whose labelled documents hold its top terms most above the others, or to none."""
    holds = np.zeros((len(subjects), max(1, len(model.words))))
    docs = np.zeros(len(subjects))
    for page, some in zip(pages, labels, strict=True):
        at = [model.words[w] for w in set(" ".join(page).split()) if w in model.words]
        for s in some:
            if s in subjects:
                holds[subjects.index(s), at] += 1
                docs[subjects.index(s)] += 1
    rate = (holds + 0.1) / (docs[:, None] + 1)
    rate /= rate.sum(axis=0, keepdims=True)
    found: list[str | None] = []
    even = 1 / max(1, len(subjects))
    for terms in top_terms(model, n):
        mean = rate[:, [model.words[t] for t in terms]].mean(axis=1) if terms else np.zeros(len(subjects))
        best = int(mean.argmax()) if len(subjects) else 0
        found.append(subjects[best] if len(subjects) and mean[best] >= even + 0.22 * (1 - even) else None)
    if all(s is not None for s in found):
        found[-1] = None  # without any common ground a unit could not be on no subject
    return Topics(model.words, model.beta, model.alpha, found, model.history, model.block)


@dataclass
class Fitted:
    docs: DataFrame
    model: Topics


def fit(documents: DataFrame, labels: DataFrame, areas: DataFrame, body: Boilerplate, labelled: int = LABELLED) -> Fitted:
    """The topics of all documents, and the documents as places of words, written once to the checkpoint folder and used by every later pass."""
    docs = checkpointed(units(documents.select("doc_id", "lang", "text"), body))
    subjects = sorted(r[0] for r in areas.select("subject").where(F.col("subject").isNotNull()).distinct().collect())
    votes = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))
    both = docs.join(broadcast_if_small(votes), "doc_id")
    rows = sample_pages(both, ["units", "subjects", "lang"], labelled, votes.count(), key="doc_id")
    pages, given = [r["units"] for r in rows], [set(r["subjects"]) for r in rows]
    model = start(vocabulary(docs), pages, given, [r["lang"] for r in rows], subjects)
    places = checkpointed(encoded(docs.select("doc_id", "units"), model))
    return Fitted(places, map_topics(refine(places, model), pages, given, subjects))


def encoded(docs: DataFrame, model: Topics) -> DataFrame:
    """(doc_id, ids, sizes): the places of all words, and the words of each unit; passes over all documents then need no strings."""
    shared = docs.sparkSession.sparkContext.broadcast(Topics(model.words, model.beta[:, :0], model.alpha, model.subjects))

    def work() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        words = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = words.coded([page or [] for page in batch.column(1).to_pylist()])
            listed = lambda bound, values: pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(values.astype(np.int32)))
            return pa.RecordBatch.from_arrays([batch.column(0), listed(got.bound, got.word), listed(got.unit_bound, got.size)], names=["doc_id", "ids", "sizes"])

        return each

    return run(docs, work, "doc_id bigint, ids array<int>, sizes array<int>", rows=512)


def document_subjects(fitted: Fitted, least: float = SHARE) -> DataFrame:
    """(doc_id, subject, share) of each subject that at least ``least`` of the document's units treat."""
    shared = fitted.docs.sparkSession.sparkContext.broadcast(fitted.model)

    def work() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        model = shared.value
        subjects = sorted({s for s in model.subjects if s is not None})
        of = np.array([[s == t for t in model.subjects] for s in subjects], dtype=float).reshape(len(subjects), len(model.subjects))
        kind = pa.list_(pa.struct([("subject", pa.string()), ("share", pa.float64())]))

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            share = model.shares(Coded.read(batch)) @ of.T
            found = [[{"subject": subjects[j], "share": float(row[j])} for j in np.flatnonzero(row >= least - 1e-9)] for row in share]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, type=kind)], names=["doc_id", "found"])

        return each

    found = run(fitted.docs, work, "doc_id bigint, found array<struct<subject: string, share: double>>", rows=CHUNK)
    return found.select("doc_id", F.explode("found").alias("x")).select("doc_id", "x.subject", "x.share")


def inspect(fitted: Fitted, n: int = 15) -> DataFrame:
    """(topic, subject, terms): the top terms by which topics are mapped."""
    rows = [(k, s, " ".join(t)) for k, (s, t) in enumerate(zip(fitted.model.subjects, top_terms(fitted.model, n), strict=True))]
    return fitted.docs.sparkSession.createDataFrame(rows, "topic int, subject string, terms string")
