"""Byte-pair encoding of whole texts with a public vocabulary, in numpy.

A text is cut by the vocabulary's pattern; different pieces of a batch that are no tokens themselves become rows of padded byte matrices,
bucketed by length. Each round every row merges its leftmost pair of least rank, found by a hash table of pairs, and closes the gap; rows
without a mergeable pair leave. In long rows all places of the least pair merge in one round, which comes to the same: a new token's own
pairs always have a higher rank.

Null and empty texts have no tokens: an empty list. Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

TOKENIZERS = "/opt/tokenizers"
# Fixed value: how byte-level vocabularies of this family cut a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same cuts for the quicker standard engine, right for texts of these characters only: it has no letter and number classes.
SIMPLE = re.compile("[\t-\r -~¡-§«®°±·»¿À-ÖØ-öø-ɏА-яЁё–—‘’“”„•…€]*")
SIMPLE_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Rows of more bytes merge all places of a pair at once.
LONG = 256
#: Different pieces a worker remembers before it starts afresh.
CACHE = 400_000
MISSING = np.int32(1 << 30)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class PairTable:
    """An open-addressing hash table from a pair of ids to the id of their join; the id is the rank."""

    keys: np.ndarray
    values: np.ndarray
    bits: int
    probes: int

    @classmethod
    def build(cls, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> PairTable:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        bits = max(4, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        slots, values = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF)), np.full(1 << bits, MISSING, dtype=np.int32)
        at, todo, probes = cls.slot(keys, bits), np.arange(len(keys)), 0
        while len(todo):
            probes += 1
            free = slots[at[todo]] == np.uint64(0xFFFFFFFFFFFFFFFF)
            first = todo[free]
            slots[at[first]] = keys[first]  # of several for one slot the last stays
            won = first[slots[at[first]] == keys[first]]
            values[at[won]] = joined[won]
            placed = np.zeros(len(keys), dtype=bool)
            placed[won] = True
            todo = todo[~placed[todo]]
            at[todo] = (at[todo] + 1) & ((1 << bits) - 1)
        return cls(slots, values, bits, probes)

    @staticmethod
    def slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, MISSING where there is none."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = self.slot(keys, self.bits)
        found = self.keys[at] == keys
        out = np.where(found, self.values[at], MISSING)
        open_ = np.flatnonzero(~found & (self.keys[at] != np.uint64(0xFFFFFFFFFFFFFFFF)))
        flat, flat_keys, flat_at = out.reshape(-1), keys.reshape(-1), at.reshape(-1)
        if out.ndim > 1:
            miss = (~found & (self.keys[at] != np.uint64(0xFFFFFFFFFFFFFFFF))).reshape(-1)
            open_ = np.flatnonzero(miss)
        step = 0
        while len(open_):
            step += 1
            at_ = (flat_at[open_] + step) & ((1 << self.bits) - 1)
            got = self.keys[at_]
            hit = got == flat_keys[open_]
            flat[open_[hit]] = self.values[at_[hit]]
            open_ = open_[~hit & (got != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return flat.reshape(out.shape)


@dataclass
class Encoder:
    """A vocabulary with its pair table; picklable, some 15 MB for 50 thousand tokens."""

    ranks: dict[bytes, int]
    pairs: PairTable
    single: np.ndarray
    _known: dict[str, int] = field(default_factory=dict)
    _pool: tuple = ()

    @classmethod
    def load(cls, name: str, folder: str = TOKENIZERS) -> Encoder:
        ranks = {}
        with open(f"{folder}/{name}.tiktoken", "rb") as f:
            for line in f:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        left, right, joined = [], [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    joined.append(rank)
        single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        return cls(ranks, PairTable.build(np.array(left), np.array(right), np.array(joined, dtype=np.int32)), single)

    def merge_rows(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ids, padded, with their sizes, merged to the end."""
        ids, size = ids.copy(), size.copy()
        active = np.flatnonzero(size > 1)
        while len(active):
            width = int(size[active].max())
            m, n = ids[active, :width], size[active]
            cols = np.arange(width)
            rank = np.where(cols[None, 1:] < n[:, None], self.pairs.find(m[:, :-1], m[:, 1:]), MISSING)
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(active)), at]
            live = best < MISSING
            active, m, n, at, best = active[live], m[live], n[live], at[live], best[live]
            if not len(active):
                break
            # close the gap behind the merged pair
            source = np.minimum(cols[None, :] + (cols[None, :] > at[:, None]), width - 1)
            m = np.take_along_axis(m, source, axis=1)
            m[np.arange(len(active)), at] = best
            ids[active, :width] = m
            size[active] = n - 1
            active = active[size[active] > 1]
        return ids, size

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row: each round merges every place of its least pair, from the left."""
        while len(ids) > 1:
            rank = self.pairs.find(ids[:-1], ids[1:])
            best = rank.min()
            if best == MISSING:
                break
            at = np.flatnonzero(rank == best)
            # of a run of overlapping places every other one counts
            start = np.r_[True, np.diff(at) != 1]
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
            at = at[run % 2 == 0]
            ids = ids.copy()
            ids[at] = best
            ids = np.delete(ids, at + 1)
        return ids

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pieces)
        lengths = np.array([len(p) for p in pieces])
        whole = [self.ranks.get(p) for p in pieces]
        rest = []
        for i, rank in enumerate(whole):
            if rank is not None:
                out[i] = np.array([rank], dtype=np.int32)
            elif lengths[i] > LONG:
                out[i] = self.merge_long(self.single[np.frombuffer(pieces[i], dtype=np.uint8)])
            else:
                rest.append(i)
        rest = np.array(rest, dtype=int)
        if len(rest):
            bucket = np.ceil(np.log2(np.maximum(lengths[rest], 4))).astype(int)
            for b in np.unique(bucket):
                for part in np.array_split(rest[bucket == b], max(1, (int((bucket == b).sum()) << int(b)) >> 20)):
                    width = 1 << int(b)
                    padded = b"".join(pieces[i].ljust(width, b"\0") for i in part)
                    ids, size = self.merge_rows(self.single[np.frombuffer(padded, dtype=np.uint8).reshape(len(part), width)], lengths[part])
                    for row, n, i in zip(ids, size, part, strict=True):
                        out[i] = row[:n].copy()
        return out

    def learn(self, pieces: list[str]) -> None:
        """Encodes pieces not met before and adds them to the pool of ids."""
        begin, sizes, pool = self._pool if self._known else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32))
        encoded = self.encode_pieces([p.encode() for p in pieces])
        n = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        self._known.update(zip(pieces, range(len(begin), len(begin) + len(pieces)), strict=True))
        self._pool = (np.concatenate([begin, len(pool) + np.cumsum(n) - n]), np.concatenate([sizes, n]), np.concatenate([pool, *encoded]))

    def cut(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Of all pieces of the texts, one after another, the number in the pool; and how many pieces each text has."""
        if len(self._known) > CACHE:
            self._known.clear()
        find, quick = regex.compile(PATTERN).findall, SIMPLE_PATTERN.findall
        pieces = [(quick(t) if SIMPLE.fullmatch(t) else find(t)) if t else [] for t in texts]
        counts = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        flat = list(chain.from_iterable(pieces))
        if new := set(flat).difference(self._known):
            self.learn(list(new))
        return np.fromiter(map(self._known.__getitem__, flat), dtype=np.int64, count=len(flat)), counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of the texts)."""
        at, counts = self.cut(texts)
        if not len(at):
            return np.zeros(0, dtype=np.int32), np.zeros(len(counts) + 1, dtype=np.int64)
        begin, sizes, pool = self._pool
        n = sizes[at]
        ends = np.cumsum(n)
        ids = pool[np.repeat(begin[at] - (ends - n), n) + np.arange(int(ends[-1]))]
        return ids, np.r_[0, ends][np.r_[0, np.cumsum(counts)]]

    def count(self, texts: list[str | None]) -> np.ndarray:
        at, counts = self.cut(texts)
        n = np.r_[0, np.cumsum(self._pool[1][at] if len(at) else at)]
        return np.diff(n[np.r_[0, np.cumsum(counts)]])


def _broadcast(df: DataFrame, tokenizer: str, folder: str):
    encoder = Encoder.load(tokenizer, folder)
    return df.sparkSession.sparkContext.broadcast(encoder)


def token_ids(df: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of every row. The vocabulary, of fixed size, is read on the driver and broadcast."""
    from .pages import run, spread

    kind = dict(df.dtypes)[key]
    shared = _broadcast(df, tokenizer, folder)

    def work():
        encoder = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, offsets = encoder.encode(batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            return pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

        return each

    return run(spread(df.select(key, text)), work, f"{key} {kind}, ids array<int>")


def token_counts(df: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens) of every row."""
    from .pages import run, spread

    kind = dict(df.dtypes)[key]
    shared = _broadcast(df, tokenizer, folder)

    def work():
        encoder = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = encoder.count(batch.column(1).to_pylist())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n)], names=[key, "n_tokens"])

        return each

    return run(spread(df.select(key, text)), work, f"{key} {kind}, n_tokens bigint")
