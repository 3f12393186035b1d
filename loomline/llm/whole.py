"""The models of p2 fitted on all labelled pages, for tables that hold more of them than one process should: nothing is drawn, every different
labelled text counts, as in ``boilerplate.train`` and ``spam.train``, and what the driver gets are sums.

Rows are dealt out by text, so that a text repeated lies in one place: it is described once and trained on once (with its least labels that are
as many as its lines). Texts are read once (``reading``) and not kept. Tokens and trigrams are counted by key; thresholds are order statistics of
all prose pages. A tree sees the rows of one window, and the windows of all trees together lie over all rows, evenly, so that a pass over the rows
is enough for a model however many rows there are. A tree whose window lies in one part grows there, others level by level from sums over the
parts. Bins of features end at quantiles of all rows, of values cut to 16 bits.
"""

from __future__ import annotations

import ctypes
import math
import pickle
import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa

from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import boosting
from .boilerplate import POSITIVE, SKIPPED, TREES, Boilerplate, Pages, around, decode, node_features
from .ngram import BITS, CLASSES, FUNCTION_WORDS, Ngrams, Tokens, Vocabulary, grams
from .pages import Bounded
from .reading import LEAST, Keyed, Read, scattered
from .spam import NORMAL, OTHER, PROSE, SPAM, Spam, repeats, short

#: Rows of the table in a part, and parts at most: the sums of a window's parts come to the driver at once.
PART, PARTS = 3000, 960
#: Parts of pages that are one part when a page is a row of few numbers.
GATHERED = 64
#: Rows worked on at once.
BATCH = 1024
#: Lines up to which all are one part when trees grow.
LONE = 300_000
#: Rows that a tree sees at least, where its share of all rows allows it.
SEEN = 20_000
#: How hard blocks are squeezed on disk.
LEVEL = 3
KINDS = (PROSE, SPAM, OTHER)


def code_of(label: str | None) -> int:
    """Positive for the body model, of weight for it, and the kind of the line (0 is none), in bits."""
    q = short(label)
    kind = next((k for k, v in enumerate(KINDS, 1) if q in v), 0)
    return (q in POSITIVE) | (bool(label) and q not in SKIPPED) << 1 | kind << 2


def half_of(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) & 1


def hold_memory() -> None:
    """In a worker: memory of arrays freed is used again and not given back each time, which costs a quarter of the time of numpy work."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 30)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 256 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):
        pass  # no glibc


def mapped(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, list]]], schema: str | StructType) -> DataFrame:
    """``f`` gets batches of at most ``BATCH`` rows and gives columns."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = list(to_arrow_schema(kind))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory()
        small = (b.slice(k, BATCH) for b in batches for k in range(0, b.num_rows, BATCH))
        for columns in f(small):
            yield pa.RecordBatch.from_arrays([columns[c.name] if isinstance(columns[c.name], pa.Array) else pa.array(columns[c.name], type=c.type) for c in arrow], names=[c.name for c in arrow])

    return df.mapInArrow(each, kind)


def squeezed(data: bytes | np.ndarray) -> bytes:
    """Bytes as they lie on disk."""
    return pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True)


def pressed(made: object) -> bytes:
    """A thing as it lies on disk: its size, and its bytes squeezed."""
    data = pickle.dumps(made, protocol=5)
    return len(data).to_bytes(8, "little") + squeezed(data)


def opened(data: bytes | bytearray | pa.Buffer) -> object:
    view = memoryview(data)
    return pickle.loads(pa.decompress(view[8:], decompressed_size=int.from_bytes(view[:8], "little"), codec="zstd"))


def by_text(pages: DataFrame, parts: int) -> DataFrame:
    return pages.select("id", "ingest_ts", "text", "line_quality_labels").repartition(parts, "text").sortWithinPartitions("text", "line_quality_labels")


def once(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None], list[bytes | None]]]:
    """Batches of rows by text with their texts, and with the codes, a byte a line, of one labelled row of each text."""
    last = None
    for batch in batches:
        labels, text = batch.column("line_quality_labels"), batch.column("text").to_pylist()
        flat = labels.flatten().dictionary_encode()
        known = np.array([*map(code_of, flat.dictionary.to_pylist()), code_of(None)], dtype=np.uint8)
        data = known[flat.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)].tobytes()
        size = labels.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        codes, begin = [], 0
        for t, n in zip(text, size.tolist(), strict=True):
            made = None
            if t is not None and n >= 0 and t != last and n == t.count("\n") + 1:
                last = t
                made = data[begin : begin + n]
            begin += max(0, n)
            codes.append(made)
        yield batch, text, codes


def dealt(pages: DataFrame, parts: int) -> DataFrame:
    """``id``, ``ingest_ts`` and ``text`` of all rows, equal texts one after another, and ``codes``, a byte a line, of one labelled row of each text."""
    rows = by_text(pages, parts)

    def work(batches):
        for batch, _, codes in once(batches):
            yield {c: batch.column(c) for c in ("id", "ingest_ts", "text")} | {"codes": codes}

    return mapped(rows, work, rows.drop("line_quality_labels").schema.add("codes", "binary"))


#: A line without label.
NONE = 255


def described(rows: DataFrame) -> DataFrame:
    """``id``, ``ingest_ts`` and ``page`` of rows by text or as dealt, and once a batch, with its first row, what is read of its different texts
    (``made``). Where that was done already nothing is done again."""
    if "made" in rows.columns:
        return rows
    given_codes = "codes" in rows.columns

    def work(batches):
        cache = Bounded(100_000)
        each = ((b, b.column("text").to_pylist(), b.column("codes").to_pylist()) for b in batches) if given_codes else once(batches)
        for batch, text, codes in each:
            cache.trim()
            number = {t: k for k, t in enumerate(dict.fromkeys(text))}
            pages = Pages(list(number), partial(Read.describe, cache=cache))
            given: list[bytes | None] = [None] * len(number)
            for t, c in zip(text, codes, strict=True):
                if c is not None:
                    given[number[t]] = c
            labelled = np.array([c is not None for c in given])
            code, has = np.full(len(pages.page), NONE, dtype=np.uint8), labelled[pages.page]
            size = np.array([len(c or b"") for c in given])
            code[has] = np.frombuffer(b"".join(c or b"" for c in given), dtype=np.uint8)[(np.cumsum(size) - size)[pages.page[has]] + pages.no[has]]
            made = {
                "read": narrowed(pages.lines), "page": pages.page.astype(np.int32), "gap": pages.gap.astype(np.uint8), "codes": code, "pages": len(number),
                "half": np.array([half_of(t or "") for t in number], dtype=np.uint8), "labelled": labelled,
            }
            yield {"id": batch.column("id"), "ingest_ts": batch.column("ingest_ts"), "page": [number[t] for t in text], "made": [pressed(made), *[None] * (len(text) - 1)]}

    return mapped(rows, work, rows.select("id", "ingest_ts").schema.add("page", "integer").add("made", "binary"))


def narrowed(read: Read) -> Read:
    """In the least bytes, a row a feature."""
    read.numbers = np.ascontiguousarray(read.numbers.T.astype(np.float32))
    read.shape, read.same = read.shape.astype(np.uint8), read.same.astype(np.int32)
    read.words.ids, read.words.size = read.words.ids.astype(np.uint16 if len(read.words.names) < 1 << 16 else np.int32), read.words.size.astype(np.int32)
    if len(read.tokens.names) < 1 << 15:
        read.tokens.word = read.tokens.word.astype(np.int16)
    return read


def widened(read: Read) -> Read:
    read.numbers, read.shape = np.ascontiguousarray(read.numbers.T.astype(float)), read.shape.astype(np.int64)
    read.words.ids, read.words.size = read.words.ids.astype(np.int64), read.words.size.astype(np.int64)
    return read


def read_made(column: Iterable[bytes | None]) -> Iterator[dict]:
    return (opened(made) for made in column if made is not None)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    return (block for batch in batches for block in read_made(batch.column("made").to_pylist()))


def made(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("made").isNotNull()).select("made")


# Sums by key


#: Different keys that a task gathers before it gives them out.
GATHER = 2_000_000


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order with the sums of their rows."""
    keys, table = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[: len(keys)]
    return keys[begin], np.add.reduceat(table[order], begin, axis=0, dtype=np.int64) if len(keys) else table.astype(np.int64)


def tallied(rows: DataFrame, each: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]], least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """What ``each`` gives of the rows of a task, keys with their rows of counts, summed by key over all tasks: those of ``least`` or more, in order.

    Keys travel in slices as bytes; a slice is added up in one task.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def give(held: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, list]:
        keys, table = added(held)
        at = (scattered(keys.view(np.uint64)) >> np.uint64(32)).astype(np.int64) * slices >> 32
        order = np.argsort(at, kind="stable")
        bound = np.searchsorted(at[order], np.arange(slices + 1))
        parts = [(k, order[bound[k] : bound[k + 1]]) for k in np.flatnonzero(np.diff(bound)).tolist()]
        return {"slice": [k for k, _ in parts], "made": [pressed((keys[x], table[x])) for _, x in parts]}

    def count(batches):
        held, size = [], 0
        for found in each(batches):
            held.append(found)
            size += len(found[0])
            if size > GATHER:
                yield give(held)
                held, size = [], 0
        if held:
            yield give(held)

    def add(batches):
        held = [part for batch in batches for part in read_made(batch.column("made").to_pylist())]
        if held:
            keys, table = added(held)
            some = table.sum(axis=1) >= least
            yield {"made": [pressed((keys[some], table[some]))]}

    sliced = mapped(made(rows), count, "slice integer, made binary").repartition("slice")
    found = list(read_made(mapped(sliced.select("made"), add, "made binary").toArrow()["made"].to_pylist()))
    return added(found) if found else (np.zeros(0, dtype=np.int64), np.zeros((0, 1), dtype=np.int64))


# Tokens of the body model


def odds_of_all(rows: DataFrame) -> list[Keyed]:
    """Odds of tokens counted on all lines, on those outside the first half and on those outside the second."""

    def each(batches):
        for block in blocks_of(batches):
            codes = block["codes"]
            some = np.flatnonzero((codes != NONE) & (codes & 2 > 0))
            if len(some):
                yield widened(block["read"]).words.take(some).counts(2 * block["half"][block["page"][some]].astype(np.int64) + (codes[some] & 1))

    keys, table = tallied(described(rows), each, LEAST)
    every = Keyed.counted(keys.view(np.uint64), table if len(keys) else np.zeros((0, 4)), [(0, 1), (1,), (0,)])
    return [every.column(k) for k in range(3)]


# Bins, and trees from sums


def coded(x: np.ndarray) -> np.ndarray:
    """The upper 16 bits of numbers as 32-bit floats, in their order: a row a feature."""
    u = (np.nan_to_num(x.astype(np.float32)) + np.float32(0)).view(np.uint32)
    return np.ascontiguousarray((np.where(u >> 31, ~u, u | np.uint32(1 << 31)) >> 16).astype(np.uint16).T)


def decoded(codes: np.ndarray) -> np.ndarray:
    """The least number of each code."""
    u = codes.astype(np.uint32) << 16
    return np.where(u >> 31, u & np.uint32((1 << 31) - 1), ~u).astype(np.uint32).view(np.float32)


def packed(codes: np.ndarray) -> tuple[tuple[int, ...], bytes]:
    """Codes as they lie on disk: upper and lower bytes apart, which packs better."""
    return codes.shape, squeezed(np.ascontiguousarray(np.moveaxis(codes.view(np.uint8).reshape(*codes.shape, 2), -1, 0)))


def unpacked(shape: tuple[int, ...], data: bytes) -> np.ndarray:
    low, high = np.frombuffer(pa.decompress(data, decompressed_size=2 * math.prod(shape), codec="zstd"), dtype=np.uint8).reshape(2, *shape)
    return low | high.astype(np.uint16) << 8


def together(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.r_[a[0], b[0]], return_inverse=True)
    return keys, np.bincount(at, weights=np.r_[a[1], b[1]], minlength=len(keys)).astype(np.int64)


class Tally:
    """How often each code of each feature stands in some blocks."""

    def __init__(self):
        self.table: np.ndarray | None = None

    def add(self, codes: np.ndarray) -> None:
        if self.table is None:
            self.table = np.zeros((len(codes), 1 << 16), dtype=np.int64)
        for row, c in zip(self.table, codes, strict=True):
            row += np.bincount(c, minlength=1 << 16)

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.flatnonzero(self.table) if self.table is not None else np.zeros(0, dtype=np.int64)
        return keys, self.table.ravel()[keys] if len(keys) else keys


def begins(keys: np.ndarray, n: np.ndarray, bins: int = 48) -> list[np.ndarray]:
    """Codes of each feature where its bins begin: quantiles of all rows."""
    out = []
    for j in range(int(keys.max() >> 16) + 1 if len(keys) else 0):
        here = keys >> 16 == j
        total = np.cumsum(n[here])
        at = np.searchsorted(total, (np.linspace(0, 1, bins + 1)[1:-1] * (total[-1] - 1)).astype(np.int64), side="right")
        out.append(np.unique(keys[here][at] & 0xFFFF).astype(np.uint16))
    return out


def quantile_codes(blocks: RDD, of: Callable[[dict], np.ndarray], bins: int = 48) -> list[np.ndarray]:
    """Where the bins of each feature of blocks begin."""

    def count(part: Iterator[dict]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        tally = Tally()
        for block in part:
            tally.add(of(block))
        if tally.table is not None:
            yield tally.sparse()

    return begins(*blocks.mapPartitions(count).treeReduce(together), bins)


#: Blocks, what their models are to know of them (``class_sums``, flat), and after those of a task how often their codes stand.
BLOCKS = "made binary, sums array<double>, counts binary"


def counted_blocks(found: Iterator[tuple[dict, np.ndarray]]) -> Iterator[dict[str, list]]:
    tally = Tally()
    for block, codes in found:
        tally.add(codes)
        yield {"made": [pressed(block)], "sums": [class_sum(block).ravel().tolist()], "counts": [None]}
    if tally.table is not None:
        yield {"made": [None], "sums": [None], "counts": [pressed(tally.sparse())]}


def begins_of(blocks: DataFrame) -> list[np.ndarray]:
    return begins(*pickled(blocks.where(F.col("counts").isNotNull()).select("counts")).treeReduce(together))


def binned(codes: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(edges, codes, strict=True)]).astype(np.uint8)


#: In a worker: rows of the tree now grown with their gradients and curvatures, for its next levels, by block and model.
_KEPT: dict[object, object] = {}
KEPT = 1_000_000
#: Sums of gradients kept beside each other.
LANES = 4


def slopes(block: dict, models: list[boosting.Trees], tree: tuple[str, int], window: Callable[[dict], np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, gradients, curvatures) of each model in the tree's window."""
    if _KEPT.get("tree") != tree:
        _KEPT.clear()
        _KEPT.update(tree=tree, rows=0)
    if block["name"] in _KEPT:
        return _KEPT[block["name"]]
    out, seen = [], window(block)
    for model, weight in zip(models, block["weight"], strict=True):
        rows = np.flatnonzero(seen & (weight > 0))
        w, y = weight[rows], block["y"][rows]
        guess = 1 / (1 + np.exp(-model.raw(np.zeros((len(rows), 0)), dict(enumerate(block["bins"][:, rows])))))
        out.append((rows, w * (guess - y), w * guess * (1 - guess)))
    _KEPT["rows"] += sum(len(rows) for rows, _, _ in out)
    if _KEPT["rows"] <= KEPT:
        _KEPT[block["name"]] = out
    return out


def level_sums(part: Iterator[dict], models: list[boosting.Trees], grown: list[tuple[np.ndarray, np.ndarray]], fresh: list[np.ndarray], tree: tuple[str, int], level: int, window: Callable[[dict], np.ndarray], width: int) -> Iterator[np.ndarray]:
    """Gradients and curvatures of the rows of a window by model, feature, node and bin, in the nodes that are ``fresh``."""
    out, first, count = None, (1 << level) - 1, 1 << level
    for block in part:
        bins = block["bins"]
        if out is None:
            out = np.zeros((len(models), 2, len(bins), count, width))
        for m, ((rows, g, h), (f, c), some) in enumerate(zip(slopes(block, models, tree, window), grown, fresh, strict=True)):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(level):
                node = 2 * node + 1 + (bins[f[node], rows] > c[node])
            node -= first
            if not some.all():
                here = np.flatnonzero(some[node])
                rows, g, h, node = rows[here], g[here], h[here], node[here]
            if not len(rows):
                continue
            # rows one after another, which are often alike, are added in lanes of their own: a sum need not wait for the one before
            nodes = np.flatnonzero(some)
            cells = len(nodes) * width
            at = (np.cumsum(some) - 1)[node] * width + np.arange(len(rows)) % LANES * cells
            for j, b in enumerate(bins):
                slot = at + b[rows]
                for k, w in enumerate((g, h)):
                    out[m, k, j, nodes] += np.bincount(slot, weights=w, minlength=LANES * cells).reshape(LANES, len(nodes), width).sum(axis=0)
    if out is not None:
        yield out


def class_sum(block: dict) -> np.ndarray:
    """Rows, weight and positive weight of each model."""
    return np.array([[np.count_nonzero(w), w.sum(dtype=float), w.astype(float) @ block["y"]] for w in block["weight"]])


def windows(trees: int, share: float, rows: float) -> tuple[list[float], float]:
    """Where the windows of the trees begin, and their common width: one after another they are far apart, and all of them cover everything."""
    step = next(q for q in range(max(1, round(0.382 * trees)), trees + 2) if math.gcd(q, trees) == 1)
    return [k * step % trees / trees for k in range(trees)], min(1.0, max(1 / trees + 1e-6, min(share, SEEN / max(1.0, rows))))


def around_place(block: dict, start: float, share: float) -> np.ndarray:
    """Rows of a window."""
    return (block["place"] - start) % 1 < share


def in_slot(block: dict, slot: int, trees: int, parts: int) -> np.ndarray:
    """Rows of one of ``trees`` windows side by side, when one of the numbers divides the other: each row is in one window."""
    k, each = block["name"][0], max(1, trees // parts)
    if each == 1:
        return np.full(len(block["place"]), k * trees // parts == slot)
    return k * each + np.clip((block["place"] * parts - k) * each, 0, each - 1).astype(np.int64) == slot


def settle(level: int, total: np.ndarray, able: list[bool], grown: list[tuple[np.ndarray, np.ndarray]], leaves: list[np.ndarray], last: bool, rate: float, ridge: float) -> list[np.ndarray]:
    """The cuts of a level by the sums of its nodes; after the last one the leaves. Gives which nodes of the next level hold less than their siblings."""
    first, count, width = (1 << level) - 1, 1 << level, total.shape[-1]
    less = []
    for m, (gs, hs) in enumerate(total.transpose(0, 1, 3, 2, 4).cumsum(axis=4)):
        gt, ht = gs[:, :, -1:], hs[:, :, -1:]
        gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
        gain[(hs < 1) | (ht - hs < 1)] = -np.inf
        where, gains = gain.argmax(axis=2), gain.max(axis=2)
        best, nodes = gains.argmax(axis=1), np.arange(count)
        good = (gains[nodes, best] > 1e-6) & able[m]
        cut = np.where(good, where[nodes, best], width - 1)
        grown[m][0][first : first + count] = np.where(good, best, 0)
        grown[m][1][first : first + count] = np.where(good, cut, 255)
        left = 2 * hs[nodes, best, cut] < ht[nodes, best, 0]
        less.append(np.stack([left, ~left], axis=1).ravel())
        if last and able[m]:
            g, h = gs[nodes, best, cut], hs[nodes, best, cut]
            leaves[m][0::2] = -rate * g / (h + ridge)
            leaves[m][1::2] = -rate * (gt[nodes, 0, 0] - g) / (ht[nodes, 0, 0] - h + ridge)
    return less


def grow(sums: Callable[[int, list, list], list[np.ndarray]], able: list[bool], depth: int, rate: float, ridge: float) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[np.ndarray]]:
    """A tree of each model from the sums of its levels: features and cuts, and leaves. Of two siblings the smaller is summed; the other is what it leaves of
    the node above."""
    size = (1 << depth) - 1
    grown, leaves = [(np.zeros(size, int), np.full(size, 255)) for _ in able], [np.zeros(size + 1) for _ in able]
    fresh, above = [np.ones(1, dtype=bool) for _ in able], None
    for level in range(depth):
        found = sums(level, grown, fresh)
        if not found:
            break
        total = sum(found)
        for m, some in enumerate(fresh if level else ()):
            rest = np.flatnonzero(~some)
            total[m][:, :, rest] = above[m][:, :, rest >> 1] - total[m][:, :, rest ^ 1]
        above, fresh = total, settle(level, total, able, grown, leaves, level == depth - 1, rate, ridge)
    return grown, leaves


def grown_there(part: Iterator[dict], models: list[boosting.Trees], tree: tuple[str, int], window: Callable[[dict], np.ndarray], width: int, able: list[bool], depth: int, rate: float, ridge: float) -> Iterator[tuple]:
    """A tree of each model whose window lies in this part: its rows are read once."""
    blocks = []
    for block in part:
        rows = np.flatnonzero(window(block))
        if len(rows):
            blocks.append({c: block[c][..., rows] if len(rows) < len(block["y"]) else block[c] for c in ("bins", "y", "weight")})
    one = [{c: np.concatenate([b[c] for b in blocks], axis=-1) for c in blocks[0]} | {"name": None}] if blocks else []
    every = lambda block: np.ones(len(block["y"]), dtype=bool)
    yield grow(lambda level, grown, fresh: list(level_sums(iter(one), models, grown, fresh, tree, level, every, width)), able, depth, rate, ridge)


def fit_all(blocks: RDD, edges: list[np.ndarray], trees: int, depth: int = 5, rate: float = 0.15, ridge: float = 2.0, share: float = 0.35, sums: np.ndarray | None = None) -> list[boosting.Trees]:
    """Trees as of ``boosting.fit``, for as many models as the blocks have weights: each block has a row of bins for each feature, the labels, and the
    place of each row in 0..1, part by part. ``sums`` are those of all blocks, where they are known."""
    sums = blocks.map(class_sum).treeReduce(np.add) if sums is None else sums
    size, parts, width = (1 << depth) - 1, blocks.getNumPartitions(), 1 + max(map(len, edges))
    values = [decoded(e) for e in edges]
    models = []
    for _, w, p in sums:
        mean = float(np.clip(p / w if w > 0 else 0.5, 1e-3, 1 - 1e-3))
        models.append(boosting.Trees(values, np.zeros((0, size), int), np.zeros((0, size), int), np.zeros((0, size + 1)), float(np.log(mean / (1 - mean)))))
    able = [n >= 20 and 0 < p < w for n, w, p in sums]
    if not any(able):
        return models
    starts, share = windows(trees, share, sums[:, 0].max())
    apart = share <= 1 / trees + 1e-6 and (parts % trees == 0 or trees % parts == 0)
    name = uuid.uuid4().hex
    for tree, start in enumerate(starts):
        bare = [boosting.Trees([], m.feature, m.cut, m.leaf, m.base) for m in models]
        if apart:
            slot = round(start * trees)
            window: Callable[[dict], np.ndarray] = partial(in_slot, slot=slot, trees=trees, parts=parts)
            meant = list(range(slot * parts // trees, max(slot * parts // trees + 1, (slot + 1) * parts // trees)))
        else:
            window = partial(around_place, start=start, share=share)
            meant = [k for k in range(parts) if any(k / parts < a + share and (k + 1) / parts > a for a in (start, start - 1))]
        run = lambda f, meant=meant: blocks.context.runJob(blocks, f, meant)
        shared = {"models": bare, "tree": (name, tree), "window": window, "width": width}
        if len(meant) == 1:
            grown, leaves = run(partial(grown_there, able=able, depth=depth, rate=rate, ridge=ridge, **shared))[0]
        else:
            grown, leaves = grow(lambda level, grown, fresh, run=run, shared=shared: run(partial(level_sums, grown=grown, fresh=fresh, level=level, **shared)), able, depth, rate, ridge)
        for m, model in enumerate(models):
            if able[m]:
                model.feature, model.cut, model.leaf = np.vstack([model.feature, grown[m][0]]), np.vstack([model.cut, grown[m][1]]), np.vstack([model.leaf, leaves[m]])
    return models


def placed(blocks: RDD) -> RDD:
    """Blocks with their names and the places of their rows."""
    parts = blocks.getNumPartitions()

    def each(k: int, part: Iterator[dict]) -> Iterator[dict]:
        rng = np.random.default_rng(k)
        for n, block in enumerate(part):
            yield block | {"name": (k, n), "place": ((k + rng.random(len(block["y"]))) / parts).astype(np.float32)}

    return blocks.mapPartitionsWithIndex(each, preservesPartitioning=True)


def gathered(blocks: RDD, parts: int) -> RDD:
    """Blocks of few numbers in ``parts`` larger parts, a block each, rows in the order they had."""
    each = blocks.getNumPartitions()
    rows = blocks.mapPartitionsWithIndex(lambda k, part: ((k * parts // each, (k, n, block)) for n, block in enumerate(part)))

    def one(part: Iterator[tuple]) -> Iterator[dict]:
        found = [b for _, _, b in sorted((x for _, x in part), key=lambda x: x[:2])]
        if found:
            yield {c: np.concatenate([b[c] for b in found], axis=-1) for c in found[0]}

    return rows.partitionBy(parts, int).mapPartitions(one)


def pickled(df: DataFrame) -> RDD:
    return df.rdd.map(lambda r: opened(r[0]))


# The body model


def page_blocks(rows: DataFrame, odds: list[Keyed]) -> DataFrame:
    """Coded features of all labelled lines, by tokens counted on the other half."""
    shared = rows.sparkSession.sparkContext.broadcast(odds)

    def each(batches):
        for block in blocks_of(batches):
            page, has = block["page"], np.flatnonzero(block["codes"] != NONE)
            if not len(has):
                continue
            read, half, code = widened(block["read"]), block["half"][page], block["codes"][has]
            odd = np.zeros((len(page), 5))
            for h in (0, 1):
                some = has[half[has] == h]
                odd[some] = shared.value[h].told(read.words.take(some), np.zeros(len(some), dtype=np.int64))
            x, node = node_features(read, odd, page, block["gap"])
            w, half, codes = (code >> 1 & 1).astype(np.uint8), half[has], coded(x[has])
            out = {"codes": packed(codes), "y": (code & 1).astype(np.uint8), "weight": np.stack([w, w * (half != 0), w * (half != 1)]), "half": half.astype(np.uint8)}
            yield out | {"page": page[has].astype(np.int32), "block": node[has].astype(np.int32)}, codes

    return mapped(made(rows), lambda batches: counted_blocks(each(batches)), BLOCKS)


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    return (opened(block.as_buffer()) for batch in batches for block in batch.column("made"))


def without(block: dict, *names: str) -> dict:
    return {k: v for k, v in block.items() if k not in names}


def train_body(rows: DataFrame, trees: int = TREES) -> Boilerplate:
    """As ``boilerplate.train``, on all labelled pages."""
    rows = described(rows)
    odds = odds_of_all(rows)
    found = page_blocks(rows, odds[1:]).persist(StorageLevel.DISK_ONLY)
    sums = found.agg(*(F.sum(F.col("sums")[k]) for k in range(9))).first()
    if sums[0] is None:
        return Boilerplate(odds[0], *(boosting.fit(np.zeros((0, 1)), np.zeros(0)) for _ in range(2)))
    sums, edges = np.array(sums, dtype=float).reshape(3, 3), begins_of(found)
    few = made(found).coalesce(1) if sums[0, 0] <= LONE else made(found)

    def bins(batches):
        for b in read_blocks(batches):
            yield {"made": [pressed(without(b, "codes") | {"bins": binned(unpacked(*b["codes"]), edges)})]}

    blocks = mapped(few, bins, "made binary").persist(StorageLevel.DISK_ONLY)
    blocks.count()
    found.unpersist()
    first, *halves = fit_all(placed(pickled(blocks)), edges, trees // 2, sums=sums)

    def said(batches):
        for b in read_blocks(batches):
            p = np.zeros(len(b["y"]))
            for h, m in enumerate(halves):
                some = np.flatnonzero(b["half"] == h)
                p[some] = m.proba(np.zeros((len(some), 0)), dict(enumerate(b["bins"][:, some])))
            codes = coded(around(p, b["page"], b["block"]))
            yield without(b, "page", "block", "half") | {"more": codes, "weight": b["weight"][:1]}, codes

    both = mapped(blocks, lambda batches: counted_blocks(said(batches)), BLOCKS).persist(StorageLevel.DISK_ONLY)
    more = begins_of(both)
    blocks.unpersist()
    (second,) = fit_all(placed(pickled(made(both))).map(lambda b: without(b, "more") | {"bins": np.concatenate([b["bins"], binned(b["more"], more)])}), edges + more, trees, sums=sums[:1])
    both.unpersist()
    return Boilerplate(odds[0], first, second)


def marked(rows: DataFrame, model: Boilerplate) -> DataFrame:
    """What ``spoken`` gives of the ``bodies`` of described rows, halves by the words of the body's lines."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def each(packed: bytes | None) -> bytes | None:
        if packed is None:
            return None
        block = opened(packed)
        read, page, n = widened(block["read"]), block["page"], block["pages"]
        keep = np.zeros(0, dtype=np.int64)
        if len(page):
            model = shared.value
            x, node = node_features(read, model.odds.told(read.words, np.zeros(len(page), dtype=np.int64)), page, block["gap"])
            bins: dict[int, np.ndarray] = {}
            near = around(model.first.proba(x, bins), page, node)
            keep = np.flatnonzero(~decode(model.second.raw(np.concatenate([x, near], axis=1), bins), node))
        page, same, line = page[keep], read.same[keep].astype(np.int64), read.words.line[keep]
        v = 1 + int(same.max(initial=0))
        different = np.bincount(np.unique(page * v + same) // v, minlength=n)
        size = np.bincount(page, minlength=n)
        order = np.arange(len(page)) - (np.cumsum(size) - size)[page]
        total = np.r_[np.uint64(0), np.cumsum(scattered(line + order.astype(np.uint64)))]
        last = np.cumsum(size)
        half = (scattered(total[last] - total[last - size]) & np.uint64(1)).astype(np.int64)
        of = np.flatnonzero(block["labelled"])
        codes = block["codes"][keep].tobytes()
        made = {
            "tokens": read.tokens.take(keep), "page": page, "same": (size - different).astype(float), "pages": n,
            "of": of.astype(np.int32), "codes": [codes[last[k] - size[k] : last[k]] for k in of.tolist()], "half": half[of],
        }
        return pressed(made)

    def work(batches):
        for batch in batches:
            yield {c: batch.column(c) for c in ("id", "ingest_ts", "page")} | {"made": [each(x) for x in batch.column("made").to_pylist()]}

    return mapped(rows, work, rows.schema)


def bodies(rows: DataFrame, model: Boilerplate) -> DataFrame:
    """``id``, ``ingest_ts``, ``body`` (the lines of the body) and the codes of its lines. A text repeated is looked at once a batch."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            texts, codes = batch.column("text").to_pylist(), batch.column("codes").to_pylist()
            number = {t: k for k, t in enumerate(dict.fromkeys(texts))}
            pages = Pages(list(number))
            keep = np.flatnonzero(~shared.value.mark(pages))
            line, no = [[] for _ in number], [[] for _ in number]
            for k in keep.tolist():
                line[pages.page[k]].append(pages.text[k])
                no[pages.page[k]].append(int(pages.no[k]))
            text = ["\n".join(x) for x in line]
            yield {
                "id": batch.column("id"), "ingest_ts": batch.column("ingest_ts"), "body": [text[number[t]] for t in texts],
                "codes": [None if c is None else bytes([c[i] for i in no[number[t]]]) for t, c in zip(texts, codes, strict=True)],
            }

    return mapped(rows, work, rows.select("id", "ingest_ts").schema.add("body", "string").add("codes", "binary"))


# The spam model


def lines_of(bodies: list[str]) -> tuple[list[str], np.ndarray]:
    per = [b.split("\n") if b else [] for b in bodies]
    return list(chain.from_iterable(per)), np.repeat(np.arange(len(per)), [len(x) for x in per])


def judged(page: np.ndarray, codes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind of each line by its label (0 is none) and of each page by its lines (1 is prose), and how sure the page's is."""
    kind = np.frombuffer(b"".join(codes), dtype=np.uint8) >> 2
    per = np.stack([np.bincount(page[kind == k], minlength=len(codes)) for k in (1, 2, 3)])
    return kind, per.argmax(axis=0) + 1, per.max(axis=0) / np.maximum(1, per.sum(axis=0))


def chosen(k: int, page: np.ndarray, kind: np.ndarray, page_kind: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Places of lines of pages of a kind: a line counts for a model when its page agrees, one of prose when its label does too."""
    return np.flatnonzero(among[page] & (page_kind[page] == k) & ((kind == 1) | (k != 1)))


def of_kind(k: int, lines: list[str], page: np.ndarray, kind: np.ndarray, page_kind: np.ndarray, among: np.ndarray) -> list[str]:
    """The lines themselves."""
    return [lines[i] for i in chosen(k, page, kind, page_kind, among)]


def spoken(rows: DataFrame) -> DataFrame:
    """``id``, ``ingest_ts`` and ``page`` of rows with their bodies, and once a batch, with its first row, its bodies as tokens (``made``): texts are
    read once for everything that follows. Where that was done already nothing is done again."""
    if "made" in rows.columns:
        return rows

    def work(batches):
        cache = Bounded(100_000)
        for batch in batches:
            cache.trim()
            body, codes = batch.column("body").to_pylist(), batch.column("codes").to_pylist()
            number = {t: k for k, t in enumerate(dict.fromkeys(body))}
            lines, page = lines_of(list(number))
            tokens = Tokens.of(lines, cache)
            if len(tokens.names) < 1 << 15:
                tokens.word = tokens.word.astype(np.int16)
            some = [k for k, c in enumerate(codes) if c is not None]
            made = {
                "tokens": tokens, "page": page.astype(np.int32), "same": repeats(lines, page, len(number)), "pages": len(number),
                "of": np.array([number[body[k]] for k in some], dtype=np.int32), "codes": [codes[k] for k in some], "half": np.array([half_of(body[k]) for k in some], dtype=np.int64),
            }
            yield {"id": batch.column("id"), "ingest_ts": batch.column("ingest_ts"), "page": [number[b] for b in body], "made": [pressed(made), *[None] * (len(body) - 1)]}

    return mapped(rows, work, rows.select("id", "ingest_ts").schema.add("page", "integer").add("made", "binary"))


def labelled_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(tokens, page of each line, kind of each line and of each page, how sure that is, half and repeated lines of each page) of the labelled rows."""
    for block in blocks_of(batches):
        of, page = block["of"], block["page"]
        n = np.bincount(page, minlength=block["pages"])
        size = n[of]
        lines = np.repeat((np.cumsum(n) - n)[of] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        if len(lines):
            mine = np.repeat(np.arange(len(of)), size)
            yield block["tokens"].take(lines), mine, *judged(mine, block["codes"]), block["half"], block["same"][of]


def vocabulary(rows: DataFrame, size: int = FUNCTION_WORDS) -> Vocabulary:
    """The words in most lines of prose; of words in as many lines, the first by name."""

    def work(batches):
        total: Counter[str] = Counter()
        for tokens, page, kind, page_kind, _, half, _ in labelled_blocks(batches):
            prose = tokens.take(chosen(1, page, kind, page_kind, half >= 0))
            v = max(1, len(prose.names))
            found = np.sort((prose.line() * v + prose.word)[prose.word >= 0])
            n = np.bincount(found[np.r_[True, found[1:] != found[:-1]]] % v, minlength=v) if len(found) else np.zeros(v, dtype=np.int64)
            some = np.flatnonzero(n)
            for k, c in zip(some.tolist(), n[some].tolist(), strict=True):
                total[prose.names[k]] += c
            if len(total) > GATHER // 4:
                yield {"word": list(total), "n": list(total.values())}
                total.clear()
        yield {"word": list(total), "n": list(total.values())}

    counted = mapped(made(spoken(rows)), work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    common = [r.word for r in counted.where("n > 1").orderBy(F.desc("n"), "word").limit(size).collect()]
    return Vocabulary({w: 2 * len(CLASSES) + k for k, w in enumerate(common)})


#: Grams are keys of so many bits, above which their kind, half and length stand.
GRAM = 3 * BITS + 1


def ngrams(rows: DataFrame, words: Vocabulary) -> dict[tuple[int, int], Ngrams]:
    """Models by kind and by the half that is not counted, -1 for none."""

    def each(batches):
        for tokens, page, kind, page_kind, _, half, _ in labelled_blocks(batches):
            for k in (1, 2, 3):
                for h in (0, 1):
                    sequence = tokens.take(chosen(k, page, kind, page_kind, half == h)).sequence(words)
                    for n in (1, 2, 3) if len(sequence) else ():
                        key, count = np.unique(grams(sequence, n), return_counts=True)
                        yield key | (k * 8 + h * 4 + n) << GRAM, count[:, None]

    gram, table = tallied(spoken(rows), each)
    count = table[:, 0]
    what, gram = gram >> GRAM, gram & ((1 << GRAM) - 1)
    out = {}
    for k in (1, 2, 3):
        for h in (-1, 0, 1):
            parts = []
            for m in (1, 2, 3):
                some = np.isin(what, [k * 8 + g * 4 + m for g in (0, 1) if g != h])
                key, at = np.unique(gram[some], return_inverse=True)
                parts.append((key, np.bincount(at, weights=count[some], minlength=len(key)).astype(np.int64)))
            out[k, h] = Ngrams.counted(parts, 2 * len(CLASSES) + len(words.words))
    return out


def order_statistics(numbers: RDD, ranks: list[int]) -> list[float]:
    """The numbers of some ranks among all, exactly, by 16 bits at a time; ``numbers`` holds arrays."""
    before = {r: (0, r) for r in ranks}
    for shift in (48, 32, 16, 0):
        meant = sorted({k for k, _ in before.values()})

        def count(part: Iterator[np.ndarray], shift: int = shift, meant: list[int] = meant) -> Iterator[np.ndarray]:
            out = np.zeros((len(meant), 1 << 16), dtype=np.int64)
            for x in part:
                u = (x.astype(np.float64) + 0.0).view(np.uint64)
                key = np.where(u >> np.uint64(63), ~u, u | np.uint64(1 << 63))
                digit, top = (key >> np.uint64(shift)).astype(np.int64) & 0xFFFF, key >> np.uint64(shift + 16) if shift < 48 else np.zeros(len(key), dtype=np.uint64)
                for k, m in enumerate(meant):
                    out[k] += np.bincount(digit[top == np.uint64(m)], minlength=1 << 16)
            yield out

        found = numbers.mapPartitions(count).treeReduce(np.add)
        for r, (k, rest) in before.items():
            total = np.cumsum(found[meant.index(k)])
            d = int(np.searchsorted(total, rest, side="right"))
            before[r] = (k << 16 | d, rest - (int(total[d - 1]) if d else 0))
    keys = np.array([before[r][0] for r in ranks], dtype=np.uint64)
    return np.where(keys >> np.uint64(63), keys & np.uint64((1 << 63) - 1), ~keys).astype(np.uint64).view(np.float64).tolist()


def quantiles(numbers: RDD, shares: list[float], least: int = 0) -> list[float] | None:
    """Quantiles of all numbers as of ``np.quantile``, or nothing where there are no more than ``least``."""
    n = numbers.map(len).sum()
    if n <= least:
        return None
    at = [q * (n - 1) for q in shares]
    ranks = sorted({k for a in at for k in (math.floor(a), math.ceil(a))})
    value = dict(zip(ranks, order_statistics(numbers, ranks), strict=True))
    return [value[math.floor(a)] + (value[math.ceil(a)] - value[math.floor(a)]) * (a - math.floor(a)) for a in at]


def train_spam(rows: DataFrame) -> Spam:
    """As ``spam.train``, on all labelled pages."""
    words = vocabulary(rows)
    models = ngrams(rows, words)
    empty = boosting.fit(np.zeros((0, 16)), np.zeros(0))
    spam = [Spam(words, *(models[k, h] for k in (1, 2, 3)), empty, 0.0, 0.0) for h in (0, 1, -1)]
    shared = rows.sparkSession.sparkContext.broadcast(spam[:2])

    def work(batches):
        for tokens, page, _, page_kind, sure, half, same in labelled_blocks(batches):
            x = np.zeros((len(half), 16))
            for h in (0, 1):
                # perplexities that trees learn from come from models of the other half
                mine = np.flatnonzero(half == h)
                some = np.flatnonzero(half[page] == h)
                if len(some):
                    x[mine] = shared.value[h].described(tokens.take(some), np.searchsorted(mine, page[some]), same[mine], len(mine))
            has = np.bincount(page, minlength=len(half)) > 0
            weight = np.where(has, sure, 0)
            normal = x[(page_kind == 1) & (weight > 0.8), 0]
            yield {"made": [pressed({"codes": coded(x), "y": (page_kind == 2).astype(float), "weight": weight[None], "normal": normal})]}

    found = pickled(mapped(made(spoken(rows)), work, "made binary"))
    blocks = placed(gathered(found, -(-found.getNumPartitions() // GATHERED))).persist(StorageLevel.DISK_ONLY)
    if not blocks.isEmpty():
        spam[2].low, spam[2].high = quantiles(blocks.map(lambda b: b["normal"]), [(1 - NORMAL) / 2, (1 + NORMAL) / 2], 10) or (0.0, 0.0)
        edges = quantile_codes(blocks, lambda b: b["codes"])
        bins = blocks.map(lambda b: without(b, "codes", "normal") | {"bins": binned(b["codes"], edges)}).persist(StorageLevel.DISK_ONLY)
        (spam[2].trees,) = fit_all(bins, edges, 40, depth=4, share=0.8)
        bins.unpersist()
    blocks.unpersist()
    return spam[2]


def flagged(rows: DataFrame, model: Spam) -> DataFrame:
    """``id``, ``ingest_ts`` and ``spam`` of rows with their bodies."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        flag: list[bool] = []
        for batch in batches:
            found = []
            for page, packed in zip(batch.column("page").to_pylist(), batch.column("made").to_pylist(), strict=True):
                if packed is not None:
                    block = opened(packed)
                    n = block["pages"]
                    x = shared.value.described(block["tokens"], block["page"], block["same"], n) if len(block["page"]) else np.zeros((n, 16))
                    flag = shared.value.decide(x, np.bincount(block["page"], minlength=n) > 0)[0].tolist()
                found.append(flag[page])
            yield {"id": batch.column("id"), "ingest_ts": batch.column("ingest_ts"), "spam": found}

    return mapped(spoken(rows), work, rows.select("id", "ingest_ts").schema.add("spam", "boolean"))


def parts_of(rows: int) -> int:
    """Parts of about ``PART`` rows; where there are many, as many as divide evenly among the trees of a model (``TREES`` and half of them)."""
    parts, step = max(1, min(PARTS, -(-rows // PART))), TREES // 2
    return parts if 2 * parts < step else max(step, min(PARTS, round(parts / step) * step))


def spam_rows(pages: DataFrame, total: int) -> DataFrame:
    """``id``, ``ingest_ts`` and ``spam`` of all rows, by models fitted on all labelled ones; ``total`` is the number of rows."""
    rows = described(by_text(pages, parts_of(total))).persist(StorageLevel.DISK_ONLY)
    body = train_body(rows)
    told = marked(rows, body).persist(StorageLevel.DISK_ONLY)
    told.count()
    rows.unpersist()
    return flagged(told, train_spam(told))
