"""Filling containers of fixed capacity with items of varying length, by local search.

Items are dealt by hash of key and row into shards of bounded size, also where a key repeats or is null; each shard is packed on its own in
one task. Best fit decreasing gives a start. Then items move, or change places one for one and two for one, between containers that are not
full: always so that the fuller container gains, which raises the sum of squared fills and drains the emptier one until it is empty. All pairs
of a donor's items are tried against all items of all other containers that are not full (full ones can gain nothing). The search ends when
no exchange is left that gains, or when there are as few containers as the sizes add up to, which no packing can undercut.

Only items longer than the capacity are split: into full pieces and one rest. Items of size 0 (null and empty texts) take no room and lie in
the first container of their shard. Repeated rows are items of their own. Null keys are keys as any other.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small

#: Items of a shard.
SHARD = 8192


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container numbers by best fit decreasing."""
    bins = np.zeros(len(sizes), dtype=np.int64)
    rest: list[tuple[int, int]] = []
    used = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        k = bisect_left(rest, (size, -1))
        if k < len(rest):
            room, b = rest.pop(k)
        else:
            room, b, used = capacity, used, used + 1
        bins[i] = b
        if room > size:
            insort(rest, (room - size, b))
    return bins


def improve(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Exchanges between containers that are not full until none gains."""
    fill = np.bincount(bins, weights=sizes).astype(np.int64)
    least = -(-int(sizes.sum()) // capacity)
    some = np.flatnonzero((fill < capacity)[bins])
    back, local = np.unique(bins[some], return_inverse=True)
    search = Search(sizes[some].astype(np.int64), local, capacity, len(fill) - least)
    search.run()
    out = bins.copy()
    out[some] = back[search.bins]
    return np.unique(out, return_inverse=True)[1]


class Search:
    """Items of containers that are not full, and how many containers may be emptied at best."""

    def __init__(self, sizes: np.ndarray, bins: np.ndarray, capacity: int, spare: int):
        self.sizes, self.bins, self.capacity, self.spare = sizes, bins.copy(), capacity, spare
        self.fill = np.bincount(bins, weights=sizes).astype(np.int64)

    def run(self) -> None:
        moved = True
        while moved and self.spare > 0:
            moved = False
            for donor in np.argsort(self.fill, kind="stable"):
                if self.fill[donor] in (0, self.capacity):
                    continue
                while self.spare > 0 and self.fill[donor] and self.step(donor):
                    moved = True
                    self.spare -= self.fill[donor] == 0

    def step(self, donor: int) -> bool:
        """The greatest gain of a container at least as full as the donor, out of the donor."""
        room = self.capacity - self.fill
        room[(self.fill < self.fill[donor]) | (self.fill == 0)] = -1
        room[donor] = -1
        own = np.flatnonzero(self.bins == donor)
        own = own[np.argsort(-self.sizes[own], kind="stable")]
        for a in own:
            # move: into the tightest container that takes it
            fits = np.flatnonzero(room >= self.sizes[a])
            if len(fits):
                self.put([a], fits[np.argmin(room[fits])])
                return True
        other = np.flatnonzero(room[self.bins] > 0)
        if not len(other):
            return False
        given, limit = self.sizes[other], self.sizes[other] + room[self.bins[other]]
        best, gain = None, 0
        for sums, groups in groups_of(self.sizes[own]):
            at = np.searchsorted(sums, limit, side="right") - 1
            more = np.where(at >= 0, sums[np.maximum(at, 0)] - given, 0)
            k = int(np.argmax(more))
            if more[k] > gain:
                best, gain = (other[k], own[list(groups[at[k]])]), int(more[k])
        if best is None:
            return False
        item, group = best
        to = self.bins[item]
        self.put([item], donor)
        self.put(group, to)
        return True

    def put(self, items: list[int] | np.ndarray, to: int) -> None:
        np.subtract.at(self.fill, self.bins[items], self.sizes[items])
        self.fill[to] += self.sizes[items].sum()
        self.bins[items] = to


def groups_of(sizes: np.ndarray) -> list[tuple[np.ndarray, list[tuple[int, ...]]]]:
    """Sums in order, with the places that make them, of all different single sizes and of all different pairs of sizes."""
    value, first, count = np.unique(sizes, return_index=True, return_counts=True)
    singles = (value, [(int(k),) for k in first])
    a, b = np.triu_indices(len(value))
    keep = (a != b) | (count[a] > 1)
    a, b = a[keep], b[keep]
    order = np.argsort(value[a] + value[b], kind="stable")
    a, b = a[order], b[order]
    second = {int(k): int(np.flatnonzero(sizes == value[k])[1]) for k in np.unique(a[a == b])}
    pairs = [(int(first[i]), int(first[j]) if i != j else second[int(i)]) for i, j in zip(a, b, strict=True)]
    return [singles, (value[a] + value[b], pairs)] if len(a) else [singles]


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container numbers from 0 for items of at most the capacity; items of size 0 go to container 0."""
    out = np.zeros(len(sizes), dtype=np.int64)
    at = np.flatnonzero(sizes > 0)
    if len(at):
        out[at] = improve(sizes[at], best_fit(sizes[at], capacity), capacity)
    return out


def pack_items(items: DataFrame, specs: DataFrame, key: str = "doc_id", size: str = "n_tokens", shard_items: int = SHARD, count: int | None = None) -> DataFrame:
    """(spec_id, container, key, piece_no, start, size): every item under every spec of (spec_id, capacity).

    ``count`` is the number of items where it is known more cheaply. ``container`` reads shard-number. Specs are a small table and multiply the items; shards bound what one task holds.
    """
    shards = max(1, -(-(items.count() if count is None else count) // shard_items))
    kind = dict(items.dtypes)[key]
    wanted = broadcast_if_small(specs.select("spec_id", F.col("capacity").cast("long").alias("capacity")).where(F.col("capacity") > 0))
    # the row's number keeps equal keys apart: one key may hold a third of all rows
    shard = F.pmod(F.xxhash64(F.col(key), F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    rows = items.select(key, F.col(size).cast("long").alias("n"), shard.alias("shard")).crossJoin(wanted)
    schema = f"spec_id int, container string, {key} {kind}, piece_no int, start bigint, n_tokens bigint"

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([key, "n"], ignore_index=True)
        capacity, spec, shard = int(frame["capacity"].iloc[0]), int(frame["spec_id"].iloc[0]), int(frame["shard"].iloc[0])
        n = frame["n"].to_numpy()
        pieces = np.maximum(1, -(-n // capacity))
        row = np.repeat(np.arange(len(n)), pieces)
        no = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        sizes = np.minimum(capacity, n[row] - no * capacity)
        container = pack(sizes, capacity)
        names = np.char.add(f"{shard}-", container.astype(str))
        return pd.DataFrame({"spec_id": spec, "container": names.astype(object), key: frame[key].to_numpy()[row], "piece_no": no, "start": no * capacity, "n_tokens": sizes})

    return rows.groupBy("spec_id", "shard").applyInPandas(fill, schema)


def fill_report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """Per spec: pieces, containers, tokens, the fewest containers that the tokens could need, and the share of the space that is used."""
    per = packed.groupBy("spec_id").agg(F.count("*").alias("pieces"), F.countDistinct("container").alias("containers"), F.sum("n_tokens").alias("tokens"))
    both = per.join(broadcast_if_small(specs.select("spec_id", "capacity")), "spec_id")
    return both.withColumns({"least": F.ceil(F.col("tokens") / F.col("capacity")), "used": F.col("tokens") / (F.col("containers") * F.col("capacity"))})
