"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

Rows are scaled by the largest norm and given one more coordinate that makes all norms 1, so that the largest inner
product is the smallest Euclidean distance. Each table has `hashes` functions floor((a.x + b) / width) with Gaussian
a. A query visits, in every table, its own bucket and then buckets with some hashes moved by one, in the order of
their estimated success (the expected squared distances to the bucket borders, a template computed once). The
candidates of all tables are merged and reranked by their exact inner product.

Every row is indexed: each cell of the grid of query and row blocks builds the tables over chunks of its rows with the
same functions, so the union over row blocks is the global index. The number of probes is fitted on at most `sample` rows
and 64 of their queries: the first step of LADDER that finds `goal` of the true neighbours (as many of the k as the
sample can hold) is used.

Defined cases: null or zero vectors, null or non-finite components and null ids take no part; vectors of other
lengths are padded with zeros; a row is never its own neighbour, nor are other rows with its id; where a chunk gives
a query fewer than k candidates its first rows are added, so that k rows are found wherever there are k; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import Best, matrix, search, usable

#: Steps of (hashes, width, probes) for each table, from few to many visited rows.
LADDER = ((12, 2.6, 25), (12, 2.6, 50), (12, 2.6, 100), (12, 2.6, 200), (12, 2.6, 400), (8, 2.2, 200), (6, 2.2, 40), (4, 3.0, 40))
TABLES, CELL_BITS = 16, 16


def probe_template(hashes: int, probes: int) -> np.ndarray:
    """probes x 2*hashes, 0 or 1: which of the border distances, from near to far, each probe crosses."""
    j = np.arange(1, 2 * hashes + 1)
    far = 2 * hashes + 1 - j
    near = (hashes + 1) * (hashes + 2)
    cost = np.where(j <= hashes, j * (j + 1) / (4 * near), 1 - far / (hashes + 1) + far * (far + 1) / (4 * near))
    sets: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (1,))]
    while heap and len(sets) < probes:
        total, own = heapq.heappop(heap)
        if not any(2 * hashes + 1 - x in own for x in own):  # both borders of one hash can't be crossed
            sets.append(own)
        last = own[-1]
        if last < 2 * hashes:
            heapq.heappush(heap, (total - cost[last - 1] + cost[last], (*own[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last], (*own, last + 1)))
    out = np.zeros((len(sets), 2 * hashes), "u8")
    for i, own in enumerate(sets):
        out[i, [x - 1 for x in own]] = 1
    return out


@dataclass
class Index:
    """The hash functions; the same in every task."""

    width: int  # components of a vector
    largest: float  # norm
    hashes: int
    step: float
    probes: int
    seed: int = 11

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        self.a = rng.standard_normal((TABLES, self.width + 1, self.hashes))
        self.b = rng.uniform(0, self.step, (TABLES, self.hashes))
        self.odd = rng.integers(0, 1 << 62, (TABLES, self.hashes), "u8") * np.uint64(2) + np.uint64(1)
        self.template = probe_template(self.hashes, self.probes)

    def _cell(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (((key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CELL_BITS)).astype("i4")

    def rows(self, x: np.ndarray) -> np.ndarray:
        """tables x rows: the cell of each row."""
        unit = x / self.largest
        unit = np.concatenate((unit, np.sqrt(np.maximum(0, 1 - (unit**2).sum(axis=1, keepdims=True)))), axis=1)
        out = []
        for a, b, odd in zip(self.a, self.b, self.odd, strict=True):
            slot = np.floor((unit @ a + b) / self.step).astype("i8").view("u8")
            out.append(self._cell((slot * odd).sum(axis=1, dtype="u8")))
        return np.stack(out)

    def visits(self, q: np.ndarray) -> np.ndarray:
        """queries x tables x probes: the cells to visit."""
        unit = q / np.linalg.norm(q, axis=1, keepdims=True)
        unit = np.concatenate((unit, np.zeros((len(q), 1))), axis=1)
        out = np.empty((len(q), TABLES, len(self.template)), "i4")
        for t in range(TABLES):
            place = (unit @ self.a[t] + self.b[t]) / self.step
            slot = np.floor(place)
            border = np.concatenate((place - slot, 1 - place + slot), axis=1)
            order = np.argsort(border, axis=1, kind="stable")
            move = np.concatenate((np.uint64(0) - self.odd[t], self.odd[t]))[order]
            base = (slot.astype("i8").view("u8") * self.odd[t]).sum(axis=1, dtype="u8")
            out[:, t] = self._cell(base[:, None] + move @ self.template.T)
        return out


class MultiProbe:
    def __init__(self, index: Index, q: np.ndarray, ids: np.ndarray, k: int) -> None:
        self.index, self.q, self.ids, self.k = index, q, ids, k
        self.found = Best(len(ids), k, np.dtype("f8").type)

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.found.rows()

    def _visits(self, step: int = 2048) -> Iterator[tuple[int, np.ndarray]]:
        """The cells that each query visits, found for `step` queries at a time."""
        for a in range(0, len(self.q), step):
            yield from enumerate(self.index.visits(self.q[a : a + step]), a)

    def feed(self, x: np.ndarray, ids: np.ndarray) -> None:
        cells, n = self.index.rows(x), len(ids)
        order = np.argsort(cells, axis=1, kind="stable")
        starts = np.stack([np.searchsorted(np.take(c, o), np.arange((1 << CELL_BITS) + 1)) for c, o in zip(cells, order, strict=True)])
        flat, shift = order.reshape(-1), (np.arange(TABLES) * n)[:, None]
        tables = np.arange(TABLES)[:, None]
        for i, cell in self._visits():
            a, b = starts[tables, cell] + shift, starts[tables, cell + 1] + shift
            size = (b - a).reshape(-1)
            full = size > 0
            size, a = size[full], a.reshape(-1)[full]
            seen = np.zeros(n, bool)
            if len(size):
                ends = np.cumsum(size)
                seen[flat[np.arange(ends[-1]) + np.repeat(a - ends + size, size)]] = True
            seen &= ids != self.ids[i]
            at = np.flatnonzero(seen)
            if len(at) < self.k:
                seen[: 2 * self.k] = True
                at = np.flatnonzero(seen & (ids != self.ids[i]))
            if len(at) < self.k:
                at = np.flatnonzero(ids != self.ids[i])
            if len(at):
                self.found.add(i, x[at] @ self.q[i], ids[at])


def fit(rows: DataFrame, every: int, k: int, width: int, largest: float, total: int, sample: int = 8192, goal: float = 0.96) -> Index:
    """The index of the first step of LADDER that finds `goal` of the sample's true neighbours."""
    part = rows if total <= sample else rows.where(F.pmod(F.xxhash64(F.lit(b"sample"), "id"), F.lit(1 << 30)) < int(sample / total * (1 << 30)))
    got = part.limit(2 * sample).toArrow()
    if not got.num_rows:
        return Index(width, largest, *LADDER[0])
    x, ids = matrix(got["v"].combine_chunks(), width), got["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    some = np.linspace(0, len(ids) - 1, min(64, len(ids))).astype("i8")
    k = max(1, min(k, round(k * len(ids) / max(1, total))))
    truth = []
    for i in some:
        best = Best(1, k, np.dtype("f8").type)
        keep = ids != ids[i]
        best.add(0, x[keep] @ x[i], ids[keep])
        truth.append(set(best.ids[0].tolist()))
    for step in LADDER:
        index = Index(width, largest, *step)
        probe = MultiProbe(index, x[some], ids[some], k)
        probe.feed(x, ids)
        hit = sum(len(t & set(f.tolist())) for t, f in zip(truth, probe.found.ids, strict=True))
        if hit >= goal * max(1, sum(map(len, truth))):
            break
    return index


def nearest(table: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose key is divisible by `every`."""
    rows = usable(table, key, vector, zero=False)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    width, largest, total = rows.select(F.max(F.size("v")), F.max(F.sqrt(squares)), F.count(F.lit(1))).first()
    index = fit(rows, every, k, width or 0, largest or 1.0, total)

    def scorer(q: np.ndarray, ids: np.ndarray) -> MultiProbe:
        return MultiProbe(index, q, ids, k)

    return search(rows, F.col("id") % every == 0, width or 0, k, scorer, "double")
