"""Exact top-k by columnar branch and bound.

Vectors are turned into integers and a chunk of rows is laid out dimension by dimension. Inner products are
accumulated over blocks of dimensions (those where the queries have most mass first). After each block a pair can
still gain at most |rest of the query| * |rest of the row|; pairs that cannot reach the query's k-th best score are
dropped, rows that no query needs are compacted away, and when few pairs are left they are finished one by one.

Sums are exact: in doubles while dimensions * largest query component * largest row component stays below 2^53,
otherwise in Python integers (clipped to the range of a long).

Defined cases: null vectors, null or non-finite components (also such that aren't finite after scaling) and null ids
take no part; vectors of other lengths are
padded with zeros; a row is never its own neighbour, nor are other rows with its id; fewer candidates than k give
fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import Best, search, usable


class BranchAndBound:
    def __init__(self, q: np.ndarray, ids: np.ndarray, k: int, scale: float, dims: int = 16, rows: int = 128) -> None:
        self.q, self.ids, self.k, self.scale, self.dims, self.rows = np.floor(scale * q), ids, k, scale, dims, rows
        self.found = Best(len(ids), k, np.dtype("i8").type)

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.found.rows()

    def feed(self, x: np.ndarray, ids: np.ndarray) -> None:
        x = np.floor(self.scale * x)
        if x.shape[1] * np.abs(x).max(initial=0) * np.abs(self.q).max(initial=0) >= 2.0**53:
            return self._large(x, ids)
        columns = np.ascontiguousarray(x.T)
        for a in range(0, len(self.q), self.rows):
            self._block(a, self.q[a : a + self.rows], columns, ids)

    def _block(self, start: int, q: np.ndarray, columns: np.ndarray, ids: np.ndarray) -> None:
        order = np.argsort(-np.abs(q).sum(axis=0), kind="stable")
        floors = np.array([self.found.floor(start + i) for i in range(len(q))])
        at, part = np.arange(columns.shape[1]), np.zeros((len(q), columns.shape[1]))
        rest_q, rest_x = (q**2).sum(axis=1), (columns**2).sum(axis=0)
        alive = np.ones(part.shape, bool)
        for d in range(0, len(order), self.dims):
            own = order[d : d + self.dims]
            block = columns[own][:, at]
            part += q[:, own] @ block
            rest_q, rest_x = np.maximum(rest_q - (q[:, own] ** 2).sum(axis=1), 0), np.maximum(rest_x - (block**2).sum(axis=0), 0)
            alive = part + np.sqrt(rest_q)[:, None] * np.sqrt(rest_x) >= (floors - 1)[:, None]
            need = alive.any(axis=0)
            if need.sum() < 0.7 * len(at):
                at, part, alive, rest_x = at[need], part[:, need], alive[:, need], rest_x[need]
            if d + self.dims < len(order) and alive.sum() < 0.02 * alive.size:
                i, j = np.nonzero(alive)
                left = order[d + self.dims :]
                part[i, j] += (q[np.ix_(np.arange(len(q)), left)][i] * columns[left][:, at[j]].T).sum(axis=1)
                break
        for i in range(len(q)):
            j = np.flatnonzero(alive[i])
            j = j[ids[at[j]] != self.ids[start + i]]
            if len(j):
                self.found.add(start + i, part[i, j], ids[at[j]])

    def _large(self, x: np.ndarray, ids: np.ndarray) -> None:
        whole = [[int(v) for v in row] for row in x]
        for i, row in enumerate(self.q):
            own = [int(v) for v in row]
            sums = [sum(a * b for a, b in zip(own, other, strict=True)) for other in whole]
            keep = ids != self.ids[i]
            self.found.add(i, np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in sums], "i8")[keep], ids[keep])


def exact_top_k(table: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose key is divisible by `every`, over floor(scale * component)."""
    rows = usable(table, key, vector, zero=True, scale=scale)
    width = rows.select(F.max(F.size("v"))).first()[0] or 0

    def scorer(q: np.ndarray, ids: np.ndarray) -> BranchAndBound:
        return BranchAndBound(q, ids, k, scale)

    return search(rows, F.col("id") % every == 0, width, k, scorer, "long")
