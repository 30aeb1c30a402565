"""What both vector searches share: clean vectors, a grid of query and row blocks, and the merge of each cell's best.

The stated queries and all rows are dealt to blocks by hash, of at most `block_mb` and 65,536 rows. A cell of the grid is
a query block and a row block: it meets the rows in chunks of `chunk` and keeps the k best of each query, and these are
merged by query. Every row is sent once for each block of the other side; none goes through the driver, and a task holds
two blocks, whatever the number of queries. Queries are numbered once in the checkpoint folder, so rows that share an id
are queries of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: (queries' matrix, queries' ids) -> an object with feed(matrix, ids) and best() -> (query number, id, score)
Scorer = Callable[[np.ndarray, np.ndarray], object]


def usable(table: DataFrame, key: str, vector: str, zero: bool, scale: float = 1.0) -> DataFrame:
    """Columns id, v (array of double): rows with an id whose vector has only components that are finite, also times
    `scale` (and isn't zero)."""
    v = F.col(vector).cast("array<double>")
    good = F.col(key).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) != float("inf")))
    if not zero:
        good &= F.exists(v, lambda x: x != 0)
    return table.where(good).select(F.col(key).cast("long").alias("id"), v.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows x width; shorter vectors are padded with zeros."""
    sizes, values = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy()
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def search(rows: DataFrame, is_query: Column, width: int, k: int, scorer: Callable[[np.ndarray, np.ndarray], Scorer], score_type: str, block_mb: int = 32, chunk: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each query row, best first, ties to the smaller id."""
    queries = cut(rows.where(is_query).withColumn("_q", F.monotonically_increasing_id()))
    most = max(1, min(65_536, (block_mb << 17) // max(1, width)))
    asked, held = queries.count(), rows.count()
    across, down = max(1, math.ceil(asked / most)), max(1, math.ceil(held / max(min(chunk, most), min(most, held // 64))))
    own = lambda n, *of: F.pmod(F.xxhash64(F.lit(b"grid"), *of), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select(own(across, "_q").alias("i"), every(down).alias("j"), "_q", "id", "v")
    c = rows.select(every(across).alias("i"), own(down, "id", "v").alias("j"), F.lit(None).cast("long").alias("_q"), "id", "v")

    def cell(table: pa.Table) -> pa.Table:
        asked = table["_q"].is_valid()
        mine, others = table.filter(asked), table.filter(pc.invert(asked))
        ids = mine["id"].to_numpy()
        best = scorer(matrix(mine["v"].combine_chunks(), width), ids)
        if len(ids):
            _feed(best, others, width, chunk)
        number, vec, score = best.best()
        return pa.table({"_q": mine["_q"].to_numpy()[number].astype("i8"), "query_id": ids[number].astype("i8"), "vec_id": vec.astype("i8"), "score": score})

    found = q.union(c).groupBy("i", "j").applyInArrow(cell, f"_q long, query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _feed(best: object, table: pa.Table, width: int, chunk: int) -> None:
    ids = table["id"].to_numpy()
    if not len(ids):
        return
    x = matrix(table["v"].combine_chunks(), width)
    order = np.argsort(ids, kind="stable")
    for a in range(0, len(ids), chunk):
        at = order[a : a + chunk]
        best.feed(x[at], ids[at])


class Best:
    """The k best (score, smaller id) of each query so far."""

    def __init__(self, queries: int, k: int, kind: type) -> None:
        self.k, self.kind = k, kind
        self.scores: list[np.ndarray] = [np.zeros(0, kind)] * queries
        self.ids: list[np.ndarray] = [np.zeros(0, "i8")] * queries

    def floor(self, q: int) -> float:
        return self.scores[q][-1] if len(self.scores[q]) == self.k else -np.inf

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.k:
            keep = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[keep], ids[keep]
        scores, ids = np.concatenate((self.scores[q], scores.astype(self.kind))), np.concatenate((self.ids[q], ids))
        top = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.ids[q] = scores[top], ids[top]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        number = np.repeat(np.arange(len(self.ids)), [len(x) for x in self.ids])
        join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
        return number, join(self.ids, "i8"), join(self.scores, self.kind)
