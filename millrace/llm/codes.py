"""Vector code compression: product codes on integer components, exact at any size.

Vectors become integers floor(scale * x), cut into equal consecutive parts; a part's code is the nearest entry of its
position's codebook. Codebooks start as the parts of the rows of smallest ids and are refined in rounds. Nearest
entries are found by one float32 matrix product for all entries; every product carries an interval that holds its true
value whatever the order of the additions, and each entry whose interval overlaps the best one's is computed again in
int64, ties to the lower index. Only the codebooks (entries x width integers) are on the driver and in the tasks; each
task sends the sums of its own rows, at most parts x entries of them.

Rows: a null vector, one with a null or non-finite component, or one whose integers don't fit 62 bits takes no part.
All other rows are kept, with a null or repeated key too; vectors shorter than the longest, or not of a multiple of
the parts, count as if zeros followed. Of rows that share a key, the smallest vector seeds; a null key is the largest.
An empty table gives no rows and no entries. Distances that a long can't hold are null (their codes are right).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, join_groups

#: Integers of more bits take no part; those of more than `_plain` bits are computed as Python integers.
BITS = 62
_SUM = "decimal(38,0)"


@dataclass
class Compressed:
    """`rows`: id, label, code array<int>, error long, label_error long. `books`: (parts, entries, part width) integers."""

    rows: DataFrame
    books: np.ndarray

    def sha256(self) -> str:
        """SHA-256 of all entries' decimal components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def integers(table: DataFrame, key: str, vector: str, label: str | None, scale: float) -> DataFrame:
    """id, label, v (array of long) of the rows that take part."""
    big = float(2**BITS)
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    held = table.select(F.col(key).cast("long").alias("id"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"), scaled.alias("v"))
    good = F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce((x >= -big) & (x < big), F.lit(False)))
    return held.where(good).withColumn("v", F.transform("v", lambda x: F.floor(x).cast("long")))


def _plain(width: int) -> int:
    """The largest magnitude whose squared distances, summed over a vector, fit in 62 bits."""
    return 1 << ((60 - max(1, width).bit_length()) // 2)


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest of `book`'s rows for each row of int64 `x`, ties to the lower index.

    With u = 2^-24, n + 4 roundings (n products and one more for |c|^2, their sum, and the conversions to float32) move
    a score |c|^2 - 2 x.c by at most g (2 |x||c| + |c|^2), g = (n + 4) u / (1 - (n + 4) u), by Cauchy-Schwarz.
    """
    most, n = _plain(x.shape[1]), x.shape[1]
    if not len(x) or not len(book):
        return np.zeros(len(x), "i8"), np.zeros(len(x), "i8")
    if max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) > most or max(map(abs, book.ravel().tolist()), default=0) > most:
        wide = x.astype(object)[:, None, :] - book.astype(object)[None, :, :]
        far = (wide * wide).sum(axis=2) if n else np.zeros(wide.shape[:2], object)
        at = np.array([min(range(len(book)), key=row.__getitem__) for row in far], "i8")
        return at, far[np.arange(len(x)), at]
    book = book.astype("i8")
    own, other = x.astype("f8"), book.astype("f8")
    square = (other * other).sum(axis=1)
    score = np.concatenate((x.astype("f4"), np.ones((len(x), 1), "f4")), axis=1) @ np.concatenate((-2 * other, square[:, None]), axis=1).astype("f4").T
    unit = (n + 4) * 2.0**-24
    reach = (unit / (1 - unit)) * (1 + 2.0**-20) * (2 * np.sqrt((own * own).sum(axis=1))[:, None] * np.sqrt(square)[None, :] + square[None, :])
    low, high = score - reach, (score + reach).min(axis=1)
    row, entry = np.nonzero(low <= high[:, None])
    gap = x[row] - book[entry]
    far = (gap * gap).sum(axis=1)
    first = np.searchsorted(row, np.arange(len(x)))
    best = np.minimum.reduceat(far, first)
    hit = np.flatnonzero(far == best[row])
    return entry[hit[np.searchsorted(row[hit], np.arange(len(x)))]], best


def _cut(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """(rows, parts, width / parts) integers."""
    sizes, values = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), "i8")
    out[np.arange(width) < sizes[:, None]] = values
    return out.reshape(len(sizes), parts, width // parts)


def _assigned(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, parts) and squared distances, an object array where int64 doesn't do."""
    each = [nearest_entries(np.ascontiguousarray(x[:, p]), books[p]) for p in range(len(books))]
    return np.stack([c for c, _ in each], axis=1), np.stack([d for _, d in each], axis=1)


def _seeds(rows: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest keys, null last."""
    ids = rows.select("id").distinct().orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()
    known = [r[0] for r in ids if r[0] is not None]
    wanted = F.col("id").isin(known) if len(known) == len(ids) else F.col("id").isin(known) | F.col("id").isNull()
    return [r[1] for r in rows.where(wanted).groupBy("id").agg(F.min("v")).orderBy(F.col("id").asc_nulls_last()).collect()]


def _refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry moved to the floor of its parts' mean; entries without a part stay."""
    parts, entries, size = books.shape

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), "i8"), np.zeros((parts, entries, size), object)
        for batch in batches:
            x = _cut(batch.column(0), parts, parts * size)
            code, _ = _assigned(x, books)
            safe = (1 << 62) // max(1, len(x))
            kind = "i8" if max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) < safe else object
            for p in range(parts):
                count[p] += np.bincount(code[:, p], minlength=entries)
                own = np.zeros((entries, size), kind)
                np.add.at(own, code[:, p], x[:, p].astype(kind))
                total[p] += own.astype(object)
        p, e = np.nonzero(count)
        told = [[str(v) for v in total[a, b]] for a, b in zip(p, e, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(told, pa.list_(pa.string()))], names=["p", "e", "n", "s"])

    held = rows.select("v").mapInArrow(sums, "p int, e int, n long, s array<string>")
    whole = held.groupBy("p", "e").agg(F.sum("n"), *[F.sum(F.get("s", F.lit(i)).cast(_SUM)) for i in range(size)])
    out = books.copy()
    for p, e, n, *s in whole.collect():
        out[p, e] = [int(v) // n for v in s]
    return out


def compress(table: DataFrame, key: str, vector: str, label: str | None = None, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0) -> Compressed:
    """The rows' codes and errors, and the codebooks (see the module for what takes part)."""
    rows = integers(table, key, vector, label, scale)
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    size = max(1, -(-longest // parts))
    seeds = [[*v, *[0] * (parts * size - len(v))] for v in _seeds(rows, entries)]
    books = np.array(seeds, object).reshape(len(seeds), parts, size).transpose(1, 0, 2)
    for _ in range(rounds if seeds else 0):
        books = _refined(rows, books)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code, far = _assigned(_cut(batch.column(2), parts, parts * size), books)
                total = far.astype(object).sum(axis=1) if far.dtype == object else far.sum(axis=1)
                error = pa.array([t if t < 1 << 63 else None for t in total.tolist()], pa.int64())
                codes = pa.ListArray.from_arrays(pa.array(np.arange(len(code) + 1) * parts, pa.int32()), pa.array(code.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes, error], names=["id", "label", "code", "error"])

    found = cut(rows.mapInArrow(assign, f"id long, label {rows.schema['label'].dataType.simpleString()}, code array<int>, error long"))
    by_label = found.groupBy("label").agg(F.try_sum(F.col("error").cast(_SUM)).alias("_s"), F.count_if(F.col("error").isNull()).alias("_none"))
    by_label = by_label.select("label", F.when(F.col("_none") == 0, F.expr("try_cast(_s AS long)")).alias("label_error"))
    return Compressed(join_groups(found, by_label, "label"), books)
