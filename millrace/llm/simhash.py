"""SimHash near-duplicates by pivot distance tables.

A fingerprint bit is set if it is set in over half of the hashes of a text's word shingles. For every distinct
fingerprint the Hamming distances to many reference fingerprints (pivots) are computed: the zero fingerprint, one
mask for each block of bits, and some seeded random ones. The distances to a mask and to zero give the fingerprint's
coordinate in that block (its number of set bits), and fingerprints within `radius` differ in few coordinates.

Candidates meet in covering tables: the blocks form m groups; within `radius` at least m - radius groups are alike, so
one table for each choice of m - radius groups finds every pair (no pair is missed). In a table, rows of one key are
compared two by two: pairs whose pivot distances differ by more than `radius` in any coordinate are discarded (triangle
inequality), the survivors are verified by their exact distance. Keys with over `most` rows are split: their rows meet
at the fingerprints one bit away, in work linear in the rows (_ball_links, radius 2 at most). A group of many links
gives a spanning forest instead of all its pairs. Components come from large-star / small-star rounds, each written to
the checkpoint folder. Near copies by shingle similarity (wide fingerprints) are in similar.py.

Defined cases: null or empty text has fingerprint 0 and is linked like any other; equal texts share a fingerprint
and are linked whatever their number without a pair being made; null ids are in the result but never a component's
name (null where a component has no other id); an empty table gives an empty result; other columns, whatever their
names, are carried along under `row`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, give_back, small_batches


def shingle_hashes(text: bytes | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle (lower case for A-Z, words joined by blanks), repeats included."""
    split = (text or b"").lower().split()
    if not split:
        return np.zeros(0, "u8")
    joined, h = b" ".join(split), xxhash.xxh64_intdigest
    if len(split) <= words:
        return np.array([h(joined, seed)], "u8")
    ends = np.cumsum(np.fromiter(map(len, split), "i8", len(split)) + 1) - 1
    starts = np.concatenate(([0], ends[:-words] + 1)).tolist()
    return np.array([h(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)], "u8")


def widened(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """Rows of `lanes` 64-bit words; the first is the hash itself, the others are mixed from it."""
    out = [hashes]
    with np.errstate(over="ignore"):
        for lane in range(1, lanes):
            x = hashes + np.uint64(lane * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            out.append(x ^ (x >> np.uint64(31)))
    return np.stack(out, axis=1)


def fingerprint(text: bytes | None, words: int = 3, lanes: int = 1) -> np.ndarray:
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return np.zeros(lanes, "u8")
    count = np.zeros(64 * lanes, "i8")
    for a in range(0, len(hashes), 65_536):
        part = widened(hashes[a : a + 65_536], lanes)
        count += np.unpackbits(np.ascontiguousarray(part).view("u1"), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return np.packbits(2 * count > len(hashes), bitorder="little").view("u8")


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, lanes: int = 1) -> DataFrame:
    """All columns but the text, and f0.. : the fingerprint in signed 64-bit words."""
    small_batches(docs.sparkSession)
    rows = docs.select(*[c for c in docs.columns if c != text], F.col(text).cast("binary").alias(text))
    fields = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType([*fields, *[T.StructField(f"f{i}", T.LongType()) for i in range(lanes)]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(fields)).to_pylist()
            found = np.array([fingerprint(t, words, lanes) for t in texts], "u8").reshape(len(texts), lanes).view("i8")
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(fields)], *[pa.array(np.ascontiguousarray(found[:, i])) for i in range(lanes)]], names=schema.names)

    return rows.mapInArrow(run, schema)


@dataclass
class Pivots:
    """Reference fingerprints (of tables: zero first, then a mask for each block, then random ones) and the tables' choices."""

    references: np.ndarray  # pivots x lanes
    widths: np.ndarray  # bits of each block
    chosen: np.ndarray  # blocks x tables, random odd factors or 0
    radius: int

    @staticmethod
    def build(lanes: int, radius: int, tables: list[list[int]], width: int, extra: int = 16, seed: int = 1) -> Pivots:
        rng, bits = np.random.default_rng(seed), 64 * lanes
        blocks = bits // width
        masks = np.zeros((1 + blocks, bits), bool)
        for j in range(blocks):
            masks[1 + j, j * width : (j + 1) * width] = True
        structured = np.packbits(masks, axis=1, bitorder="little").view("u8")
        chosen = np.zeros((blocks, len(tables)), "u8")
        for t, own in enumerate(tables):
            chosen[own, t] = rng.integers(1, 1 << 63, len(own), "u8") * np.uint64(2) + np.uint64(1)
        return Pivots(np.concatenate((structured, rng.integers(0, 1 << 64, (extra, lanes), "u8"))), np.full(blocks, width), chosen, radius)

    @staticmethod
    def covering(lanes: int, radius: int, groups: int, width: int = 2) -> Pivots:
        blocks = np.array_split(np.arange(64 * lanes // width), groups)
        return Pivots.build(lanes, radius, [np.concatenate(c).tolist() for c in combinations(blocks, groups - radius)], width)

    @staticmethod
    def wide(lanes: int, radius: int, pivots: int = 8, seed: int = 5) -> Pivots:
        """References alone, for rows that meet under keys of another kind."""
        own = np.random.default_rng(seed).integers(0, 1 << 64, (pivots, lanes), "u8")
        return Pivots(own, np.zeros(0, "i8"), np.zeros((0, 0), "u8"), radius)

    def distances(self, prints: np.ndarray) -> np.ndarray:
        """The pivot distance table: rows x pivots."""
        out = np.zeros((len(prints), len(self.references)), "i2")
        for lane in range(prints.shape[1]):
            out += np.bitwise_count(prints[:, lane, None] ^ self.references[None, :, lane])
        return out

    def keys(self, table: np.ndarray) -> np.ndarray:
        """Rows x tables: a 64-bit key of the chosen coordinates."""
        blocks = len(self.widths)
        coordinates = ((table[:, :1] + self.widths - table[:, 1 : 1 + blocks]) // 2).astype("u8")
        with np.errstate(over="ignore"):
            out = np.stack([(coordinates[:, own := np.flatnonzero(self.chosen[:, t])] * self.chosen[own, t]).sum(axis=1, dtype="u8") + np.uint64(t * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for t in range(self.chosen.shape[1])], axis=1)
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))

    def links(self, prints: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of the pairs (i, j), those within the radius: pivots first, then the exact distance."""
        at = np.arange(len(i))
        for a in range(0, table.shape[1], 8):
            apart = np.abs(table[i[at], a : a + 8] - table[j[at], a : a + 8]).max(axis=1)
            at = at[apart <= self.radius]
        return at[np.bitwise_count(prints[i[at]] ^ prints[j[at]]).sum(axis=1, dtype="i4") <= self.radius]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of n nodes."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    own = np.flatnonzero(label != np.arange(n))
    return own, label[own]


def _linker(pivots: Pivots, lanes: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, node, f0..) sorted by key -> links (a, b) that connect all nodes of a key within the radius."""

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def found(key: np.ndarray, node: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        sizes = np.diff(first)
        keep = np.repeat(sizes > 1, sizes)  # rows alone under their key have no partner
        key, node, prints, sizes = key[keep], node[keep], prints[keep], sizes[sizes > 1]
        if not len(key):
            return
        table = pivots.distances(prints)
        begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        end_of = np.repeat(begin + sizes, sizes)
        size_of = np.repeat(sizes, sizes)
        small = np.flatnonzero(size_of <= 16)
        for step in range(1, 16):
            small = small[small + step < end_of[small]]
            if not len(small):
                break
            ok = small[pivots.links(prints, table, small, small + step)]
            if len(ok):
                yield out(node[ok], node[ok + step])
        for a, n in zip(begin[sizes > 16].tolist(), sizes[sizes > 16].tolist(), strict=True):
            ii, jj = [], []
            for r in range(0, n, 128):  # blocks of rows, so that memory stays small
                i, j = np.triu_indices(min(128, n - r), 1, n - r)
                ok = pivots.links(prints[a : a + n], table[a : a + n], i + r, j + r)
                ii.append(i[ok] + r)
                jj.append(j[ok] + r)
            x, y = _forest(n, np.concatenate(ii), np.concatenate(jj))
            if len(x):
                yield out(node[a + x], node[a + y])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] | None = None
        for batch in batches:
            key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            prints = np.stack([batch.column(2 + k).to_numpy() for k in range(lanes)], axis=1).view("u8")
            if rest is not None:
                key, node, prints = (np.concatenate((a, b)) for a, b in zip(rest, (key, node, prints), strict=True))
            if len(key):
                tail = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
                yield from found(key[:tail], node[:tail], prints[:tail])
                rest = (key[tail:], node[tail:], prints[tail:])
        if rest is not None:
            yield from found(*rest)
        give_back()

    return run


def sized(keyed: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows (key, ...) of keys with several rows, and those with over `most` (None if there are none), with their _n.

    Keys are counted before the shuffle; the join with the counts is one that adaptive execution can split.
    """
    sizes = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    rows = keyed.join(sizes, "key")
    hot = rows.where(F.col("_n") > most)
    return rows.where(F.col("_n") <= most), None if sizes.where(F.col("_n") > most).isEmpty() else hot


def links(nodes: DataFrame, pivots: Pivots, lanes: int, most: int = 256) -> DataFrame:
    """Links (a, b) that connect all nodes within the radius. `nodes`: _node long, f0.. (distinct fingerprints)."""
    prints = [f"f{i}" for i in range(lanes)]

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                own = np.stack([part.column(1 + k).to_numpy() for k in range(lanes)], axis=1).view("u8")
                keys = pivots.keys(pivots.distances(own))
                for t in range(keys.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(keys[:, t]).view("i8")), *part.columns], names=["key", "_node", *prints])

    lane_type = ", ".join(f"{f} long" for f in prints)
    rows = cut(nodes.select("_node", *prints).mapInArrow(keyed, f"key long, _node long, {lane_type}"))
    cold, hot = sized(rows, most)
    pairs = cold.drop("_n").repartition("key").sortWithinPartitions("key").mapInArrow(_linker(pivots, lanes), "a long, b long")
    if hot is None:
        return pairs
    return pairs.union(_ball_links(hot.groupBy("_node").agg(*[F.first(f).alias(f) for f in prints]), prints))


def _ball_links(nodes: DataFrame, prints: list[str]) -> DataFrame:
    """Links that connect all nodes within radius 2, in work linear in the nodes however alike these are.

    Each node is put at its own fingerprint and at those one bit away. Nodes within two bits meet at some point, and
    nodes that meet are within two bits: a point has at most bits + 1 distinct fingerprints, and a star links them.
    """
    flips = lambda f: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.struct(*[(F.col(g).bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)) if g == f else F.col(g)).alias(g) for g in prints]))
    points = F.concat(F.array(F.struct(*prints)), *[flips(f) for f in prints])
    met = nodes.select("_node", F.explode(points).alias("_point")).groupBy("_point").agg(F.collect_list("_node").alias("_met")).where(F.size("_met") > 1)
    return met.select(F.explode("_met").alias("a"), F.array_min("_met").alias("b")).where("a <> b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """Columns _node, _root (the smallest node reachable) for all nodes that have a link but the roots themselves."""
    edges = cut(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m")
        small = large.join(least, F.col("u") == F.col("x"))
        edges = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("_node"), F.col("v").alias("_root"))
        state = now


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, lanes: int = 1, radius: int = 2, groups: int = 4, most: int = 256) -> DataFrame:
    """Columns: row (struct of all columns but the text), f0.., component_id: the smallest `key` among the linked rows."""
    if radius > 2:
        raise ValueError("hot keys are split at a radius of 2 at most")
    prints = [f"f{i}" for i in range(lanes)]
    own = docs.select(F.struct(*[c for c in docs.columns if c != text]).alias("row"), F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = cut(fingerprints(own, "_text", words, lanes))
    nodes = cut(rows.groupBy(*prints).agg(F.min("_key").alias("_least"))).withColumn("_node", F.monotonically_increasing_id())
    roots = components(links(nodes, Pivots.covering(lanes, radius, groups), lanes, most))
    placed = nodes.join(roots, "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    named = placed.groupBy("_root").agg(F.min("_least").alias("component_id"))
    placed = cut(placed.join(named, "_root").select(*prints, "component_id"))
    return rows.join(placed, prints).select("row", *prints, "component_id")
