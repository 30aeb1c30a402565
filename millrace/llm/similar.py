"""Near copies by SimHash: wide fingerprints, blocks of anchor shingles, pivots, then exact similarity.

A text's set is that of the XXH64 hashes of its word shingles; two texts are near copies at a Jaccard similarity of 4/5
or more of their sets, exactly. Rows linked by near copies, directly or through others, form a group.

1. Every text gets a fingerprint of 256 bits (SimHash of its set) and ANCHORS anchors, the least shingle under seeded
   orders. Texts of similarity s share each anchor with probability s: at 4/5 a pair has none in common once in 15,000.
   Equal sets are one node.
2. Nodes meet under their anchors. Pairs whose distances to the reference fingerprints differ by more than RADIUS in any
   coordinate are discarded, the survivors are verified by their Hamming distance. At similarity 4/5 that is about 39 bits
   with a deviation of 6, so RADIUS = 64 loses about one pair of 100,000 (a few of 1,000 for sets of about five shingles).
   Neither chance depends on the number of rows.
3. Anchors with over `most` nodes are split by the next two anchors; what is over `most` even then is dealt into chunks,
   and each pair of chunks is a task of its own.
4. Nodes linked so far are suspects: their texts are read, and inside each group of suspects all pairs are verified by
   their exact sets, as products of 0/1 matrices (large groups by pairs of chunks). Only exact links make groups.

Defined cases: null text counts as empty; texts without a word are alike; a text of fewer words than a shingle is one
shingle; equal rows are alike; ids may be null or repeat; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, give_back, small_batches
from .simhash import Pivots, _forest, _linker, components, shingle_hashes, sized, widened

ANCHORS, LANES, RADIUS = 6, 4, 64
_PRINTS = [f"f{i}" for i in range(LANES)]
_ODD = np.random.default_rng(17).integers(0, 1 << 62, ANCHORS, "u8") * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """The distinct shingle hashes in ascending order."""
    return np.unique(shingle_hashes(text, words))


def set_print(own: np.ndarray) -> np.ndarray:
    """The fingerprint of a set."""
    count = np.zeros(64 * LANES, "i8")
    for a in range(0, len(own), 16_384):
        count += np.unpackbits(np.ascontiguousarray(widened(own[a : a + 16_384], LANES)).view("u1"), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return np.packbits(2 * count > len(own), bitorder="little").view("u8")


def anchors(own: np.ndarray) -> list[int]:
    """The set's least shingle under each of the orders; none of an empty set."""
    if not len(own):
        return []
    with np.errstate(over="ignore"):
        mixed = own[None, :] * _ODD[:, None]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return own[(mixed ^ (mixed >> np.uint64(29))).argmin(axis=1)].view("i8").tolist()


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """_rid, _k, text -> _rid, _k, _set (digest), _size, f0.., _anchors."""
    small_batches(rows.sparkSession)
    texts = rows.select("_rid", "_k", F.col("text").cast("binary").alias("text"))
    more = [T.StructField("_set", T.BinaryType()), T.StructField("_size", T.IntegerType()), *[T.StructField(f, T.LongType()) for f in _PRINTS], T.StructField("_anchors", T.ArrayType(T.LongType()))]
    schema = T.StructType([*texts.schema.fields[:2], *more])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column(2).to_pylist()]
            prints = np.array([set_print(s) for s in sets], "u8").reshape(len(sets), LANES).view("i8")
            names = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            lanes = [pa.array(np.ascontiguousarray(prints[:, k])) for k in range(LANES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), names, pa.array([len(s) for s in sets], pa.int32()), *lanes, pa.array([anchors(s) for s in sets], pa.list_(pa.int64()))], names=schema.names)
        give_back()

    return texts.mapInArrow(run, schema)


def candidates(nodes: DataFrame, most: int = 512) -> DataFrame:
    """Links (a, b) that connect all nodes that share an anchor within the radius. `nodes`: _node, f0.., _anchors."""
    after = lambda k: F.get("_anchors", F.pmod(F.col("_t") + k, F.size("_anchors")))
    keyed = nodes.select("_node", *_PRINTS, "_anchors", F.posexplode("_anchors").alias("_t", "_a"))
    keyed = keyed.select(F.xxhash64("_t", "_a").alias("key"), "_node", *_PRINTS, after(1).alias("_a1"), after(2).alias("_a2"))
    block = ["key", "_node", *_PRINTS]
    cold, hot = sized(keyed, most)
    blocks = cold.select(block)
    if hot is not None:
        second = F.explode(F.array(F.xxhash64("key", F.lit(1), "_a1"), F.xxhash64("key", F.lit(2), "_a2"))).alias("key")
        cold, hot = sized(hot.select(second, "_node", *_PRINTS), most)
        blocks = blocks.union(cold.select(block))
        if hot is not None:
            chunks = F.ceil(F.col("_n") / most).cast("int")
            dealt = hot.withColumn("_i", F.pmod(F.xxhash64("_node"), chunks).cast("int")).withColumn("_j", F.explode(F.sequence(F.lit(0), chunks - 1)))
            blocks = blocks.union(dealt.select(F.xxhash64("key", F.least("_i", "_j"), F.greatest("_i", "_j")).alias("key"), "_node", *_PRINTS))
    return blocks.repartition("key").sortWithinPartitions("key").mapInArrow(_linker(Pivots.wide(LANES, RADIUS), LANES), "a long, b long")


def alike(sets: list[np.ndarray], block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs of sets whose similarity is 4/5 or more."""
    sizes = np.array([len(s) for s in sets], "i8")
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    own = shared[column]
    column, row = (np.cumsum(shared) - 1)[column[own]], np.repeat(np.arange(len(sets)), sizes)[own]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    common = np.zeros((len(sets), len(sets)), "f4")
    for a in range(0, int(shared.sum()), block):
        first, last = np.searchsorted(column, (a, a + block))
        part = np.zeros((len(sets), min(block, int(shared.sum()) - a)), "f4")
        part[row[first:last], column[first:last] - a] = 1
        common += part @ part.T
    i, j = np.nonzero(np.triu(9 * common >= 4 * (sizes[:, None] + sizes), 1))  # common / union >= 4/5
    return _forest(len(sets), i, j)


def exact_links(texts: DataFrame, words: int) -> DataFrame:
    """Rows (key, _node, text) -> links (a, b) between near copies under a key."""

    def found(nodes: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(nodes) > 1:
            i, j = alike(sets)
            at = np.array(nodes, "i8")
            yield pa.RecordBatch.from_arrays([pa.array(at[i]), pa.array(at[j])], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, sets = None, [], []
        for batch in batches:
            for key, node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != at:
                    yield from found(nodes, sets)
                    at, nodes, sets = key, [], []
                nodes.append(node)
                sets.append(shingle_set(text, words))
        yield from found(nodes, sets)
        give_back()

    rows = texts.select("key", "_node", F.col("text").cast("binary").alias("text"))
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def near_copies(rows: DataFrame, words: int = 5, most: int = 512, most_words: int = 1_000_000) -> DataFrame:
    """_rid, _k, _group of each row of `rows` (_rid, _k, text): equal for rows that links of similarity 4/5 or more connect.

    A task that verifies holds two chunks of `most` sets or `most_words` shingles at most (or a single larger text).
    """
    sketched = cut(sketches(rows, words))
    own = [F.min("_rid").alias("_rid"), *[F.first(c).alias(c) for c in ("_size", *_PRINTS, "_anchors")]]
    nodes = cut(sketched.groupBy("_set").agg(*own)).withColumn("_node", F.monotonically_increasing_id())
    linked = components(cut(candidates(nodes, most)))
    linked = linked.union(linked.select(F.col("_root").alias("_node"), "_root").distinct())
    suspects = nodes.select("_node", "_rid", "_size").join(linked, "_node")
    chunks = F.ceil(F.greatest(F.count(F.lit(1)) / most, F.sum("_size") / most_words)).cast("int").alias("_chunks")
    asked = suspects.join(cut(suspects.groupBy("_root").agg(chunks)), "_root").withColumn("_i", F.pmod(F.xxhash64("_node"), F.col("_chunks")).cast("int"))
    keys = F.transform(F.sequence(F.lit(0), F.col("_chunks") - 1), lambda j: F.xxhash64("_root", F.least("_i", j), F.greatest("_i", j)))
    texts = rows.select("_rid", "text").join(asked.select("_rid", "_node", keys.alias("_keys")), "_rid")
    links = cut(exact_links(texts.select(F.explode("_keys").alias("key"), "_node", "text"), words))
    groups = nodes.select("_set", "_node").join(components(links), "_node", "left").select("_set", F.coalesce("_root", "_node").alias("_group"))
    return sketched.select("_rid", "_k", "_set").join(cut(groups), "_set").select("_rid", "_k", "_group")
