"""Prefix trie of conversations: every distinct sequence of first turns, with what its conversations share.

Conversations are sorted as sequences of turn digests (ties by id), so the members of a node stand side by side. The
longest common prefixes of neighbours (LCPs, in turns) make a Cartesian tree: an LCP with its nearest smaller ones to
both sides bounds the rows that share so many turns. Equal LCPs with the same bounds are one node; depths between a
node and its parent are filled in; sums over a node's rows come from running sums.

Nearest smaller values are found in parallel: the sorted rows are cut into blocks (range partitions in a checkpoint).
A block finds those inside it with a stack. A node that goes over a block's edge is named by the block in which it
starts and its depth: that block is the nearest one to the left whose smallest LCP lies below the depth, found among
block minima by pointers to the next smaller minimum. Blocks give their shares of such nodes (at most two for each
depth), which are added up by name. The driver holds three integers for each block.

A conversation's turns are one row of 16 bytes and a count for each turn; texts are never moved. Rows without a
conversation id take no part. Turns are ordered by number, null first, ties by the turn's digest; a null role or text
is empty; repeated rows are repeated turns. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, join_groups

_EMPTY = hashlib.sha256(b"").hexdigest()
_NODES = "conv_id long, depth long, parent_conv_id long, pb int, pd long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_SHARES = "b int, depth long, pb int, pd long, conv_id long, n_convs long, n_children long, n_leaves long, lcp_tokens long, above long, at int, ends string"


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, seq: each conversation's turns in order, as structs of digest `d` and words `w`."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t)))
    one = F.struct(F.col(turn).alias("t"), digest.alias("d"), F.regexp_count(t, F.lit(WORD)).cast("int").alias("w"))
    own = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), one.alias("one"))
    held = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("s"))
    return held.select("conv_id", F.transform("s", lambda x: F.struct(x["d"].alias("d"), x["w"].alias("w"))).alias("seq"))


def rebuilt(own: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """conv_id, seq: the first `head` turns (`most` at most) of the conversation `base`, then the own turns after the
    first `head`. Both are expressions of conv_id; a base that isn't there gives no turns.
    """
    asked = own.select("conv_id", "seq", base.alias("_base"), head.cast("int").alias("_h"))
    bases = own.select(F.col("conv_id").alias("_base"), F.slice("seq", 1, most).alias("_first"))
    first = F.coalesce(F.slice("_first", F.lit(1), F.col("_h")), F.filter("seq", lambda x: F.lit(False)))
    rest = F.filter("seq", lambda x, i: i >= F.col("_h"))
    return asked.join(bases, "_base", "left").select("conv_id", F.concat(first, rest).alias("seq"))


def _shared(a: Column, b: Column) -> Column:
    """Number of first elements that two arrays share."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(differ == 0, F.least(F.size(a), F.size(b))).otherwise(differ - 1).cast("int")


class _Block:
    """The sorted rows of one block: ids, lengths, running words, and LCPs with the neighbours outside."""

    def __init__(self, batches: Iterable[pa.RecordBatch]) -> None:
        got = list(batches)
        self.n = sum(batch.num_rows for batch in got)
        if not self.n:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        seq, words = table["seq"].chunk(0), table["words"].chunk(0)
        self.block = int(table["b"][0].as_py())
        self.conv = table["conv_id"].to_numpy()
        self.size = seq.value_lengths().to_numpy(zero_copy_only=False).astype("i8")
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        held = seq.flatten()
        self.turns = np.frombuffer(held.buffers()[2], "u8")[2 * _start(held) :][: 2 * len(held)].reshape(-1, 2) if len(held) else np.zeros((0, 2), "u8")
        self.words = np.concatenate(([0], np.cumsum(words.flatten().to_numpy().astype("i8"))))

    def inner(self) -> np.ndarray:
        """LCP of each row with the one before it; the first row's is 0."""
        out = np.zeros(self.n, "i8")
        both = np.minimum(self.size[1:], self.size[:-1])
        if both.sum():
            row = np.repeat(np.arange(1, self.n), both)
            step = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
            same = (self.turns[self.at[row] + step] == self.turns[self.at[row - 1] + step]).all(axis=1)
            first = np.full(self.n, np.iinfo("i8").max)
            np.minimum.at(first, row[~same], step[~same])
            out[1:] = np.minimum(first[1:], both)
        return out

    def before(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Words in the first `depth` turns of each row; none for depths up to 0."""
        return self.words[self.at[row] + np.maximum(depth, 0)] - self.words[self.at[row]]

    def ends(self, a: int, n: int) -> str:
        return ",".join(map(str, self.conv[a : a + n].tolist()))


def _start(binary: pa.Array) -> int:
    """Number of the first 16-byte value in its buffer."""
    return int(np.frombuffer(binary.buffers()[1], "i4")[binary.offset]) // 16


def _tree(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For positions 0 to n of the LCPs: nearest one to the left that isn't larger (-1: none), nearest smaller one to
    the right (n + 1: none), and the leftmost position of the same merged node."""
    n = len(lcp)
    left, right, same, held = np.full(n, -1), np.full(n, n), np.arange(n), []
    values = lcp.tolist()
    for i, value in enumerate(values):
        while held and values[held[-1]] > value:
            right[held.pop()] = i
        if held:
            left[i] = held[-1]
            if values[held[-1]] == value:
                same[i] = same[held[-1]]
        held.append(i)
    return left, right, same


class _Edges:
    """Block minima, pointers from each to the next smaller one on the left, and the LCPs between blocks."""

    def __init__(self, blocks: list[tuple[int, int, int]]) -> None:
        """`blocks`: (number, LCP with the block before, smallest LCP inside), in order."""
        last = max((b for b, _, _ in blocks), default=-1) + 1
        self.enters, self.least, self.smaller, self.next = np.full(last + 1, -1), np.zeros(last, "i8"), np.full(last, -1), np.full(last, last)
        held: list[int] = []
        for k, (b, enters, least) in enumerate(blocks):
            self.enters[b], self.least[b] = enters, min(enters, least)
            while held and self.least[held[-1]] >= self.least[b]:
                held.pop()
            self.smaller[b] = held[-1] if held else -1
            held.append(b)
            if k:
                self.next[blocks[k - 1][0]] = b
        self.previous = dict(zip([b for b, _, _ in blocks[1:]], [b for b, _, _ in blocks], strict=False))

    def starts(self, block: int) -> list[int]:
        """For each depth up to the LCP with the block before: the block in which that node starts."""
        out, at = [], self.previous.get(block, -1)
        for depth in range(int(self.enters[block]), -1, -1):
            while self.least[at] >= depth:
                at = int(self.smaller[at])
            out.append(at)
        return out[::-1]


def _nodes(held: _Block, edges: _Edges, shares: bool) -> Iterator[pa.RecordBatch]:
    n, b = held.n, held.block
    lcp = np.append(held.inner(), edges.enters[edges.next[b]])
    lcp[0] = edges.enters[b]
    left, right, same = _tree(lcp)
    size, conv = held.size, held.conv
    starts = edges.starts(b)
    longer = np.append(size > lcp[:n], False)
    at_lcp = np.append(held.before(np.arange(n), lcp[:n]), 0)
    leaf = np.concatenate(([0], np.cumsum(lcp[1:] < size)))
    tokens = np.concatenate(([0], np.cumsum(at_lcp[:n])))
    begin = np.where(left >= 0, lcp[left], np.iinfo("i8").max) < lcp  # merged nodes that start in this block
    joined = np.bincount(same, weights=longer, minlength=n + 1).astype("i8")  # children that start at an LCP of the node
    rows = np.arange(n)

    def parents(row: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position of the parent's merged node, block where it starts, its depth) of nodes over [row, end)."""
        at = np.where((lcp[row] >= lcp[np.minimum(end, n)]) | (end > n), row, np.minimum(end, n))
        depth = lcp[at]
        inside = (at > 0) & begin[same[at]]
        first = np.array(starts if starts else [-1])
        return same[at], np.where(inside, b, first[np.clip(depth, 0, len(first) - 1)]), depth

    if not shares:
        p = np.flatnonzero(begin & (right <= n) & (np.arange(n + 1) > 0))
        p = p[same[p] == p]
        single = np.flatnonzero(np.maximum(lcp[:n], lcp[1:]) < size)
        row, end = np.concatenate((left[p], single)), np.concatenate((right[p], single + 1))
        deep = np.concatenate((lcp[p], size[single]))
        high = np.maximum(lcp[row], lcp[end])
        smallest = np.append(conv, np.iinfo("i8").max)
        least = np.concatenate((_least(smallest, left[p], right[p]), conv[single]))
        children = np.concatenate((joined[p] + (size[left[p]] > lcp[p]), np.zeros(len(single), "i8")))
        of_node = np.full(n + 1, np.iinfo("i8").max)
        of_node[p] = least[: len(p)]
        up, up_block, up_depth = parents(row, end)
        local = (up > 0) & begin[up] & (right[up] <= n)
        run = np.zeros(n + 1, "i8")  # rows that end where the merged node's first row ends
        np.add.at(run, same, np.append(size == lcp[:n], False))
        digest = np.full(len(row), _EMPTY, object)
        for k in np.flatnonzero(size[row] == deep):
            digest[k] = hashlib.sha256(held.ends(int(row[k]), 1 + (int(run[p[k]]) if k < len(p) else 0)).encode()).hexdigest()
        deals, most = deep - high, 1 << 16
        for a, z in _pieces(deals, most):
            s = np.repeat(np.arange(a, z), deals[a:z])
            depth = high[s] + 1 + np.arange(len(s)) - np.repeat(np.cumsum(deals[a:z]) - deals[a:z], deals[a:z])
            top, bottom, count = depth == high[s] + 1, depth == deep[s], end[s] - row[s]
            shared = tokens[end[s]] - tokens[row[s] + 1] - (count - 1) * held.before(row[s], depth - 1)
            far = top & ~local[s] & (depth > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(least[s]),
                    pa.array(depth),
                    pa.array(np.where(top, of_node[up[s]], least[s]), mask=far | (depth == 0)),
                    pa.array(up_block[s].astype("i4"), mask=~far),
                    pa.array(up_depth[s], mask=~far),
                    pa.array(count),
                    pa.array(np.where(bottom, children[s], 1)),
                    pa.array(leaf[end[s]] - leaf[row[s]]),
                    pa.array(shared),
                    pa.array(np.where(bottom, digest[s], _EMPTY), pa.string()),
                ],
                names=["conv_id", "depth", "parent_conv_id", "pb", "pd", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
            )
        return

    lowest, out = np.minimum.accumulate(lcp[1:]), []
    running = np.minimum.accumulate(conv)
    for depth, source in enumerate(starts):  # nodes that come in from the left
        end = 1 + int(np.searchsorted(-lowest, -depth, side="right"))
        end = min(end, n)
        ending = int(np.argmin(np.append(size[:end] == depth, False)))
        branch = int(((lcp[:end] == depth) & (size[:end] > depth)).sum())
        out.append((source, depth, None, None, int(running[end - 1]), end, branch, int(leaf[end] - leaf[0]), int(tokens[end]), None, held.ends(0, ending) if ending else None))
    p = np.flatnonzero(begin & (right > n) & (np.arange(n + 1) > 0))
    for k in p[same[p] == p].tolist():  # nodes that start here and go out to the right
        row = int(left[k])
        _, up_block, up_depth = (v.tolist()[0] for v in parents(np.array([row]), np.array([n + 1])))
        for depth in range(int(lcp[row]) + 1, int(lcp[k]) + 1):
            bottom = depth == int(lcp[k])
            ending = int((size[row:] == depth).argmin()) if (size[row:] != depth).any() else n - row
            branch = int(size[row] > depth) + (int(joined[k]) if bottom else 0)
            parent = (b, depth - 1) if depth > int(lcp[row]) + 1 else (up_block, up_depth)
            above = int(held.before(np.array([row]), np.array([depth - 1]))[0])
            told = (None, None) if depth == 0 else parent
            out.append((b, depth, *told, int(conv[row:].min()), n - row, branch, int(leaf[n] - leaf[row]), int(tokens[n] - tokens[row + 1]), above, held.ends(row, ending) if ending else None))
    columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 7, pa.string()))]
    yield pa.RecordBatch.from_arrays([*columns[:10], pa.array([b] * len(out), pa.int32()), columns[10]], names=["b", "depth", "pb", "pd", "conv_id", "n_convs", "n_children", "n_leaves", "lcp_tokens", "above", "at", "ends"])


def _least(values: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Smallest value in each [a, z); intervals are nested or apart."""
    if not len(a):
        return np.zeros(0, "i8")
    order = np.argsort(a, kind="stable")
    found = np.minimum.reduceat(values, np.stack((a[order], z[order]), axis=1).ravel())[::2]
    out = np.zeros(len(a), "i8")
    out[order] = found
    return out


def _pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to about `most`."""
    part = np.cumsum(sizes) // most
    edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)])) if len(sizes) else np.array([0])
    yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def trie(convs: DataFrame, turns_per_block: int = 400_000) -> DataFrame:
    """One row for each node (columns as in the query's contract) of conversations (conv_id, seq)."""
    held = convs.select("conv_id", F.transform("seq", lambda x: x["d"]).alias("seq"), F.transform("seq", lambda x: x["w"]).alias("words"))
    total, rows = held.agg(F.sum(F.size("seq")), F.count(F.lit(1))).first()
    blocks = max(1, math.ceil(((total or 0) + rows) / turns_per_block))
    ordered = cut(held.repartitionByRange(blocks, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")).withColumn("b", F.spark_partition_id())

    def minima(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Block(batches)
        if own.n:
            lists = [own.turns[own.at[i] : own.at[i + 1]].tobytes() for i in (0, own.n - 1)]
            cells = [pa.array([[x[j : j + 16] for j in range(0, len(x), 16)]], pa.list_(pa.binary())) for x in lists]
            least = int(own.inner()[1:].min(initial=np.iinfo("i8").max))
            yield pa.RecordBatch.from_arrays([pa.array([own.block], pa.int32()), pa.array([least]), *cells], names=["b", "least", "first", "last"])

    ends = ordered.mapInArrow(minima, "b int, least long, first array<binary>, last array<binary>")
    enters = F.coalesce(_shared(F.lag("last").over(Window.orderBy("b")), F.col("first")), F.lit(-1))
    edges = _Edges([tuple(r) for r in ends.select("b", enters, "least").orderBy("b").collect()])

    def run(kind: bool):  # noqa: ANN202
        def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = _Block(batches)
            if own.n:
                yield from _nodes(own, edges, kind)

        return each

    shares = cut(ordered.mapInArrow(run(True), _SHARES))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "lcp_tokens")]
    over = shares.groupBy("b", "depth").agg(F.min("conv_id").alias("conv_id"), *[F.max(c).alias(c) for c in ("pb", "pd", "above")], *sums)
    over = cut(over.join(_hashed(shares), ["b", "depth"], "left"))
    named = over.select(F.col("b").alias("pb"), F.col("depth").alias("pd"), F.col("conv_id").alias("_parent"))
    saved = F.col("lcp_tokens") - (F.col("n_convs") - 1) * F.col("above")
    wide = over.select("conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "pb", "pd", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
    nodes = ordered.mapInArrow(run(False), _NODES).unionByName(wide)
    found = join_groups(nodes, named, "pb", "pd").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
    return found.drop("pb", "pd", "_parent")


def _hashed(shares: DataFrame) -> DataFrame:
    """b, depth, ends_sha256: the hash over a node's pieces in the order of blocks, one piece in memory at a time."""
    pieces = shares.where(F.col("ends").isNotNull()).select("b", "depth", "at", "ends")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for b, depth, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True):
                if (b, depth) == name:
                    digest.update(b",")
                else:
                    out.append((name, digest.hexdigest()))
                    name, digest = (b, depth), hashlib.sha256()
                digest.update(ends.as_buffer())
            yield _hash_rows(out)
        yield _hash_rows([(name, digest.hexdigest())])

    return pieces.repartition("b", "depth").sortWithinPartitions("b", "depth", "at").mapInArrow(run, "b int, depth long, ends_sha256 string")


def _hash_rows(rows: list) -> pa.RecordBatch:
    own = [(*name, digest) for name, digest in rows if name is not None]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in own], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.string()))], names=["b", "depth", "ends_sha256"])
