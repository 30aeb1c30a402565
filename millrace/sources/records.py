"""CSV records and elements of JSON arrays in files of any size, read in ranges: each may go over any border.

Files are read as lines by Spark's text reader, which cuts large files into blocks, whatever the store. Whether a block
begins inside quotes can't be seen from it, so each block is scanned once for both cases (its end state and number of
records for either); these small tables are composed along each file, and then every block knows its state and its
first record's number. A second reading takes the records; pieces of those that go over a block's edge meet by number.
JSON arrays are read in the same way, where the state is the depth of brackets.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A cell may be as long as a row of Spark, 2 GB.
CELL = (1 << 31) - 1
_MARK = b"\xef\xbb\xbf"
_TO_QUOTE, _FIELD = re.compile(rb'(?:[^"]|"")*+"(?!")'), re.compile(rb"[^,\r]*")
_ROWS = 10_000


def pieces(line: bytes, quoted: bool) -> Iterator[tuple[bytes, bool]]:
    """A line (without its line end) in pieces, and after each whether it ends inside quotes.

    A piece ends at the line's end or behind a carriage return outside quotes. Quotes count at the start of a field.
    """
    if b'"' not in line and (quoted or b"\r" not in line):
        yield line + b"\n", quoted
        return
    at = begin = 0
    while True:
        if not quoted and at < len(line) and line[at] == 34:
            quoted, at = True, at + 1
        if quoted:
            end = _TO_QUOTE.match(line, at)
            if end is None:
                yield line[begin:] + b"\n", True
                return
            quoted, at = False, end.end()
        at = _FIELD.match(line, at).end()
        if at < len(line) and line[at] == 44:
            at += 1
            continue
        if line[at + 1 :]:  # behind a carriage return
            yield line[begin : at + 1], False
            begin = at = at + 1
            continue
        yield line[begin:] + b"\n", False
        return


def lines(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path, block (its first byte), line: a task has each of its blocks' lines in order."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, lineSep="\n")
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def _by_block(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """Runs of lines with equal keys; a run has to be read before the next one is asked for."""
    rows = ((tuple(k), line) for batch in batches for *k, line in zip(*[batch.column(c).to_pylist() for c in keys], batch.column("line").to_pylist(), strict=True))
    head = next(rows, None)

    def run(key: tuple) -> Iterator[bytes]:
        nonlocal head
        first = key[1] == 0
        while head is not None and head[0] == key:
            line, first, head = head[1].removeprefix(_MARK) if first else head[1], False, next(rows, None)
            yield line

    while head is not None:
        yield head[0], run(head[0])


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block and each state at its start: the state at its end and the number of records that start in it."""
    for (path, block), own in _by_block(batches, ("path", "block")):
        state, count = [False, True], [0, 0]
        for line in own:
            same = state[0] == state[1]
            for i in (0, 1):
                if not (i and same):
                    more, after = 0, state[i]
                    for _, ends in pieces(line, after):
                        more, after = more + (not after), ends
                state[i], count[i] = after, count[i] + more
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (path, block, *state, *count)], names=["path", "block", "plain_end", "quoted_end", "plain_n", "quoted_n"])


def _composed(blocks: pd.DataFrame) -> pd.DataFrame:
    """The blocks of one file, in order: whether each begins inside quotes, and the number of records before it."""
    quoted, before, out = False, 0, []
    for b in blocks.sort_values("block").itertuples():
        out.append((b.path, b.block, quoted, before))
        quoted, before = (b.quoted_end, before + b.quoted_n) if quoted else (b.plain_end, before + b.plain_n)
    return pd.DataFrame(out, columns=["path", "block", "quoted", "before"])


def _parsed(body: bytes) -> list[list[str]]:
    csv.field_size_limit(CELL)
    return list(csv.reader(io.StringIO(body.decode("utf-8", "replace"), newline="")))


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records with their cells; parts of others with their bytes."""
    for (path, block, quoted, before), own in _by_block(batches, ("path", "block", "quoted", "before")):
        held, whole, size, at, open_ = [], 0, 0, before - quoted, quoted
        for line in own:
            for piece, ends in pieces(line, open_):
                held.append(piece)
                size, open_ = size + len(piece), ends
                if not ends:
                    if quoted:  # the end of a record that an earlier block began
                        yield _rows(path, at, block, [None], [b"".join(held)])
                        at, held, size, quoted = at + 1, [], 0, False
                    whole = len(held)
            if whole and (whole >= _ROWS or size > 1 << 22):
                found = _parsed(b"".join(held[:whole]))
                yield _rows(path, at, block, found, [None] * len(found))
                at, held, whole, size = at + len(found), held[whole:], 0, 0
        if whole:
            found = _parsed(b"".join(held[:whole]))
            yield _rows(path, at, block, found, [None] * len(found))
            at, held = at + len(found), held[whole:]
        if held:
            yield _rows(path, at, block, [None], [b"".join(held)])


def _rows(path: str, at: int, block: int, cells: list, parts: list) -> pa.RecordBatch:
    n = len(cells)
    columns = ([path] * n, range(at, at + n), [block] * n, cells, parts)
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "row_no", "block", "cells", "part"])


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, at, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            quoted = False
            for line in body.split(b"\n")[:-1]:
                for _, quoted in pieces(line, quoted):  # noqa: B020
                    pass
            found = _parsed(body[:-1] if quoted else body)
            yield _rows(path, at, 0, found, [None] * len(found)).select(["path", "row_no", "cells"])


def read_records(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(path, row_no, cells): each record of each file, whatever its width, its length and the blocks it lies in.

    A blank line is a record without cells. A quoted cell that is never closed ends before the file's last line end. Bytes that aren't UTF-8 are replaced, a byte order mark is left out. One row
    for each block of a file is broadcast (about 100 bytes).
    """
    text = lines(spark, root, pattern)
    scanned = text.mapInArrow(_scan, "path string, block long, plain_end boolean, quoted_end boolean, plain_n long, quoted_n long")
    known = scanned.groupBy("path").applyInPandas(_composed, "path string, block long, quoted boolean, before long")
    found = text.join(F.broadcast(known), ["path", "block"]).mapInArrow(_records, "path string, row_no long, block long, cells array<string>, part binary")
    whole = found.where(F.col("part").isNull()).select("path", "row_no", "cells")
    parts = found.where(F.col("part").isNotNull()).groupBy("path", "row_no").agg(F.array_sort(F.collect_list(F.struct("block", "part"))).alias("p"))
    body = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["part"]))
    return whole.union(parts.select("path", "row_no", body.alias("body")).mapInArrow(_joined, "path string, row_no long, cells array<string>"))


def first_records(spark: SparkSession, root: str, pattern: str = "*.csv", most: int = 4, first: int = 1 << 16) -> DataFrame:
    """(path, row_no, cells): the first `most` records of each file, of which only so many bytes are read.

    The first `first` bytes are read, and twice as many again while they don't hold the records. Files are listed by
    Spark and opened in its tasks by the store's own client (local paths, or schemes that Arrow knows).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length")

    def heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                with opened(path) as f:
                    cells = _first(f, length, most, first)
                yield _rows(path, 0, 0, cells, [None] * len(cells)).select(["path", "row_no", "cells"])

    return files.mapInArrow(heads, "path string, row_no long, cells array<string>")


def _first(f: pa.NativeFile, length: int, most: int, size: int) -> list[list[str]]:
    while size < length:
        f.seek(0)
        held, ends, quoted = [], [], False
        for line in f.read(size).removeprefix(_MARK).split(b"\n")[:-1]:
            for piece, after in pieces(line, quoted):
                held.append(piece)
                quoted = after
                if not quoted:
                    ends.append(len(held))
        if len(ends) >= most:
            return _parsed(b"".join(held[: ends[most - 1]]))
        size *= 2
    f.seek(0)
    return _parsed(f.read(length).removeprefix(_MARK))[:most]


def opened(path: str) -> pa.NativeFile:
    """A file for ranged reads, by Arrow's file systems."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, place = fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


_JSON_STRING, _JSON_MARK = re.compile(rb'"(?:[^"\\]|\\.)*+"'), re.compile(rb"[\[\]{},]")


def _marks(line: bytes) -> Iterator[tuple[int, int]]:
    """(place, mark) of each bracket and comma outside strings; a string never goes over a line's end."""
    blank = _JSON_STRING.sub(lambda m: b" " * len(m[0]), line) if b'"' in line else line
    for m in _JSON_MARK.finditer(blank):
        yield m.start(), line[m.start()]


def _scan_json(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block: by how much the depth changes, and the number of commas at each depth, from the block's start."""
    for (path, block), own in _by_block(batches, ("path", "block")):
        depth, commas = 0, {}
        for line in own:
            for _, mark in _marks(line):
                if mark == 44:
                    commas[depth] = commas.get(depth, 0) + 1
                else:
                    depth += 1 if mark in b"[{" else -1
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([block]), pa.array([depth]), pa.array([list(commas.items())], pa.map_(pa.int64(), pa.int64()))], names=["path", "block", "change", "commas"])


def _composed_json(blocks: pd.DataFrame) -> pd.DataFrame:
    """The blocks of one file, in order: the depth at each one's start, and the number of the element that goes on there."""
    depth, before, out = 0, 0, []
    for b in blocks.sort_values("block").itertuples():
        out.append((b.path, b.block, depth, before))
        before += dict(b.commas).get(1 - depth, 0)
        depth += b.change
    return pd.DataFrame(out, columns=["path", "block", "depth", "before"])


def _elements(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of the outer array: whole ones, and parts of those that go over the block's edge."""
    for (path, block, depth, at), own in _by_block(batches, ("path", "block", "depth", "before")):
        held, begun, out = [], False, []  # text of the element so far; whether it began here
        for line in own:
            last = 0
            for place, mark in _marks(line):
                if mark in b"[{":
                    depth += 1
                    if depth == 1:
                        last, begun = place + 1, True
                elif mark == 44 and depth == 1:
                    out.append((at, begun, b"".join([*held, line[last:place]])))
                    at, last, held, begun = at + 1, place + 1, [], True
                elif mark != 44:
                    depth -= 1
                    if depth == 0:
                        out.append((at, begun, b"".join([*held, line[last:place]])))
                        last, held = len(line), []
            if depth:
                held.append(line[last:] + b"\n")
            if len(out) >= _ROWS:
                yield _element_rows(path, block, out)
                out = []
        if depth and held:
            out.append((at, False, b"".join(held)))
        yield _element_rows(path, block, out)


def _element_rows(path: str, block: int, out: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
    columns = ([path] * len(out), [n for n, _, _ in out], [block] * len(out), [w for _, w, _ in out], [b for _, _, b in out])
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "row_no", "block", "whole", "part"])


def read_elements(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """(path, row_no, element): the elements, as JSON texts, of files that each hold one array, read in ranges.

    Files are cut at line ends, so an array on one line is one task's. An empty array has no elements.
    """
    text = lines(spark, root, pattern)
    scanned = text.mapInArrow(_scan_json, "path string, block long, change long, commas map<long,long>")
    known = scanned.groupBy("path").applyInPandas(_composed_json, "path string, block long, depth long, before long")
    found = text.join(F.broadcast(known), ["path", "block"]).mapInArrow(_elements, "path string, row_no long, block long, whole boolean, part binary")
    parts = found.where(~F.col("whole")).groupBy("path", "row_no").agg(F.array_sort(F.collect_list(F.struct("block", "part"))).alias("p"))
    body = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["part"]))
    every = found.where("whole").select("path", "row_no", F.col("part").alias("b")).union(parts.select("path", "row_no", body))
    element = F.regexp_replace(F.col("b").cast("string"), r"^\s+|\s+$", "")
    return every.select("path", "row_no", element.alias("element")).where(F.col("element") != "")
