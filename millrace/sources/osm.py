"""OpenStreetMap extracts (PBF): ways with their tags, as a data source of byte ranges, and a writer.

A file is a row of blobs, each behind a header; a data blob is on its own (a block of up to 8,000 entities with its own
strings). The source `osm_ways` cuts files into ranges of bytes without reading them: a task looks for the first header
in its range (a candidate counts if the headers that follow it are where they must be), and takes the blobs that begin
in the range. Only the ranges are read, a blob at a time. A condition on the tag's value is pushed to the source: a
block whose strings don't hold the value isn't taken apart. Only ways are read: ids and tags, no nodes, relations or
geometry.
"""

from __future__ import annotations

import lzma
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from millrace.sources.records import opened

# Field numbers of the format.
HEADER_TYPE, HEADER_SIZE = 1, 3
BLOB_RAW, BLOB_SIZE, BLOB_ZLIB, BLOB_LZMA, BLOB_ZSTD = 1, 2, 3, 4, 7
BLOCK_STRINGS, BLOCK_GROUP, GROUP_WAYS = 1, 2, 3
WAY_ID, WAY_KEYS, WAY_VALUES = 1, 2, 3
#: The largest header, entities of a block, and how a data blob's header begins.
MOST_HEADER, BLOCK_ENTITIES, DATA_MARK = 64 << 10, 8_000, b"\x0a\x07OSMData"


def fields(body: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message: integers as they are, all else as bytes."""
    at, end = 0, len(body)

    def integer() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = body[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        key = integer()
        kind = key & 7
        if kind == 0:
            yield key >> 3, integer()
            continue
        size = integer() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, body[at : at + size]
        at += size


def packed(body: bytes) -> list[int]:
    out, value, shift = [], 0, 0
    for byte in body:
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            out.append(value)
            value = shift = 0
    return out


def block(blob: bytes) -> bytes:
    held = dict(fields(blob))
    if BLOB_RAW in held:
        return held[BLOB_RAW]
    if BLOB_ZLIB in held:
        return zlib.decompress(held[BLOB_ZLIB])
    if BLOB_LZMA in held:
        return lzma.decompress(held[BLOB_LZMA])
    if BLOB_ZSTD in held:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(held[BLOB_ZSTD], max_output_size=held.get(BLOB_SIZE, 32 << 20))
    raise ValueError("a blob of an unknown compression")


def ways(blob: bytes, key: str | None = None, wanted: set[str] | None = None) -> Iterator[tuple[int, dict[str, str]]]:
    """(id, tags) of a data blob's ways; of those with the tag `key` only, and only with a wanted value, if given."""
    strings: list[bytes] = []
    groups: list[bytes] = []
    for number, value in fields(block(blob)):
        if number == BLOCK_STRINGS:
            strings = [v for _, v in fields(value)]
        elif number == BLOCK_GROUP:
            groups.append(value)
    known = set(strings)
    if (key is not None and key.encode() not in known) or (wanted is not None and not any(w.encode() in known for w in wanted)):
        return
    for group in groups:
        for number, value in fields(group):
            if number == GROUP_WAYS:
                own = dict(fields(value))
                pairs = zip(packed(own.get(WAY_KEYS, b"")), packed(own.get(WAY_VALUES, b"")), strict=True)
                tags = {strings[k].decode(): strings[v].decode() for k, v in pairs}
                if (key is None or key in tags) and (wanted is None or tags[key] in wanted):
                    yield (own[WAY_ID] ^ 1 << 63) - (1 << 63), tags


def _header(f: pa.NativeFile, at: int, size: int) -> tuple[bytes, int, int] | None:
    """(type, first byte and size of the blob) of the header at this place; None if there is none."""
    if at + 4 > size:
        return None
    f.seek(at)
    (length,) = struct.unpack(">I", f.read(4))
    if not 0 < length <= MOST_HEADER or at + 4 + length > size:
        return None
    try:
        held = dict(fields(f.read(length)))
        kind, body = held[HEADER_TYPE], held[HEADER_SIZE]
    except (KeyError, IndexError, ValueError):
        return None
    if not isinstance(kind, bytes) or not isinstance(body, int) or at + 4 + length + body > size:
        return None
    return kind, at + 4 + length, body


def _is_border(f: pa.NativeFile, at: int, size: int, more: int = 3) -> bool:
    """Whether headers stand here and at the next `more` places where they must be, up to the end."""
    for _ in range(more + 1):
        if at == size:
            return True
        found = _header(f, at, size)
        if found is None:
            return False
        at = found[1] + found[2]
    return True


def _first_border(f: pa.NativeFile, begin: int, end: int, size: int, window: int = 1 << 16) -> int | None:
    """The first header that begins in [begin, end)."""
    if begin == 0:
        return 0
    at = begin
    while at < end:
        f.seek(at)
        body = f.read(min(window + len(DATA_MARK) + 4, size - at))
        found = body.find(DATA_MARK, 4)
        while found >= 0 and found - 4 < window:
            if at + found - 4 < end and _is_border(f, at + found - 4, size):
                return at + found - 4
            found = body.find(DATA_MARK, found + 1)
        at += window
    return None


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int
    size: int


class WayReader(DataSourceReader):
    def __init__(self, path: str, key: str, pattern: str, range_bytes: int) -> None:
        self.path, self.key, self.pattern, self.range_bytes, self.wanted = path, key, pattern, range_bytes, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            own = {f.value} if isinstance(f, EqualTo) and f.attribute == ("value",) else set(f.value) if isinstance(f, In) and f.attribute == ("value",) else None
            if own is None:
                yield f
            else:
                self.wanted = own if self.wanted is None else self.wanted & own

    def partitions(self) -> list[Range]:
        from pyarrow import fs

        store, place = (fs.LocalFileSystem(), "/" + self.path.removeprefix("file:").lstrip("/")) if self.path.startswith(("file:", "/")) else fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(place)
        found = [info] if info.type == fs.FileType.File else [i for i in store.get_file_info(fs.FileSelector(place, recursive=True)) if i.type == fs.FileType.File and fnmatch(i.base_name, self.pattern)]
        head = self.path.split("://")[0] + "://" if "://" in self.path and not self.path.startswith("file:") else ""
        return [Range(head + i.path, a, min(a + self.range_bytes, i.size), i.size) for i in sorted(found, key=lambda i: i.path) for a in range(0, i.size, self.range_bytes)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        with opened(part.path) as f:
            at = _first_border(f, part.begin, part.end, part.size)
            while at is not None and at < part.end:
                kind, start, length = _header(f, at, part.size)
                if kind == b"OSMData":
                    f.seek(start)
                    found = list(ways(f.read(length), self.key, self.wanted))
                    if found:
                        tags = pa.array([list(t.items()) for _, t in found], pa.map_(pa.string(), pa.string()))
                        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([t[self.key] for _, t in found], pa.string()), tags], names=["id", "value", "tags"])
                at = start + length


class WaySource(DataSource):
    """`path` (a file or folder), `key` (the tag that a way must have), `pattern` of file names, `rangeBytes`."""

    @classmethod
    def name(cls) -> str:
        return "osm_ways"

    def schema(self) -> str:
        return "id long, value string, tags map<string,string>"

    def reader(self, schema: object) -> WayReader:
        return WayReader(self.options["path"], self.options.get("key", "power"), self.options.get("pattern", "*.pbf"), int(self.options.get("rangeBytes", 64 << 20)))


def read_ways(spark: SparkSession, path: str, key: str = "power", value: str = "substation", range_bytes: int = 64 << 20) -> DataFrame:
    """(id, <key>, tags map): the ways with that tag, of a file or of the *.pbf files of a folder; a file without one
    gives no rows. Files are read in ranges of about `range_bytes`, whatever their size."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WaySource)
    found = spark.read.format("osm_ways").option("key", key).option("rangeBytes", range_bytes).load(path)
    return found.where(F.col("value") == value).select("id", F.col("value").alias(key), "tags")


def _number(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, value: int | bytes) -> bytes:
    if isinstance(value, int):
        return _number(number << 3) + _number(value)
    return _number(number << 3 | 2) + _number(len(value)) + value


def way_blob(found: list[tuple[int, dict[str, str]]]) -> bytes:
    """A data blob, with its header, of ways (ids from 0 up, tags)."""
    place: dict[bytes, int] = {b"": 0}
    group = b""
    for i, tags in found:
        pairs = [(place.setdefault(k.encode(), len(place)), place.setdefault(v.encode(), len(place))) for k, v in tags.items()]
        own = _field(WAY_ID, i % (1 << 64)) + _field(WAY_KEYS, b"".join(_number(k) for k, _ in pairs)) + _field(WAY_VALUES, b"".join(_number(v) for _, v in pairs))
        group += _field(GROUP_WAYS, own)
    body = _field(BLOCK_STRINGS, b"".join(_field(1, s) for s in place)) + _field(BLOCK_GROUP, group)
    blob = _field(BLOB_SIZE, len(body)) + _field(BLOB_ZLIB, zlib.compress(body))
    head = _field(HEADER_TYPE, b"OSMData") + _field(HEADER_SIZE, len(blob))
    return struct.pack(">I", len(head)) + head + blob


def write_ways(rows: DataFrame, path: str, id_: str = "id", tags: str = "tags") -> None:
    """Ways as <path>/part-<partition>.pbf files of blobs; a task that runs again writes its file anew."""
    from pyarrow import fs

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        local = path.startswith(("file:", "/"))
        store, base = (fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")) if local else fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        n, held = 0, []
        with store.open_output_stream(f"{base}/part-{TaskContext.get().partitionId():05d}.pbf") as out:
            for batch in batches:
                held += [(i, dict(t or [])) for i, t in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
                while len(held) >= BLOCK_ENTITIES:
                    out.write(way_blob(held[:BLOCK_ENTITIES]))
                    n, held = n + BLOCK_ENTITIES, held[BLOCK_ENTITIES:]
            if held:
                out.write(way_blob(held))
        yield pa.RecordBatch.from_arrays([pa.array([n + len(held)])], names=["n"])

    rows.select(id_, tags).mapInArrow(write, "n long").agg(F.sum("n")).collect()


def expanded(found: DataFrame, keys: tuple[str, ...], prefix: str = "tag::") -> DataFrame:
    """The named tags as columns under the prefix, in place of the map."""
    rest = [c for c in found.columns if c != "tags"]
    return found.select(*rest, *[F.try_element_at("tags", F.lit(k)).alias(f"{prefix}{k}") for k in keys])
