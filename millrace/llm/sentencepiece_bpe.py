"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

A text's symbols are its characters after the model's own normalisation. An agenda holds the neighbours whose joint
text is a piece, best score first, ties to the left; merging two symbols puts the new neighbours on it, and entries
whose symbols have changed since are passed over. What is no piece in the end becomes byte pieces, or the unknown id.
Where no piece has a blank after another character (read from the vocabulary), no merge crosses such a place, so texts
are taken apart there and each distinct part is merged once for a worker (`CACHE` parts are kept, the others are
merged again). Every batch is checked against the sentencepiece library: ids and texts must be equal.

Texts are whole at any length. A null text is empty: it has only the ids around it. Rows that repeat are rows. The
model file's path is read by each worker; nothing of it is sent.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, small_batches

#: The blank's stand-in in pieces, the text of the unknown id (fixed values); parts that a worker remembers, and their
#: length at most; the place of a score that isn't there.
BLANK, UNKNOWN, CACHE, SHORT, NONE = "▁", " ⁇ ", 600_000, 32, np.iinfo("i4").max
SILENT, ODD = 1, 2


class Pieces:
    """A merge-type vocabulary: encode and decode by its pieces and scores."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, n = self.library, self.library.vocab_size()
        self.text = [lib.id_to_piece(i) for i in range(n)]
        self.shown = [t.replace(BLANK, " ") for t in self.text]
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        self.ids = {self.text[i]: i for i in plain}
        if any(lib.is_unused(i) for i in plain):
            raise ValueError("vocabularies with unused pieces aren't supported")
        self.order = {self.text[i]: -lib.get_score(i) for i in plain}
        self.bytes = {int(self.text[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.silent = {i for i in range(n) if lib.is_control(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        low = {i for i, b in self.byte_of.items() if b < 128}  # characters on their own, whatever stands beside them
        self.kinds = np.array([SILENT if i in self.silent else ODD if lib.is_unknown(i) or (i in self.byte_of and i not in low) else 0 for i in range(n)], "u1")
        self.table = np.array(["" if i in self.silent else chr(self.byte_of[i]) if i in low else t for i, t in enumerate(self.shown)], object)
        self.part = _parts(self.ids)
        self._pairs()
        self.known: dict[str, bytes] = {}

    def merged(self, part: str) -> list[str]:
        """The symbols that are left when the agenda is empty."""
        order, n = self.order.get, len(part)
        agenda = [(found, i, i + 1, part[i : i + 2]) for i in range(n - 1) if (found := order(part[i : i + 2])) is not None]
        symbols = list(part)
        if not agenda:
            return symbols
        heapq.heapify(agenda)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        while agenda:
            _, left, right, both = heapq.heappop(agenda)
            if after[left] != right or len(symbols[left]) + len(symbols[right]) != len(both):
                continue
            far = after[right]
            symbols[left], symbols[right], after[left], after[right] = both, "", far, -2
            if far >= 0:
                before[far] = left
                joint = both + symbols[far]
                if (found := order(joint)) is not None:
                    heapq.heappush(agenda, (found, left, far, joint))
            near = before[left]
            if near >= 0:
                joint = symbols[near] + both
                if (found := order(joint)) is not None:
                    heapq.heappush(agenda, (found, near, left, joint))
        return [s for s in symbols if s]

    def _pairs(self) -> None:
        """Sorted pairs of symbols (a piece's id, or the number of ids and a character's code) that make a piece, with
        the places of their scores and the pieces."""
        place = {v: i for i, v in enumerate(sorted(set(self.order.values())))}
        self.symbol = {c: self.ids.get(c, len(self.text) + ord(c)) for c in {c for t in self.ids for c in t}}
        found = []
        for t, i in self.ids.items():
            for k in range(1, len(t)):
                left, right = (self.ids.get(x, self.symbol[x] if len(x) == 1 else None) for x in (t[:k], t[k:]))
                if left is not None and right is not None:
                    found.append((left << 21 | right, place[self.order[t]], i))
        table = np.array([*sorted(found), (np.iinfo("i8").max, NONE, 0)], "i8")
        self.keys, self.places, self.made = np.ascontiguousarray(table[:, 0]), table[:, 1].astype("i4"), table[:, 2].copy()

    def _joint(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the pair's score (NONE: no piece, or a side that is no symbol, -1) and the pair's number."""
        key = left << 21 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.places[at], NONE), at

    def _merged_parts(self, parts: list[str]) -> None:
        """part_ids() of many short parts at once: in each round every part takes the best pair of its agenda."""
        n, ids = len(parts), len(self.text)
        size = np.array([len(p) for p in parts])
        wide = int(size.max()) + 1
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        kinds, which = np.unique(codes, return_inverse=True)
        symbols = np.full((n, wide), -1, "i8")
        symbols[np.arange(wide) < size[:, None]] = np.array([self.symbol.get(chr(c), ids + c) for c in kinds.tolist()], "i8")[which]
        agenda, pair = np.full((n, wide), NONE, "i4"), np.zeros((n, wide), "i4")
        agenda[:, :-1], pair[:, :-1] = self._joint(symbols[:, :-1], symbols[:, 1:])
        after = np.tile(np.arange(1, wide + 1, dtype="i4"), (n, 1))
        before = np.tile(np.arange(-1, wide - 1, dtype="i4"), (n, 1))
        row = np.arange(n)
        while len(row):
            best = agenda[row].argmin(axis=1)
            open_ = agenda[row, best] != NONE
            row, left = row[open_], best[open_]
            right = after[row, left]
            own = symbols[row, left] = self.made[pair[row, left]]
            symbols[row, right], agenda[row, right] = -1, NONE
            far = np.minimum(after[row, right], wide - 1)  # the last place is never a symbol
            after[row, left], before[row, far] = far, left
            agenda[row, left], pair[row, left] = self._joint(own, symbols[row, far])
            near = before[row, left]
            inner = near >= 0
            some, near = row[inner], near[inner]
            agenda[some, near], pair[some, near] = self._joint(symbols[some, near], own[inner])
        held = symbols >= 0
        whole = symbols[held]
        ends, odd = np.cumsum(held.sum(axis=1)).tolist(), (symbols >= ids).any(axis=1).tolist()
        body, last = whole.astype("<u4").tobytes(), 0
        for part, end, strange in zip(parts, ends, odd, strict=True):
            if strange:  # characters that are no pieces
                self.part_ids(part)
            else:
                self.known[part] = body[4 * last : 4 * end]
            last = end

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """encode() of many texts."""
        if len(self.known) >= CACHE:
            self.known.clear()
        parts = [self.part.findall(self.library.normalize(t)) for t in texts]
        found = [list(map(self.known.get, own)) for own in parts]
        new = {p for own, ids in zip(parts, found, strict=True) if None in ids for p, i in zip(own, ids, strict=True) if i is None and len(p) <= SHORT}
        new = sorted(new, key=len)
        for a in range(0, len(new), 8192):
            self._merged_parts(new[a : a + 8192])
        return [self._joined(own, ids) for own, ids in zip(parts, found, strict=True)]

    def part_ids(self, part: str) -> bytes:
        out: list[int] = []
        for symbol in self.merged(part):
            own = self.ids.get(symbol)
            if own is not None:
                out.append(own)
            elif self.bytes:
                out.extend([self.bytes[b] for b in symbol.encode()])
            else:
                out.append(self.library.unk_id())
        found = array("I", out).tobytes()
        if len(part) <= SHORT:
            self.known[part] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit integers."""
        parts = self.part.findall(self.library.normalize(text))
        return self._joined(parts, list(map(self.known.get, parts)))

    def _joined(self, parts: list[str], found: list[bytes | None]) -> bytes:
        out = b"".join([f if f is not None else self.known.get(p) or self.part_ids(p) for f, p in zip(found, parts, strict=True)] if None in found else found)
        if not self.bytes:  # neighbouring unknown symbols are one
            ids, unknown = np.frombuffer(out, "u4"), self.library.unk_id()
            out = ids[np.append(True, (ids[1:] != unknown) | (ids[:-1] != unknown))[: len(ids)]].tobytes()
        return out

    def decode_all(self, texts: list[np.ndarray]) -> list[str]:
        """decode() of many texts; most have no odd pieces and are joined from a table."""
        out = []
        for ids in texts:
            kind = self.kinds[ids]
            if kind[1:-1].any() or len(ids) < 3 or kind[0] == ODD or kind[-1] == ODD:
                out.append(self.decode(ids.tolist()))
            else:
                whole = "".join(self.table[ids].tolist())
                out.append(whole[1:] if whole[:1] == " " and (ids[1] if kind[0] else ids[0]) not in self.byte_of else whole)
        return out

    def decode(self, ids: list[int]) -> str:
        """Pieces with their blanks, less one blank before the first; byte pieces as UTF-8, each byte that isn't part of
        a character as U+FFFD; control pieces are silent."""
        text, silent, byte_of, unknown = self.shown, self.silent, self.byte_of, self.library.unk_id()
        out: list[str] = []
        held, first = bytearray(), True
        for i in ids:
            if i in byte_of:
                held.append(byte_of[i])
                continue
            if held:
                out.append(_characters(bytes(held)))
                held, first = bytearray(), False
            if i in silent:
                continue
            if i == unknown:
                out.append(UNKNOWN)
            elif first and text[i][:1] == " ":
                out.append(text[i][1:])
            else:
                out.append(text[i])
            first = False
        if held:
            out.append(_characters(bytes(held)))
        return "".join(out)


def _parts(pieces: Iterable[str]) -> re.Pattern:
    """Parts of a normalised text that no merge leaves: blanks, and after them characters of one group."""
    group: dict[str, str] = {}

    def top(c: str) -> str:
        while group.setdefault(c, c) != c:
            c = group[c]
        return c

    for piece in pieces:
        own = piece.lstrip(BLANK)
        if BLANK in own:
            return re.compile(r"(?s).+")
        for a, b in zip(own, own[1:], strict=False):
            group[top(a)] = top(b)
    classes: dict[str, list[str]] = {}
    for c in list(group):
        classes.setdefault(top(c), []).append(c)
    each = [f"{BLANK}*[{''.join(map(re.escape, sorted(own)))}]+" for own in sorted(classes.values(), key=len, reverse=True)]
    return re.compile("|".join([*each, f"{BLANK}*[^{BLANK}]", f"{BLANK}+"]))


def _characters(body: bytes) -> str:
    out = ""
    while body:
        try:
            return out + body.decode()
        except UnicodeDecodeError as e:
            out, body = out + body[: e.start].decode() + "\ufffd", body[e.start + 1 :]
    return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _same(found: list, wanted: list, what: str) -> None:
    for own, other in zip(found, wanted, strict=True):
        if own != other:
            raise ValueError(f"{what} differs from the library's: {own!r:.200} is not {other!r:.200}")


def encoded(docs: DataFrame, text: Column, model: str, decode: bool = False, begin: bool = True, end: bool = True) -> DataFrame:
    """The docs as struct `row` and `ids`: little-endian unsigned 32-bit ids in one binary, with the model's begin and
    end ids around them if asked; with `decode` also `decoded`, the text that these ids give."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()), *([T.StructField("decoded", T.StringType())] if decode else [])])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        lib = own.library
        head, tail = (np.array([i] * asked, "<u4").tobytes() for i, asked in ((lib.bos_id(), begin), (lib.eos_id(), end)))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = [head + i + tail for i in own.encode_all(texts)]
            wanted = lib.encode(texts, add_bos=begin, add_eos=end, num_threads=1, out_type="numpy")
            _same(ids, [i.tobytes() for i in wanted], "an encoding")
            out = [batch.column(0), pa.array(ids, pa.binary())]
            if decode:
                back = own.decode_all(wanted)
                _same(back, lib.decode(wanted, num_threads=1), "a text")
                out.append(pa.array(back, pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)
        give_back()

    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, ids: Column, model: str) -> DataFrame:
    """The rows as struct `row` and `text` of their ids (as encoded() gives them; null: none). Ids beyond the
    vocabulary raise an error when run."""
    small_batches(rows.sparkSession)
    held = rows.select(F.struct("*").alias("row"), F.coalesce(ids, F.lit(b"")).alias("ids"))
    schema = T.StructType([held.schema["row"], T.StructField("text", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            asked = [np.frombuffer(b, "<u4") for b in batch.column(1).to_pylist()]
            back = own.decode_all(asked)
            _same(back, own.library.decode([i.tolist() for i in asked], num_threads=1) if asked else [], "a text")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(back, pa.string())], names=schema.names)
        give_back()

    return held.mapInArrow(run, schema)
