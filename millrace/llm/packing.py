"""Best-fit packing with certified bin counts.

Documents are tokenized whole; only a document longer than the capacity is cut into pieces. Pieces are dealt at
random into partitions of about `part_rows`; each partition is packed by best-fit decreasing, and dual-feasible
functions give a lower bound of the sequences it needs. A partition whose count equals its bound is certified. The
others have gaps: they put the documents of their least filled sequences into an exchange with up to `fan_in`
neighbours, where best-fit decreasing runs again, and so on until one group is left. A rerun that needs as many
sequences as before is discarded. (A certified partition offers its one least filled sequence, as the bound of the
union can be lower than the sum of the bounds.)

Only piece lengths are needed to pack: drop the ids column first if the ids themselves aren't wanted downstream.

Defined cases: null or empty text is the end id alone; rows with equal ids are packed each on its own; an empty table
gives an empty result; a length that isn't in 1..capacity raises ValueError; other columns, whatever their names, are
carried along under `row`.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucket_count, cut, give_back, small_batches

#: Words for which the pre-tokenizer's rule can be applied here: ASCII and the letters of Latin-1.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: The pre-tokenizer's pattern of word_bpe_49k.json for such words, after lower-casing. (fixed value)
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


@cache
def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Words(dict):
    """Word -> ids, found at the first lookup; `held` is about the bytes that it takes."""

    def __init__(self, find: Callable[[str | bytes], bytes]) -> None:
        self.find, self.held = find, 0

    def __missing__(self, word: str | bytes) -> bytes:
        ids = self[word] = self.find(word)
        self.held += 180 + len(word) + len(ids)
        return ids

    def forget(self, most: int) -> None:
        if self.held > most:
            self.clear()
            self.held = 0


class WordTokenizer:
    """ids(text) as the tokenizer file gives them, found word by word.

    The file drops white space and never joins across it, so a text's ids are its words' ids in a row. Words are
    remembered, which is many times faster than whole texts; when they take over `most` bytes all are forgotten before
    the next text. A Python worker keeps one tokenizer for all of its tasks (see _worker_tokenizer), and no words.
    """

    def __init__(self, path: str, most: int = 80 << 20) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model, self.letter = self.whole.model, _byte_letters().__getitem__
        self.most, self.words, self.parts = most, _Words(self._word), _Words(self._part)

    def _part(self, part: str) -> bytes:
        spelt = part if part.isascii() else "".join(map(self.letter, part.encode()))
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        if len(word) <= 200:  # ASCII letters, with a mark behind them: the rule below, in short
            if word.isalpha():
                return self.parts[word.lower().decode()]
            if word[-1:] in b".,;:!?" and word[:-1].isalpha():
                return self.parts[word[:-1].lower().decode()] + self.parts[word[-1:].decode()]
        text = word.decode("utf-8", "replace")
        if len(text) <= 200 and _PLAIN.fullmatch(text) and "<|" not in text:
            low = text.lower()
            return self.parts[low] if low.isalpha() else b"".join([self.parts[p] for p in _PARTS.findall(low)])
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def forget(self, most: int = -1) -> None:
        self.words.forget(most)
        self.parts.forget(most)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (UTF-8)."""
        out, ids = [], self.words.__getitem__
        for t in texts:
            self.forget(self.most)
            out.append(b"".join(map(ids, t.split())))
        return out


@cache
def _worker_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _chunks(texts: list[bytes | None], size: int = 4_000_000) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t or b"")
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def token_pieces(docs: DataFrame, tokenizer_path: str, text: str = "text", key: tuple[str, ...] = ("doc_id",), capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Columns: row (struct of the key), piece int, start long, length long, ids binary (little-endian unsigned 32-bit)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*key).alias("row"), F.col(text).cast("binary").alias("_text"))
    schema = T.StructType([rows.schema["row"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _worker_tokenizer(tokenizer_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _chunks(texts):
                at, piece, ids = [], [], []
                for i, got in enumerate(tokenizer.encode([t or b"" for t in texts[a:b]]), a):
                    got += end
                    for k in range(0, len(got), step):
                        at.append(i)
                        piece.append(k // step)
                        ids.append(got[k : k + step])
                number = pa.array(piece, pa.int32())
                lengths = np.array([len(x) // 4 for x in ids], "i8")
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), number, pa.array(np.array(piece, "i8") * capacity), pa.array(lengths), pa.array(ids, pa.binary())], names=schema.names)
        tokenizer.forget()
        give_back()

    return rows.mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: longest first, into the open bin that it fills best."""
    bins, offsets = np.empty(len(lengths), "i8"), np.empty(len(lengths), "i8")
    free: dict[int, list[int]] = {}
    mask = count = 0
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        if fits := mask >> size:
            room = size + (fits & -fits).bit_length() - 1
            own = free[room]
            b = own.pop()
            if not own:
                mask ^= 1 << room
        else:
            b, room = count, capacity
            count += 1
        bins[i], offsets[i] = b, capacity - room
        if room := room - size:
            free.setdefault(room, []).append(b)
            mask |= 1 << room
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest of the bounds that three families of dual-feasible functions give.

    The identity; for each threshold t <= capacity / 2 the function that raises sizes over capacity - t to the
    capacity and drops sizes under t; and the rounding functions floor((k + 1) x / capacity) / k.
    """
    if not len(lengths):
        return 0
    size = np.arange(capacity + 1)
    have = np.bincount(lengths, minlength=capacity + 1)
    total, mass = np.cumsum(have), np.cumsum(have * size)
    best = -(-int(mass[-1]) // capacity)
    t = np.arange(1, capacity // 2 + 1)
    raised = (total[-1] - total[capacity - t]) * capacity + mass[capacity - t] - mass[t - 1]
    best = max(best, -(-int(raised.max(initial=0)) // capacity))
    for k in range(1, 33):
        whole, rest = np.divmod((k + 1) * size, capacity)
        exact = np.where(rest == 0, size * k, whole * capacity)  # times capacity * k
        best = max(best, -(-int((have * exact).sum()) // (capacity * k)))
    return best


def _pack(lengths: np.ndarray, capacity: int, before: pd.DataFrame | None) -> dict[str, np.ndarray]:
    if len(lengths) and not 1 <= int(lengths.min()) <= int(lengths.max()) <= capacity:
        raise ValueError(f"lengths must be in 1..{capacity}")
    bins, offsets = best_fit_decreasing(lengths, capacity)
    count = int(bins.max(initial=-1)) + 1
    if before is not None:
        old = before.groupby(["_seq"], sort=False).ngroup().to_numpy()
        if count >= (most := int(old.max(initial=-1)) + 1):
            bins, offsets, count = old, before["offset"].to_numpy(), most
    bound = lower_bound(lengths, capacity)
    slack = capacity - np.bincount(bins, weights=lengths, minlength=count).astype("i8")
    offer = 1 if count == bound else max(8, count // 50)
    open_ = np.zeros(count, bool)
    open_[np.argsort(-slack, kind="stable")[:offer]] = True
    open_ &= slack > 0
    return {"_bin": bins, "offset": offsets, "_open": open_[bins]}


def _repacker(capacity: int, turn: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def repack(group: pd.DataFrame) -> pd.DataFrame:
        got = _pack(group["_length"].to_numpy("i8"), capacity, group if turn else None)
        seq = (np.int64(turn) << 58) | (group["_part"].to_numpy("i8") << 28) | got["_bin"]
        return pd.DataFrame({"_row": group["_row"], "_length": group["_length"], "_part": group["_part"], "_seq": seq, "offset": got["offset"], "_open": got["_open"] & (not last)})

    return repack


def pack(pieces: DataFrame, length: str = "length", capacity: int = 2048, part_rows: int = 20_000, fan_in: int = 16) -> DataFrame:
    """Columns: row (struct of the pieces' columns), sequence_id long, offset long. `pieces` goes to the checkpoint folder first."""
    rows = cut(pieces.select(F.struct("*").alias("row"), F.col(length).cast("long").alias("_length"))).withColumn("_row", F.monotonically_increasing_id())
    parts = bucket_count(rows.count(), part_rows, 1 << 22)
    state = rows.select("_row", "_length", F.pmod(F.xxhash64("_row"), F.lit(parts)).alias("_part"), F.lit(None).cast("long").alias("_seq"), F.lit(None).cast("long").alias("offset"))
    schema = "_row long, _length long, _part long, _seq long, offset long, _open boolean"
    done, turn = [], 0
    while True:
        last = parts == 1
        out = cut(state.groupBy("_part").applyInPandas(_repacker(capacity, turn, last), schema))
        done.append(out.where(~F.col("_open")).select("_row", F.col("_seq").alias("sequence_id"), "offset"))
        if last:
            break
        parts, turn = -(-parts // fan_in), turn + 1
        state = out.where("_open").select("_row", "_length", F.floor(F.col("_part") / fan_in).cast("long").alias("_part"), "_seq", "offset")
    placed = done[0]
    for more in done[1:]:
        placed = placed.union(more)
    return rows.join(placed, "_row").select("row", "sequence_id", "offset")
