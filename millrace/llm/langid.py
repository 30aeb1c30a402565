"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are folded (letters to lower case, every run of other characters to one blank, a blank at both ends) and all
their 1-, 2- and 3-grams are hashed into 2^bits cells. Training counts the cells of a bounded sample of labelled
documents (max_train rows, by a hash of the id; every labelled row where there are fewer), in the cluster. The matrix
of log probabilities, cells x languages, is broadcast: at most `matrix_mb`, as `bits` is lowered for many languages and
more than `max_langs` labels raise ValueError. A batch of documents is scored as a sparse matrix (compressed rows:
document offsets, cell indices) times that matrix.

score is the share of the predicted language among all languages' probabilities, per character: the mean log
likelihoods of a text are compared as if it had `evidence` n-grams, so that long texts do not all score 1.

Defined cases: a null text or one without a letter is `und` with score 0, and so is every text where nothing could be
learned; ties go to the first language by code point; null labels are not learned from; equal rows have equal results;
an empty table gives an empty result; other columns, whatever their names, are carried along under `row`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

GRAMS = (1, 2, 3)
BLANK = 32


@cache
def _folds() -> np.ndarray:
    """For each code point: its lower-case letter, or a blank if it isn't a letter."""
    out = np.full(0x110000, BLANK, "u4")
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def folded(text: bytes) -> np.ndarray:
    codes = _folds()[np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4")]
    if len(codes):
        blank = codes == BLANK
        codes = codes[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]
    edge = np.array([BLANK], "u4")
    start, stop = (1, 1) if not len(codes) else (int(codes[0] != BLANK), int(codes[-1] != BLANK))
    return np.concatenate((edge[:start], codes, edge[:stop]))


def cells(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The cell of the n-gram that begins at each position."""
    with np.errstate(over="ignore"):
        h = codes[: len(codes) - n + 1] * np.uint32(0x9E3779B1)
        for k, odd in zip(range(1, n), (0x85EBCA77, 0xC2B2AE3D), strict=False):
            h = (h ^ (h >> np.uint32(15))) + codes[k : len(codes) - n + 1 + k] * np.uint32(odd)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0x27D4EB2F)
    return h >> np.uint32(32 - bits)


@dataclass
class Model:
    langs: list[str]
    bits: int
    weights: np.ndarray  # languages x cells, log probabilities
    prior: np.ndarray

    def predict(self, texts: list[bytes | None], evidence: float = 60.0) -> tuple[list[str], list[float]]:
        pred, score = ["und"] * len(texts), [0.0] * len(texts)
        parts = [(i, codes) for i, t in enumerate(texts) if t and (codes := folded(t)).max(initial=BLANK) > BLANK]
        if not parts or not self.langs:
            return pred, score
        sizes = np.array([len(c) for _, c in parts])
        ends = np.cumsum(sizes)
        codes, sums, grams = np.concatenate([c for _, c in parts]), np.zeros((len(parts), len(self.langs))), np.zeros(len(parts))
        for n in GRAMS:
            index = cells(codes, n, self.bits)
            first, last = ends - sizes, np.maximum(ends - n + 1, ends - sizes)  # n-grams across documents stay out
            some = np.flatnonzero(last > first)
            edges, index = np.stack((first[some], last[some]), axis=1).reshape(-1), np.append(index, 0)
            if len(some):
                for k, own in enumerate(self.weights):  # one column of the sparse rows' product
                    sums[some, k] += np.add.reduceat(own[index], edges)[::2]
            grams += last - first
        best = (sums + self.prior).argmax(axis=1)
        scaled = sums * (np.minimum(grams, evidence) / grams)[:, None] + self.prior
        share = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        for (i, _), k, s in zip(parts, best, share, strict=True):
            pred[i], score[i] = self.langs[k], float(s[k])
        return pred, score


def _slices(texts: list[bytes | None], size: int = 250_000) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t or b"")
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def train(docs: DataFrame, where: Column, key: str = "doc_id", text: str = "text", label: str = "lang", max_train: int = 20_000, bits: int = 16, matrix_mb: int = 64, max_langs: int = 1024, seed: int = 2) -> Model:
    """Learn from at most about `max_train` labelled rows among those that satisfy `where`; rows are drawn by id and
    text. Labels of which no drawn text has a letter aren't learned."""
    labelled = docs.where(where & F.col(label).isNotNull()).select(key, F.col(label).alias("_label"), F.col(text).alias("_text"))
    small_batches(docs.sparkSession)
    per = {r["_label"]: r["n"] for r in labelled.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).limit(max_langs + 1).collect()}
    if len(per) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs, total = sorted(per), sum(per.values())
    while bits > 8 and len(langs) * 8 << bits > matrix_mb << 20:
        bits -= 1
    share = 1.0 if total <= max_train else max_train / total
    sample = labelled if share == 1 else labelled.where(F.pmod(F.xxhash64(F.lit(seed), key, "_text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = folded(t or b"")
                if codes.max(initial=BLANK) > BLANK:
                    have = own.setdefault(lang, np.zeros(1 << bits, "i8"))
                    for n in GRAMS:
                        have += np.bincount(cells(codes, n, bits), minlength=1 << bits)
        for lang, have in own.items():
            at = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype("i4")), pa.array(have[at])], names=["lang", "cell", "n"])

    seen = sample.select("_label", F.col("_text").cast("binary")).mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    told = set(seen["lang"].to_pylist())
    langs = [k for k in langs if k in told]
    counts = np.full((1 << bits, len(langs)), 0.5)
    place = {k: i for i, k in enumerate(langs)}
    if seen.num_rows:
        np.add.at(counts, (seen["cell"].to_numpy(), np.array([place[k] for k in seen["lang"].to_pylist()])), seen["n"].to_numpy())
    weights = np.ascontiguousarray(np.log(counts / counts.sum(axis=0)).T) if langs else np.zeros((0, 1))
    return Model(langs, bits, weights, np.log(np.array([per[k] for k in langs]) / max(1, total)) if langs else np.zeros(0))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Columns: row (struct of the input's columns), lang_pred string, score double. Only texts go to Python."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        own, rows, pred, score = shared.value, texts.to_pylist(), [], []
        for a, b in _slices(rows):
            p, s = own.predict(rows[a:b])
            pred += p
            score += s
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}  # read by arrow_udf, which can't resolve their text form
    found = F.arrow_udf(run, "lang_pred string, score double")
    out = docs.select(F.struct("*").alias("row"), found(F.col(text).cast("binary")).alias("_p"))
    return out.select("row", "_p.lang_pred", "_p.score")


def held_out(key: Column) -> Column:
    """crc32 of the id's text, mod 4, is 2. Null ids are not held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))
