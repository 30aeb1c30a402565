"""Weighted similarity of two texts, 0 to 100: whole texts, best-aligned windows, and word sets.

The plain score is 200 times the longest common subsequence (LCS) over the summed lengths. Texts of like length (below
1.5 to 1) take the best of the plain score and 95 % of the scores of their sorted words and word sets. Unlike ones take
the plain score, the score of the shorter text in the best window of the longer one (90 %, 60 % beyond 8 to 1), and
95 % of that share of the same by words, which is full where they share a word. Case counts; an empty text has 0.

LCSs are bit-parallel: of whole texts by one integer as long as the longer text, of windows by one vector of machine
words over all windows of all pairs of a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

# Shares of the word scores and of window scores, and the length ratios at which they change.
WORDS, WINDOW, FAR_WINDOW = 0.95, 0.9, 0.6
ALIKE, FAR = 1.5, 8.0


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence: a step for each character of the shorter text."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at: dict[str, int] = {}
    if len(long) > 200:
        codes = np.frombuffer(long.encode("utf-32-le", "surrogatepass"), "<u4")
        at = {c: int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little") for c in set(short)}
    else:
        for i, c in enumerate(long):
            at[c] = at.get(c, 0) | 1 << i
    every = (1 << len(long)) - 1
    state = every
    for c in short:
        hit = state & at.get(c, 0)
        state = ((state + hit) | (state - hit)) & every
    return len(long) - state.bit_count()


def plain(a: str, b: str) -> float:
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def windows(pairs: Sequence[tuple[str, str]], most: int = 1 << 20) -> list[float]:
    """For each (shorter, longer): the best plain score of the shorter text with a window of the longer one.

    A window has the shorter one's length, or less at both ends of the longer text. About `most` windows at a time.
    """
    out = [0.0] * len(pairs)
    by_words: dict[int, list[int]] = {}
    for i, (s, t) in enumerate(pairs):
        if s and t:
            by_words.setdefault(-(-len(s) // 64), []).append(i)
    for words, own in by_words.items():
        held: list[int] = []
        size = 0
        for i in own:
            held.append(i)
            size += words * (len(pairs[i][1]) + 2 * len(pairs[i][0]))
            if size >= most:
                _best(pairs, held, words, out)
                held, size = [], 0
        if held:
            _best(pairs, held, words, out)
    return out


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")


def _best(pairs: Sequence[tuple[str, str]], own: list[int], words: int, out: list[float]) -> None:
    """Every pair's longer text lies in one vector with room for a whole window on both sides; a lane is a window."""
    size = np.array([len(pairs[i][0]) for i in own])
    length = np.array([len(pairs[i][1]) for i in own])
    room = length + 2 * size
    first = np.cumsum(room) - room
    inside = np.repeat(first + size - np.cumsum(length) + length, length) + np.arange(length.sum())
    text = _codes([pairs[i][1] for i in own])
    pair = np.repeat(np.arange(len(own)), length)
    short, begin = _codes([pairs[i][0] for i in own]), np.cumsum(size) - size
    longest = int(size.max())
    mask = np.zeros((words, int(room.sum())), "u8")
    for k in range(longest):
        there = (k < size)[pair] & (text == short[np.minimum(begin + k, len(short) - 1)][pair])
        mask[k >> 6, inside[there]] |= np.uint64(1 << (k & 63))
    lanes = length + size - 1  # windows that meet the text
    start = np.repeat(first + 1 - np.cumsum(lanes) + lanes, lanes) + np.arange(lanes.sum())
    mine = np.repeat(np.arange(len(own)), lanes)
    steps = size[mine]
    state = np.full((words, len(start)), np.iinfo("u8").max, "u8")
    for k in range(longest):
        now = start + np.minimum(k, steps)  # one past the window's end there is no hit for a finished lane
        active = k < steps
        over = np.zeros(len(start), "u8")
        for w in range(words):
            s = state[w]
            hit = np.where(active, s & mask[w, np.minimum(now, mask.shape[1] - 1)], np.uint64(0))
            with np.errstate(over="ignore"):
                total = s + hit
                carry = (total < s).astype("u8")
                total = total + over
                carry |= (total < over).astype("u8")
            state[w] = np.where(active, total | (s & ~hit), s)
            over = np.where(active, carry, np.uint64(0))
    common = np.zeros(len(start), "i8")
    for w in range(words):
        used = np.clip(size - 64 * w, 0, 64)
        bits = np.where(used >= 64, np.uint64(np.iinfo("u8").max), (np.uint64(1) << np.minimum(used, 63).astype("u8")) - np.uint64(1))
        common += np.bitwise_count(~state[w] & bits[mine])
    at = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes) - steps + 1  # start in the text, maybe < 0
    width = np.minimum(at + steps, length[mine]) - np.maximum(at, 0)
    score = 200.0 * common / (steps + width)
    best = np.maximum.reduceat(score, np.cumsum(lanes) - lanes)
    for i, value in zip(own, best.tolist(), strict=True):
        out[i] = max(out[i], value)


def _word_sets(a: list[str], b: list[str]) -> float:
    """Score of two texts' sets of words: 100 where one holds the other, else the best of three comparisons with the
    shared words in front."""
    mine, other = set(a), set(b)
    both = mine & other
    left, right = sorted(mine - other), sorted(other - mine)
    if not a or not b:
        return 0.0
    if both and (not left or not right):
        return 100.0
    x, y = " ".join(left), " ".join(right)
    shared = len(" ".join(both))
    front = shared + (shared > 0)
    total = 2 * front + len(x) + len(y)
    best = 100.0 * (1 - (len(x) + len(y) - 2 * lcs(x, y)) / total)
    if shared:
        for rest in (len(x), len(y)):
            best = max(best, 100.0 * (1 - (1 + rest) / (2 * shared + 1 + rest)))
    return best


def weighted(first: Sequence[str | None], second: Sequence[str | None]) -> list[float | None]:
    """The weighted similarity of each pair; null where a text is null."""
    out: list[float | None] = []
    asked: list[tuple[str, str]] = []
    owner: list[tuple[int, float]] = []

    def ask(i: int, share: float, a: str, b: str) -> None:
        if len(a) <= len(b):
            asked.append((a, b))
            owner.append((i, share))
        if len(b) <= len(a):
            asked.append((b, a))
            owner.append((i, share))

    for i, (a, b) in enumerate(zip(first, second, strict=True)):
        if a is None or b is None:
            out.append(None)
            continue
        if not a or not b:
            out.append(0.0)
            continue
        score = plain(a, b)
        x, y = sorted(a.split()), sorted(b.split())
        unlike = max(len(a), len(b)) / min(len(a), len(b))
        if unlike < ALIKE:
            score = max(score, WORDS * plain(" ".join(x), " ".join(y)) if x and y else 0.0, WORDS * _word_sets(x, y))
        else:
            share = WINDOW if unlike <= FAR else FAR_WINDOW
            ask(i, share, a, b)
            if set(x) & set(y):
                score = max(score, 100.0 * WORDS * share)
            elif x and y:
                ask(i, share * WORDS, " ".join(x), " ".join(y))
                if len(set(x)) < len(x) or len(set(y)) < len(y):
                    ask(i, share * WORDS, " ".join(sorted(set(x))), " ".join(sorted(set(y))))
        out.append(score)
    for (i, share), score in zip(owner, windows(asked), strict=True):
        out[i] = max(out[i], share * score)
    return [None if s is None else round(s, 4) for s in out]


def weighted_similarity(a: Column, b: Column) -> Column:
    """The weighted similarity of two text columns, in Arrow batches, four decimals."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        clean = lambda s: [None if v is None else str(v) for v in s.astype(object).where(s.notna(), None)]
        return pd.Series(weighted(clean(x), clean(y)), dtype="float64")

    return pandas_udf(run, "double").asNondeterministic()(a, b)  # so that a filter on the score doesn't compute it again
