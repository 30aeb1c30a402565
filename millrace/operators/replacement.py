"""Ordered replacement by long lists of codes: an automaton finds the few entries that can fire.

The result is that of putting " (name)" behind every occurrence of each entry's code in turn, over all entries in
order, also where an inserted name holds a later entry's code. An Aho-Corasick automaton finds all codes of a text in
one pass; their entries are put in by order, and after each only the places around its insertions are passed again for
later ones. A text's cost is one pass, and for each entry that fires a plain search and its insertions, whatever the
number of entries. A worker remembers short results, so copies of a text are worked out once there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

#: More entries than this aren't taken (they go to every task); results that a worker remembers, and their length at most.
MOST_ENTRIES, REMEMBERED, SHORT = 1_000_000, 10_000, 2_000


class Entries:
    """Codes and names in order, ready to be put into texts."""

    def __init__(self, codes: tuple[str, ...], names: tuple[str, ...]) -> None:
        self.codes, self.names = codes, names
        places: dict[str, list[int]] = {}
        for i, code in enumerate(codes):
            places.setdefault(code, []).append(i)
        self.found = ahocorasick.Automaton()
        for code, own in places.items():
            self.found.add_word(code, own)
        self.found.make_automaton()
        self.reach = max(map(len, codes)) - 1
        self.known: dict[str, str] = {}

    def folded(self, text: str) -> str:
        """fold(), from memory where it can be."""
        out = self.known.get(text)
        if out is None:
            out = self.fold(text)
            if len(out) <= SHORT:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[text] = out
        return out

    def fold(self, text: str) -> str:
        agenda = sorted({i for _, own in self.found.iter(text) for i in own})
        known = set(agenda)
        while agenda:
            at = heapq.heappop(agenda)
            code, added = self.codes[at], f" ({self.names[at]})"
            parts = text.split(code)
            if len(parts) == 1:  # an insertion has parted it
                continue
            text = (code + added).join(parts)
            # a code that is new in the text touches an insertion
            begin, last, step = 0, -1, len(code) + len(added)
            for part in parts[:-1]:
                begin += len(part) + step
                first, end = max(begin - len(added) - self.reach, 0), begin + self.reach
                if first <= last:
                    last = max(last, end)
                    continue
                if last >= 0:
                    self._later(text[start:last], at, known, agenda)
                start, last = first, end
            self._later(text[start:last], at, known, agenda)
        return text

    def _later(self, text: str, at: int, known: set[int], agenda: list[int]) -> None:
        """Puts the entries behind `at` whose codes the text holds on the agenda."""
        for _, own in self.found.iter(text):
            for i in own:
                if i > at and i not in known:
                    known.add(i)
                    heapq.heappush(agenda, i)


@lru_cache(maxsize=2)
def ready(codes: tuple[str, ...], names: tuple[str, ...]) -> Entries:
    return Entries(codes, names)


def replace_all(text: Column, entries: Iterable[tuple[str | None, str | None]]) -> Column:
    """The text after all entries (code, name) in order; null names and null or empty codes are skipped, null texts stay."""
    kept = [(c, n) for c, n in entries if c and n is not None]
    if not kept:
        return text
    if len(kept) > MOST_ENTRIES:
        raise ValueError(f"more than {MOST_ENTRIES} entries")
    codes, names = (tuple(x) for x in zip(*kept, strict=True))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        folded = ready(codes, names).folded
        for texts in batches:
            yield texts.map(lambda t: t if t is None else folded(t))

    return run(text)


def entry_list(entries: DataFrame, order: str, code: str = "code", name: str = "name") -> list[tuple[str, str]]:
    """(code, name) in order; more than `MOST_ENTRIES` raise ValueError."""
    held = entries.select(order, code, name).orderBy(order).limit(MOST_ENTRIES + 1).collect()
    if len(held) > MOST_ENTRIES:
        raise ValueError(f"more than {MOST_ENTRIES} entries")
    return [(r[1], r[2]) for r in held]


def serialized_measure(columns: list[str], entries: Iterable[tuple[str, str]], text: str, source: str, pattern: str) -> Column:
    """A row's serialised text, with the entries put into `text` first where `source` holds the pattern from its start."""
    held = F.col(f"`{source}`").rlike(f"^(?:{pattern})")
    named = F.when(held, replace_all(F.when(held, F.col(f"`{text}`")), entries)).otherwise(F.col(f"`{text}`"))
    shown = [c for c in columns if not any(w in c.lower() for w in T.UNSERIALISED)]
    return T.serialize({c: named if c == text else F.col(f"`{c}`") for c in shown}, "query: ")
