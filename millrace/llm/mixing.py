"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

A source's documents are put into a seeded order and read as one ring of words, cut into blocks of equal word counts
(the last one may be shorter). Blocks go to sources by highest quotient target / (2 * blocks so far + 1); as this rule
is house monotone, the first k/shards-th part of the allotment is a valid allotment of its own, and the differences are
the integer quotas of each shard. Sources of unlike sizes are apportioned in tiers (targets within a factor of 16 of each
other), each with blocks of its own size, so a small source doesn't make the blocks of a large one small. The seats of a source are then dealt to its blocks by a seeded permutation: seat j
takes block (start + j * step) mod blocks, and seats lie in shards as the quotas say. A quota above the source's blocks
goes round again, never past two rounds.

Only one row per source reaches the driver (at most `max_sources`, else ValueError); ranks and running sums inside
a hot source are found in two levels (see common.ranked).

Defined cases: null source is a source of its own and comes last; null or empty text has size 0 and is taken 0 times;
a source of size 0 has target 0; equal rows are interchangeable; an empty table gives an empty result; other columns,
whatever their names, are carried along under `row`.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, bucket_count, group_key, ranked, seeded

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)


@dataclass
class Share:
    size: int
    target: float
    blocks: int  # seats won
    quotas: list[int]  # of each shard
    ring: int  # blocks of the source
    block: int  # words of a block
    start: int
    turn: int  # inverse of the permutation's step modulo ring


def targets(sizes: list[int], weights: list[float], share: float, cap: float) -> list[float]:
    """Weighted shares of share * sum(sizes), none above cap * its size; the excess goes to the others by weight."""
    left, out, open_ = share * sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = float(cap * sizes[i])
            left -= out[i]
        gone = set(full)
        open_ = [i for i in open_ if i not in gone]
    return out


def sainte_lague(weights: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotient w / (2s + 1), ties to the earlier party; no party gets more than `most`.

    A divisor gives all but the last few seats (rounding below), the heap gives those one by one.
    """
    total = sum(weights)
    seats = min(seats, sum(m for m, w in zip(most, weights, strict=True) if w > 0))
    if total <= 0 or seats <= 0:
        return [0] * len(weights)
    low = max(0, seats - len(weights) - 1)
    won = [min(m, max(0, math.floor(w / total * low - 0.5))) for w, m in zip(weights, most, strict=True)]
    heap = [(-w / (2 * s + 1), i) for i, (w, s, m) in enumerate(zip(weights, won, most, strict=True)) if w > 0 and s < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(won)):
        _, i = heapq.heappop(heap)
        won[i] += 1
        if won[i] < most[i]:
            heapq.heappush(heap, (-weights[i] / (2 * won[i] + 1), i))
    return won


def tier(goal: float) -> int:
    """Number of the tier of a target: a block of 1, 16, 256 or 1024 words is at most 1/300 of it."""
    return sum(goal >= 300 * least for least in (16, 256, 1024))


def plan(sizes: dict[str, int], share: float = 1.5, cap: int = 2, weights: tuple[float, ...] = WEIGHTS, shards: int = 16, seed: int = 8, block: int | None = None) -> dict[str, Share]:
    """Each source's share. Keys: as group_key makes them ("" for null, last). `block` is every block's size, if given."""
    names = sorted(sizes, key=lambda k: (k == "", k))
    goal = targets([sizes[k] for k in names], [weights[i % len(weights)] for i in range(len(names))], share, cap)
    tiers: dict[int, list[int]] = {}
    for i, g in enumerate(goal):
        tiers.setdefault(tier(g), []).append(i)
    out = {}
    for own in tiers.values():
        size, aim = [sizes[names[i]] for i in own], [goal[i] for i in own]
        width = block or max(1, min(1024, int(min((g for g in aim if g > 0), default=0) / 300)), max(size) >> 31)
        most = [math.ceil(cap * s / width) for s in size]
        seats = round(sum(aim) / width)
        so_far = [sainte_lague(aim, seats * (k + 1) // shards, most) for k in range(shards)]
        for i, n in enumerate(own):
            won, ring = [s[i] for s in so_far], max(1, math.ceil(size[i] / width))
            start, turn = (int(hashlib.md5(f"{x}|{names[n]}".encode()).hexdigest()[:15], 16) % ring for x in (seed, seed + 1))
            while math.gcd(turn, ring) != 1:
                turn += 1
            out[names[n]] = Share(size[i], aim[i], won[-1], [b - a for a, b in zip([0, *won], won)], ring, width, start, turn)
    return out


def _table(spark: SparkSession, shares: dict[str, Share]) -> DataFrame:
    """One row per source, made in the JVM from a literal."""
    rows = [{"_g": k, "target": s.target, "_seats": s.blocks, "_ring": s.ring, "_block": s.block, "_start": s.start, "_turn": s.turn, "_until": [sum(s.quotas[: i + 1]) for i in range(len(s.quotas))]} for k, s in shares.items()]
    kind = "array<struct<_g:string,target:double,_seats:long,_ring:long,_block:long,_start:long,_turn:long,_until:array<long>>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def mix(docs: DataFrame, source: str = "source", text: str | None = "text", size: str | None = None, key: tuple[str, ...] = ("doc_id",), seed: int = 8, max_sources: int = 100_000, **rule: object) -> DataFrame:
    """Columns: row (struct), size, source_size, target, taken, readings array<struct<start, stop, shard, round>>.

    A reading is a block's share of the document, words [start, stop), that the mix takes: of the first round or the
    second, for one shard. taken is the readings' words. `size` names a column that has the word count already.
    """
    words = F.col(size) if size else F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0))
    ids = [F.col(k) for k in key]
    base = docs.select(F.struct("*").alias("row"), group_key(F.col(source)).alias("_g"), words.cast("long").alias("size"), seeded(seed, *ids).alias("_h"), *[c.alias(f"_k{i}") for i, c in enumerate(ids)])
    found = base.groupBy("_g").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    shares = plan({r["_g"]: r["size"] for r in found}, seed=seed, **rule)
    df = ranked(base, bucket_count(sum(r["rows"] for r in found)), "_g", "_h", ["size", *[f"_k{i}" for i in range(len(ids))]], "size", _table(docs.sparkSession, shares))
    begin, end, width = F.col("_before"), F.col("_before") + F.col("size"), F.col("_block")
    low, high = F.floor(begin / width).cast("long"), F.floor((end - 1) / width).cast("long")

    def readings(b: Column) -> Column:
        seat = F.pmod((b - F.col("_start")) * F.col("_turn"), F.col("_ring"))
        seats = F.filter(F.array(seat, seat + F.col("_ring")), lambda j: j < F.col("_seats"))
        start, stop = F.greatest(b * width - begin, F.lit(0)), F.least((b + 1) * width - begin, F.col("size"))
        shard = lambda j: F.size(F.filter("_until", lambda q: q <= j)).cast("int")
        return F.transform(seats, lambda j, i: F.struct(start.alias("start"), stop.alias("stop"), shard(j).alias("shard"), (i + 1).cast("int").alias("round")))

    own = F.when(F.col("size") > 0, F.flatten(F.transform(F.sequence(low, high), readings)))
    df = df.withColumn("readings", F.coalesce(own, F.array().cast("array<struct<start:long,stop:long,shard:int,round:int>>")))
    taken = F.aggregate("readings", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    return df.select("row", "size", F.col("_sum").alias("source_size"), "target", taken.alias("taken"), "readings")


def mixed_texts(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The documents of the mix: for each round, each stretch of a document that lies in blocks taken.

    Columns: those of the input's rows. A stretch that is the whole document keeps its text byte for byte; a shorter
    one has its words joined by single blanks.
    """
    whole = F.col(f"row.{text}")
    words = F.regexp_extract_all(whole, F.lit(f"({WORD})"), F.lit(1))

    def stretches(turn: int) -> Column:
        own = F.filter("readings", lambda x: x["round"] == turn)
        first, last = F.transform(own, lambda x: x["start"]), F.transform(own, lambda x: x["stop"])
        stops = F.array_except(last, first)
        return F.transform(F.array_except(first, last), lambda a, i: F.struct(a.alias("start"), F.get(stops, i).alias("stop")))

    kept = mixed.where("taken > 0").select("row", "size", F.explode(F.concat(stretches(1), stretches(2))).alias("_s"))
    part = F.array_join(F.slice(words, (F.col("_s.start") + 1).cast("int"), (F.col("_s.stop") - F.col("_s.start")).cast("int")), " ")
    chosen = F.when((F.col("_s.start") == 0) & (F.col("_s.stop") == F.col("size")), whole).otherwise(part)
    names = mixed.schema["row"].dataType.fieldNames()
    return kept.select(*[(chosen if n == text else F.col("row")[n]).alias(n) for n in names])
