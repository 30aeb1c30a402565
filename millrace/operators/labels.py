"""Review labels: upserts, lookups, membership, triplets, checks, samples and splits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str, place: str | None = None) -> DataFrame:
    """The last write of each key wins: the largest `version` (null first), of equal ones the new row, then the largest.

    `place`, if named, keeps the smallest value of a key's writes, so that a row stays where it was first put. One
    partial aggregate, no sort.
    """
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    names = [c for c in rows.columns if c != "_new"]
    order = F.struct(F.col(version).isNotNull().alias("a"), F.col(version).alias("b"), F.col("_new").alias("c"), F.struct(*[F.col(c) for c in names if c not in keys]).cast("string").alias("d"))
    first = [F.min(place).alias("_place")] if place else []
    out = rows.groupBy(*keys).agg(F.max_by(F.struct(*names), order).alias("_r"), *first)
    return out.select(*[F.col("_place").alias(c) if c == place else F.col("_r")[c].alias(c) for c in names])


def _same(rows: DataFrame, labels: DataFrame, key: str) -> Column:
    return rows[key].eqNullSafe(labels[key])


def unlabelled(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Rows whose key (null counts as a key) has no label."""
    labels = labels.select(key).distinct()
    return rows.join(labels, _same(rows, labels, key), "left_anti")


def labelled(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    labels = labels.select(key).distinct()
    return rows.join(labels, _same(rows, labels, key), "left_semi")


def existing_labels(asked: DataFrame, labels: DataFrame, row: str, candidate: str, label: str) -> DataFrame:
    """The labels of each asked (row, candidate): of that pair, or, where no candidate is asked, all of the row.

    `asked` has both columns; a pair without a label stays with a null one.
    """
    known = labels.select(F.col(row).alias("_row"), F.col(candidate).alias("labelled_candidate"), F.col(label).alias(label))
    hit = (F.col(row) == F.col("_row")) & (F.col(candidate).isNull() | (F.col(candidate) == F.col("labelled_candidate")))
    return asked.join(known, hit, "left").drop("_row")


def first_label(asked: DataFrame, labels: DataFrame, key: str, place: str) -> DataFrame:
    """The label row of each asked key that comes first by `place`."""
    first = labels.groupBy(key).agg(F.min_by(F.struct(*[c for c in labels.columns if c != key]), F.col(place)).alias("_r"))
    return asked.join(first, key, "left").select(*asked.columns, "_r.*")


def next_candidate(ranked: DataFrame, seen: DataFrame, key: str, rank: str = "rank") -> DataFrame:
    """For each key of `seen` (key, rank): the candidate one rank further, or a null one where the list is at its end."""
    asked = seen.select(key, (F.col(rank) + 1).alias(rank))
    return asked.join(ranked, [key, rank], "left")


def advance(ranked: DataFrame, seen: DataFrame, key: str, drawn: DataFrame, rank: str = "rank") -> DataFrame:
    """For each (key, rank) of `seen`: the candidate one rank further, or, behind the last one, the first candidate of
    the drawn measure (`drawn`: one row with the key; none: nothing follows)."""
    asked = seen.select(F.col(key).alias("_asked"), (F.col(rank) + 1).alias("_rank"))
    own = asked.join(ranked, (F.col("_asked") == F.col(key)) & (F.col("_rank") == F.col(rank)), "left")
    begin = ranked.where(F.col(rank) == 1).join(F.broadcast(drawn.select(key).limit(1)), key, "left_semi").limit(1)
    other = F.broadcast(begin.select(F.struct(*ranked.columns).alias("_new")))
    both = own.withColumn("_own", F.struct(*ranked.columns)).join(other, F.col(rank).isNull(), "left")
    return both.select(F.col("_asked").alias("seen"), F.when(F.col(rank).isNotNull(), F.col("_own")).otherwise(F.col("_new")).alias("_r")).select("seen", "_r.*")


def at_most_one(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows; when run, an error if a key has several."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rows.columns)).alias("_r"))
    checked = counted.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("a key has several rows")).cast("boolean")))
    return checked.select("_r.*")


#: Most candidates of either kind in one block of an anchor that is dealt.
BLOCK = 4096
#: About so many rejected candidates meet an accepted one as one row of the join.
MET = 256


def triplets(labels: DataFrame, anchor: str, candidate: str, label: str, yes: object = 1, no: object = 0, texts: DataFrame | None = None, key: str | None = None, parts: int = 1) -> DataFrame:
    """(anchor, positive, negative): every accepted with every rejected candidate of an anchor.

    With `texts` (key and `text`), the candidates are replaced by their texts before they meet, so that no pair is
    shuffled. `parts` above 1 deals the accepted ones of an anchor to at least that many blocks, and either kind to
    blocks of about `BLOCK`, for anchors with many; the result itself is their product. In a block the rejected ones
    meet the accepted ones as arrays of about `MET`, so that the join makes a row for each array instead of each pair.
    """
    shown = "_text" if texts is not None else candidate
    if texts is not None:
        labels = labels.join(texts.select(F.col(key).alias(candidate), F.col("text").alias("_text")), candidate)
    good, bad = F.col(label) == F.lit(yes), F.col(label) == F.lit(no)
    blocks = []
    if parts > 1:
        n = lambda kind, least: F.greatest(F.lit(least).cast("long"), F.ceil(F.count_if(kind) / BLOCK))
        sizes = labels.groupBy(anchor).agg(n(good, parts).alias("_goods"), n(bad, 1).alias("_bads"))
        labels, blocks = labels.join(sizes, anchor), ["_good", "_bad"]
    own = lambda count: F.pmod(F.xxhash64(candidate), count)
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    side = lambda kind, name, *dealt: labels.where(kind).select(anchor, F.col(shown).alias(name), *(c.alias(b) for c, b in zip(dealt, [*blocks, "_array"] if blocks else [], strict=False)))
    one = side(good, "positive", own(F.col("_goods")), every("_bads"))
    other = side(bad, "negative", every("_goods"), own(F.col("_bads")), F.pmod(F.xxhash64(candidate, F.lit("array")), F.lit(max(1, BLOCK // MET))))
    if not blocks:
        return one.join(other, anchor).select(anchor, "positive", "negative")
    # few rows, many pairs: a fixed number of tasks, which Spark doesn't join to fewer
    wide = int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one, other = (x.repartition(wide, anchor, *blocks) for x in (one, other))
    met = other.groupBy(anchor, *blocks, "_array").agg(F.collect_list(F.struct("negative"))["negative"].alias("_negatives"))  # structs keep null texts
    return one.join(met.drop("_array"), [anchor, *blocks]).select(anchor, "positive", F.explode("_negatives").alias("negative"))


def consistent(rows: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """(key, rows, consistent): whether all of a key's rows carry the same payload, compared as JSON with sorted names."""
    told = F.to_json(F.struct(*[F.col(c) for c in sorted(payload)]), {"ignoreNullFields": "false"})
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), (F.min(told) == F.max(told)).alias("consistent"))


def draw(seed: int, *keys: str) -> Column:
    """A seeded number for a row: the first eight hexadecimal digits of an MD5, the same in every engine."""
    return F.conv(F.left(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), F.lit(8)), 16, 10).cast("long")


def split(rows: DataFrame, key: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds `part` (test or train) by a seeded draw of the key: no shuffle, the same at every run; rows of a key stay
    together, so with the anchor as key no anchor is in both parts."""
    return rows.withColumn("part", F.when(draw(seed, key) % 10_000 < int(share * 10_000), "test").otherwise("train"))


def nth_draw(draws: DataFrame, n: int, bits: int = 15, digits: int = 4) -> tuple[int, int]:
    """(the n-th smallest of the column `draw`, from 1; how many are smaller): one histogram of 2^bits counts for each
    digit, from the highest down, over the draws that agree with it so far."""
    known, before = F.lit(True), 0
    value = 0
    for d in reversed(range(digits)):
        digit = F.shiftright("draw", bits * d)
        low = digit.bitwiseAND(F.lit((1 << bits) - 1))
        for at, count in draws.where(known).groupBy(low.alias("at")).agg(F.count(F.lit(1)).alias("n")).orderBy("at").collect():
            if before + count >= n:
                value = value << bits | at
                break
            before += count
        known = digit == value
    return value, before


def split_exact(rows: DataFrame, key: str, share: float = 0.2, seed: int = 42, by_key: bool = False) -> DataFrame:
    """Adds `part`: exactly ceil(share x n) are `test`, the rest `train`: of the rows, or (`by_key`) of the keys, whose
    rows then stay together.

    The border is the n-th smallest seeded draw of the keys, found by counts alone, so no row moves; a null key is one
    more key. Only rows that share the border's draw, as those of one key do, are ranked: by their task and place in it.
    """
    drawn = rows.withColumn("draw", F.conv(F.left(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), F.lit(15)), 16, 10).cast("long"))
    of = drawn.select(key, "draw").distinct() if by_key else drawn.select("draw")
    total = of.count()
    wanted = math.ceil(round(share * total, 9))
    if not wanted:
        return drawn.withColumn("part", F.lit("train")).drop("draw")
    border, before = nth_draw(of, wanted)
    if by_key or of.where(F.col("draw") == border).limit(2).count() == 1:
        return drawn.withColumn("part", F.when(F.col("draw") <= border, "test").otherwise("train")).drop("draw")
    ties = drawn.where(F.col("draw") == border).withColumn("_task", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    counts = ties.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_task", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_task").orderBy("_at"))
    told = ties.join(counts, "_task").withColumn("part", F.when(place <= wanted - before, "test").otherwise("train")).select(*rows.columns, "part")
    rest = drawn.where(F.col("draw") != border).withColumn("part", F.when(F.col("draw") < border, "test").otherwise("train"))
    return rest.select(*rows.columns, "part").union(told)


def sample_by_file(rows: DataFrame, file: str, key: str, seed: int) -> DataFrame:
    """One random row of every file: the one with the smallest seeded draw."""
    order = F.struct(draw(seed, key), F.col(key))
    return rows.groupBy(file).agg(F.min_by(F.struct(*[c for c in rows.columns if c != file]), order).alias("_r")).select(file, "_r.*")


def random_row(rows: DataFrame, file: str, key: str, seed: int, labels: DataFrame | None = None) -> DataFrame:
    """One random row: a file is drawn first, so rows of small files come up more often; labelled keys are left out."""
    rows = rows if labels is None else unlabelled(rows, labels, key)
    each = sample_by_file(rows, file, key, seed)
    return each.orderBy(draw(seed + 1, file), file).limit(1)


def resampled(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """`n` rows drawn with replacement: each of n seeded draws takes the row of that number in the order of the key.

    The rows' numbers are found in one task for a key's range only, by counts of ranges (two levels).
    """
    spark, total = rows.sparkSession, rows.count()
    if not total:
        return rows.withColumn("draw", F.lit(0).cast("long"))
    parts = rows.withColumn("_part", F.pmod(F.crc32(F.col(key).cast("string")), F.lit(max(1, total // 100_000 + 1))))
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    number = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    numbered = parts.join(before, "_part").withColumn("_at", number).drop("_part", "_before")
    draws = spark.range(n).select(F.col("id").alias("draw"), (draw(seed, "id") % F.lit(total)).alias("_at"))
    return draws.join(numbered, "_at").drop("_at")


def chunked(rows: DataFrame, position: str, size: int = 10) -> DataFrame:
    return rows.withColumn("chunk", F.floor(F.col(position) / size).cast("long"))
