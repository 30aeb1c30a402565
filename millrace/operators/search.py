"""Search and matching: regular expressions, similarity, and vector top-k."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.matching import estimate, sketch

#: Between the columns of a row that is searched as one text, and the name of the score's column. (fixed values)
BETWEEN, SCORE = " | ", "_search_score"


def by_regex(df: DataFrame, columns: list[str], pattern: str, case: bool = False) -> DataFrame:
    """Rows in which any of the columns (those that exist) holds the pattern; all rows where there is nothing to seek.

    A pattern that isn't valid raises ValueError at once.
    """
    own = [c for c in columns if c in df.columns]
    if not pattern or not columns:
        return df
    full = pattern if case else f"(?iu){pattern}"
    try:
        df.sparkSession._jvm.java.util.regex.Pattern.compile(full)
    except IllegalArgumentException as e:
        raise ValueError(f"not a regular expression: {pattern}") from e
    found = F.lit(False)
    for c in own:
        found |= T.single_blanks(F.coalesce(F.col(c).cast("string"), F.lit(""))).rlike(full)
    return df.where(found)


def by_similarity(df: DataFrame, columns: list[str], query: str, cutoff: float = 70.0, ties: tuple[str, ...] = (), scorer: Callable[[Column, Column], Column] = T.similarity) -> DataFrame:
    """Rows whose joined columns are like the query; adds SCORE, best first, then by `ties` and the columns searched."""
    if not query.strip() or not columns:
        return df
    own = [c for c in columns if c in df.columns]
    if not own:
        return df.limit(0)
    joined = T.strip(T.single_blanks(F.concat_ws(BETWEEN, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in own])))
    score = F.when(joined == "", 0.0).otherwise(scorer(F.lit(query), joined))
    return df.withColumn(SCORE, score).where(F.col(SCORE) >= cutoff).orderBy(F.desc(SCORE), *ties, *own)


def _pairs(t: Column) -> Column:
    """The lower-cased text's pairs of neighbouring letters, in order."""
    low = F.lower(t)
    n = F.char_length(low)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(low, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))


def _prefixes(t: Column, least: float, counters: Column) -> Column:
    """struct<n (length), short, pairs>: some of the text's pairs of letters, of which two similar texts share one.

    One edit changes two pairs of letters at most. A text of n letters is at most (1 - least) / least * n edits away
    from any text like it, so of twice as many pairs and one more, the rarest ones (in an order that is the same for all
    texts), there is one that no edit changed. Texts that have not so many pairs are `short`.
    """
    n = F.char_length(F.lower(t))
    need = (2 * F.floor(n * (1 - least) / least + 1e-9) + 1).cast("int")
    numbered = lambda p: F.transform(p, lambda g, i: F.struct(estimate(counters, g).alias("n"), F.xxhash64(g, F.size(F.filter(F.slice(p, 1, i + 1), lambda x: x == g))).alias("g")))
    first = F.get(F.transform(F.array(_pairs(t)), lambda p: F.transform(F.slice(F.array_sort(numbered(p)), F.lit(1), need), lambda x: x["g"])), F.lit(0))
    return F.struct(n.alias("n"), (n - 1 < need).alias("short"), first.alias("pairs"))


def fuzzy_matches(names: DataFrame, name: str, candidates: DataFrame, key: str, label: str, cutoff: float = 75.0, k: int = 10) -> DataFrame:
    """(name, key, label, score, rank): the k candidates most like each distinct name, ties to the smaller key.

    Equal names and equal labels are compared once; a label that several candidates share stands for the smallest
    key. Names and labels meet where they share one of their rarest pairs of letters (see _prefixes: no match is lost;
    a count-min sketch of the labels says what is rare); texts too short for that meet all texts whose length is within the cutoff's reach.
    """
    if cutoff <= 0:
        raise ValueError("the cutoff must be above 0")
    least = cutoff / 100
    one = names.where(F.col(name).isNotNull()).select(F.col(name).alias("name")).distinct()
    other = candidates.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.min(key).alias("key"))
    counters = sketch(other.select(F.explode(_pairs(F.col("label"))).alias("g")), "g")
    one, other = one.withColumn("_a", _prefixes(F.col("name"), least, counters)), other.withColumn("_b", _prefixes(F.col("label"), least, counters))
    near = (F.col("_b.n") >= F.col("_a.n") * least - 1e-9) & (F.col("_a.n") >= F.col("_b.n") * least - 1e-9)
    met = one.withColumn("_x", F.explode("_a.pairs")).join(other.withColumn("_x", F.explode("_b.pairs")), "_x").where(near)
    reach = one.withColumn("_n", F.explode(F.sequence(F.ceil(F.col("_a.n") * least - 1e-9).cast("int"), F.floor(F.col("_a.n") / least + 1e-9).cast("int"))))
    short = reach.join(other.withColumn("_n", F.col("_b.n")), "_n").where("_a.short or _b.short")
    pairs = met.select("name", "key", "label").union(short.select("name", "key", "label")).distinct()
    scored = pairs.withColumn("score", T.similarity(F.col("name"), F.col("label"))).where(F.col("score") >= cutoff)
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("score"), "key"))
    return scored.select("name", "key", "label", "score", rank.alias("rank")).where(F.col("rank") <= k)


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(len(lists), -1)


def _best(ids: np.ndarray, q: np.ndarray, others: np.ndarray, x: np.ndarray, k: int, step: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, ids, scores): the k best of a block of candidates for `step` queries at a time."""
    for a in range(0, len(ids), step):
        raw = q[a : a + step] @ x.T
        score = np.sign(raw) * np.floor(np.abs(raw) * 1e6 + 0.5) / 1e6
        score[ids[a : a + step, None] == others[None, :]] = -np.inf
        last = np.partition(score, max(0, len(others) - k), axis=1)[:, max(0, len(others) - k)]
        row, col = np.nonzero((score >= last[:, None]) & (score > -np.inf))
        found = score[row, col]
        order = np.lexsort((others[col], -found, row))
        row, col, found = row[order], col[order], found[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        yield ids[a + row[keep]], others[col[keep]], found[keep]


def vector_matches(queries: DataFrame, candidates: DataFrame, key: str, vector: str, k: int = 5, block: int = 8192) -> DataFrame:
    """(query_id, vec_id, score, rank): each stated query's k largest dot products among the other candidates.

    Queries and candidates are dealt to blocks of about `block` rows by hash, fewer where vectors are long (16 MB). A
    cell of the grid is a query block and a candidate block: one matrix product, of which each query's k best go on to
    the merge. Every row is sent once for each block of the other side and none through the driver; a task holds two
    blocks and the scores of 256 queries at a time (about 100 MB), whatever the number of queries. Scores have six
    decimals, ties go to the smaller key. Rows with a null key or vector take no part; all vectors must be of one length.
    """
    queries, candidates = (d.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")) for d in (queries, candidates))
    asked, width = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    rows = max(1, min(block, (16 << 20) // (8 * max(1, width or 1))))
    across, down = max(1, math.ceil(asked / rows)), max(1, math.ceil(candidates.count() / rows))
    own = lambda n: F.pmod(F.xxhash64(F.lit(b"grid"), "id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select(own(across).alias("i"), every(down).alias("j"), F.lit(True).alias("asked"), "id", "v")
    c = candidates.select(every(across).alias("i"), own(down).alias("j"), F.lit(False).alias("asked"), "id", "v")

    def cell(table: pa.Table) -> pa.Table:
        asked, ids = table["asked"].to_numpy(), table["id"].to_numpy()
        out = [(np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0))]
        if asked.any() and not asked.all():
            v = _matrix(table["v"].combine_chunks())
            out += _best(ids[asked], v[asked], ids[~asked], v[~asked], k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(part) for part in zip(*out, strict=True)), strict=True)))

    found = q.union(c).groupBy("i", "j").applyInArrow(cell, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def looked_up(matches: DataFrame, table: DataFrame, key: str, rank: str = "rank") -> DataFrame:
    """The rows of `table` behind matched keys, each with its match's columns, in match order."""
    return matches.join(table, key).orderBy(rank, key)


def exactly_one(df: DataFrame, where: Column) -> DataFrame:
    """The one row that fulfils the condition; when run, an error if there are none or several."""
    hit = df.where(where)
    counted = hit.agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*hit.columns)).alias("_r"))
    sure = F.when(F.col("_n") == 1, F.col("_r")).otherwise(F.raise_error(F.concat(F.lit("rows found: "), F.col("_n").cast("string"))).cast(hit.select(F.struct("*").alias("r")).schema["r"].dataType))
    return counted.select(sure.alias("_r")).select("_r.*")


def selected(shown: DataFrame, every: DataFrame, key: str, clicked: object, remembered: object) -> DataFrame:
    """The clicked row of those shown, else the remembered one of those shown, else the remembered one of all."""
    one = lambda df, value, order: df.where(F.col(key) == F.lit(value)).withColumn("_order", F.lit(order))
    found = one(shown, clicked, 0).unionByName(one(shown, remembered, 1)).unionByName(one(every, remembered, 2))
    return found.orderBy("_order", key).limit(1).drop("_order")
