"""Similarity joins by the weighted score (whole texts, windows, words): no match is lost, no hot key meets in one task.

A text is known by the pairs of neighbouring characters of " text ", at the text's n + 1 places. With d characters of
the text and i of the other one (or of its best window) outside their common subsequence, all but 2 d + i places are
found in the other text, since a lost character takes two places with it and a foreign one splits one. Sorting the
words changes no pair, as every word stands between blanks. So a text that is like another shares one of its
`most lost + 1` rarest places, and a text only has to meet the others by these.

Rarity comes from a count-min sketch of the pairs, built in one pass over the texts and sent with the plan: `DEPTH` x
`WIDTH` bytes, whatever the input. The same counters say which pairs stay hot: their rows are dealt to more parts, each side by its
own count. A match that rests on nothing but a shared word has a fixed score, so of the texts of one length that share
a word only the k of smallest keys can be among the k best.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.alignment import ALIKE, FAR, WINDOW, WORDS, weighted_similarity

#: Rows and counters of a sketch; rows of a pair of characters that one part takes; most parts of a pair.
DEPTH, WIDTH, PART_ROWS, MOST_PARTS = 3, 1 << 14, 20_000, 512
#: The smallest cutoff: below it, like texts may have no pair of characters in common.
LEAST = 70.0


def places(text: Column) -> Column:
    """The pairs of neighbouring characters of " text ", in order."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.char_length(text) + 1), lambda i: F.substring(padded, i, F.lit(2)))


def _counter(gram: Column, row: int) -> Column:
    return (F.pmod(F.xxhash64(F.lit(row), gram), F.lit(WIDTH)) + row * WIDTH).cast("int")


def sketch(grams: DataFrame, column: str) -> Column:
    """The counters of a count-min sketch, each rounded up to an eighth of a power of two in one byte; `DEPTH` x
    `WIDTH` bytes, whatever the input."""
    each = grams.select(F.explode(F.array(*[_counter(F.col(column), d) for d in range(DEPTH)])).alias("at"))
    counters = bytearray(DEPTH * WIDTH)
    for at, n in each.groupBy("at").agg(F.count(F.lit(1))).collect():
        counters[at] = min(255, math.ceil(8 * math.log2(n)) + 1)
    return F.lit(bytes(counters))


def estimate(counters: Column, gram: Column) -> Column:
    """The logarithm of at least as often as the pair was counted, in eighths and one more; 0 for none."""
    return F.least(*[F.conv(F.hex(F.substring(counters, _counter(gram, d) + 1, F.lit(1))), 16, 10).cast("int") for d in range(DEPTH)])


def _lost_whole(n: Column, c: float) -> Column:
    """Most places of a text of n characters that a text of any length with a plain score of c doesn't have."""
    return F.floor(n * (4 - 4 * c) / (2 - c) + 1e-9)


def _lost_window(n: Column, c: float) -> Column:
    """The same for a window of another text, whose ends aren't blanks."""
    return F.floor(n * (4 - 4 * c) / (2 - c) + 1e-9) + 2


def _texts(rows: DataFrame, text: str, key: str | None) -> DataFrame:
    """text, n, (smallest key), its forms (as it is, and without repeated words where there are any), and its bag: a
    number for each character and how often it has come before."""
    clean = T.strip(T.single_blanks(F.col(text)))
    held = rows.select(clean.alias("text"), *([F.col(key).alias("key")] if key else [])).where(F.col("text") != "")
    held = held.groupBy("text").agg(F.min("key").alias("key")) if key else held.distinct()
    words = F.split("text", " ")
    once = F.array_join(F.array_distinct(words), " ")
    signs = F.split("text", "")
    bag = F.transform(signs, lambda c, i: F.xxhash64(c, F.size(F.filter(F.slice(signs, F.lit(1), i), lambda x: x == c))))
    return held.withColumn("n", F.char_length("text")).withColumn("bag", bag).withColumn("forms", F.when(F.size(F.array_distinct(words)) < F.size(words), F.array("text", once)).otherwise(F.array("text")))


def _rarest(form: Column, lost: Column, counters: Column) -> Column:
    """The rarest places of a form of which a like text has one."""
    ranked = F.array_sort(F.transform(places(form), lambda g: F.struct(estimate(counters, g).alias("n"), g.alias("g"))))
    return F.array_distinct(F.transform(F.slice(ranked, F.lit(1), (lost + 1).cast("int")), lambda x: x["g"]))


def _parts(counters: Column, gram: Column) -> Column:
    rows = F.pow(F.lit(2.0), estimate(counters, gram) / 8)
    return F.least(F.ceil(rows / PART_ROWS), F.lit(MOST_PARTS)).cast("int")


def _met(few: DataFrame, all_: DataFrame, lost: Column, few_counters: Column, all_counters: Column) -> DataFrame:
    """a, b: texts of `few` and of `all_` that share one of a's rarest places, each pair at the first that it shares.

    A place's rows are dealt to a grid: those of `few` by parts of their own number, each to all parts of the others.
    """
    form = few.select(F.col("text").alias("a"), F.col("n").alias("an"), F.col("bag").alias("ab"), F.explode("forms").alias("form"), F.size("forms").alias("af"))
    form = form.withColumn("_lost", lost).withColumn("own", _rarest(F.col("form"), F.col("_lost"), all_counters))
    left = form.select("*", F.posexplode("own").alias("at", "g")).select("a", "an", "ab", "af", "form", F.slice("own", F.lit(1), F.col("at")).alias("before"), "g")
    right = all_.select(F.col("text").alias("b"), F.col("n").alias("bn"), F.col("bag").alias("bb"), F.size("forms").alias("bf"), F.explode(F.array_distinct(places(F.col("text")))).alias("g"))
    left = left.withColumn("i", F.pmod(F.xxhash64("a"), _parts(few_counters, F.col("g"))).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), _parts(all_counters, F.col("g")) - 1)))
    right = right.withColumn("j", F.pmod(F.xxhash64("b"), _parts(all_counters, F.col("g"))).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), _parts(few_counters, F.col("g")) - 1)))
    padded = F.concat(F.lit(" "), F.col("b"), F.lit(" "))
    first = ~F.exists("before", lambda g: F.contains(padded, g))
    return left.join(right, ["g", "i", "j"]).where(first)


def _enough(n: Column, m: Column, c: float, window: bool) -> Column:
    """Least number of a's places (a has n characters) that b (m characters) has in a pair of score c or more."""
    unlike = F.greatest(n, m) / F.least(n, m)
    words = c / WORDS
    whole = n + 1 - F.floor(2 * n + m - 1.5 * c * (n + m) + 1e-9)
    sets = F.floor(F.least(n, m) * words / (2 - words)) - 1
    in_window = n + 1 - _lost_window(n, c / WINDOW) if window else F.lit(1)
    return F.when(unlike < ALIKE, F.least(whole, sets)).otherwise(F.least(whole, F.when(n < m, in_window).otherwise(whole)))


def _possible(c: float) -> Column:
    """Whether a pair (a, b, lengths, bags) can have the score: no common subsequence is longer than the characters that
    both have, and the shared words are known."""
    n, m = F.col("an"), F.col("bn")
    common = F.size(F.array_intersect("ab", "bb"))
    whole = 2 * common >= c * (n + m) - 1e-9
    window = 2 * common >= c / WINDOW * (F.least(n, m) + common) - 1e-9
    mine, other = (F.array_distinct(F.split(x, " ")) for x in ("a", "b"))
    long = lambda words: F.char_length(F.array_join(words, " "))
    both, left, right = F.array_intersect(mine, other), F.array_except(mine, other), F.array_except(other, mine)
    words = (F.size(both) > 0) & (2 * long(both) >= c / WORDS * (2 * long(both) + 1 + F.least(long(left), long(right))) - 1e-9)
    inside = (F.size(both) > 0) & ((F.size(left) == 0) | (F.size(right) == 0))
    return whole | F.when(F.greatest(n, m) < ALIKE * F.least(n, m), words | inside).otherwise(window)


def aligned_candidates(names: DataFrame, labels: DataFrame, cutoff: float, k: int, counted: bool = True) -> DataFrame:
    """a, b: every pair that may be among the k best matches of a name (`names`, `labels` as _texts gives them).

    With `counted` off, pairs are not held against the places and characters that they must share.
    """
    c = cutoff / 100
    gram = lambda rows: rows.select(F.explode(places(F.col("text"))).alias("g"))
    of_names, of_labels = sketch(gram(names), "g"), sketch(gram(labels), "g")
    reach = F.greatest("an", "bn") <= F.least("an", "bn") * FAR
    by_name = _met(names, labels, F.greatest(_lost_whole(F.char_length("form"), c), _lost_window(F.char_length("form"), c / WINDOW)), of_names, of_labels).where(reach)
    by_label = _met(labels, names, _lost_window(F.char_length("form"), c / WINDOW), of_labels, of_names).where(reach & ((F.col("an") < F.col("bn")) | (F.col("af") > 1) | (F.col("bf") > 1)))
    shared = F.size(F.filter(places(F.col("form")), lambda g: F.contains(F.concat(F.lit(" "), F.col("b"), F.lit(" ")), g)))
    enough = (F.col("af") > 1) | (F.col("bf") > 1) | (shared >= _enough(F.col("an"), F.col("bn"), c, True)) & _possible(c) if counted else F.lit(True)
    found = by_name.where(enough).select("a", "b").union(by_label.where(enough).select(F.col("b").alias("a"), F.col("a").alias("b")))
    tiny = next(n for n in range(1, 1000) if int(n * (4 - 4 * c / WINDOW) / (2 - c / WINDOW) + 1e-9) + 2 <= n)
    found = found.union(_tiny(names, labels, tiny)).union(_tiny(labels, names, tiny).select("b", "a"))
    if cutoff <= 100 * WORDS * WINDOW:
        found = found.union(_by_word(names, labels, k))
    return found.distinct()


def _tiny(few: DataFrame, all_: DataFrame, tiny: int) -> DataFrame:
    """a, b: texts of `few` below `tiny` characters, and longer texts within reach that have one of these characters.

    So short a text may share no pair of characters with the window that is like it.
    """
    short = few.where(F.col("n") < tiny).select(F.col("text").alias("a"), F.col("n").alias("an"), F.explode(F.array_distinct(F.split("text", ""))).alias("g"))
    long = all_.where(F.col("n") < tiny * FAR).select(F.col("text").alias("b"), F.col("n").alias("bn"), F.explode(F.array_distinct(F.split("text", ""))).alias("g"))
    return short.join(long, "g").where((F.col("bn") >= F.col("an") * ALIKE) & (F.col("bn") <= F.col("an") * FAR)).select("a", "b")


def _by_word(names: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """a, b: of the labels of one length that hold a name's word, the k of smallest keys."""
    word = lambda rows: F.explode(F.array_distinct(F.split(rows, " "))).alias("w")
    own = labels.select(F.col("text").alias("b"), "key", F.col("n").alias("bn"), word("text"))
    top = own.withColumn("_r", F.row_number().over(Window.partitionBy("w", "bn").orderBy("key", "b"))).where(F.col("_r") <= k)
    unlike = F.greatest("an", "bn") / F.least("an", "bn")
    asked = names.select(F.col("text").alias("a"), F.col("n").alias("an"), word("text"))
    return asked.join(top, "w").where(unlike.between(ALIKE, FAR)).select("a", "b")


def aligned_matches(names: DataFrame, name: str, candidates: DataFrame, key: str, label: str, cutoff: float = 75.0, k: int = 10) -> DataFrame:
    """(name, key, label, score, rank): the k candidates of highest weighted score for each distinct name, ties to the
    smaller key.

    Texts are compared with single blanks between words and none around them; null and blank ones match nothing. A
    label that several candidates share stands for the smallest key. Cutoffs below `LEAST` raise ValueError.
    """
    if cutoff < LEAST:
        raise ValueError(f"the cutoff must be {LEAST} at least")
    asked, known = _texts(names, name, None), _texts(candidates, label, key)
    pairs = aligned_candidates(asked, known, cutoff, k).select(F.col("a").alias("name"), F.col("b").alias("label"))
    scored = pairs.withColumn("score", weighted_similarity(F.col("name"), F.col("label"))).where(F.col("score") >= cutoff)
    scored = scored.join(known.select(F.col("text").alias("label"), "key"), "label")
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("score"), "key", "label"))
    return scored.select("name", "key", "label", "score", rank.alias("rank")).where(F.col("rank") <= k)
