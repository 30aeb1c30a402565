"""Line dedup by content-defined line chunks, in DataFrame functions only.

1. Every line is hashed (MD5, so that plain SQL can do it too). A rolling hash over two line hashes names each pair of neighbouring lines; a pair that occurs
   once in the corpus can't be inside a repeated chunk, so chunks are sought only in runs of repeated pairs.
2. A run is cut at pairs whose rolling hash is larger than those beside it. The rule looks at nothing but these lines,
   so cuts stay where they are when lines are put in before them; every chunk keeps two lines or more.
3. Of the chunks that repeat (equal hashes of their pairs) the first one (smallest id, then row, then line) stays; the
   others are removed with their line ends, after their texts have been compared byte by byte.
4. A passage whose neighbours differ from document to document may lie in chunks that differ. So of the pairs of lines
   that repeat in what is left, each is a chunk of two lines, of which all but the first are later ones; a stretch of
   later pairs goes as a whole. At the end lines of at least `min_words` words that stand in several places are treated
   as chunks of one line.
5. No span goes that has fewer than `min_span` words (the query and the pipeline ask for 10): blank lines, braces and
   salutations then stay, wherever they repeat.

Hot lines and chunks: counts and first places are summed before the shuffle and written once; the joins with them are
plain joins that adaptive execution can split. Nothing is collected but one document's own chunks.

Rows are known by file and place, or numbered once in the checkpoint folder (common.numbered): lost executors or a
change of cores don't change the result, and ids may be null or repeat.

Defined cases: null text stays null and takes no part; an empty text is one empty line; empty lines are lines; equal
rows count as several occurrences, so the first stays whole; a text of which every line is removed becomes empty (its
`left` is 0); null ids come after all others; an empty table gives an empty result; other columns, whatever their
names, are carried along under `row`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, numbered

SPAN = "array<struct<start:int,n:int>>"


def _repeated(rows: DataFrame, by: str, *more: Column) -> DataFrame:
    """`by` values of several rows, with their number _n."""
    return cut(rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), *more).where("_n > 1"))


def chunks(pairs: DataFrame, min_span: int) -> DataFrame:
    """Repeated pairs of lines (_rid, _k, pos, item, words w and v of both lines) -> their chunks (_rid, _k, start, n,
    chunk) of at least `min_span` words."""
    by_row = Window.partitionBy("_rid").orderBy("pos")
    runs = pairs.withColumn("_run", F.col("pos") - F.row_number().over(by_row))
    run = Window.partitionBy("_rid", "_run").orderBy("pos")
    before, after = F.lag("item").over(run), F.lead("item").over(run)
    bound = F.coalesce((F.col("item") > before) & (F.col("item") >= after), F.lit(False))
    inside = runs.withColumn("_bound", bound).where(~F.col("_bound"))
    inside = inside.withColumn("_chunk", F.col("pos") - F.row_number().over(by_row))
    return inside.groupBy("_rid", "_chunk").agg(
        F.first("_k").alias("_k"),
        F.min("pos").alias("start"),
        (F.count(F.lit(1)) + 1).cast("int").alias("n"),
        F.xxhash64(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda x: x["item"])).alias("chunk"),
        (F.sum("w") + F.max_by("v", "pos")).alias("_words"),
    ).where(F.col("_words") >= min_span).drop("_chunk", "_words")


def _places(found: DataFrame) -> DataFrame:
    """The repeated ones of `found`, and `first`: whether this is the one that stays."""
    found = cut(found)
    place = F.struct(F.col("_k").isNull().alias("a"), F.col("_k").alias("b"), F.col("_rid").alias("c"), F.col("start").alias("d"))
    firsts = _repeated(found, "chunk", F.min(place).alias("_first"))
    return cut(found.join(firsts.select("chunk", "_first"), "chunk").select(*found.columns, (place == F.col("_first")).alias("first")))


def _long_stretches(pairs: DataFrame, min_span: int) -> DataFrame:
    """Pairs that stay, and later ones that lie in stretches of at least `min_span` words."""
    later = pairs.where("not first").withColumn("_run", F.col("start") - F.row_number().over(Window.partitionBy("_rid").orderBy("start")))
    stretch = Window.partitionBy("_rid", "_run")
    words = F.sum("w").over(stretch) + F.max_by("v", "start").over(stretch)
    return pairs.where("first").unionByName(later.withColumn("_words", words).where(F.col("_words") >= min_span).drop("_run", "_words")).drop("w", "v")


def _without(rows: DataFrame, gone: DataFrame, reach: int) -> DataFrame:
    """The rows (_rid, pos) that lie in no removed span; a row is `reach` lines longer than one."""
    lost = gone.where("not first").select("_rid", F.explode(F.sequence(F.col("start") - reach, F.col("start") + F.col("n") - 1)).alias("pos"))
    return rows.join(lost.distinct(), ["_rid", "pos"], "left_anti")


def _stretches(at: Column) -> Column:
    """Ascending numbers -> their stretches without a gap."""
    starts, ends = F.array_except(at, F.transform(at, lambda x: x + 1)), F.array_except(at, F.transform(at, lambda x: x - 1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("n")))


def _verified(places: DataFrame, rows: DataFrame) -> DataFrame:
    """The spans to remove (_rid, start, n), after a comparison of all bytes of the chunks that have equal hashes."""
    asked = places.groupBy("_rid").agg(F.collect_list(F.struct("start", "n", "chunk", "first", "round")).alias("_asked"))
    held = rows.select("_rid", "_k", F.split("_t", "\n", -1).alias("_s")).join(asked, "_rid")
    body = lambda c: F.array_join(F.slice("_s", c["start"] + 1, c["n"]), "\n")
    bodies = held.select("_rid", "_k", F.explode(F.transform("_asked", lambda c: F.struct(c["round"].alias("round"), c["chunk"].alias("chunk"), c["start"].alias("start"), c["n"].alias("n"), body(c).alias("body")))).alias("_c")).select("_rid", "_k", "_c.*")
    same = bodies.groupBy("round", "chunk").agg((F.min("body") != F.max("body")).alias("_unlike"))
    unlike = cut(same.where("_unlike").select("round", "chunk"))
    gone = places.where("not first").select("_rid", "start", "n", "round", "chunk")
    if unlike.isEmpty():
        return gone.select("_rid", "start", "n")
    place = F.struct(F.col("_k").isNull().alias("a"), F.col("_k").alias("b"), F.col("_rid").alias("c"), F.col("start").alias("d"))
    mixed = cut(bodies.join(unlike, ["round", "chunk"]))
    firsts = mixed.groupBy("round", "chunk", "body").agg(F.min(place).alias("_first"))
    later = mixed.join(firsts, ["round", "chunk", "body"]).where(place != F.col("_first"))
    return gone.join(unlike, ["round", "chunk"], "left_anti").select("_rid", "start", "n").union(later.select("_rid", "start", "n"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50, min_span: int = 0) -> DataFrame:
    """Columns: row (struct), lines int, removed array<struct<start int, n int>> (never null), left int, text (new)."""
    rows = numbered(docs, F.struct("*").alias("row"), F.col(text).alias("_t"), F.col(key).alias("_k"))
    measured = F.transform(F.split("_t", "\n", -1), lambda x: F.struct(F.md5(x).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w")))
    lines = rows.select("_rid", "_k", measured.alias("_l"))
    number = lambda x: F.conv(F.left(x, F.lit(15)), 16, 10).cast("long")
    pairs = F.transform("_l", lambda x, i: F.struct(i.alias("pos"), number(F.md5(F.concat(x["h"], F.get("_l", i + 1)["h"]))).alias("item"), (i + 1 < F.size("_l")).alias("pair"), x["w"].alias("w"), F.get("_l", i + 1)["w"].alias("v")))
    alone = F.transform("_l", lambda x, i: F.struct(i.alias("pos"), (-1 - number(x["h"])).alias("item"), (x["w"] < min_words).alias("pair"), x["w"].alias("w"), F.lit(0).alias("v")))
    items = lines.select("_rid", "_k", F.explode(F.concat(F.filter(pairs, lambda x: x["pair"]), F.filter(alone, lambda x: ~x["pair"]))).alias("_i")).select("_rid", "_k", "_i.*")
    met = cut(items.join(_repeated(items, "item"), "item"))
    live, long = met.where("pair"), met.where("not pair").select("_rid", "_k", "pos", F.col("item").alias("chunk"))
    places = [_places(chunks(live, min_span))]
    left = cut(_without(live.select("_rid", "_k", "pos", "item", "w", "v"), places[0], 1))
    again = left.join(_repeated(left, "item"), "item").select("_rid", "_k", F.col("pos").alias("start"), F.lit(2).alias("n"), F.col("item").alias("chunk"), "w", "v")
    places.append(cut(_long_stretches(_places(again), min_span)))
    single = _without(_without(long, places[0], 0), places[1], 0)
    places.append(_places(single.select("_rid", "_k", F.col("pos").alias("start"), F.lit(1).alias("n"), "chunk")))
    places = [p.withColumn("round", F.lit(i)) for i, p in enumerate(places)]
    every = places[0]  # all with the same columns
    for more in places[1:]:
        every = every.unionByName(more)
    spans = F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("n") - 1)))
    gone = _verified(every, rows).groupBy("_rid").agg(F.array_sort(F.array_distinct(spans)).alias("_at"))
    gone = gone.select("_rid", _stretches(F.col("_at")).alias("_gone"))
    split, out = F.split("_t", "\n", -1), rows.join(gone, "_rid", "left")
    total = F.coalesce(F.when(F.col("_t").isNotNull(), F.size(split)), F.lit(0))
    ends = F.concat(F.transform("_gone", lambda s: s["start"]), F.array(total))
    kept = F.flatten(F.transform(F.concat(F.array(F.lit(0)), F.transform("_gone", lambda s: s["start"] + s["n"])), lambda a, i: F.slice(split, a + 1, F.get(ends, i) - a)))
    lost = F.aggregate(F.col("_gone"), F.lit(0), lambda a, s: a + s["n"])
    return out.select(
        "row",
        total.alias("lines"),
        F.coalesce("_gone", F.array().cast(SPAN)).alias("removed"),
        (total - F.coalesce(lost, F.lit(0))).alias("left"),
        F.when(F.col("_gone").isNull(), F.col("_t")).otherwise(F.array_join(kept, "\n")).alias("text"),
    )
