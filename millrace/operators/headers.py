"""Header detection and harmonisation in long form: (source_file, row_no, cells) in, one wide table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T


def header_rows(cells: DataFrame, file: str = "source_file", most: int = 4) -> DataFrame:
    """(file, header_start, header_end): the best of the first `most` rows and the rows that go on from it.

    The run goes on while a row's score is positive and not below the one before; row 0 where no score is positive.
    """
    scored = cells.where(F.col("row_no") < most).select(file, "row_no", T.header_score(F.col("cells")).alias("score"))
    per_file = scored.groupBy(file).agg(F.array_sort(F.collect_list(F.struct("row_no", "score"))).alias("s"))
    best = F.array_max(F.transform("s", lambda x: F.struct(x["score"], (-x["row_no"]).alias("at"))))
    start = F.when(best["score"] > 0, -best["at"]).otherwise(0)
    with_start = per_file.withColumn("header_start", start.cast("int")).withColumn("_best", best["score"])
    step = lambda a, x: F.when(
        a["open"] & (x["row_no"] == a["end"] + 1) & (x["score"] > 0) & (x["score"] >= a["last"]),
        F.struct(x["row_no"].alias("end"), x["score"].alias("last"), F.lit(True).alias("open")),
    ).otherwise(F.struct(a["end"].alias("end"), a["last"].alias("last"), (a["open"] & (x["row_no"] <= a["end"])).alias("open")))
    first = F.struct(F.col("header_start").alias("end"), F.col("_best").alias("last"), (F.col("_best") > 0).alias("open"))
    return with_start.select(file, "header_start", F.aggregate("s", first, step)["end"].alias("header_end"))


def merged_headers(cells: DataFrame, spans: DataFrame, file: str = "source_file") -> DataFrame:
    """(file, col_no, name, key): each column's header parts joined by a blank, blank parts left out."""
    own = cells.join(spans, file).where(F.col("row_no").between(F.col("header_start"), F.col("header_end")))
    parts = own.select(file, "row_no", F.posexplode("cells").alias("col_no", "cell")).groupBy(file, "col_no")
    found = parts.agg(F.array_sort(F.collect_list(F.struct("row_no", T.strip(F.coalesce("cell", F.lit(""))).alias("c")))).alias("p"))
    name = F.array_join(F.filter(F.transform("p", lambda x: x["c"]), lambda c: c != ""), " ")
    return found.select(file, "col_no", name.alias("name")).withColumn("key", T.header_key(F.col("name")))


def long_values(cells: DataFrame, file: str = "source_file") -> DataFrame:
    """(file, row_no, key, value): data cells by canonical key, the leftmost known value where headers share a key.

    Rows above and in the header are dropped, and so are empty rows and columns without a name.
    """
    spans = header_rows(cells, file)
    heads = merged_headers(cells, spans, file).where((T.strip(F.col("name")) != "") & ~F.lower("name").startswith("unnamed"))
    data = cells.join(spans, file).where((F.col("row_no") > F.col("header_end")) & (F.size("cells") > 0))
    values = data.select(file, "row_no", F.posexplode("cells").alias("col_no", "cell")).withColumn("value", T.known_value(F.col("cell")))
    joined = values.join(heads.select(file, "col_no", "key"), [file, "col_no"])
    return joined.groupBy(file, "row_no", "key").agg(F.min_by("value", F.when(F.col("value").isNotNull(), F.col("col_no"))).alias("value"))


def harmonise(cells: DataFrame, file: str = "source_file") -> DataFrame:
    """One wide row per data row: file, operator id and name, the canonical columns, then `extra` (a sorted map)."""
    values = long_values(cells, file)
    known = F.col("key").isin(*T.CANONICAL)
    picked = [F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in T.CANONICAL]
    extra = F.map_from_entries(F.array_sort(F.collect_list(F.when(~known & F.col("value").isNotNull(), F.struct("key", "value"))))).alias("extra")
    number, name = T.folder_parts(F.split_part(F.col(file), F.lit("/"), F.lit(1)))
    wide = values.groupBy(file, "row_no").agg(*picked, extra)
    return wide.select(file, number.alias("operator_id"), name.alias("operator_name"), "row_no", *T.CANONICAL, "extra")


def coalesce_same_named(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns in order under new names; columns that share a name become its first value that isn't null."""
    held = df.toDF(*[f"_{i}" for i in range(len(names))])
    return held.select(*[F.coalesce(*[F.col(f"_{i}") for i, n in enumerate(names) if n == name]).alias(name) for name in dict.fromkeys(names)])


def distinct_rows(rows: DataFrame, by: list[str], place: str) -> DataFrame:
    """Each distinct row once, with the place of its first occurrence; equal rows meet after a partial aggregate."""
    return rows.groupBy(*by).agg(F.min(place).alias(place))


def histogram(rows: DataFrame, column: str, width: float) -> DataFrame:
    """(bin, low, n): counts over bins of `width` whose edges begin at the smallest value; when run, an error if there
    is no value."""
    low, some = rows.agg(F.min(column), F.count(column)).first()
    if not some:
        raise ValueError(f"no values in {column}")
    placed = rows.where(F.col(column).isNotNull()).select(F.floor((F.col(column) - F.lit(low)) / width).cast("long").alias("bin"))
    return placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).select("bin", (F.lit(float(low)) + F.col("bin") * width).alias("low"), "n")


def spelled_out(wide: DataFrame, most: int = 10_000) -> DataFrame:
    """Canonical keys under their display names, and each extra key as a column (names sorted); more than `most` extra
    keys raise ValueError."""
    names = [r[0] for r in wide.select(F.explode(F.map_keys("extra"))).distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} extra columns")
    fixed = [F.col(k).alias(v) for k, v in T.CANONICAL.items()]
    return wide.select("source_file", "operator_id", "operator_name", *fixed, *[F.col("extra")[n].alias(n) for n in sorted(names)])


def reordered(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns in order; those that don't exist are null text."""
    return df.select(*[F.col(f"`{n}`") if n in df.columns else F.lit(None).cast("string").alias(n) for n in names])


def renames(columns: list[str], spark: SparkSession) -> dict[str, str]:
    """Old -> new name: the display name of a known header, else its _extra_ key; blank headers are left out."""
    found = spark.createDataFrame([(c,) for c in columns], "name string").select("name", T.header_key(F.col("name")).alias("key")).collect()
    return {r["name"]: T.CANONICAL.get(r["key"], r["key"]) for r in found if r["name"].strip()}


def values_under(cells: DataFrame, pattern: str, file: str = "source_file") -> DataFrame:
    """(value): the distinct cleaned cells below row 0 of each file's column whose header matches the pattern, sorted.

    When run, an error if a file has several such columns. Blank cells count as values, null ones don't.
    """
    head = cells.where("row_no = 0").select(file, F.posexplode("cells").alias("col_no", "name"))
    own = head.where(F.col("name").rlike(f"(?iu){pattern}")).groupBy(file).agg(F.count(F.lit(1)).alias("_n"), F.min("col_no").alias("col_no"))
    own = own.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("several columns match")).cast("boolean")))
    value = F.replace(F.trim(F.get("cells", F.col("col_no"))), F.lit("\n"), F.lit(""))
    return cells.where("row_no > 0").join(own, file).select(value.alias("value")).where("value is not null").distinct().orderBy("value")


def widths(cells: DataFrame, file: str = "source_file") -> DataFrame:
    """(file, width): the most cells that a row of the file has."""
    return cells.groupBy(file).agg(F.max(F.size("cells")).alias("width"))


def without_empty_rows(df: DataFrame) -> DataFrame:
    """Rows with at least one value."""
    return df.na.drop("all")
