"""Types of CSV columns: the narrowest type that holds a column's cells, for each file and for all files together.

A cell has a class, a column the union of its cells' classes: one bit each, merged by bit-or in any order, so a type
of all files comes from those of the files. Whole numbers are `long`, but `double` where a cell is missing; words for
true and false are `boolean`; a mixture, or a boolean column with a missing cell, is text; a column without a value is
`double`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

WHOLE, FRACTION, TRUTH, WORDS, NONE = 1, 2, 4, 8, 16
#: Words that stand for true and false, and forms of numbers. (fixed values)
TRUE, FALSE = ("True", "TRUE", "true"), ("False", "FALSE", "false")
_WHOLE, _FRACTION = r"^\s*[+-]?[0-9]+\s*$", r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^[+-]?(inf|Inf|INF|infinity|Infinity|INFINITY)$"


def cell_class(cell: Column) -> Column:
    """One bit; a whole number that no long holds counts as words."""
    whole = F.when(F.trim(cell).try_cast("long").isNotNull(), WHOLE).otherwise(WORDS)
    return F.when(T.known_value(cell).isNull(), NONE).when(cell.rlike(_WHOLE), whole).when(cell.rlike(_FRACTION), FRACTION).when(cell.isin(*TRUE, *FALSE), TRUTH).otherwise(WORDS)


def narrowest(classes: Column) -> Column:
    """The type that holds all of the classes."""
    has = lambda *bits: classes.bitwiseAND(F.lit(sum(bits))) != 0
    mixed = has(WORDS) | (has(TRUTH) & has(WHOLE, FRACTION, NONE))
    return F.when(mixed, "string").when(has(TRUTH), "boolean").when(has(FRACTION, NONE), "double").otherwise("long")


def column_classes(cells: DataFrame, file: str = "source_file") -> DataFrame:
    """(file, name, classes): the classes of each column's cells below row 0, the header; repeated names get ".1" and so
    on. Cells beyond the header are left out, those that a short row lacks are missing, empty rows are dropped."""
    heads = cells.where("row_no = 0").select(file, T.told_apart(F.col("cells")).alias("_h"))
    each = F.transform("_h", lambda h, i: F.struct(h.alias("name"), cell_class(F.get("cells", i)).alias("c")))
    rows = cells.where((F.col("row_no") > 0) & (F.size("cells") > 0)).join(heads, file).select(file, F.inline(each))
    return rows.groupBy(file, "name").agg(F.bit_or("c").alias("classes"))


def column_types(classes: DataFrame, file: str = "source_file") -> DataFrame:
    """(file, name, type) of each file, and under a null file those of all: a file without the column has it missing."""
    files = classes.select(file).distinct().agg(F.count(F.lit(1)).alias("_files"))
    together = classes.groupBy("name").agg(F.bit_or("classes").alias("classes"), F.countDistinct(file).alias("_n")).join(F.broadcast(files))
    together = together.withColumn("classes", F.when(F.col("_n") < F.col("_files"), F.col("classes").bitwiseOR(F.lit(NONE))).otherwise(F.col("classes")))
    both = classes.select(file, "name", "classes").union(together.select(F.lit(None).cast(classes.schema[file].dataType).alias(file), "name", "classes"))
    return both.select(file, "name", narrowest(F.col("classes")).alias("type"))


def typed(cell: Column, type_: Column) -> Column:
    """A cell as a variant of its column's type; null where it is missing."""
    v, blank = T.known_value(cell), F.trim(cell)
    return (
        F.when(v.isNull(), F.lit(None).cast("variant"))
        .when(type_ == "long", blank.try_cast("long").cast("variant"))
        .when(type_ == "double", blank.try_cast("double").cast("variant"))
        .when(type_ == "boolean", v.isin(*TRUE).cast("variant"))
        .otherwise(v.cast("variant"))
    )


def typed_rows(rows: DataFrame, types: DataFrame, file: str = "source_file") -> DataFrame:
    """Rows (file, row_no, fields map) with their fields as variants of the types (file, name, type): of each file's
    own, or of all files' where `types` has a null file only."""
    own = types.groupBy(file).agg(F.map_from_entries(F.collect_list(F.struct("name", "type"))).alias("_types"))
    each = rows.join(own.where(F.col(file).isNotNull()), file) if types.where(F.col(file).isNotNull()).limit(1).count() else rows.join(F.broadcast(own.select("_types")))
    return each.select(file, "row_no", F.transform_values("fields", lambda k, v: typed(v, F.try_element_at("_types", k))).alias("fields"))
