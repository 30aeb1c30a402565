"""Pages, words and tables of documents, once something has read them into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_slice(rows: DataFrame, first: int, last: int, page: str = "page") -> DataFrame:
    """Pages first to last, counted from 1, both included."""
    return rows.where(F.col(page).between(first, last))


def words_between(words: DataFrame, low: float, high: float, left: str = "x0", ties: tuple[str, ...] = ("text",)) -> DataFrame:
    """Words whose left edge lies in [low, high], from left to right."""
    return words.where(F.col(left).between(low, high)).orderBy(left, *ties)


def words_like(words: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    return words.where(F.col(text).rlike(pattern))


def first_tables(tables: DataFrame, document: str = "path", page: str = "page", table: str = "table_no") -> DataFrame:
    """Of each page's tables the first; pages without one have no rows."""
    first = tables.groupBy(document, page).agg(F.min(table).alias(table))
    return tables.join(first, [document, page, table], "left_semi")


def range_rows(rows: DataFrame, ranges: Column, document: str = "path", page: str = "page", row: str = "row_no") -> DataFrame:
    """(document, range_no, cells, place): the rows of each page range, each distinct row once, where it comes first.

    Blank cells are null, and rows are compared cell by cell. `ranges`: array<struct<first, last>>.
    """
    cells = F.transform("cells", lambda c: F.nullif(c, F.lit("")))
    placed = rows.select(document, page, row, cells.alias("cells"), F.posexplode(ranges).alias("range_no", "_r")).where(F.col(page).between(F.col("_r.first"), F.col("_r.last")))
    return placed.groupBy(document, "range_no", "cells").agg(F.min(F.struct(page, row)).alias("place"))


def page_count(content: Column) -> Column:
    """Pages of a PDF whose page objects are stored plainly; null for other content (compressed object streams too)."""
    text = F.decode(content, "ISO-8859-1")
    n = F.regexp_count(text, F.lit(r"/Type\s*/Page[^s]"))
    return F.when(text.startswith("%PDF") & (n > 0), n)
