"""Readers and writers: CSV folders, CSV cells in long form, JSON tables and arrays, whole files, named documents."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.sources import records


def below(root: str, path: Column | None = None) -> Column:
    """The file's decoded path below the last `root`/."""
    at = F.url_decode(F.replace(F.col("_metadata.file_path") if path is None else path, F.lit("+"), F.lit("%2B")))
    return F.substring_index(at, f"{root.rstrip('/').rsplit('/', 1)[-1]}/", -1)


def read_cells(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(source_file, row_no, cells): each record of each CSV file, whatever its width; large files are read in ranges.

    Bytes that aren't UTF-8 are replaced. `pattern` is matched against file names, "*csv" for any that end so.
    """
    found = records.read_records(spark, root, pattern)
    return found.select(below(root, F.col("path")).alias("source_file"), F.col("row_no").cast("int").alias("row_no"), "cells")


def read_preview(spark: SparkSession, root: str, pattern: str = "*.csv", most: int = 4) -> DataFrame:
    """read_cells() of the first records of each file; only the files' first bytes are read."""
    found = records.first_records(spark, root, pattern, most)
    plain = F.replace(F.col("path"), F.lit("%"), F.lit("%25"))
    return found.select(below(root, plain).alias("source_file"), F.col("row_no").cast("int").alias("row_no"), "cells")


def preview(cells: DataFrame, most: int = 4) -> DataFrame:
    """The first records of each file."""
    return cells.where(F.col("row_no") < most)


def source_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(source_file), sorted; files without a byte are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select(below(root).alias("source_file")).orderBy("source_file")


def read_rows(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(source_file, row_no, fields): the data rows of CSV files whose record 0 is the header, each file by its own.

    `fields` maps header -> value; missing-value words and blank cells are left out. Of headers that repeat in a file,
    all but the first get ".1", ".2" and so on; cells beyond the header are left out; rows without cells are dropped.
    """
    cells = read_cells(spark, root, pattern)
    return rows_by_header(cells)


def rows_by_header(cells: DataFrame, file: str = "source_file") -> DataFrame:
    """read_rows() over records that have been read."""
    heads = cells.where("row_no = 0").select(file, T.told_apart(F.col("cells")).alias("_h"))
    rows = cells.where((F.col("row_no") > 0) & (F.size("cells") > 0)).join(heads, file)
    pairs = F.filter(F.transform("_h", lambda h, i: F.struct(h.alias("k"), T.known_value(F.get("cells", i)).alias("v"))), lambda p: p["v"].isNotNull())
    return rows.select(file, "row_no", F.map_from_entries(pairs).alias("fields"))


def read_tables(spark: SparkSession, root: str, columns: list[str], pattern: str = "*.csv") -> DataFrame:
    """The named columns of all CSV files, by header name whatever a file's order of columns, and source_file."""
    rows = read_rows(spark, root, pattern)
    return rows.select(*[F.try_element_at("fields", F.lit(c)).alias(c) for c in columns], "source_file")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the JSON array of a file (or of each file of a folder), read in ranges of lines; a missing file has none.

    Elements that don't fit the schema are rows of nulls.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return records.read_elements(spark, path, "*").select(F.from_json("element", schema).alias("r")).select("r.*")


def read_json_tables(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """(source_file, row_no, cells): JSON files that each hold one table as an array of arrays, row 0 the header."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    return json_tables(files.select(below(root).alias("source_file"), "value"))


def json_tables(files: DataFrame, file: str = "source_file", value: str = "value") -> DataFrame:
    """read_json_tables() over texts that have been read."""
    return files.select(file, F.posexplode(F.from_json(value, "array<array<string>>")).alias("row_no", "cells"))


def lookup_entries(text: Column) -> Column:
    """{"entries": {code: {"canonical_name": name}}} -> array<struct<code, name>> in the file's order; null names stay."""
    entries = F.map_entries(F.from_json(text, "struct<entries:map<string,struct<canonical_name:string>>>")["entries"])
    return F.transform(entries, lambda e: F.struct(e["key"].alias("code"), e["value"]["canonical_name"].alias("name")))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """One row with the lookup file's `entries`."""
    return spark.read.text(path, wholetext=True).select(lookup_entries(F.col("value")).alias("entries"))


def read_bytes(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length", "content")


def scratch(spark: SparkSession) -> str:
    """A new folder that the driver and all tasks share, below spark.checkpoint.dir; a local master needs none set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp()
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{uuid.uuid4().hex}")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """A folder of CSV files; `path` must not be one that `df` reads."""
    df.write.csv(path, header=header, escape='"', quoteAll=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, mode=mode)


def write_tables(rows: DataFrame, path: str, folder: str = "folder", table: str = "table", width: int | None = None) -> None:
    """Rows (folder, table, place, cells) -> one headerless CSV folder for each table, below its folder, in order.

    Every table is as wide as the widest (or `width`): blank cells fill up.
    """
    wide = width or rows.agg(F.max(F.size("cells"))).first()[0] or 0
    flat = rows.select(folder, table, "place", *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(wide)])
    sorted_ = flat.repartition(folder, table).sortWithinPartitions(folder, table, "place").drop("place")
    sorted_.write.partitionBy(folder, table).csv(path, header=False, escape='"', mode="overwrite")


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, nulls kept, other scripts as they are."""
    df.write.json(path, ignoreNullFields=False, mode="overwrite")


def write_json_array(df: DataFrame, path: str, order: list[str]) -> None:
    """One JSON array in one file of the folder, for labels of a size that a person has given; rows in order."""
    every = F.array_sort(F.collect_list(F.struct(*order, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("_json"))))
    text = F.concat(F.lit("[\n"), F.array_join(F.transform(every, lambda x: x["_json"]), ",\n"), F.lit("\n]"))
    df.agg(text.alias("value")).write.mode("overwrite").text(path)


def write_case(df: DataFrame, path: str, row_hash: str) -> None:
    """Edge cases: each row as JSON in a folder named by its hash."""
    named = df.select(F.col(row_hash).cast("string").alias("_case"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    named.write.partitionBy("_case").mode("overwrite").text(path)


def document_names(rows: DataFrame, folder: str, name: str, order: str) -> DataFrame:
    """Adds `file`: the name, from the second of a folder's equal names on with _1, _2 and so on before its ending.

    A suffixed name that is another document's own name gets a further suffix in the same way.
    """
    first = rows.withColumn("file", _suffixed(F.col(name), F.row_number().over(_by(folder, name, order)) - 1))
    return first.withColumn("file", _suffixed(F.col("file"), F.row_number().over(_by(folder, "file", F.col("file") != F.col(name), order)) - 1))


def _suffixed(name: Column, number: Column) -> Column:
    ending = F.regexp_extract(name, r"(?s)[^/.](\.[^./]*)$", 1)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(ending))
    return F.when(number == 0, name).otherwise(F.concat(stem, F.lit("_"), number.cast("string"), ending))


def _by(folder: str, name: str, *order: str | Column) -> WindowSpec:
    return Window.partitionBy(folder, name).orderBy(*order)


def write_documents(rows: DataFrame, path: str, folder: str = "folder", file: str = "file", content: str = "content") -> None:
    """Each document's bytes as <path>/<folder>/<file>, written by the tasks through Hadoop's file systems.

    A task that runs again writes the same bytes over its own.
    """
    for part in rows.select(folder, file).where(F.col(file).contains("/")).limit(1).collect():
        raise ValueError(f"a file name with a slash: {part[1]}")
    from pyarrow import fs

    def write(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        for batch in found:
            for d, f, body in zip(batch[folder], batch[file], batch[content], strict=True):
                store.create_dir(str(PurePosixPath(base, d)), recursive=True)
                with store.open_output_stream(str(PurePosixPath(base, d, f))) as out:
                    out.write(body)
            yield pd.DataFrame({"n": [len(batch)]})

    rows.select(folder, file, content).mapInPandas(write, "n long").agg(F.sum("n")).collect()
