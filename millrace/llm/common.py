"""Helpers that several operators share: lineage cuts, stable row numbers and two-level ranking inside skewed groups."""

from __future__ import annotations

import contextlib
import ctypes
import math

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters that separate words in every word-based contract: blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; where none is set, a local master gets a folder and a cluster an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or "/tmp/checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from those files."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Lower the session's bytes per Arrow batch, so that a Python worker holds a few MB of texts at a time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = (spark.conf.get(name, None) or "").rstrip("b")
    if not own.isdigit() or int(own) > most:
        spark.conf.set(name, f"{most}b")


def give_back() -> None:
    """Return freed memory of this Python worker, which outlives its task, to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def _of_one_table(df: DataFrame) -> bool:
    """Whether the rows of `df` are rows of one relation, each once at most (projections and filters only)."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.nodeName().startswith("LogicalRelation") or plan.nodeName().startswith("Relation")


def numbered(rows: DataFrame, *columns: str | Column, name: str = "_rid") -> DataFrame:
    """The `columns`, and `name`: a struct that tells all rows apart and stays theirs however the table is read again.

    Rows of a Parquet table are known by their file and place in it, whatever the splits. All other rows are written
    to the checkpoint folder once, where their numbers are fixed.
    """
    if "_metadata" not in rows.columns and _of_one_table(rows):
        try:
            place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
            return rows.select(*columns, place.alias(name))
        except AnalysisException:  # a format without row numbers
            pass
    kept = cut(rows.select(*columns))
    return kept.withColumn(name, F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("at")))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def group_key(column: Column) -> Column:
    """A key that is never null: null groups stay apart from empty strings."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), text))


def seeded(seed: int, *columns: Column) -> Column:
    """A seeded number of 60 bits, from an MD5 of the columns that aren't null, so that plain SQL can give it too."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns])
    return F.conv(F.left(F.md5(text), F.lit(15)), 16, 10).cast("long")


def bucket_count(rows: int, rows_per_bucket: int = 500, most: int = 1 << 20) -> int:
    """Parts of about `rows_per_bucket` rows; beyond `most` parts (half a billion rows) the parts grow with the rows."""
    return max(1, min(most, math.ceil(rows / rows_per_bucket)))


def ranked(df: DataFrame, buckets: int, group: str, order: str, ties: list[str], value: str, extra: DataFrame | None = None) -> DataFrame:
    """Rank and running sum of `value` inside each group, without one task per group.

    Rows of a group are ordered by (order mod buckets, order, ties). A group's rows fall into `buckets` parts of
    nearly equal size, whatever the group's size; only the parts' counts and sums are accumulated per group.
    Adds _rank (from 1), _before (sum of value of earlier rows), _rows and _sum (of the group), and the columns of
    `extra` (keyed by `group`), which are joined to the small table of parts and not to the rows.
    """
    df = df.withColumn("_part", F.pmod(F.col(order), F.lit(buckets)).cast("int"))
    parts = df.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
    whole, earlier = Window.partitionBy(group), Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        group,
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rank0"),
        F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_before0"),
        F.sum("_n").over(whole).alias("_rows"),
        F.sum("_v").over(whole).alias("_sum"),
    )
    if extra is not None:
        parts = parts.join(extra, group)
    inside = Window.partitionBy(group, "_part").orderBy(order, *ties)
    return (
        df.join(parts, [group, "_part"])
        .withColumn("_rank", F.col("_rank0") + F.row_number().over(inside))
        .withColumn("_before", F.col("_before0") + F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_part", "_rank0", "_before0")
    )


def join_groups(rows: DataFrame, groups: DataFrame, *keys: str, most: int = 100_000, salts: int = 32) -> DataFrame:
    """The rows with the columns of their group (one row of `groups` for each value of the keys, null a value too).

    Groups are counted: up to `most` of them are broadcast; more are written out `salts` times, so that the rows of a
    group that holds a large share of all meet it in that many tasks. A row without a group has nulls.
    """
    own = groups.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    if own.limit(most + 1).count() <= most:
        out = rows.join(F.broadcast(own), same, "left")
    else:
        salted = own.withColumn("_k_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(F.lit("salt"), *rows.columns), F.lit(salts)).cast("int"))
        out = dealt.join(salted, [*same, F.col("_salt") == F.col("_k_salt")], "left").drop("_salt", "_k_salt")
    return out.drop(*[f"_k_{k}" for k in keys])
