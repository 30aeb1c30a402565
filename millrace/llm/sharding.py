"""Sharding by proportional stratified interleaving (law: rows).

Rows are shuffled by a seeded hash inside their source. A row's fractional rank is (rank - 1 + start) / rows of the
source, where start in [0, 1) is a seeded hash of the source, so that sources of one row do not all meet at one
point. Rows are ordered by fractional rank and the order is cut into shards whose row counts are at most one apart;
each run of the order holds every source in proportion.

Both orders are found in two levels (parts of about 500 rows, then a window inside each part), so that neither a
hot source nor the whole table ever lies in one task. Only the parts' counts, at most 2^20, meet in one task.

Defined cases: null source is a source of its own; null text has size 1 (no bytes, plus 1); rows that are equal in
every column are interchangeable; an empty table gives an empty result; fewer rows than shards leave the last shards
empty; other columns, whatever their names, are carried along under `row`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_count, group_key, ranked, seeded


def shard_rows(rows: DataFrame, source: str = "source", key: tuple[str, ...] = ("doc_id",), shards: int = 16, seed: int = 20, rows_per_part: int = 500) -> DataFrame:
    """Columns: row (struct of the input's columns), shard int, slot long (gapless from 0 in each shard)."""
    total = rows.select(F.count(F.lit(1))).first()[0]
    parts = bucket_count(total, rows_per_part)
    ids = [F.col(k) for k in key]
    df = rows.select(F.struct("*").alias("row"), group_key(F.col(source)).alias("_g"), seeded(seed, *ids).alias("_h"), F.lit(1).alias("_one"), *[c.alias(f"_k{i}") for i, c in enumerate(ids)])
    ties = [f"_k{i}" for i in range(len(ids))]
    df = ranked(df, parts, "_g", "_h", ties, "_one")
    start = F.pmod(seeded(seed + 1, F.col("_g")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    df = df.withColumn("_f", (F.col("_rank") - 1 + start) / F.col("_rows"))
    df = df.withColumn("_p", F.least(F.floor(F.col("_f") * parts), F.lit(parts - 1)).cast("int")).drop("_before", "_sum", "_one")
    counts = df.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_from"))
    place = F.row_number().over(Window.partitionBy("_p").orderBy("_f", "_g", "_rank"))
    df = df.join(counts, "_p").withColumn("_place", F.col("_from") + place - 1)
    small, longer = divmod(total, shards)
    edge = longer * (small + 1)
    position, size = F.col("_place"), max(small, 1)
    shard = F.when(position < edge, F.floor(position / (small + 1))).otherwise(longer + F.floor((position - edge) / size))
    slot = F.when(position < edge, position % (small + 1)).otherwise((position - edge) % size)
    return df.select("row", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in slot order inside each file."""
    flat = sharded.select("shard", "slot", F.col("row").alias("row"))
    flat.repartition("shard", F.floor(F.col("slot") / 1_000_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
