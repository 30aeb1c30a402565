"""Corpus pipeline: stages over the documents table, each one an operator of millrace.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the shared folder and
reads it again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid, line_dedup, mixing, packing, queries, similar
from millrace.llm.common import checkpoint_dir, numbered

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no learned language go: no letter, or no language that takes half of the probability.

    A document without a label gets the predicted language as its `lang`. Where no language could be learned (no
    label, or no labelled text with a letter), only documents without a letter go.
    """
    model = langid.train(docs, where=F.lit(True))
    if not model.langs:
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(docs.select(*COLUMNS), model).where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5))
    return found.select(*[F.coalesce("row.lang", "lang_pred").alias("lang") if c == "lang" else F.col(f"row.{c}") for c in COLUMNS])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks of 10 words or more and repeated long lines go; a document that has no other line goes too."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS), min_span=10)
    return _with_text(out.where((F.col("left") > 0) | (F.size("removed") == 0)), F.col("text"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (sets of five words, exact similarity 0.8 or more) one row stays.

    That is the row of the smallest doc_id, null last, the first in the table of several such; rows with equal or null
    ids are told apart by their place.
    """
    rows = numbered(docs, *COLUMNS)
    groups = similar.near_copies(rows.select("_rid", F.col("doc_id").alias("_k"), "text"))
    order = F.struct(F.col("_k").isNull().alias("a"), F.col("_k").alias("b"), F.col("_rid").alias("c"))
    keep = groups.groupBy("_group").agg(F.min(order)["c"].alias("_rid")).select("_rid")
    return rows.join(keep, "_rid", "left_semi").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents are left out, cut, or read again as their source's blocks say."""
    mixed = mixing.mixed_texts(mixing.mix(docs.select(*COLUMNS)))
    return _with_text(mixed.select(F.struct("*").alias("row")), F.col("row.text"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048 tokens."""
    pieces = packing.token_pieces(docs, queries._tokenizer(), capacity=2048)
    digest = pieces.select("row.doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digest, capacity=2048).select("row.*", "sequence_id", "offset")


def _with_text(rows: DataFrame, text: Column) -> DataFrame:
    """The columns of documents from `row`, with a new text and its length."""
    return rows.select("row.doc_id", text.alias("text"), "row.lang", "row.source", F.char_length(text).cast("long").alias("n_chars"))


STAGES: list = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("mixing", mixture),
    ("packing", sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
