"""Calls of models and services over rows: prompts in, checked answers out.

A client is any object with `ask(requests: list[str]) -> list[str | None]` that can be pickled or builds its connection
at the first call in a worker; `Recorded` answers from a dictionary and `RecordedTable` from a DataFrame of any size,
for runs without a network and for answers of earlier runs. Batches are
bounded by `batch`, requests of one batch may be answered in parallel by the client, and a row's answer stays with its
row: positions never leave it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text as X

#: What a clue extraction answers. (fixed values)
ASSET_TYPES = ("power_line", "substation", "generator")
CLUES = "struct<location_clues:array<string>,asset_type:string>"
#: Settings of a structured call: context and answer length in tokens, temperature. (fixed values)
OPTIONS = {"num_ctx": 16384, "num_predict": 512, "temperature": 0}


class Client(Protocol):
    def ask(self, requests: list[str]) -> list[str | None]: ...


@dataclass
class Recorded:
    """Answers by request; what isn't recorded has none."""

    answers: dict[str, str] = field(default_factory=dict)

    def ask(self, requests: list[str]) -> list[str | None]:
        return [self.answers.get(r) for r in requests]


@dataclass
class RecordedTable:
    """Answers in a DataFrame (request, answer): they are joined by the requests' digests. Of several answers of one
    request the largest counts; what isn't recorded has none."""

    answers: DataFrame

    def by_digest(self, digest: str) -> DataFrame:
        return self.answers.where(F.col("request").isNotNull()).groupBy(F.sha2("request", 256).alias(digest)).agg(F.max("answer").alias("_recorded"))


def answered(rows: DataFrame, request: Column, client: Client | RecordedTable, answer: str = "answer", batch: int = 64) -> DataFrame:
    """The rows and their answers (text); a null request isn't asked and has a null answer."""
    if isinstance(client, RecordedTable):
        held = rows.select(F.struct("*").alias("_row"), F.sha2(request.cast("string"), 256).alias("_digest")).join(client.by_digest("_digest"), "_digest", "left")
        return held.select("_row.*", F.col("_recorded").alias(answer))
    asked = rows.select(F.struct("*").alias("_row"), request.cast("string").alias("_request"))
    schema = T.StructType([asked.schema["_row"], T.StructField(answer, T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for a in range(0, part.num_rows, batch):
                own = part.slice(a, batch)
                requests = own.column(1).to_pylist()
                found = iter(client.ask([r for r in requests if r is not None]))
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array([None if r is None else next(found) for r in requests], pa.string())], names=schema.names)

    return asked.mapInArrow(run, schema).select("_row.*", answer)


def messages(instructions: str, examples: str, row: Column, model: str, schema: dict | None = None, options: dict | None = None) -> Column:
    """One chat request as JSON: a system message (instructions, answer schema and examples), the row as the user's,
    the schema that the answer must follow, and the options of the call."""
    form = schema or {"type": "object", "properties": {"location_clues": {"type": "array", "items": {"type": "string"}}, "asset_type": {"enum": [*ASSET_TYPES, None]}}, "required": ["location_clues", "asset_type"]}
    system = f"{instructions}\n\nAnswer as JSON of this schema:\n{json.dumps(form, ensure_ascii=False)}\n\n{examples}"
    talk = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), row.alias("content")))
    head = {"model": model, "format": form, "options": options or OPTIONS, "think": False, "stream": False}
    return F.concat(F.lit(json.dumps(head, ensure_ascii=False)[:-1] + ', "messages": '), F.to_json(talk), F.lit("}"))


def clues(answer: Column) -> Column:
    """The answer as CLUES: null where it isn't such JSON; an asset type that isn't known is null."""
    got = F.from_json(answer, CLUES)
    kind = F.when(got["asset_type"].isin(*ASSET_TYPES), got["asset_type"])
    return F.when(got["location_clues"].isNotNull(), F.struct(got["location_clues"].alias("location_clues"), kind.alias("asset_type")))


def extract_clues(rows: DataFrame, client: Client | RecordedTable, request: Column, prefix: str = "inferred:") -> DataFrame:
    """The rows and two columns, `location_clues` and `asset_type`, after the prefix.

    Rows that have either already (a run that is taken up again) keep theirs and aren't asked.
    """
    names = [f"{prefix}location_clues", f"{prefix}asset_type"]
    for name, kind in zip(names, ("array<string>", "string"), strict=True):
        rows = rows if name in rows.columns else rows.withColumn(name, F.lit(None).cast(kind))
    pending = F.col(f"`{names[0]}`").isNull() & F.col(f"`{names[1]}`").isNull()
    got = answered(rows, F.when(pending, request), client, "_answer").withColumn("_c", clues(F.col("_answer")))
    for name, part in zip(names, ("location_clues", "asset_type"), strict=True):
        got = got.withColumn(name, F.coalesce(F.col(f"`{name}`"), F.col("_c")[part]))
    return got.drop("_answer", "_c")


def by_chunk(rows: DataFrame, client: Client | RecordedTable, file: str, position: str, columns: list[str], instructions: str, size: int = 10, answer: str = "answer") -> DataFrame:
    """The rows and their answers, where `size` rows of a file at a time make one request that is answered by a JSON array.

    When run, an error if an array has not one element for each row.
    """
    own = rows.withColumn("_chunk", F.floor(F.col(position) / size))
    told = F.struct(F.col(position).alias("at"), X.row_json(columns, by_name=False).alias("json"), F.struct(*rows.columns).alias("row"))
    chunk = own.groupBy(file, "_chunk").agg(F.array_sort(F.collect_list(told)).alias("_rows"))
    request = F.concat(F.lit(instructions + "\n"), F.array_join(F.transform("_rows", lambda r: r["json"]), "\n"))
    got = answered(chunk, request, client, "_answer").withColumn("_a", F.from_json("_answer", "array<string>"))
    whole = F.when(F.col("_a").isNull() | (F.size("_a") == F.size("_rows")), F.lit(True)).otherwise(F.raise_error(F.lit("an answer for each row was asked for")).cast("boolean"))
    each = got.where(whole).select(F.posexplode("_rows").alias("_i", "_r"), "_a")
    return each.select("_r.row.*", F.get("_a", F.col("_i")).alias(answer))


def embedded(rows: DataFrame, text: Column, client: Client | RecordedTable, vector: str = "embedding", unit: bool = True) -> DataFrame:
    """The rows and their texts' vectors (the client answers JSON arrays of numbers), at length 1 if `unit`."""
    got = answered(rows, text, client, "_answer").withColumn(vector, F.from_json("_answer", "array<double>")).drop("_answer")
    return got.withColumn(vector, X.unit(F.col(vector))) if unit else got


def found_tables(files: DataFrame, client: Client | RecordedTable, document: str = "path", content: str = "content") -> DataFrame:
    """(document, page, table_no, row_no, cells): what a table reader finds in documents, blank cells null.

    The client is asked with base64 content and answers a JSON array of {page, table_no, rows}.
    """
    got = answered(files.select(document, X.base64_text(F.col(content)).alias("_asked")), F.col("_asked"), client, "_answer")
    tables = got.select(document, F.inline(F.from_json("_answer", "array<struct<page:int,table_no:int,rows:array<array<string>>>>")))
    return tables.select(document, "page", "table_no", F.posexplode("rows").alias("row_no", "cells")).withColumn("cells", F.transform("cells", lambda c: F.nullif(c, F.lit(""))))


def found_words(files: DataFrame, client: Client | RecordedTable, document: str = "path", content: str = "content") -> DataFrame:
    """(document, page, text, x0, x1, top, bottom): the words a reader finds, asked and answered as in found_tables."""
    got = answered(files.select(document, X.base64_text(F.col(content)).alias("_asked")), F.col("_asked"), client, "_answer")
    return got.select(document, F.inline(F.from_json("_answer", "array<struct<page:int,text:string,x0:double,x1:double,top:double,bottom:double>>")))


def with_documents(operators: DataFrame, excluded: tuple[int, ...] = (770,)) -> DataFrame:
    """(operator_id, operator_name, document_id, document_name): operators that have documents, one row for each.

    `operators`: operator_id, operator_name, documents array<struct<_id, name>> (null and empty ones are left out).
    """
    kept = operators.where((F.size("documents") > 0) & ~F.col("operator_id").isin(*excluded))
    return kept.select("operator_id", "operator_name", F.explode("documents").alias("_d")).select("operator_id", "operator_name", F.col("_d._id").alias("document_id"), F.col("_d.name").alias("document_name"))


def scan_registry(spark: object, client: Client | RecordedTable, ids: int = 10_000, excluded: tuple[int, ...] = (770,)) -> DataFrame:
    """with_documents() over the operators 0 to ids - 1; the client answers an id with JSON or nothing."""
    asked = spark.range(ids).where(~F.col("id").isin(*excluded))
    got = answered(asked, F.col("id").cast("string"), client, "_answer")
    form = "struct<name:string,documents:array<struct<_id:string,name:string>>>"
    return with_documents(got.select(F.col("id").alias("operator_id"), F.from_json("_answer", form).alias("_o")).select("operator_id", F.col("_o.name").alias("operator_name"), "_o.documents"), excluded)


def places(names: DataFrame, name: str, client: Client | RecordedTable, country: str = "de", limit: int = 10) -> DataFrame:
    """(name, variant, place): what a place search answers for each synonym of a name, `limit` places at most."""
    each = names.select(name, F.explode(F.array_distinct(X.variants(F.col(name)))).alias("variant"))
    request = F.to_json(F.struct(F.col("variant").alias("q"), F.lit(country).alias("countrycodes"), F.lit(limit).alias("limit"), F.lit("json").alias("format")))
    got = answered(each, request, client, "_answer").withColumn("_p", F.slice(F.from_json("_answer", "array<map<string,string>>"), 1, limit))
    return got.select(name, "variant", F.explode("_p").alias("place"))


def fetched(documents: DataFrame, url: Column, client: Client | RecordedTable, content: str = "content") -> DataFrame:
    """The documents and their bytes (the client answers base64); when run, an error if one isn't answered.

    Time limits and retries are the client's own.
    """
    got = answered(documents, url, client, "_answer")
    lost = F.raise_error(F.lit("a document wasn't answered")).cast("binary")
    return got.withColumn(content, F.when(F.col("_answer").isNull(), lost).otherwise(F.unbase64("_answer"))).drop("_answer")
