"""Two stores in shared folders: labels in buckets behind a manifest, and answers by the digest of their request."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import labels
from millrace.operators.models import Client, RecordedTable


class Lost(RuntimeError):
    """Another writer committed first."""


class LabelStore:
    """Labels of unique keys, dealt to `buckets` folders by the hash of their keys.

    A version is a manifest: a small file that names each bucket's folder. An upsert reads and writes only the buckets
    that its labels fall into, under new names, and then creates the next manifest, which the file system grants to one
    writer only; the other one begins again from the new version, so no write is lost. Files of untouched buckets stay
    as they are, and a reader keeps the version that it began with. The first upsert fixes the number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], version: str, buckets: int = 64) -> None:
        self.spark, self.path, self.keys, self.version, self.buckets = spark, path.rstrip("/"), keys, version, buckets

    def _at(self, path: str) -> tuple[object, object]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _manifest(self) -> tuple[int, dict]:
        fs, place = self._at(f"{self.path}/manifests")
        numbers = [int(f.getPath().getName().split(".")[0]) for f in fs.listStatus(place) if f.getPath().getName().endswith(".json")] if fs.exists(place) else []
        if not numbers:
            return -1, {"buckets": self.buckets, "schema": None, "folders": {}}
        text = self.spark.read.text(f"{self.path}/manifests/{max(numbers)}.json", wholetext=True).first()[0]
        return max(numbers), json.loads(text)

    def _commit(self, number: int, manifest: dict) -> None:
        fs, place = self._at(f"{self.path}/manifests/{number}.json")
        try:
            out = fs.create(place, False)
        except (Py4JJavaError, PySparkException) as e:
            if fs.exists(place):
                raise Lost(str(place)) from e
            raise
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()

    def _rows(self, manifest: dict, wanted: set[int] | None = None) -> DataFrame | None:
        own = [f"{self.path}/{f}" for b, f in manifest["folders"].items() if wanted is None or int(b) in wanted]
        if not manifest["schema"]:
            return None
        schema = T.StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*own) if own else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame | None:
        """All labels of the last version; None before the first upsert."""
        return self._rows(self._manifest()[1])

    def upsert(self, new: DataFrame, place: str | None = None, attempts: int = 20) -> int:
        """The last write of each key wins (see labels.upsert); returns the version's number."""
        for _ in range(attempts):
            number, manifest = self._manifest()
            bucket = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(manifest["buckets"])).cast("int")
            touched = {r[0] for r in new.select(bucket.alias("b")).distinct().collect()}
            old = self._rows(manifest, touched)
            merged = labels.upsert(new.limit(0) if old is None else old, new, self.keys, self.version, place)
            name = f"labels/{uuid.uuid4().hex}"
            merged.withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
            folders = manifest["folders"] | {str(b): f"{name}/_bucket={b}" for b in touched}
            schema = json.loads(merged.schema.json())
            try:
                self._commit(number + 1, {"buckets": manifest["buckets"], "schema": schema, "folders": folders})
            except Lost:
                continue
            return number + 1
        raise Lost(f"{attempts} attempts")


class AnswerStore:
    """Answers of a client, each under the SHA-256 of its request, so that no request is asked twice.

    A run writes the distinct requests that have no answer yet, and its tasks ask them in batches; each batch's answers
    are a file of their own before the next batch is asked. A task that runs again, or a second run after a lost job,
    finds them there. Requests without an answer (null) are kept as such.
    """

    SCHEMA = "digest string, answer string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        """digest, answer: what is stored, each digest once."""
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/answers").getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/answers")):
            return self.spark.createDataFrame([], self.SCHEMA)
        held = self.spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").schema(self.SCHEMA).parquet(f"{self.path}/answers")
        return held.groupBy("digest").agg(F.max("answer").alias("answer"))

    def answered(self, rows: DataFrame, request: Column, client: Client | RecordedTable, answer: str = "answer", batch: int = 64) -> DataFrame:
        """The rows and their answers; equal requests are asked once, null ones not at all."""
        asked = rows.withColumn("_request", request.cast("string")).withColumn("_digest", F.sha2("_request", 256))
        new = asked.where(F.col("_request").isNotNull()).groupBy("_digest").agg(F.any_value("_request").alias("_request"))
        run = f"{self.path}/requests/{uuid.uuid4().hex}"
        new.join(self.read().select(F.col("digest").alias("_digest")), "_digest", "left_anti").write.parquet(run)
        self._ask(run, client, batch)
        known = self.read().select(F.col("digest").alias("_digest"), F.col("answer").alias(answer))
        return asked.join(known, "_digest", "left").drop("_digest", "_request")

    def _ask(self, run: str, client: Client | RecordedTable, batch: int) -> None:
        folder = f"{self.path}/answers/{run.rsplit('/', 1)[-1]}"
        asked = self.spark.read.parquet(run).select("_digest", "_request")
        if isinstance(client, RecordedTable):
            asked.join(client.by_digest("_digest"), "_digest", "left").select(F.col("_digest").alias("digest"), F.col("_recorded").alias("answer")).write.parquet(folder)
            return

        def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            part, at, n, held = TaskContext.get().partitionId(), 0, 0, []

            def put(own: list[tuple[str, str]]) -> int:
                if _stored(folder, f"{part}-{at}"):
                    return 0
                found = client.ask([r for _, r in own])
                _store(folder, f"{part}-{at}", pa.table({"digest": [d for d, _ in own], "answer": pa.array(found, pa.string())}))
                return len(own)

            for got in batches:
                held += zip(*[c.to_pylist() for c in got.columns], strict=True)
                while len(held) >= batch:
                    n, at, held = n + put(held[:batch]), at + batch, held[batch:]
            n += put(held) if held else 0
            yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

        asked.mapInArrow(ask, "n long").agg(F.sum("n")).collect()


def _place(folder: str) -> tuple[object, str]:
    from pyarrow import fs

    if folder.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _stored(folder: str, name: str) -> bool:
    from pyarrow import fs

    store, base = _place(folder)
    return store.get_file_info(f"{base}/{name}.parquet").type == fs.FileType.File


def _store(folder: str, name: str, table: pa.Table) -> None:
    """A whole file or none: it gets its name when it is written."""
    import pyarrow.parquet as pq

    store, base = _place(folder)
    store.create_dir(base, recursive=True)
    pq.write_table(table, f"{base}/{name}.open", filesystem=store)
    store.move(f"{base}/{name}.open", f"{base}/{name}.parquet")
