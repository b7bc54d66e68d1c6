"""S21 as a data source writer with two phases: no object is seen before all tasks have theirs.

A task stages its objects below `_staged/<job>/<task>`, reads each back, and ends with a
manifest of them.  The job's commit is one small file that names the tasks' manifests (one
line a task); its abort deletes what was staged.  `published` then moves the objects of all
committed jobs to their keys in a Spark job of its own.  Both phases may be run again: an object that is
there with the same bytes is neither staged nor moved, one with other bytes is an error.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from broadleaf.functions import text as X
from broadleaf.llm.common import arrow_rows

MANIFEST = pa.schema([("key", pa.string()), ("staged", pa.string()), ("size", pa.int64()), ("sha256", pa.string())])
#: Rows of a manifest that a task holds before it writes them.
MANIFEST_ROWS = 10_000
RESULT = "key string, written boolean, size long, media_type string, sha256 string"


def store_of(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def found_at(store, path: str) -> tuple[int, str] | None:
    """Size and SHA-256 of an object, or None."""
    from pyarrow import fs

    if store.get_file_info(path).type != fs.FileType.File:
        return None
    digest, size = hashlib.sha256(), 0
    with store.open_input_stream(path, compression=None) as f:
        while part := f.read(1 << 20):
            digest.update(part)
            size += len(part)
    return size, digest.hexdigest()


@dataclass
class Staged(WriterCommitMessage):
    manifest: str
    objects: int


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.root, self.job = options["path"], uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        import pyarrow.parquet as pq

        store, base = store_of(self.root)
        task = f"{base}/_staged/{self.job}/{uuid.uuid4().hex}"
        rows: dict[str, list] = {c: [] for c in MANIFEST.names}
        n = 0
        store.create_dir(task, recursive=True)
        try:
            with store.open_output_stream(f"{task}/manifest.parquet") as m, pq.ParquetWriter(m, MANIFEST) as manifest:
                for batch in iterator:
                    for key, content in zip(batch.column(0), batch.column(1), strict=True):
                        key, content = key.as_py(), content.as_py()
                        if key is None or content is None:
                            raise ValueError("an object needs a key and content")
                        wanted, staged = (len(content), hashlib.sha256(content).hexdigest()), None
                        there = found_at(store, f"{base}/{key}")
                        if there is None:
                            staged = f"{task}/{n}"
                            with store.open_output_stream(staged, compression=None) as f:
                                f.write(content)
                            there = found_at(store, staged)
                        if there != wanted:
                            raise ValueError(f"{key} reads back with other bytes")
                        for c, v in zip(rows, (key, staged, *wanted), strict=True):
                            rows[c].append(v)
                        n += 1
                        if len(rows["key"]) == MANIFEST_ROWS:
                            manifest.write_table(pa.table(rows, schema=MANIFEST))
                            rows = {c: [] for c in MANIFEST.names}
                manifest.write_table(pa.table(rows, schema=MANIFEST))
        except BaseException:
            store.delete_dir(task)
            raise
        return Staged(f"{task}/manifest.parquet", n)

    def commit(self, messages: list[Staged | None]) -> None:
        store, base = store_of(self.root)
        store.create_dir(f"{base}/_jobs", recursive=True)
        temp = f"{base}/_jobs/.{self.job}"
        with store.open_output_stream(temp, compression=None) as f:
            f.write("".join(json.dumps({"manifest": m.manifest}) + "\n" for m in messages if m and m.objects).encode())
        store.move(temp, f"{base}/_jobs/{self.job}.json")

    def abort(self, messages: list[Staged | None]) -> None:
        store, base = store_of(self.root)
        store.create_dir(f"{base}/_staged/{self.job}", recursive=True)
        store.delete_dir(f"{base}/_staged/{self.job}")


class Objects(DataSource):
    @classmethod
    def name(cls) -> str:
        return "object_sink"

    def schema(self) -> str:
        return "key string, content binary"

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(dict(self.options))


def staged(objects: DataFrame, root: str) -> None:
    """The first phase: all rows key, content staged and named by one commit, or nothing. An invalid key is an error."""
    objects.sparkSession.dataSource.register(Objects)
    arrow_rows(objects.sparkSession, 500)  # contents are long, and a worker holds several copies of a batch
    broken = X.object_key_error(F.col("key"), F.lit(None).cast("string"))
    key = F.when(F.col("key").isNull() | broken.isNotNull(), F.raise_error(F.concat(F.lit("invalid_object_key "), F.coalesce("key", F.lit("null")))).cast("string")).otherwise(F.col("key"))
    objects.select(key.alias("key"), "content").write.format("object_sink").mode("append").save(root)


def published(spark: SparkSession, root: str) -> DataFrame:
    """The second phase, for every committed job: key, written (False if it was there already), size, media_type and sha256 of each object."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        for batch in batches:
            got: dict[str, list] = {c.split()[0]: [] for c in RESULT.split(", ")}
            for key, path, size, sha in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, written = f"{base}/{key}", False
                there = found_at(store, at)
                if there is None and path is not None:
                    store.create_dir(at.rpartition("/")[0], recursive=True)
                    store.move(path, at)
                    there, written = found_at(store, at), True
                if there != (size, sha):
                    raise ValueError(f"{key} is there with other bytes")
                for c, v in zip(got, (key, written, size, "audio/mpeg" if key.endswith(".mp3") else "image/webp", sha), strict=True):
                    got[c].append(v)
            yield pa.RecordBatch.from_pydict(got, schema=pa.schema([("key", pa.string()), ("written", pa.bool_()), ("size", pa.int64()), ("media_type", pa.string()), ("sha256", pa.string())]))

    store, base = store_of(root)
    from pyarrow import fs

    jobs = [f for f in store.get_file_info(fs.FileSelector(f"{base}/_jobs", allow_not_found=True)) if f.extension == "json"]
    manifests = []
    for job in jobs:  # one line a task
        with store.open_input_stream(job.path, compression=None) as f:
            manifests += [json.loads(line)["manifest"] for line in f.read().decode().splitlines()]
    prefix = root[: len(root) - len(base)] if root.endswith(base) else ""
    rows = spark.read.schema("key string, staged string, size long, sha256 string").parquet(*(prefix + m for m in manifests)) if manifests else spark.createDataFrame([], "key string, staged string, size long, sha256 string")
    one = rows.groupBy("key").agg(F.max("staged").alias("staged"), F.min("size").alias("size"), F.min("sha256").alias("sha256"), F.max("sha256").alias("other"))
    sha = F.when(F.col("other") == F.col("sha256"), F.col("sha256")).otherwise(F.raise_error(F.concat(F.lit("two contents for "), "key")))
    return one.select("key", "staged", "size", sha.alias("sha256")).mapInArrow(run, RESULT)


def cleared(root: str) -> None:
    """Drops the marks of published jobs and what is left of their stages."""
    store, base = store_of(root)
    for d in ("_jobs", "_staged"):
        store.create_dir(f"{base}/{d}", recursive=True)
        store.delete_dir(f"{base}/{d}")


def put(objects: DataFrame, root: str, result: str) -> DataFrame:
    """Both phases; what became of each object is kept as a table at `result`, so that reading it again moves nothing."""
    spark = objects.sparkSession
    staged(objects, root)
    published(spark, root).write.mode("overwrite").parquet(result)
    cleared(root)
    return spark.read.schema(RESULT).parquet(result)
