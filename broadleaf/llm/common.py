"""What the operators of this subpackage share: places, written tables, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when its counted rows times this many bytes stay under BROADCAST_BYTES.
BROADCAST_BYTES = 32 << 20


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one is made only where none is set, and only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="broadleaf-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def arrow_rows(spark: SparkSession, rows: int = 2000) -> None:
    """Rows that go to a Python worker at once, set on the session: texts are long, and a worker holds several copies of a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


#: What operators remember in a Python worker, by operator: how to forget it.
_MEMORIES: dict = {}


def remembers(owner: str, forget) -> None:
    """Called in a worker by an operator with a memory of its own, or with None: others' memories are emptied, so that they don't add up."""
    for other in [k for k in _MEMORIES if k != owner]:
        _MEMORIES.pop(other)()
    if forget:
        _MEMORIES[owner] = forget


class Hashes(dict):
    """Word to 64-bit hash, filled as words come and emptied when large."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers well mixed, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_blocks(texts: Iterable[str | None], chars: int) -> Iterator[list[str]]:
    """Texts in lists of a bounded number of characters; a longer one comes alone; null is empty."""
    out, size = [], 0
    for t in texts:
        t = t or ""
        if out and size + len(t) > chars:
            yield out
            out, size = [], 0
        out.append(t)
        size += len(t)
    if out:
        yield out


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/broadleaf/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, *dirs: str) -> None:
    for d in dirs:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(d)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, where: str | None = None) -> DataFrame:
    """The rows of df as a table in the shared folder: cuts lineage and outlives executors."""
    spark = df.sparkSession
    where = where or new_dir(spark, name)
    df.write.option("compression", "zstd").parquet(where)
    return spark.read.schema(df.schema).parquet(where)


class Scratch:
    """Written tables of one call, which can be deleted together once its result is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, new_dir(spark, name)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, name, f"{self.base}/{name}-{uuid.uuid4().hex}")

    def clear(self) -> None:
        delete(self.spark, self.base)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is on this and every other machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def broadcast_if_small(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """df with a broadcast hint if its counted size allows one; else as it is, for a shuffled join."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI or a plain local path."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), uri) if "://" not in uri and not uri.startswith("file:") else fs.FileSystem.from_uri(uri)


def with_texts(docs: DataFrame, text_col: str, run, added: str = "") -> DataFrame:
    """docs through run, a function for mapInArrow, all columns renamed and back so that no names clash.

    run gets the text as column 0 and then all columns of docs; it returns the columns of `added` (DDL) and then those of docs.
    """
    arrow_rows(docs.sparkSession)
    back = [f"c{k}" for k in range(len(docs.columns))]
    schema = ", ".join([*([added] if added else []), *(f"{b} {f.dataType.simpleString()}" for b, f in zip(back, docs.schema, strict=True))])
    new = [x.split()[0] for x in added.split(",")] if added else []
    rows = docs.toDF(*back).select(F.col(back[docs.columns.index(text_col)]).cast("string").alias("t"), *back)
    return rows.mapInArrow(run, schema).toDF(*new, *docs.columns)


def keep_texts(docs: DataFrame, text_col: str, keep) -> DataFrame:
    """The rows of docs whose text keep(texts), a list of booleans, keeps."""

    def run(batches):
        import pyarrow as pa

        remembers("filter", None)
        for batch in batches:
            mask = pa.array(keep(batch.column(0).to_pylist()), pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[1:], names=batch.schema.names[1:]).filter(mask)

    return with_texts(docs, text_col, run)
