"""Files beside tables: contained paths, atomic writes, object listing and idempotent puts."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path, PurePosixPath

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadleaf import fixed as V
from broadleaf.functions import text as X

def _literal(value) -> Column:
    """A literal of nested settings; fields in alphabetical order, as canonical JSON has them."""
    if isinstance(value, dict):
        return F.struct(*(_literal(value[k]).alias(k) for k in sorted(value)))
    return F.array(*map(_literal, value)) if isinstance(value, list) else F.lit(value)


def image_configuration(max_provider_bytes: int, max_pixels: int, max_final_bytes: int) -> Column:
    """the conversion settings and limits as a struct."""
    return _literal({**V.IMAGE_SETTINGS, "max_provider_image_bytes": max_provider_bytes, "max_image_pixels": max_pixels, "max_final_webp_bytes": max_final_bytes})


def bounded(name: str, value: str | None, default: int, low: int, high: int) -> int:
    """V9: a whole number from text within bounds."""
    n = default if value in (None, "") else int(value)
    if not low <= n <= high:
        raise ValueError(f"{name} must be from {low} to {high}")
    return n


def contained(root: str, relative: str) -> Path:
    """A path below root; an error for anything that leaves it, links included."""
    base = Path(root).resolve()
    clean = PurePosixPath(relative).as_posix()  # drops empty and single-dot steps
    if clean != relative or clean in ("", ".") or clean.startswith("/") or {"..", "\\"} & {*clean.split("/"), *clean}:
        raise ValueError(f"unsafe path: {relative}")
    path = base / clean
    if path.is_symlink() or path.parent.resolve().parts[: len(base.parts)] != base.parts:
        raise ValueError(f"path leaves its root: {relative}")
    return path


def write_atomic(spark: SparkSession, path: str, data: bytes | Iterable[bytes]) -> bool:
    """The file with these bytes, by a rename that replaces it, in any store; False and nothing changed if it has them already."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    temp = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}.tmp")
    out, digest, size = fs.create(temp, True), hashlib.sha256(), 0
    for part in [data] if isinstance(data, bytes) else data:
        out.write(part)
        digest.update(part)
        size += len(part)
    out.close()
    if fs.exists(at) and fs.getFileStatus(at).getLen() == size:
        f, old = fs.open(at), hashlib.sha256()
        while part := bytes(f.readNBytes(1 << 20)):
            old.update(part)
        f.close()
        if old.digest() == digest.digest():
            fs.delete(temp, False)
            return False
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(temp), fs.makeQualified(at), how)  # there is always an old or a new file
    return True


def listed(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Key and size of the objects below root; contents aren't read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    base = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
    return rows.withColumn("b", F.lit(base)).select(F.expr("substring(path, instr(path, b) + length(b))").alias("key"), F.col("length").alias("size"))


def ensured(objects: DataFrame, root: str) -> DataFrame:
    """Puts each (key, content) below root unless it is there and reads it back; returns key, written, size, media_type, sha256.

    An invalid key, an object with other bytes, and one that reads back differently are errors.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        store, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            got: dict[str, list] = {"key": [], "written": [], "size": [], "media_type": [], "sha256": []}
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path, there = f"{base}/{key}", False
                if store.get_file_info(path).type == pafs.FileType.File:
                    with store.open_input_file(path) as f:
                        there = f.read() == content
                    if not there:
                        raise ValueError(f"{key} is there with other bytes")
                else:
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    temp = f"{path}.{uuid.uuid4().hex}.tmp"
                    with store.open_output_stream(temp, compression=None) as f:
                        f.write(content)
                    store.move(temp, path)
                with store.open_input_file(path) as f:
                    found = f.read()
                if len(found) != len(content) or hashlib.sha256(found).digest() != hashlib.sha256(content).digest():
                    raise ValueError(f"{key} reads back with other bytes")
                kind = "audio/mpeg" if key.endswith(".mp3") else "image/webp"
                for k, v in zip(got, (key, not there, len(found), kind, hashlib.sha256(found).hexdigest()), strict=True):
                    got[k].append(v)
            yield pa.RecordBatch.from_pydict(got, schema=pa.schema([("key", pa.string()), ("written", pa.bool_()), ("size", pa.int64()), ("media_type", pa.string()), ("sha256", pa.string())]))

    broken = X.object_key_error(F.col("key"), F.lit(None).cast("string"))
    key = F.when(F.col("key").isNull() | broken.isNotNull(), F.raise_error(F.concat(F.lit("invalid_object_key "), F.coalesce("key", F.lit("null")))).cast("string")).otherwise(F.col("key"))
    return objects.select(key.alias("key"), "content").mapInArrow(run, "key string, written boolean, size long, media_type string, sha256 string")


def put_texts(rows: DataFrame, root: str) -> DataFrame:
    """Writes each (path, text) below root, by a rename; returns path and written: false where the file had these bytes already."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        store, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            paths, done = batch.column(0).to_pylist(), []
            for path, text in zip(paths, batch.column(1).to_pylist(), strict=True):
                at, data, same = f"{base}/{path}", (text or "").encode(), False
                if store.get_file_info(at).type == pafs.FileType.File:
                    with store.open_input_file(at) as f:
                        same = f.read() == data
                if not same:
                    store.create_dir(at.rpartition("/")[0], recursive=True)
                    temp = f"{at}.{uuid.uuid4().hex}.tmp"
                    with store.open_output_stream(temp, compression=None) as f:
                        f.write(data)
                    store.move(temp, at)
                done.append(not same)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(done, pa.bool_())], names=["path", "written"])

    unsafe = F.col("path").isNull() | F.col("path").startswith("/") | F.exists(F.split("path", "/"), lambda p: p.isin("", ".", ".."))
    path = F.when(unsafe, F.raise_error(F.concat(F.lit("unsafe path: "), F.coalesce("path", F.lit("null")))).cast("string")).otherwise(F.col("path"))
    return rows.select(path.alias("path"), "text").mapInArrow(run, "path string, written boolean")


def read_texts(paths: DataFrame, root: str) -> DataFrame:
    """path and text of the files that rows of path name below root; null text where there is none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        store, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), []
            for path in names:
                text = None
                if store.get_file_info(f"{base}/{path}").type == pafs.FileType.File:
                    with store.open_input_file(f"{base}/{path}") as f:
                        text = f.read().decode("utf-8", "replace")
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["path", "text"])

    return paths.select(F.col("path").cast("string")).mapInArrow(run, "path string, text string")
