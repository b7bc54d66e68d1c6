"""Incremental work: changed sources, manifest upsert, unreferenced objects, checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from broadleaf import fixed as V


def filter_changed(sources: DataFrame, manifest: DataFrame, existing: DataFrame, schema_version: str = V.SCHEMA_VERSION, generator_version: str = V.GENERATOR_VERSION) -> DataFrame:
    """Sources (relative_path, content_hash, derived_path) to derive again, with the first reason that holds.

    manifest: source_path, source_content_hash, schema_version, generator_version; existing: derived_path of documents there are.
    """
    m = manifest.groupBy("source_path").agg(*(F.max_by(c, "issue_id").alias(f"m_{c}") for c in ("source_content_hash", "schema_version", "generator_version")))
    rows = sources.join(m, sources["relative_path"] == m["source_path"], "left").join(existing.select(F.col("derived_path").alias("m_path")).distinct(), F.col("derived_path") == F.col("m_path"), "left")
    differs = lambda c, v: ~F.col(f"m_{c}").eqNullSafe(v)
    reason = (
        F.when(F.col("source_path").isNull(), "new")
        .when(differs("source_content_hash", F.col("content_hash")), "hash")
        .when(F.col("m_path").isNull(), "missing")
        .when(differs("schema_version", F.lit(schema_version)), "schema")
        .when(differs("generator_version", F.lit(generator_version)), "generator")
    )
    return rows.select(*sources.columns, reason.alias("reason")).where("reason is not null")


def upsert(old: DataFrame, new: DataFrame, key: str = "issue_id", order: str | None = None) -> DataFrame:
    """Rows of new, and rows of old whose key new hasn't; of repeated old keys the last by order."""
    if order:
        old = old.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")
    return old.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new)


def unreferenced(listed: DataFrame, referenced: DataFrame, key: str) -> DataFrame:
    """Keys that are listed but not referenced; a set."""
    return listed.select(key).subtract(referenced.select(key))


def eligible(pending: DataFrame, files: DataFrame) -> DataFrame:
    """Pending rows whose source and normalized files are there with the hashes noted."""
    one = files.select(F.col("path").alias("source_path"), F.col("sha256").alias("source_sha256"))
    two = files.select(F.col("path").alias("normalized_path"), F.col("sha256").alias("normalized_sha256"))
    return pending.join(one, ["source_path", "source_sha256"], "left_semi").join(two, ["normalized_path", "normalized_sha256"], "left_semi")


def must_be_clean(changed: DataFrame) -> None:
    """V8: an error if anything is left to derive."""
    if not changed.isEmpty():
        raise ValueError("sources changed after generation")
