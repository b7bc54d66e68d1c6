"""Sources and sinks of the corpus: raw files, manifest, issue documents."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadleaf import fixed as V
from broadleaf.functions import text as X
from broadleaf.operators.incremental import upsert
from broadleaf.sources import objects as O

ARTICLE = "struct<id:string,order:int,title:string,summary:string,url:string,reading_time_minutes:int,source_domain:string,content_type:string,is_sponsor:boolean>"
SECTION = f"struct<id:string,heading:string,order:int,articles:array<{ARTICLE}>>"
ISSUE = f"schema_version string, generator_version string, issue_id string, sector string, sector_slug string, date string, source_path string, source_content_hash string, format_family string, parse_status string, parse_warnings array<struct<code:string,message:string,line:int>>, title string, sections array<{SECTION}>"
ENTRY = "issue_id string, sector string, sector_slug string, date string, source_path string, source_content_hash string, schema_version string, generator_version string, format_family string, parse_status string, derived_path string"


def named_sources(files: DataFrame) -> DataFrame:
    """S1, S2 on rows of relative_path and content: the approved ones, with sector, dates, hash and size."""
    parts = F.split("relative_path", "/")
    name = parts[1]
    rows = files.where((F.size(parts) == 2) & X.is_sector(parts[0])).withColumn("date_iso", X.filename_date(name)).where("date_iso is not null")
    return rows.select(
        "relative_path",
        parts[0].alias("sector"),
        X.slug(parts[0]).alias("sector_slug"),
        "date_iso",
        F.regexp_extract(name, r"(\d{2}-\d{2}-\d{4})", 1).alias("date_original"),
        X.content_hash(F.col("content")).alias("content_hash"),
        F.octet_length("content").cast("long").alias("size_bytes"),
        "content",
    )


def discover(spark: SparkSession, root: str) -> DataFrame:
    """All approved sources below a folder, in any store that Spark reads; L1's order is (sector_slug, date_iso, relative_path)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "article_*.md").load(root)
    base = F.lit(spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/")
    # binaryFile gives a percent-decoded URI; what follows the root is the relative path
    inside = F.expr("substring(path, instr(path, b) + length(b))")
    return named_sources(files.withColumn("b", base).select(inside.alias("relative_path"), "content"))


def resolve(spark: SparkSession, root: str, relative_path: str) -> DataFrame:
    """One source, of which only its own file is read, or an error if its path isn't approved."""
    if "\\" in relative_path or ".." in relative_path.split("/") or relative_path.startswith("/"):
        raise ValueError(f"not an approved source: {relative_path}")
    at = spark._jvm.org.apache.hadoop.fs.Path(root, relative_path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    found = named_sources(spark.read.format("binaryFile").load(at.toString()).select(F.lit(relative_path).alias("relative_path"), "content")) if there else None
    if found is None or found.isEmpty():
        raise ValueError(f"not an approved source: {relative_path}")
    return found


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a manifest file; none if it is missing or broken."""
    try:
        docs = spark.read.schema(f"issues array<struct<{', '.join(x.strip().replace(' ', ':') for x in ENTRY.split(','))}>>").option("multiLine", True).json(path)
        docs.isEmpty()
    except Exception as missing:  # the store says in many ways that there is no such file
        if "PATH_NOT_FOUND" not in str(missing) and "FileNotFound" not in str(missing):
            raise
        return spark.createDataFrame([], ENTRY)
    return docs.select(F.explode("issues").alias("e")).select("e.*")


def manifest_hashes(manifest: DataFrame) -> DataFrame:
    """source_path and hash; of repeated paths the last by issue_id."""
    rows = manifest.where("coalesce(source_path, '') <> '' and coalesce(source_content_hash, '') <> ''")
    return rows.groupBy("source_path").agg(F.max_by("source_content_hash", "issue_id").alias("source_content_hash"))


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """Issue documents, one JSON file each."""
    return spark.read.schema(ISSUE).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)


def verified_issues(manifest: DataFrame, issues: DataFrame) -> DataFrame:
    """Issues of manifest entries; any entry whose document is missing or differs fails the query."""
    side = issues.withColumnsRenamed({c: f"i_{c}" for c in ("date", "parse_status")})
    rows = manifest.select("issue_id", "date", "derived_path").join(side, "issue_id", "left")
    bad_path = ~F.col("derived_path").startswith("issues/") | F.array_contains(F.split("derived_path", "/"), "..")
    bad = F.col("i_date").isNull() | (F.col("i_date") != F.col("date")) | (F.col("i_parse_status") == "failed")
    checked = F.when(bad_path, F.raise_error(F.lit("normalized_path_invalid"))).when(bad, F.raise_error(F.lit("normalized_issue_mismatch"))).otherwise(F.col("i_date"))
    return rows.withColumn("date", checked.cast("string")).drop("i_date", "derived_path").withColumnRenamed("i_parse_status", "parse_status")


def issues_of(entries: DataFrame, root: str) -> DataFrame:
    """The issue documents that manifest entries name below root; no other file is read."""
    texts = O.read_texts(entries.select(F.col("derived_path").alias("path")), root).where("text is not null")
    return texts.select(F.from_json("text", ISSUE).alias("d")).where("d.issue_id is not null").select("d.*")


def existing_hashes(entries: DataFrame, root: str) -> DataFrame:
    """derived_path and the source hash that the document there holds; null if there is none or it is broken."""
    return O.read_texts(entries.select(F.col("derived_path").alias("path")), root).select(F.col("path").alias("derived_path"), F.get_json_object("text", "$.source_content_hash").alias("source_content_hash"))


def write_issues(issues: DataFrame, path: str) -> None:
    """Issues as a table, partitioned by sector and year, committed by Spark's protocol."""
    issues.withColumn("year", F.substring("date", 1, 4)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sector_slug", "year").parquet(path)


def write_issue_files(issues: DataFrame, root: str) -> int:
    """Each issue as root/issues/<sector>/<year>/<date>.json; returns how many files changed."""
    done = O.put_texts(issue_json(issues).select(F.col("derived_path").alias("path"), F.col("json").alias("text")), root)
    return done.agg(F.count_if("written").alias("n")).collect()[0]["n"]


def write_manifest(entries: DataFrame, path: str, merge: bool = True) -> bool:
    """The manifest file with its versions and the entries in order, merged with those it had; returns whether it changed.

    Entries pass the driver one partition at a time.
    """
    names = [c.strip().split()[0] for c in ENTRY.split(",")]
    entries = entries.select(*names)
    if merge:
        entries = upsert(read_manifest(entries.sparkSession, path).select(*names), entries)
    rows = in_order(entries).select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("json"))

    def parts():
        before = "\n"
        yield f'{{\n  "schema_version": "{V.SCHEMA_VERSION}",\n  "generator_version": "{V.GENERATOR_VERSION}",\n  "issues": ['.encode()
        for r in rows.toLocalIterator():
            lines = json.dumps(json.loads(r["json"]), ensure_ascii=False, indent=2).replace("\n", "\n    ")
            yield f"{before}    {lines}".encode()
            before = ",\n"
        yield b"]\n}\n" if before == "\n" else b"\n  ]\n}\n"

    return O.write_atomic(entries.sparkSession, path, parts())


def changed_rows(new: DataFrame, old: DataFrame, key: str, value: Column | str) -> DataFrame:
    """Rows of new whose value differs from the old one or has none: nothing is written for the rest."""
    was = old.select(F.col(key).alias("_key"), (F.col(value) if isinstance(value, str) else value).alias("_was"))
    return new.join(was, new[key] == was["_key"], "left").where(~F.col("_was").eqNullSafe(F.col(value) if isinstance(value, str) else value)).drop("_key", "_was")


def manifest_entries(issues: DataFrame) -> DataFrame:
    """Manifest rows of issue rows."""
    return issues.select("issue_id", "sector", "sector_slug", "date", "source_path", "source_content_hash", "schema_version", "generator_version", "format_family", "parse_status", X.issue_path(F.col("sector_slug"), F.col("date")).alias("derived_path"))


def in_order(rows: DataFrame) -> DataFrame:
    """L1, L2: sources or manifest entries in their fixed order."""
    last = "relative_path" if "relative_path" in rows.columns else "issue_id"
    return rows.orderBy("sector_slug", "date_iso" if "date_iso" in rows.columns else "date", last)


def compact_json(value: Column) -> Column:
    """JSON of a struct whose fields are in alphabetical order, nulls kept, and a line feed."""
    return F.concat(F.to_json(value, {"ignoreNullFields": "false"}), F.lit("\n"))


def _pretty(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        laid_out = [json.dumps(json.loads(x), ensure_ascii=False, indent=2) + "\n" for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(laid_out, pa.string())], names=["derived_path", "json"])


def issue_json(issues: DataFrame) -> DataFrame:
    """derived_path and the canonical JSON of each issue. S19: two-space indent, field order kept, other than ASCII kept, and a line feed."""
    cols = [c.strip().split()[0] for c in ISSUE.split(", ") if c.split()[0] in issues.columns]
    compact = issues.select(X.issue_path(F.col("sector_slug"), F.col("date")).alias("derived_path"), F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))
    return compact.mapInArrow(_pretty, "derived_path string, json string")
