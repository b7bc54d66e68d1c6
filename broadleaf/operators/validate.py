"""Corpus reports and consistency rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from broadleaf import fixed as V
from broadleaf.operators.privacy import article_hits


def counts(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A1, A2: (metric, value, n) of each named column's values, and of all rows as (`source_count`, null, n); one pass."""
    pairs = [F.struct(F.lit(name).alias("metric"), F.col(c).cast("string").alias("value")) for name, c in columns.items()]
    every = F.struct(F.lit("source_count").alias("metric"), F.lit(None).cast("string").alias("value"))
    return rows.select(F.explode(F.array(every, *pairs)).alias("x")).groupBy("x.metric", "x.value").agg(F.count("*").alias("n"))


def count_maps(issues: DataFrame) -> DataFrame:
    """A1: one row of key-sorted count maps of issue documents."""
    codes = issues.select(F.explode("parse_warnings.code").alias("warning_code"))
    one = counts(issues, {"parse_status": "parse_status", "format_family": "format_family"}).unionByName(counts(codes, {"warning_code": "warning_code"}).where("metric <> 'source_count'"))
    as_map = lambda m: F.map_from_entries(F.array_sort(F.collect_list(F.when((F.col("metric") == m) & F.col("value").isNotNull(), F.struct("value", "n")))))
    return one.agg(F.max(F.when(F.col("metric") == "source_count", F.col("n"))).alias("source_count"), *(as_map(m).alias(f"{m}_counts") for m in ("parse_status", "format_family", "warning_code")))


def privacy_hits(articles: DataFrame) -> DataFrame:
    """U-5: source_path and hit of article rows (source_path, url)."""
    return articles.select("source_path", F.explode(article_hits(F.col("url"))).alias("hit"))


def warning_samples(rows: DataFrame, order: list[str], warnings: str = "parse_warnings", most: int = 50, each: int = 5) -> DataFrame:
    """The first rows, in source order, that have warnings, with the first few of each."""
    return rows.where(F.size(warnings) > 0).orderBy(*order).limit(most).withColumn(warnings, F.slice(warnings, 1, each))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A4: (key, value, n) of values that occur more than once; empty and null ones don't count."""
    pairs = rows.select(F.explode(F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys))).alias("x")).select("x.*")
    return pairs.where("coalesce(value, '') <> ''").groupBy("key", "value").agg(F.count("*").alias("n")).where("n > 1")


def missing(rows: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Keys without a file."""
    return rows.select(key).where(F.col(key).isNotNull()).distinct().join(files.select(key), key, "left_anti")


def consistency_errors(manifest: DataFrame, files: DataFrame, schema_version: str = V.SCHEMA_VERSION, generator_version: str = V.GENERATOR_VERSION) -> DataFrame:
    """V1, A5: (place, ord, error) of all problems, in their order, of a manifest (with a position idx, and perhaps an id that
    stands in for a missing issue_id) and its document files (derived_path, versions, source_path).

    Problems of entries come first, entry by entry; then those of the whole, then those of files by path.
    """
    if "id" in manifest.columns:
        manifest = manifest.withColumn("issue_id", F.coalesce(F.nullif("issue_id", F.lit("")), "id"))
    keys = ("issue_id", "source_path", "derived_path")
    low, bad = V.FORBIDDEN_SOURCE.lower(), V.FORBIDDEN_SOURCE
    row = lambda place, ord_, error: (place.cast("string").alias("place"), F.lit(ord_).alias("ord"), error.alias("error"))
    entry = F.concat(F.lit("entry "), F.lpad(F.col("idx").cast("string"), 12, "0"))
    out = []
    for i, k in enumerate(keys):
        empty = manifest.where(F.coalesce(F.col(k), F.lit("")) == "")
        out.append(empty.select(*row(entry, 10 * i, F.concat(F.lit("manifest issues["), F.col("idx").cast("string"), F.lit(f"] missing {k}")))))
        again = manifest.where(F.coalesce(F.col(k), F.lit("")) != "").withColumn("nth", F.row_number().over(W.partitionBy(k).orderBy("idx"))).where("nth > 1")
        out.append(again.select(*row(entry, 10 * i + 1, F.concat(F.lit(f"duplicate manifest {k}: "), F.col(k)))))
    out.append(manifest.where(F.col("source_path").contains(bad)).select(*row(entry, 12, F.concat(F.lit(f"{bad} path in manifest: "), F.col("source_path")))))
    lost = manifest.where("coalesce(derived_path, '') <> ''").join(files.select("derived_path").distinct(), "derived_path", "left_anti")
    out.append(lost.select(*row(entry, 22, F.concat(F.lit("missing derived file for "), F.col("derived_path")))))
    n = manifest.agg(F.count("*").alias("a")).crossJoin(files.agg(F.count("*").alias("b"), F.max(F.lower("derived_path").contains(low)).alias("has")))  # one row each
    out.append(n.where("has").select(*row(F.lit("files"), 0, F.lit(f"{bad} output exists under generated/issues"))))
    out.append(n.where("a <> b").select(*row(F.lit("files"), 1, F.format_string("issue file count (%d) != manifest entries (%d)", "b", "a"))))
    file = F.concat(F.lit("of "), F.col("derived_path"))
    shown = lambda c: F.when(c.isNull(), "None").otherwise(F.concat(F.lit("'"), c, F.lit("'")))
    for i, (k, v) in enumerate((("generator_version", generator_version), ("schema_version", schema_version))):
        out.append(files.where(~F.col(k).eqNullSafe(F.lit(v))).select(*row(file, i, F.concat(F.col("derived_path"), F.lit(f": {k} "), shown(F.col(k)), F.lit(f" != '{v}'")))))
    forbidden = F.lower("derived_path").contains(low) | F.coalesce(F.col("source_path").contains(bad), F.lit(False))
    out.append(files.where(forbidden).select(*row(file, 2, F.concat(F.lit(f"{bad} issue output: "), F.col("derived_path")))))
    return reduce(DataFrame.unionByName, out)


def inventory_hash(rows: DataFrame, path: str = "relative_path", digest: str = "content_hash") -> DataFrame:
    """One hash over all files' hashes in path order, by way of one hash for each of 4096 path buckets."""
    own = rows.select(F.sha2(F.col(path), 256).alias("p"), F.col(path).alias("path"), F.col(digest).alias("d"))
    buckets = own.groupBy(F.substring("p", 1, 3).alias("b")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "d"))), lambda x: F.concat(x["path"], F.lit("\0"), x["d"])), "\n"), 256).alias("h"))
    return buckets.agg(F.concat(F.lit("sha256:"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), ""), 256)).alias("inventory_hash"))


def prefix_count(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """A11."""
    return rows.agg(F.count_if(F.col(column).startswith(prefix)).alias("n"))


def unique_registry(rows: DataFrame, key: str) -> None:
    """An error if a registry names something twice."""
    if not duplicates(rows, [key]).isEmpty():
        raise ValueError(f"duplicate {key}")


def written_with_report(issues: DataFrame, path: str) -> DataFrame:
    """A1, A2 in one job: issues written as a table, and one row of their counts, which Spark takes as they pass (sources, each status, articles)."""
    seen = Observation("issues")
    n_articles = F.aggregate("sections", F.lit(0), lambda n, s: n + F.size(s["articles"]))
    of = lambda status: F.count_if(F.col("parse_status") == status).alias(status)
    issues.observe(seen, F.count("*").alias("sources"), of("complete"), of("partial"), of("failed"), F.coalesce(F.sum(n_articles), F.lit(0)).alias("articles")).write.parquet(path)
    counts = seen.get
    return issues.sparkSession.createDataFrame([tuple(counts[c] for c in REPORT_COLUMNS)], ", ".join(f"{c} long" for c in REPORT_COLUMNS))


REPORT_COLUMNS = ("sources", "complete", "partial", "failed", "articles")
