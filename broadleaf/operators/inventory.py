"""Inventories of files as trees of path prefixes, and V11, V12: what is stale because something that it was made from is.

A folder's digest is made of sums over the files below it, so that it is the same in any
order and sums up map-side; two trees are told apart from the root down, and below a folder
whose digest is equal nothing is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadleaf.llm.common import delete, new_dir, written

NODE = "level int, prefix string, parent string, is_file boolean, digest string, n_files long"
LANES = 8


def tree(inventory: DataFrame) -> DataFrame:
    """Nodes (NODE) of an inventory's files (path, hash), from the root (level 0, an empty prefix) down to the files themselves."""
    file_digest = F.sha2(F.concat_ws("\n", "path", F.coalesce("hash", F.lit(""))).cast("binary"), 256)
    lanes = [F.conv(F.substring("d", 8 * k + 1, 8), 16, 10).cast("long").alias(f"l{k}") for k in range(LANES)]
    rows = inventory.where("path IS NOT NULL").select(F.split("path", "/").alias("steps"), file_digest.alias("d")).select("steps", *lanes)
    prefix = lambda n: F.array_join(F.slice("steps", F.lit(1), n), "/")
    rows = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.size("steps"))))
    rows = rows.select("level", prefix(F.col("level")).alias("prefix"), F.when(F.col("level") > 0, prefix(F.col("level") - 1)).alias("parent"), (F.col("level") == F.size("steps")).alias("is_file"), *(f"l{k}" for k in range(LANES)))
    summed = rows.groupBy("level", "prefix", "parent", "is_file").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LANES)), F.count("*").alias("n_files"))
    digest = F.sha2(F.concat_ws(",", *(F.col(f"l{k}").cast("string") for k in range(LANES)), F.col("n_files").cast("string")).cast("binary"), 256)
    return summed.select("level", "prefix", "parent", "is_file", digest.alias("digest"), "n_files")


def write_tree(inventory: DataFrame, path: str) -> None:
    """A tree as a table with a folder a level."""
    tree(inventory).write.partitionBy("level").parquet(path)


def diff(spark: SparkSession, old: str, new: str, scratch: str) -> tuple[DataFrame, list[int]]:
    """Files that differ between two written trees (path; change: added, removed or changed), and how many nodes were compared at each level."""
    sides = [spark.read.schema(NODE).parquet(p) for p in (old, new)]
    found, counts, level, open_ = [], [], 0, None
    while True:
        at = [s.where(F.col("level") == level) for s in sides]
        if open_ is not None:
            at = [a.join(open_, "parent", "left_semi") for a in at]
        a, b = (x.select("prefix", "is_file", F.col("digest").alias(f"digest_{k}")) for k, x in zip("ab", at, strict=True))
        both = a.join(b, ["prefix", "is_file"], "full").withColumn("differs", ~F.col("digest_a").eqNullSafe(F.col("digest_b")))
        both.write.parquet(f"{scratch}/level-{level}")
        both = spark.read.schema(both.schema).parquet(f"{scratch}/level-{level}")
        counts.append(both.count())
        change = F.when(F.col("digest_a").isNull(), "added").when(F.col("digest_b").isNull(), "removed").otherwise("changed")
        found.append(both.where("differs AND is_file").select(F.col("prefix").alias("path"), change.alias("change")))
        open_ = both.where("differs AND NOT is_file").select(F.col("prefix").alias("parent"))
        if open_.isEmpty():
            break
        level += 1
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out, counts


#: Steps from what is stale at its own inputs; more than that is a cycle.
MOST_STEPS = 40


def stale(made: DataFrame, inputs: DataFrame) -> DataFrame:
    """Ids of artifacts that are stale, and how many steps away the nearest reason is (0: an input of its own).

    made: id, hash, of everything there is; inputs: id, input_id, input_hash, what each artifact was made from and the hash that that had then. Whatever
    hangs on a stale artifact is stale; a missing input is one that changed. A cycle is an error. Each step is a join and a written table of its own, since
    a recursive query stops beyond a number of rows.
    """
    spark = made.sparkSession
    own = inputs.join(made.select(F.col("id").alias("input_id"), "hash"), "input_id", "left").where(~F.col("hash").eqNullSafe(F.col("input_hash"))).select("id").distinct()
    stage = new_dir(spark, "stale-edges")
    edges = written(inputs.select("id", "input_id"), "stale-edges", stage)
    at, reached = written(own, "stale"), None
    for step in range(MOST_STEPS):
        found = at.select("id", F.lit(step).alias("steps"))
        reached = found if reached is None else reached.unionByName(found)
        at = written(edges.join(at.select(F.col("id").alias("input_id")), "input_id", "left_semi").select("id").distinct(), "stale")
        if at.isEmpty():
            delete(spark, stage)
            return reached.groupBy("id").agg(F.min("steps").alias("steps"))
    delete(spark, stage)
    raise ValueError("artifacts that are made from each other")
