"""Inventory trees, stale chains, sorted JSON and the observed report, beyond their queries' SQL."""

import json
import random

import pytest
from pyspark.sql import functions as F

from broadleaf.functions import text as X
from broadleaf.operators import inventory, validate


def test_diff_reads_only_what_differs(spark, tmp_path):
    rng = random.Random(2)
    old = {f"d{k % 40}/e{k % 7}/f{k}": str(rng.random()) for k in range(2000)} | {"top": "1"}
    new = dict(old)
    del new["d3/e3/f3"], new["top"]
    new |= {"d5/e5/f5": "edited", "d3/e9/new": "x", "another": "y"}
    for name, files in (("old", old), ("new", new)):
        df = spark.createDataFrame([*files.items(), (None, "no path")], "path string, hash string")
        inventory.write_tree(df.orderBy(F.rand(3)), f"file://{tmp_path}/{name}")
    found, counts = inventory.diff(spark, f"file://{tmp_path}/old", f"file://{tmp_path}/new", f"file://{tmp_path}/scratch")
    assert {(r.path, r.change) for r in found.collect()} == {("d3/e3/f3", "removed"), ("top", "removed"), ("d5/e5/f5", "changed"), ("d3/e9/new", "added"), ("another", "added")}
    assert counts[0] == 1 and len(counts) == 4 and sum(counts) < 150  # of some 2,300 nodes
    same, counts = inventory.diff(spark, f"file://{tmp_path}/old", f"file://{tmp_path}/old", f"file://{tmp_path}/again")
    assert same.count() == 0 and counts == [1]


def test_stale_follows_what_was_made(spark):
    made = spark.createDataFrame([(x, x.upper()) for x in "abcdefg"], "id string, hash string")
    inputs = [("b", "a", "A"), ("c", "b", "B"), ("d", "c", "old"), ("e", "d", "D"), ("e", "b", "B"), ("f", "gone", "G"), ("g", "a", None)]
    found = inventory.stale(made, spark.createDataFrame(inputs, "id string, input_id string, input_hash string"))
    assert {(r.id, r.steps) for r in found.collect()} == {("d", 0), ("e", 1), ("f", 0), ("g", 0)}
    with pytest.raises(Exception, match="made from each other"):
        inventory.stale(made, spark.createDataFrame([*inputs, ("d", "e", "E")], "id string, input_id string, input_hash string")).collect()


def test_stale_of_more_rows_than_a_recursive_query_may_have(spark):
    name = lambda kind: F.concat(F.lit(kind), F.col("id").cast("string"))
    n, limit = 500, "spark.sql.cteRecursionRowLimit"
    made = spark.range(n).select(name("a").alias("id"), F.lit("new").alias("hash"))
    inputs = spark.range(n).select(name("b").alias("id"), name("a").alias("input_id"), F.lit("old").alias("input_hash"))
    for above, below in ("bc", "cd"):
        made = made.unionByName(spark.range(n).select(name(above).alias("id"), F.lit("x").alias("hash")))
        inputs = inputs.unionByName(spark.range(n).select(name(below).alias("id"), name(above).alias("input_id"), F.lit("x").alias("input_hash")))
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, str(n))
        found = inventory.stale(made, inputs).collect()
    finally:
        spark.conf.set(limit, before)
    assert sorted((r.id[0], r.steps) for r in found) == [("b", 0)] * n + [("c", 1)] * n + [("d", 2)] * n


def test_sorted_json(spark):
    values = [{"b": {"z": 1, "a": [{"y": None, "x": "é\n\"\\"}, []], "B": True}, "a": {}}, [3, {"b": 1, "a": 2}], "text", 7, None, {"ä": 1, "z": 2, "": 3}]
    rows = [(k, json.dumps(v)) for k, v in enumerate(values)] + [(90, "{not json"), (91, None)]
    got = {r.k: r.j for r in spark.createDataFrame(rows, "k int, t string").select("k", X.sorted_json(F.col("t")).alias("j")).collect()}
    assert got == {k: json.dumps(v, sort_keys=True, ensure_ascii=False, separators=(",", ":")) for k, v in enumerate(values)} | {90: None, 91: None}


def test_report_of_one_job(spark, tmp_path):
    articles = "array<struct<articles:array<struct<id:string>>>>"
    rows = spark.createDataFrame([("complete", [([("a",), ("b",)],), ([("c",)],)]), ("failed", []), ("partial", [([],)])], f"parse_status string, sections {articles}")
    report = validate.written_with_report(rows, f"file://{tmp_path}/issues")
    assert tuple(report.first()) == (3, 1, 1, 1, 3) and spark.read.parquet(f"file://{tmp_path}/issues").count() == 3
