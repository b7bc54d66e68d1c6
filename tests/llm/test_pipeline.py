"""The pipeline's stages, one after the other, on odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from broadleaf.llm import pipeline
from broadleaf.llm.common import table, written

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def variety(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgilmnorstu", k=rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark, sf_dir):
    item = table(spark, sf_dir, "benchmark").orderBy("item_id").first().text
    long_, plain = variety(1, 60_000), variety(2, 200)
    rows = [
        (1, plain, "en", "a", 1), (2, plain, "en", "a", 1), (2, plain, "en", "a", 1), (2, variety(3, 150), "en", "a", 1), (None, variety(4, 150), "en", "a", 1), (None, plain, "en", None, None), (3, None, "en", "a", 1),
        (4, "", "en", "a", 0), (5, " \n", "en", "a", 2), (6, "1234 !!", None, "b", 7), (7, long_, "en", "b", len(long_)), (8, f"{variety(5, 60)} {item} {variety(6, 60)}", "en", "c", 1),
        (9, f"write to someone.real@mail.example or 4111 1111 1111 1111 {variety(7, 120)}", "en", "c", 1), (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS).withColumn("c0", F.lit("clash")).withColumn("node", F.lit(1)).withColumn("t", F.lit(2.5)).withColumn("key", F.lit(None).cast("string"))


def test_stages_on_odd_rows(spark, sf_dir, odd):
    docs, left = odd, {}
    for name, stage in pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir), f"test-{name}")
        if name != "sentencepiece":
            assert out.columns == odd.columns
            assert out.where("c0 <> 'clash' OR node <> 1 OR t <> 2.5 OR key IS NOT NULL").count() == 0
        left[name] = sorted((r.doc_id for r in out.select("doc_id").collect()), key=str)
        docs = out
    assert left["language"] == sorted([1, 2, 2, 2, None, None, 7, 8, 9], key=str)
    assert left["near_duplicates"] == sorted([1, 2, None, 7, 8, 9], key=str)
    assert left["decontamination"] == sorted([1, 2, None, 7, 9], key=str)
    assert left["pii"] == left["sentencepiece"] == left["decontamination"]


def test_stages_on_no_rows(spark, sf_dir):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), f"none-{name}")
        assert docs.count() == 0
