"""The corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which run() writes
as Parquet in the shared folder and reads again for the next one.  All but the last
give the columns of documents.

Defined results: rows of null text or of text without a letter have no language and go in
the first stage, as do all rows if no row has a language to learn from; repeated rows and
rows with one doc_id are copies or documents each, by their texts; a row with a null doc_id
stays unless it is a copy; empty and very long texts and further columns of any name pass
through; an empty table gives an empty table at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, langid, near_dup, pii, sentencepiece_sa
from .common import table, tokenizer_path, written

#: The key of this repository's own runs; a deployment sets its own.
PII_KEY = b"broadleaf example key"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language, or with one that is less likely than not."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of exact and near copies."""
    return near_dup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item or an edited copy of one."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms in place of personal data; n_chars follows the text."""
    done = pii.replace(docs, PII_KEY)
    return done.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))) if "n_chars" in docs.columns else done


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, and whether the ids decode to the text."""
    return sentencepiece_sa.encode(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_pii),
    ("sentencepiece", encode),
]

#: No stage can be expressed in SQL; tests hold the operators against plain versions and the stages against the operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
