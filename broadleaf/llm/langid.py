"""Language of whole texts by multinomial naive Bayes over hashed character n-grams.

Training counts the 1-, 2- and 3-grams of a sample of labelled texts into
2**15 buckets per language.  The sample is bounded: up to TRAIN_TEXTS distinct
texts per language, picked by a hash of the text, each read whole; copies count
once.  The matrix of log-probabilities (languages x buckets, at most
MATRIX_BYTES) is broadcast and every text is scored whole, in numpy, batch by
batch.  Scoring a batch gathers matrix entries at the batch's sparse bucket
numbers and sums them by document, so a prediction depends on the text alone.

Letters are lower-cased; everything else acts as space; n-grams without a
letter don't count.  The score is the posterior of the winner with evidence
scaled to at most EVIDENCE n-grams, as overlapping n-grams aren't independent.

Defined results: null text, empty text and text without a letter give `und` with
score 0; so does everything when there is nothing to learn from; ties go to the
language that sorts first; repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, keep_texts, remembers, text_blocks

BITS = 15
BUCKETS = 1 << BITS
ORDERS = (1, 2, 3)
TRAIN_TEXTS = 10_000
MATRIX_BYTES = 64 << 20
EVIDENCE = 64.0
SMOOTHING = 0.1
UNKNOWN = "und"
BLOCK_CHARS = 2_000_000


@functools.lru_cache(1)
def letters() -> np.ndarray:
    """For each code point itself if it is a letter, else 32."""
    codes = np.arange(0x110000, dtype=np.uint32)
    codes[[not chr(c).isalpha() for c in range(0x110000)]] = 32
    return codes


def features(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Start of each text, a bucket for each position and order (BUCKETS: no letter), and the letters' number in each text."""
    joined = "".join("  " + t for t in texts) + "  "
    starts = np.cumsum([0] + [len(t) + 2 for t in texts[:-1]])
    low = joined.lower()
    if len(low) != len(joined):  # some letter grows in lower case
        parts = [t.lower() for t in texts]
        low = "".join("  " + t for t in parts) + "  "
        starts = np.cumsum([0] + [len(t) + 2 for t in parts[:-1]])
    codes = letters()[np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")]
    is_letter = codes != 32
    n = len(codes) - 2
    out, some, h = [], np.zeros(n, bool), np.zeros(n, np.uint32)
    for k in range(max(ORDERS)):
        h = h * np.uint32(0x01000193) + codes[k : n + k] * np.uint32(0x9E3779B1) + np.uint32(k + 1)
        some = some | is_letter[k : n + k]
        if k + 1 in ORDERS:
            mixed = h ^ (h >> np.uint32(15))
            bucket = ((mixed * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)).astype(np.int32)
            bucket[~some] = BUCKETS
            out.append(bucket)
    return starts, out, np.add.reduceat(is_letter[:n], starts, dtype=np.int64)


def _count(langs: list[str]):
    schema = pa.schema([("lang", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        remembers("langid", None)
        for batch in batches:
            by: dict[int, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for block in text_blocks(texts, BLOCK_CHARS):
                    for f in features(block)[1]:
                        total[lang] = total.get(lang, 0) + np.bincount(f, minlength=BUCKETS + 1)
        for lang, counts in total.items():
            at = np.flatnonzero(counts[:BUCKETS])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), lang, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))], schema=schema)

    return run


class Model:
    """langs: sorted names; table: float32 (languages, BUCKETS + 1) of log-probabilities; prior: log-priors."""

    def __init__(self, langs: list[str], table: np.ndarray, prior: np.ndarray):
        self.langs, self.table, self.prior = langs, table, prior

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner (-1: none) and its score, for each text."""
        starts, found, n_letters = features(texts)
        sums = np.empty((len(self.langs), len(texts)))
        for k, row in enumerate(self.table):
            sums[k] = sum(np.add.reduceat(row[f], starts, dtype=np.float64) for f in found)
        n = sum(np.add.reduceat(f != BUCKETS, starts, dtype=np.int64) for f in found)
        logits = (sums + self.prior[:, None]) * (EVIDENCE / np.maximum(n, EVIDENCE))
        best = logits.argmax(0)
        score = 1 / np.exp(logits - logits.max(0)).sum(0)
        return np.where(n_letters > 0, best, -1), np.where(n_letters > 0, score, 0.0)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_TEXTS) -> Model | None:
    """Fit on up to per_language distinct texts of each language; None if there is nothing to learn from."""
    arrow_rows(docs.sparkSession)
    own = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    light = own.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy("lang").count()
    most = MATRIX_BYTES // (4 * (BUCKETS + 1))
    counts = {r["lang"]: r["count"] for r in light.limit(most + 1).collect()}
    if len(counts) > most:
        raise ValueError(f"more than {most} languages")
    if not counts:
        return None
    langs = sorted(counts)
    share = F.create_map(*(F.lit(x) for k in langs for x in (k, min(1.0, per_language / counts[k]))))[F.col("lang")]
    number = F.create_map(*(F.lit(x) for i, k in enumerate(langs) for x in (k, i)))[F.col("lang")]
    unit = (F.xxhash64("text", F.lit("sample")) / F.lit(float(1 << 63)) + 1) / 2
    sample = own.where(unit < share).withColumn("h", F.xxhash64("text")).dropDuplicates(["lang", "h"])
    rows = sample.select(number.alias("lang"), "text").mapInArrow(_count(langs), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(langs), BUCKETS + 1))
    table[rows["lang"].to_numpy(), rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    table += SMOOTHING
    table = np.log(table / table[:, :BUCKETS].sum(1, keepdims=True))
    table[:, BUCKETS] = 0
    prior = np.array([counts[k] for k in langs], float)
    return Model(langs, table.astype(np.float32), np.log(prior / prior.sum()))


def _predict(shared):
    names = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            pred, score = [], []
            for block in text_blocks(batch.column(2).to_pylist(), BLOCK_CHARS):
                best, s = model.score(block)
                pred += [UNKNOWN if k < 0 else model.langs[k] for k in best.tolist()]
                score.append(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(np.concatenate([*score, []]))], schema=names)

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_TEXTS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row; learns from rows that have an id and aren't held out."""
    spark = docs.sparkSession
    model = train(docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)), text_col, lang_col, per_language)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_predict(spark.sparkContext.broadcast(model)), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_TEXTS) -> DataFrame:
    """docs, all columns, without the texts that have no language or one of a lower score; all go if there is nothing to learn from."""
    model = train(docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)), text_col, lang_col, per_language)
    if model is None:
        return docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(texts: list[str | None]) -> list[bool]:
        out: list[bool] = []
        for block in text_blocks(texts, BLOCK_CHARS):
            best, score = shared.value.score(block)
            out += ((best >= 0) & (score >= least)).tolist()
        return out

    return keep_texts(docs, text_col, keep)
