"""Importance resampling: documents drawn by how much likelier target text makes them than raw text.

Words and punctuation runs, and pairs of neighbours, are hashed into BUCKETS.
One pass over all documents counts them for the raw model, and for the target
model in labelled documents of good quality, up to TARGET_DOCS of them picked by
a hash of their id.  A second pass sums log(target / raw) over each whole text: the
log weight is the log ratio of what the two models make of the text.  Adding Gumbel noise, keyed by id and text hash,
and keeping the top k draws without replacement by weight.  The k-th key is found
by counting keys by digit, level by level, so no task sorts or holds all keys.

Defined results: null or empty text has log weight 0; without target documents
all weights are 0; ties of key and id are all kept, so that repeated rows share a fate;
an empty table gives no rows; labels of unknown documents are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, remembers, written

BITS = 14
BUCKETS = 1 << BITS
TARGET_DOCS = 20_000
SMOOTHING = 1.0
KEEP_SHARE = 0.8
TOKEN = re.compile(r"\w+|[^\w\s]+")
DIGIT_BITS, KEY_UNIT = 12, 1 << 20


class Hashes(dict):
    """Token to 32-bit hash, filled as tokens come and emptied when large."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        return h


HASHES = Hashes()


def features(text: str) -> np.ndarray:
    """Bucket numbers of the text's tokens and of its pairs of neighbours."""
    tokens = TOKEN.findall(text.lower())
    h = np.fromiter(map(HASHES.__getitem__, tokens), np.uint64, len(tokens))
    both = np.concatenate([h * np.uint64(2) + np.uint64(1), (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))])
    return ((both * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int64)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS), np.int64)
    remembers("importance", HASHES.clear)
    for batch in batches:
        for text, is_target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = np.bincount(features(text or ""), minlength=BUCKETS)
            total[0] += n
            if is_target:
                total[1] += n
    for k in range(2):
        at = np.flatnonzero(total[k])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[k][at])], names=["kind", "bucket", "n"])


def target_ids(labels: DataFrame, id_col: str = "doc_id", most: int = TARGET_DOCS) -> DataFrame:
    """Distinct ids of good documents, about `most` of them at most, picked by a hash."""
    good = labels.where(F.col("quality") == 1).select(F.col(id_col).alias("_target")).where("_target is not null").distinct()
    share = min(1.0, most / max(1, good.count()))
    return good.where((F.xxhash64("_target", F.lit("target")) / F.lit(float(1 << 63)) + 1) / 2 < share)


def ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TARGET_DOCS) -> np.ndarray:
    """log(target / raw) of each bucket."""
    ids = F.broadcast(target_ids(labels, id_col, most))  # of bounded size
    arrow_rows(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("_target"), F.col(text_col).cast("string").alias("text"))
    rows = own.join(ids.withColumn("good", F.lit(True)), "_target", "left").select("text", F.col("good").isNotNull())
    counts = rows.mapInArrow(_count, "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((2, BUCKETS))
    total[counts["kind"].to_numpy(), counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    if not total[1].any():
        return np.zeros(BUCKETS)
    total += SMOOTHING * total.sum(1, keepdims=True) / total.sum(1).max()  # the same smoothing as a share of each
    total /= total.sum(1, keepdims=True)
    return np.log(total[1]) - np.log(total[0])


def _score(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        remembers("importance", HASHES.clear)
        for batch in batches:
            out = [float(ratio[features(text or "")].sum()) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["doc_id", "text_hash", "log_weight"])

    return run


def smallest(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The k-th smallest value of a long column (k from 1), and how many are smaller; by counts of digits."""
    low, high = rows.agg(F.min(column), F.max(column)).collect()[0]
    shift = max(0, (high - low).bit_length() - DIGIT_BITS)
    before = 0
    while True:
        inside = rows.where(F.col(column).between(low, high))
        counts = dict(inside.groupBy(F.shiftright(F.col(column) - F.lit(low), shift).alias("digit")).count().collect())  # 4096 at most
        for digit in sorted(counts):
            if before + counts[digit] >= k:
                break
            before += counts[digit]
        low = low + (digit << shift)
        high = low + (1 << shift) - 1
        if not shift:
            return low, before
        shift = max(0, shift - DIGIT_BITS)


def top(rows: DataFrame, k: int, key: str = "rank", tie: str = "doc_id") -> Column:
    """Whether a row is of the k with the largest key, ties going to the smaller id."""
    if k <= 0:
        return F.lit(False)
    light = rows.select((-F.col(key)).alias("key"), F.coalesce(F.col(tie), F.lit(-(1 << 62))).alias("tie"))
    at, before = smallest(light, "key", k)
    last, _ = smallest(light.where(F.col("key") == at), "tie", k - before)
    return (F.col(key) > -at) | ((F.col(key) == -at) & (F.coalesce(F.col(tie), F.lit(-(1 << 62))) <= last))


def resample(docs: DataFrame, labels: DataFrame, share: float = KEEP_SHARE, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """doc_id, log_weight, rank (log weight and Gumbel noise, in units of 2**-20) and kept of each row; keeps the share's ceiling."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios(docs, labels, id_col, text_col))
    text = F.col(text_col).cast("string")
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(_score(shared), "doc_id long, text_hash long, log_weight double")
    unit = (F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    ranked = scored.withColumn("rank", F.floor((F.col("log_weight") - F.log(-F.log(unit))) * KEY_UNIT).cast("long"))
    rows = written(ranked.select("doc_id", "log_weight", "rank"), "scored")
    n = rows.count()
    return rows.withColumn("kept", top(rows, -int(-share * n // 1)) if n else F.lit(False))
