"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs of letters and digits, compared by 64-bit hashes.  A
first pass counts in how many documents each word pair of the benchmark occurs.  A
passage that counts keeps a least number of its item's word pairs (least_pairs), so
of each item the most frequent pairs, half of that number, are let go: a ranking
within the item, so that a widely copied item keeps its seeds.  The other pairs are
seeds, and a second pass aligns the words around places where the other half of that
number of seeds occur together with the whole item by Smith-Waterman, many passages
at a time in numpy.  A pair counts if its score is at least MIN_SHARE of the item's
score with itself; none that counts is lost to the choice of seeds.

Items and seeds are broadcast in blocks of about BLOCK_WORDS words.  Documents are
read twice, whatever the number of blocks: a worker takes each batch through all
blocks and holds one of them at a time.  Documents are never shuffled, and each is
read whole.  Passages are aligned in lots of ALIGN_BYTES; the memory of one alone
grows with its item's length, not with the square.

Defined results: null or wordless documents match nothing; null or wordless items
are ignored; items of one word seed with it; items of up to SHORT words match only
whole; repeated rows of either table each count; an empty benchmark leaves all
documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hashes, arrow_rows, keep_texts, mixed, remembers, text_blocks, written

SEED = 2
MATCH, MISMATCH, GAP = 2, -1, -2
MIN_SHARE, SHORT = 0.5, 8
BLOCK_WORDS = 2_000_000
WORD = re.compile(r"[^\W_]+")
#: Characters of documents that are matched at once, and bytes of a row of all alignments that run together.
BATCH_CHARS, ALIGN_BYTES = 2_000_000, 4 << 20
HASHES = Hashes()


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Texts:
    """Word hashes of many texts end to end; text k is hashes[starts[k]:starts[k + 1]]."""

    def __init__(self, texts: Iterable[str | None]):
        each, sizes = [], [0]
        for t in texts:
            found = words(t)
            each += map(HASHES.__getitem__, found)
            sizes.append(len(found))
        self.hashes = np.array(each, np.uint64)
        self.starts = np.cumsum(sizes)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where n words in a row of one text start, and a 64-bit number of each."""
        inside = np.ones(max(0, len(self.hashes) - n + 1), bool)
        for k in range(1, n):  # the last words of a text start none
            at = self.starts[1:] - k
            inside[at[(at >= 0) & (at < len(inside))]] = False
        at = np.flatnonzero(inside)
        out = np.full(len(at), n, np.uint64)
        for k in range(n):
            out = mixed(out * np.uint64(0xC2B2AE3D27D4EB4F) + self.hashes[at + k])
        return at, out


class Items:
    """Items of a benchmark block, their words as hashes, and their seeds."""

    def __init__(self, ids: list, texts: list[str | None]):
        some = [(i, t) for i, t in zip(ids, texts, strict=True) if words(t)]
        self.ids = [i for i, _ in some]
        self.texts = Texts(t for _, t in some)
        self.sizes = np.diff(self.texts.starts)
        self.needed = np.maximum(least_pairs(self.sizes), 1)
        self.short = [n for n in range(1, SEED) if (self.sizes == n).any()]
        grams, item, offset = [], [], []
        for n in (*self.short, SEED):
            at, g = self.texts.grams(n)
            k = np.searchsorted(self.texts.starts, at, "right") - 1
            own = np.minimum(self.sizes[k], SEED) == n
            grams.append(g[own])
            item.append(k[own])
            offset.append((at - self.texts.starts[k])[own])
        self._index(np.concatenate(grams), np.concatenate(item).astype(np.int32), np.concatenate(offset).astype(np.int32))

    def _index(self, grams: np.ndarray, item: np.ndarray, offset: np.ndarray) -> None:
        order = np.argsort(grams, kind="stable")
        self.item, self.offset = item[order], offset[order]
        self.grams, self.first = np.unique(grams[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(order)))
        self.bits = max(10, (8 * len(self.grams)).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)  # most words pairs of a document are none of the grams
        self.maybe[(self.grams >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def keep_rare(self, df: np.ndarray) -> None:
        """Drop each item's most frequent seeds, half as many as it needs, by the document frequency of each of grams; ties by place."""
        f = np.repeat(df, self.count)
        order = np.lexsort((self.offset, f, self.item))
        item = self.item[order]
        rank = np.arange(len(order)) - np.searchsorted(item, item)
        size = np.bincount(item, minlength=len(self.ids))
        dropped = self.needed // 2
        keep = order[(rank < (size - dropped)[item]) & (f[order] > 0)]
        self.needed = self.needed - dropped
        self._index(np.repeat(self.grams, self.count)[keep], self.item[keep], self.offset[keep])

    def hits(self, docs: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Places in docs, and numbers in grams, of the seeds that occur."""
        places, which = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for n in (*self.short, SEED) if len(self.grams) else ():
            at, g = docs.grams(n)
            some = self.maybe[(g >> np.uint64(64 - self.bits)).astype(np.int64)]
            at, g = at[some], g[some]
            k = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
            same = self.grams[k] == g
            places.append(at[same])
            which.append(k[same])
        return np.concatenate(places), np.concatenate(which)

    def frequencies(self, docs: Texts) -> np.ndarray:
        """In how many of the texts each gram occurs."""
        at, which = self.hits(docs)
        doc = np.searchsorted(docs.starts, at, "right") - 1
        return np.bincount(np.unique(doc * len(self.grams) + which) % max(1, len(self.grams)), minlength=len(self.grams))

    def matches(self, docs: Texts) -> list[tuple[int, int, float]]:
        """(text, item, share) of each pair that counts, with the share of its best passage."""
        at, which = self.hits(docs)
        if not len(at):
            return []
        n = self.count[which]
        k = np.repeat(self.first[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        windows = sorted(self._windows(docs, self.item[k].astype(np.int64), self.offset[k].astype(np.int64), np.repeat(at, n)), key=lambda w: (self.sizes[w[1]], w))
        best: dict[tuple[int, int], float] = {}
        a = 0
        while a < len(windows):
            b = a + 1
            while b < len(windows) and (b + 1 - a) * 20 * int(self.sizes[windows[b][1]]) <= ALIGN_BYTES:
                b += 1
            for (row, item, _), score in zip(windows[a:b], self._align(windows[a:b], docs), strict=True):
                m = int(self.sizes[item])
                if score >= max(MIN_SHARE * MATCH * m, MATCH * min(m, SHORT)):
                    best[row, item] = max(score / (MATCH * m), best.get((row, item), 0.0))
            a = b
        return [(row, item, share) for (row, item), share in sorted(best.items())]

    def _windows(self, docs: Texts, item: np.ndarray, offset: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, start in the text) of the windows that hold enough different seeds.

        The gaps of a passage that counts move it by less than a step, so its seeds start in one window or in two that adjoin.
        Texts stand so far apart that no two of their windows adjoin.
        """
        doc = np.searchsorted(docs.starts, at, "right") - 1
        apart = 3 * int(self.sizes.max()) + 8
        step = self.sizes[item] // 2 + 1
        key = (item << 40) + (at + doc * apart - offset) // step + (1 << 30)  # a window; the next number is the next window of the item
        for thorough in (False, True):
            order = np.lexsort((offset, key)) if thorough else np.argsort(key, kind="stable")
            key, item, offset, step, doc = key[order], item[order], offset[order], step[order], doc[order]
            if thorough:
                new = np.append(True, (key[1:] != key[:-1]) | (offset[1:] != offset[:-1]))
                key, item, offset, step, doc = key[new], item[new], offset[new], step[new], doc[new]
            each, first, count = np.unique(key, return_index=True, return_counts=True)
            after = np.append(np.where(np.diff(each) == 1, count[1:], 0), 0)
            before = np.append(0, np.where(np.diff(each) == 1, count[:-1], 0))
            needed = self.needed[item[first]]
            good = count + after >= needed
            if thorough:
                start = ((each & ((1 << 40) - 1)) - (1 << 30)) * step[first] - doc[first] * apart - docs.starts[doc[first]]
                yield from zip(doc[first][good].tolist(), item[first][good].tolist(), start[good].tolist(), strict=True)
            elif good.any():
                rows = np.repeat(good | (count + before >= needed), count)
                key, item, offset, step, doc = key[rows], item[rows], offset[rows], step[rows], doc[rows]
            else:
                return

    def _align(self, windows: list[tuple[int, int, int]], docs: Texts) -> list[int]:
        """Best local score of each window's item with the passage around its start: half an item before to one after its end."""
        sizes = [int(self.sizes[i]) for _, i, _ in windows]
        rows, width = max(sizes), max(2 * m + m // 2 + 2 for m in sizes)
        items = np.zeros((len(windows), rows), np.uint64)
        text = np.ones((len(windows), width), np.uint64)
        for k, ((row, item, start), m) in enumerate(zip(windows, sizes, strict=True)):
            items[k, :m] = self.texts.hashes[self.texts.starts[item] : self.texts.starts[item + 1]]
            begin, end = docs.starts[row], docs.starts[row + 1]
            passage = docs.hashes[begin + max(0, start - m // 2) : min(end, begin + max(0, start + 2 * m + 2))]
            text[k, : min(width, len(passage))] = passage[:width]
        slope = (-GAP * np.arange(width + 1)).astype(np.int32)
        before = np.zeros((len(windows), width + 1), np.int32)
        best = np.zeros(len(windows), np.int32)
        for j in range(rows):
            now = before + np.int32(GAP)
            step = np.where(text == items[:, j : j + 1], np.int32(MATCH), np.int32(MISMATCH))
            np.maximum(now[:, 1:], before[:, :-1] + step, out=now[:, 1:])
            np.maximum(now, 0, out=now)
            now[:, 0] = 0
            now = np.maximum.accumulate(now + slope, axis=1) - slope  # gaps along the passage
            np.maximum(best, now.max(1), out=best)
            before = now
        return best.tolist()


def least_pairs(m: np.ndarray) -> np.ndarray:
    """The least number of an item's word pairs that any alignment with a counting score keeps, by the item's words m.

    k matches, x mismatches and g gap words score 2k - x - 2g >= s in at most 1 + x + g runs, so at least k - 1 - x - g pairs
    stay, which is least for g = (2k - x - s) / 2: (s - x) / 2 - 1.  From k + x <= m follows 3x <= 2m - s.
    """
    s = np.maximum(np.ceil(MIN_SHARE * MATCH * m).astype(np.int64), MATCH * np.minimum(m, SHORT))
    return (s - (2 * m - s) // 3 + 1) // 2 - 1


def _each(shared: list) -> Iterator[tuple[int, Items]]:
    """The blocks one after another; of several, only the one in use stays in a worker."""
    for k, block in enumerate(shared):
        yield k, block.value
        if len(shared) > 1:
            block.__dict__.pop("_value", None)


def _frequencies(shared: list):
    schema = pa.schema([("block", pa.int32()), ("gram", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembers("decontaminate", HASHES.clear)
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for texts in text_blocks(batch.column(0).to_pylist(), BATCH_CHARS):
                docs = Texts(texts)
                for k, items in _each(shared):
                    total[k] = total.get(k, 0) + items.frequencies(docs).astype(np.int32)
        for k, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], schema=schema)

    return run


def blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    """The benchmark's items, as many at a time as BLOCK_WORDS allows."""
    own = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    size = own.agg(F.sum(F.size(F.split("text", r"[^\p{L}\p{N}]+"))).alias("n")).collect()[0]["n"] or 0
    n = 1 + 5 * size // (4 * BLOCK_WORDS) if size > BLOCK_WORDS else 1
    for k in range(n):
        rows = own.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).orderBy("id", "text").toArrow()
        items = Items(rows["id"].to_pylist(), rows["text"].to_pylist())
        if items.ids:
            yield items


def seeded(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> list:
    """Broadcasts of the benchmark's blocks with their rare seeds, by one pass over docs."""
    spark = docs.sparkSession
    arrow_rows(spark)
    shared = [spark.sparkContext.broadcast(items) for items in blocks(benchmark, item_col, item_text_col)]
    if not shared:
        return []
    counts = docs.select(F.col(text_col).cast("string")).mapInArrow(_frequencies(shared), "block int, gram int, n long").groupBy("block", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "seed-counts") if len(shared) > 1 else counts
    out = []
    for k, block in enumerate(shared):
        items, found = block.value, counts.where(F.col("block") == k).toArrow()
        df = np.zeros(len(items.grams), np.int64)
        df[found["gram"].to_numpy()] = found["n"].to_numpy()
        items.keep_rare(df)
        out.append(spark.sparkContext.broadcast(items))
        block.destroy()
    return out


def _pairs(shared: list):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("share", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembers("decontaminate", HASHES.clear)
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for texts in text_blocks(batch.column(1).to_pylist(), BATCH_CHARS):
                docs = Texts(texts)
                for _, items in _each(shared):
                    yield pa.RecordBatch.from_pylist([{"doc_id": ids[at + r], "item_id": items.ids[i], "share": s} for r, i, s in items.matches(docs)], schema=schema)
                at += len(texts)

    return run


def _clean(shared: list):
    def keep(texts: list[str | None]) -> list[bool]:
        out = []
        for some in text_blocks(texts, BATCH_CHARS):
            docs = Texts(some)
            hit = {r for _, items in _each(shared) for r, _, _ in items.matches(docs)}
            out += [k not in hit for k in range(len(some))]
        return out

    return keep


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id and share (of the item's score with itself) of each document and item that match."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(_pairs(seeded(docs, benchmark, text_col, item_col, item_text_col)), "doc_id long, item_id long, share double")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs, all columns, without the documents that match an item."""
    shared = seeded(docs, benchmark, text_col, item_col, item_text_col)
    return keep_texts(docs, text_col, _clean(shared)) if shared else docs
