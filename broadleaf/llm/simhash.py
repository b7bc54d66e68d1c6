"""SimHash classes by the generalised pigeonhole principle.

A text's fingerprint has bit k if more than half of its 3-word shingles' hashes (XXH64,
seed 42) have it.  Fingerprints link at DISTANCE or fewer differing bits; rows with one
fingerprint are one node.

If the bits are dealt to parts with thresholds t that satisfy sum(t + 1) = DISTANCE + 1,
two linked fingerprints differ by at most t bits in some part (-1: the part isn't looked
at).  Bits that go together in a sample are put into one part, so that parts are as unlike
in selectivity as the data have it, and a dynamic programme gives each part the threshold
that makes the estimated work least: pairs that come together, and rows that probe (a
fingerprint stands in a part's bucket by its own value and probes those up to t bits away).
The number of parts is chosen by the same estimate.  The sample decides only how the links
are searched; every link is found with any scheme.

First members of a bucket are held against its least and its greatest fingerprint, which
joins most of any large family.  Buckets that still hold several classes have all pairs
across classes judged in blocks of BLOCK fingerprints, each block emitting only links that
join classes.  Buckets of over LARGEST members are dealt on before that by the bits not
yet used (the four quarters of those: one of them must be equal), until none is so large.

Defined results: null text and text without words have fingerprint zero, which links like any
other; fewer than three words are one shingle; the class of rows is named by the least doc_id in
it, null if none has one; repeated rows get a row each; an empty table has no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_rows, broadcast_if_small, mixed, remembers, written
from .components import NODE_BYTES, joined

WORDS, SEED, DISTANCE = 3, 42, 3
#: Fingerprints that the parts and their thresholds are fitted on, by hash; numbers of parts that are tried.
SAMPLE, PARTS = 20_000, range(2, 9)
#: Work of a row that is dealt to a bucket, in pairs compared.
ROW_COST = 200
BLOCK = 4096
LARGEST = 16 * BLOCK
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 16


def fingerprint(text: str | None) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined_words, k, digest = memoryview(b" ".join(words)), min(WORDS, len(words)), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts, ends = np.append(0, ends[:-1] + 1)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    count, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, AT_ONCE):
        some = zip(starts[at : at + AT_ONCE], ends[at : at + AT_ONCE], strict=True)
        hashes = np.fromiter((digest(joined_words[s:e], SEED) for s, e in some), np.uint64)
        count += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n, bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    remembers("simhash", None)
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "node"])


# -- the scheme ---------------------------------------------------------------


def bit_groups(bits: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits, columns of 0 and 1, in m groups of bits that go together."""
    spread = bits - bits.mean(axis=0)
    size = np.sqrt((spread * spread).sum(axis=0))
    size[size == 0] = 1
    alike = np.abs(spread.T @ spread / np.outer(size, size))
    np.fill_diagonal(alike, 0)
    left, groups = list(range(64)), []
    for k in range(m):
        width = len(left) // (m - k)
        own = [left[int(alike[np.ix_(left, left)].max(axis=1).argmax())]]
        while len(own) < width:
            rest = [b for b in left if b not in own]
            own.append(rest[int(alike[np.ix_(rest, own)].mean(axis=1).argmax())])
        groups.append(sorted(own))
        left = [b for b in left if b not in own]
    return groups


def mask_of(bits: Iterable[int]) -> int:
    return sum(1 << b for b in bits)


def flips(bits: list[int], t: int) -> list[int]:
    """What changes at most t of the bits: nothing first, then one bit, then two ..."""
    return [mask_of(c) for k in range(t + 1) for c in combinations(bits, k)]


def near_pairs(sample: np.ndarray, bits: list[int], t: int) -> int:
    """Ordered pairs of a sample that differ by at most t of the bits."""
    values, count = np.unique(sample & np.uint64(mask_of(bits)), return_counts=True)
    total = -len(sample)
    for flip in flips(bits, t):
        other = values ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        total += int((count * count[at])[values[at] == other].sum())
    return total


def scheme(sample: np.ndarray, n: int, parts: Iterable[int] = PARTS) -> list[tuple[list[int], int]]:
    """Parts (their bits) with thresholds, of those looked at, that make the estimated work over n fingerprints least."""
    bits = (sample[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(np.float64) if len(sample) else np.zeros((1, 64))
    best: tuple[float, list] | None = None
    for m in parts:
        # cheapest[used]: work and thresholds of the parts so far that use so much of DISTANCE + 1
        cheapest: dict[int, tuple[float, list]] = {0: (0.0, [])}
        for own in bit_groups(bits, m):
            after = dict(cheapest)
            for t in range(min(DISTANCE, 3 if len(own) < 24 else 2)):
                ball = sum(comb(len(own), k) for k in range(t + 1))
                if ball > 600:
                    break
                work = ROW_COST * n * ball + near_pairs(sample, own, t) * (n / max(1, len(sample))) ** 2 + n * n * ball / 2 ** len(own)
                for used, (cost, chosen) in cheapest.items():
                    if used + t + 1 <= DISTANCE + 1 and (after.get(used + t + 1, (np.inf,))[0] > cost + work):
                        after[used + t + 1] = (cost + work, [*chosen, (own, t)])
            cheapest = after
        if (found := cheapest.get(DISTANCE + 1)) and (best is None or found[0] < best[0]):
            best = found
    return best[1]


def quarters(mask: int) -> list[int]:
    """The bits outside a mask in DISTANCE + 1 groups."""
    left = [b for b in range(64) if not mask >> b & 1]
    return [q for k in range(DISTANCE + 1) if (q := mask_of(left[k :: DISTANCE + 1]))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# -- the search ---------------------------------------------------------------


def _keys(parts: list[tuple[list[int], int]]):
    """For mapInArrow: nodes to rows key, mask, node, own (whether the key is of the node's own bits)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column(0)
            x = node.to_numpy().view(np.uint64)
            for k, (bits, t) in enumerate(parts):
                mask = mask_of(bits)
                for flip in flips(bits, t):
                    keys = mixed(mixed((x & np.uint64(mask)) ^ np.uint64(flip)) + np.uint64(k + 1))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(x), signed(mask))), node, pa.array(np.full(len(x), flip == 0))], names=["key", "mask", "node", "own"])

    return run


def cross_links(node: np.ndarray, label: np.ndarray, own: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the labels of a block, or of two by side: as many as are needed."""
    _, code = np.unique(label, return_inverse=True)
    two = side.min() != side.max()
    a = np.flatnonzero(side == side.min()) if two else np.arange(len(node))
    b = np.flatnonzero(side == side.max()) if two else a
    up, links = list(range(int(code.max()) + 1)), []

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for at in range(0, len(a), 512):
        i = a[at : at + 512]
        near = np.bitwise_count(node[i][:, None] ^ node[b][None, :]) <= DISTANCE
        near &= (code[i][:, None] != code[b][None, :]) & (own[i][:, None] | own[b][None, :])
        x, y = np.nonzero(near)
        if not len(x):
            continue
        _, first = np.unique(code[i[x]].astype(np.int64) * len(up) + code[b[y]], return_index=True)
        for k in first.tolist():
            p, q = int(i[x[k]]), int(b[y[k]])
            if (r := root(int(code[p]))) != (s := root(int(code[q]))):
                up[r] = s
                links.append((p, q))
    return links


def _block_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows key, one, two (blocks), node, label, own, blk in order of the first three, to links a, b."""
    held: list[pa.RecordBatch] = []

    def links(group: pa.Table) -> Iterator[pa.RecordBatch]:
        node, label, blk = (group.column(k).to_numpy() for k in ("node", "label", "blk"))
        found = cross_links(node.view(np.uint64), label, group.column("own").to_numpy(zero_copy_only=False), blk)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(node[[p for p, _ in found]]), pa.array(node[[q for _, q in found]])], names=["a", "b"])

    def cut(t: pa.Table) -> np.ndarray:
        ids = np.stack([t.column(k).to_numpy() for k in ("key", "one", "two")])
        return np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1

    for batch in batches:
        held.append(batch)
        t = pa.Table.from_batches(held)
        ends = cut(t)
        if len(ends):  # all groups but the last are whole
            start = 0
            for end in ends.tolist():
                yield from links(t.slice(start, end - start))
                start = end
            held = t.slice(start).combine_chunks().to_batches()
    if held:
        yield from links(pa.Table.from_batches(held))


def _labelled(members: DataFrame, labels: DataFrame | None, n: int) -> DataFrame:
    """Members of buckets with several labels, and their label."""
    rows = members.withColumn("label", F.col("node")) if labels is None else members.join(broadcast_if_small(labels, NODE_BYTES, n), "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("own").alias("any")).where("lo < hi AND any").select("key")
    return rows.join(several, "key").select("key", "mask", "node", "own", "label")


def refined(rows: DataFrame, scratch: Scratch, largest: int) -> DataFrame:
    """Labelled members with buckets of over `largest` dealt on by quarters of the bits that their key doesn't hold."""
    done = []
    while True:
        big = scratch.written(rows.groupBy("key").count().where(F.col("count") > largest).select("key"), "big")
        if not (n := big.count()):
            return united([*done, rows])
        big = broadcast_if_small(big, NODE_BYTES, n)
        done.append(rows.join(big, "key", "left_anti"))
        masks = [r.mask for r in rows.join(big, "key", "left_semi").select("mask").distinct().collect()]  # at most parts * 4 ^ turns
        table = [(m, signed((m & (2**64 - 1)) | q), signed(q)) for m in masks for q in quarters(m & (2**64 - 1))]
        if not table:
            return united([*done, rows.join(big, "key", "left_semi")])
        table = F.broadcast(rows.sparkSession.createDataFrame(table, "mask long, mask2 long, bits long"))
        dealt = rows.join(big, "key", "left_semi").join(table, "mask")
        dealt = dealt.select(F.xxhash64("key", "bits", F.col("node").bitwiseAND(F.col("bits"))).alias("key"), F.col("mask2").alias("mask"), "node", "own", "label")
        several = dealt.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("own").alias("any")).where("lo < hi AND any").select("key")
        rows = scratch.written(dealt.join(several, "key"), "refined")


def united(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def linked(nodes: DataFrame, n: int, scratch: Scratch, parts: list[tuple[list[int], int]], block: int = BLOCK, largest: int = LARGEST) -> tuple[DataFrame | None, int]:
    """node and label of the n distinct nodes that have links, and the number of links found."""
    keys = nodes.select("node").mapInArrow(_keys(parts), "key long, mask long, node long, own boolean")
    shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("own").alias("any")).where("lo < hi AND any").select("key")
    members = scratch.written(keys.join(shared, "key"), "members")
    near = F.bit_count(F.col("node").bitwiseXOR(F.col("c"))) <= DISTANCE
    centres = members.where("own").groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    stars = members.join(centres, "key").select("node", F.explode(F.array("lo", "hi")).alias("c")).where((F.col("node") != F.col("c")) & near)
    stars = scratch.written(stars.select(F.col("node").alias("a"), F.col("c").alias("b")).distinct(), "stars")
    n_links, labels = stars.count(), None
    if n_links:
        labels = joined(None, stars, n_links, scratch)
    rows = refined(scratch.written(_labelled(members, labels, 2 * n_links), "open"), scratch, largest)
    several = rows.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("several"))
    rows = rows.join(several, "key").withColumn("blk", F.pmod(F.xxhash64("node"), F.col("several")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("several") - 1)))
    rows = rows.select("key", F.least("blk", "other").alias("one"), F.greatest("blk", "other").alias("two"), "node", "label", "own", "blk")
    rows = rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    found = scratch.written(rows.mapInArrow(_block_links, "a long, b long"), "found")
    if more := found.count():
        labels = joined(labels, found, more, scratch)
    return labels, n_links + more


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: list | None = None, block: int = BLOCK, largest: int = LARGEST) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row, as a written table."""
    arrow_rows(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "simhash")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = scratch.written(own.mapInArrow(_fingerprints, "doc_id long, node long"), "fingerprints")
    nodes = scratch.written(rows.groupBy("node").agg(F.min("doc_id").alias("doc")), "nodes")
    n = nodes.count()
    if parts is None:
        sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(max(1, n))) < SAMPLE).select("node").toPandas()["node"].to_numpy().astype(np.int64)
        parts = scheme(sample.view(np.uint64), n)
    labels, n_links = linked(nodes, n, scratch, parts, block, largest)
    if labels is None:
        named = nodes.withColumn("component_id", F.col("doc"))
    else:
        of = nodes.join(broadcast_if_small(labels, NODE_BYTES, 2 * n_links), "node", "left").withColumn("label", F.coalesce("label", "node"))
        least = of.groupBy("label").agg(F.min("doc").alias("component_id"))
        named = of.join(least, "label")
    named = scratch.written(named.select("node", "component_id"), "named")
    done = written(rows.join(named, "node").select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id"), "simhash-classes")
    scratch.clear()
    return done
