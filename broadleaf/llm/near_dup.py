"""Near-duplicate classes by Order MinHash, verified by banded alignment.

Texts are lower-cased word sequences.  Equal sequences share a node (a 64-bit hash
of the text).  Each node gets SKETCHES Order MinHash values of its k-mers of words: the
TUPLE least k-mers, labelled by occurrence, under a random order, hashed in the order
they have in the text.  Nodes that share a value share a bucket.  Texts of SHORT words
or fewer have sketches of single words, and texts of over 4/5 of that (so that two
texts alike always have one kind in common) sketches of WORDS words in a row.

Two nodes are a link if the longest common subsequence of their words, found by
bit-parallel alignment within the band that the threshold leaves, is at least
SIMILARITY of the words of both taken together.  So a text with one word in nine
replaced is a copy, although with edits that lie evenly it shares but 0.29 of its
five-word shingles.  The k-mers only bring candidates together, and are shorter so that
texts just at the threshold meet wherever their edits lie: tests plant pairs of 4 to 900
words at 0.80 and 0.84.

First every node is paired with the least node of all its buckets, one pair a node,
which joins most of any large family.  Then members of buckets that still hold several
classes are paired with the bucket's least and with its greatest node, unless both are
in one class already.  Buckets that hold several classes even then have all their
pairs across classes judged, in blocks of about BLOCK_BYTES of nodes alike in size,
each with each whose sizes allow a link and that aren't of one class (a class that fills
blocks has its own): words in common are counted for all pairs of a
block and PARTNERS that it meets at once, and only pairs with enough of them are aligned (words by 32 bits of
their hashes).  So every link between two members of a bucket is found or implied,
whatever its size.  Links make classes by contraction over written tables.

Only light rows are kept of all texts.  Words are read again just for nodes that
occur in pairs, once per node.  Copies within a task are counted once before any
shuffle.  A node in many pairs has its words copied under several salts.

Defined results: null text and text without words are classes of their own; texts
of fewer than four words have no near copies but equal ones; the class id
is its least doc_id (null if none has one); rows that share a doc_id each get a row,
and deduplicate() keeps exactly one row of each class whatever the ids are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Hashes, Scratch, arrow_rows, broadcast_if_small, mixed, remembers, with_texts, written
from .components import NODE_BYTES, components, joined

SIMILARITY = 0.8
WORDS, SKETCHES, TUPLE = 3, 40, 3
#: Words of a text up to which single words are its k-mers.
SHORT = 20
ORDERS = (np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
#: Words of a block of the exact pass; a node counts as LEAST_BYTES at least, so that a block has 512 nodes at most.
BLOCK_BYTES, LEAST_BYTES = 2 << 20, 4096
#: Blocks that a block is judged against at once.
PARTNERS = 4
#: Nodes that a task remembers to count copies once.
MOST_SEEN = 200_000
#: Pairs of a node under one salt.
SALT_PAIRS = 2000
#: Nodes of one block differ by this factor in size at most.
SIZE_STEP = 1.1
#: Words beyond which an alignment looks positions up instead of holding a bit set for each word.
LONG = 16_384


HASHES = Hashes()


def words(text: str | None) -> tuple[int, np.ndarray]:
    """The text's node and the 64-bit hashes of its words in order."""
    import xxhash

    found = (text or "").lower().split()
    node = xxhash.xxh3_64_intdigest(" ".join(found).encode("utf-8", "surrogatepass"))
    return node, np.fromiter(map(HASHES.__getitem__, found), np.uint64, len(found))


def shingles(h: np.ndarray) -> np.ndarray:
    """64-bit hashes of every WORDS words in a row; one of all words if there are fewer."""
    k = min(WORDS, len(h))
    if not k:
        return h
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + h[i : len(h) - k + 1 + i]
    return mixed(out)


def sketches(h: np.ndarray) -> np.ndarray:
    """SKETCHES Order MinHash values of shingles in order."""
    n = len(h)
    labelled = h
    order = np.argsort(h, kind="stable")
    if (repeated := h[order][1:] == h[order][:-1]).any():
        at = np.arange(n)
        first = np.maximum.accumulate(np.where(np.append(True, ~repeated), at, 0))
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = (at - first).astype(np.uint64)
        # a first occurrence keeps its own label, as in texts without repeats
        labelled = np.where(occurrence == 0, h, mixed(h + occurrence * np.uint64(0xD6E8FEB86659FD93)))
    k = min(TUPLE, n)
    if n <= 100_000:
        keys = mixed_orders(labelled[None, :], ORDERS[:, None])
        places = np.argpartition(keys, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (SKETCHES, 1))
    else:
        places = np.stack([np.argpartition(mixed_orders(labelled, o), k - 1)[:k] for o in ORDERS])
    places.sort(axis=1)
    out = ORDERS.copy()
    for i in range(k):
        out = mixed(out * np.uint64(0xC2B2AE3D27D4EB4F) + h[places[:, i]])
    return out


def text_sketches(h: np.ndarray) -> np.ndarray:
    """The sketches of a text by its words' hashes; none without words."""
    kinds = [mixed(sketches(h) ^ ORDERS[0])] if 0 < len(h) <= SHORT else []
    if len(h) > SIMILARITY * SHORT:
        kinds.append(sketches(shingles(h)))
    return np.concatenate(kinds) if kinds else h


def mixed_orders(h: np.ndarray, order: np.ndarray) -> np.ndarray:
    x = (h ^ (order >> np.uint64(7))) * order
    return x ^ (x >> np.uint64(32))


class Places:
    """Where each value of a long list stands; memory is linear in its length."""

    def __init__(self, values: list[int]):
        codes, inverse, count = np.unique(np.array(values), return_inverse=True, return_counts=True)
        order, ends = np.argsort(inverse, kind="stable"), np.cumsum(count)
        self.at = {v: order[e - c : e] for v, e, c in zip(codes.tolist(), ends.tolist(), count.tolist(), strict=True)}

    def bits(self, value: int, low: int, high: int) -> int:
        """The places of value from low to high - 1, as bits from low."""
        at = self.at.get(value)
        if at is None:
            return 0
        at = at[np.searchsorted(at, low) : np.searchsorted(at, high)]
        if len(at) <= 4:
            return sum(1 << (p - low) for p in at.tolist())
        some = np.zeros(int(at[-1]) - low + 1, np.uint8)
        some[at - low] = 1
        return int.from_bytes(np.packbits(some, bitorder="little").tobytes(), "little")


def common_within(a: list[int], b: list[int], band: int) -> int:
    """As common(), holding only the bits within the band: those before it are settled, those after it still free."""
    places, n, low, high = Places(a), len(a), 0, min(len(a), band)
    free, settled = (1 << high) - 1, 0
    for j, y in enumerate(b):
        if j + band < n:
            high += 1
            free |= 1 << (high - 1 - low)
        if j > band and low < n:
            settled += not free & 1
            free >>= 1
            low += 1
        m = places.bits(y, low, high)
        if m:
            u = free & m
            free = ((free + u) | (free - u)) & ((1 << (high - low)) - 1)
    return settled + (high - low) - free.bit_count()


def common(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence of a and b among places at most band apart."""
    if len(a) > LONG:
        return common_within(a, b, band)
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    free = whole = (1 << len(a)) - 1
    width = (1 << (2 * band + 1)) - 1
    for j, y in enumerate(b):
        m = places.get(y)
        if m is None:
            continue
        m &= width << (j - band) if j >= band else width >> (band - j)
        u = free & m
        free = ((free + u) | (free - u)) & whole
    return len(a) - free.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Common subsequence over the words of both taken together; 0 if it is below least."""
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return 0.0
    need = int(np.ceil(total * least / (1 + least) - 1e-9))
    if min(len(a), len(b)) < need:
        return 0.0
    (x, nx), (y, ny) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if np.minimum(nx[i], ny[j]).sum() < need:
        return 0.0
    m = min(len(a), len(b))
    differ = np.flatnonzero(a[:m] != b[:m])
    head = int(differ[0]) if len(differ) else m
    a, b = a[head:], b[head:]
    m = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - m :][::-1] != b[len(b) - m :][::-1])
    tail = int(differ[0]) if len(differ) else m
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    length = head + tail + (common(a.tolist(), b.tolist(), total - 2 * need) if len(a) and len(b) else 0)
    found = length / (total - length)
    return found if found >= least else 0.0


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("raw", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("values", pa.list_(pa.int64()))])
    seen: set[int] = set()
    remembers("near_dup", HASHES.clear)
    for batch in batches:
        nodes, sizes, values = [], [], []
        for text in batch.column(2).to_pylist():
            node, h = words(text)
            new = node not in seen
            if new:
                if len(seen) >= MOST_SEEN:
                    seen.clear()
                seen.add(node)
            nodes.append(node)
            sizes.append(len(h))
            values.append(text_sketches(h).view(np.int64) if new else ())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(values, pa.list_(pa.int64()))], schema=schema)


def _blobs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    remembers("near_dup", HASHES.clear)
    for batch in batches:
        nodes, blobs = [], []
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if node not in seen:
                if len(seen) >= MOST_SEEN:
                    seen.clear()
                seen.add(node)
                nodes.append(node)
                blobs.append((words(text)[1] >> np.uint64(32)).astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(blobs, pa.binary())], names=["node", "blob"])


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [similarity(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) > 0 for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])


def overlaps(arrays: list[np.ndarray], first: int | None = None) -> np.ndarray:
    """For each of the first arrays (all, if None) and each array, how many values they have in common, repeats counted."""
    n = len(arrays)
    m = n if first is None else first
    labelled = []
    for x in arrays:
        x = np.sort(x).astype(np.uint64)
        new = np.append(True, x[1:] != x[:-1])
        at = np.arange(len(x))
        nth = at - np.maximum.accumulate(np.where(new, at, 0))
        labelled.append(x << np.uint64(32) | nth.astype(np.uint64))
    owner = np.repeat(np.arange(n), [len(x) for x in labelled])
    _, code, count = np.unique(np.concatenate(labelled), return_inverse=True, return_counts=True)
    order = np.argsort(code, kind="stable")
    owner, start = owner[order], np.cumsum(count) - count
    total = np.zeros(m * n, np.float32)
    for c in range(2, 9):  # values of few arrays, pair by pair; owners ascend
        at = start[count == c]
        for i in range(c):
            for j in range(i + 1, c):
                x, y = owner[at + i], owner[at + j]
                x, y = x[x < m], y[x < m]
                total += np.bincount(x * n + y, minlength=m * n)
    total = total.reshape(m, n)
    total[:, :m] += total[:, :m].T.copy()
    hot = np.flatnonzero(count > 8)
    for k in range(0, len(hot), 4096):
        part = hot[k : k + 4096]
        has = np.zeros((n, len(part)), np.float32)
        for i, h in enumerate(part):
            has[owner[start[h] : start[h] + count[h]], i] = 1
        total += has[:m] @ has.T
    return total


def _block_links(group: pa.Table) -> pa.Table:
    """Links between the nodes of a block (own) and those of the blocks that it meets, and within it (inner), that join all of their classes that links join."""
    own = group["own"].to_numpy(zero_copy_only=False)
    group = group.take(np.argsort(~own, kind="stable"))
    first, inner = int(own.sum()), group["chunk"][0].as_py() == 0
    nodes, arrays = group["node"].to_pylist(), [np.frombuffer(x, np.uint32) for x in group["blob"].to_pylist()]
    label, size = group["label"].to_numpy().copy(), np.array([len(x) for x in arrays])
    need = np.ceil((size[:first, None] + size[None, :]) * SIMILARITY / (1 + SIMILARITY) - 1e-9)
    wanted = (overlaps(arrays, first) >= need) & (label[:first, None] != label[None, :])
    wanted[:, :first] = np.triu(wanted[:, :first], 1) if inner else False
    a, b = np.nonzero(wanted)
    links = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        if label[i] != label[j] and similarity(arrays[i], arrays[j]) > 0:
            links.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
            label[label == label[j]] = label[i]
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})


def _meetings(blocks: DataFrame) -> DataFrame:
    """unit, blk1, chunk, blk: block blk1 with those after it that it meets, PARTNERS at a time, so that blk1 is sent once for all of a chunk; chunk 0 has it with itself.

    blocks: unit, blk, lo, hi (sizes of nodes), from, to (least and greatest label).
    """
    x, y = (blocks.select("unit", *(F.col(c).alias(c + k) for c in ("blk", "lo", "hi", "from", "to"))) for k in "12")
    fits = (F.col("blk1") <= F.col("blk2")) & (F.col("hi1") >= F.col("lo2") * SIMILARITY - 1) & (F.least("from1", "from2") < F.greatest("to1", "to2"))
    chunk = F.floor((F.row_number().over(W.partitionBy("unit", "blk1").orderBy("blk2")) - 1) / PARTNERS).cast("int")
    meet = x.join(y, "unit").where(fits).select("unit", "blk1", "blk2", chunk.alias("chunk"))
    return meet.select("unit", "blk1", "chunk", F.explode(F.array("blk1", "blk2")).alias("blk")).distinct()


def _blobs_of(own: DataFrame, least: DataFrame, nodes: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """node and blob (its words as 32-bit hashes) of n nodes. Texts are read again for them only."""
    needed = scratch.written(nodes.join(least, "node").select("node", "raw"), "needed")
    found = own.select("raw", "text").join(broadcast_if_small(needed, NODE_BYTES), "raw").select("node", "text").mapInArrow(_blobs, "node long, blob binary")
    return scratch.written(found.groupBy("node").agg(F.first("blob").alias("blob")), "blobs")


def _with_words(rows: DataFrame, pairs: DataFrame, blobs: DataFrame, node: str, name: str, n: int) -> DataFrame:
    """rows, one for each of n pairs, with the words of a node; those of a node in many pairs are copied under salts, so that its pairs spread."""
    many = pairs.groupBy(node).agg(F.ceil(F.count("*") / SALT_PAIRS).cast("int").alias("salts")).where("salts > 1")
    many = broadcast_if_small(many, NODE_BYTES, n // SALT_PAIRS)  # each has more than SALT_PAIRS of the n pairs
    salted = rows.join(many, node, "left").withColumn("salt", F.pmod(F.xxhash64("a", "b"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    copies = blobs.withColumnsRenamed({"node": node, "blob": name}).join(many, node, "left")
    copies = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return salted.join(copies, [node, "salt"]).drop("salt")


def _judged(own: DataFrame, least: DataFrame, pairs: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """n pairs a, b with ok: whether they are links."""
    blobs = _blobs_of(own, least, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), 2 * n, scratch)
    at_b = _with_words(pairs.select("a", "b"), pairs, blobs, "b", "y", n)
    both = _with_words(at_b, pairs, blobs, "a", "x", n).select("a", "b", "x", "y")
    return scratch.written(both.mapInArrow(_verify, "a long, b long, ok boolean"), "judged")


def _rest(own: DataFrame, least: DataFrame, sizes: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame | None:
    """Links a, b that join all classes that any link within a bucket joins, from members (key, node, label) of buckets with several labels.

    Buckets that share nodes are taken together where that gives fewer pairs than one by one.
    """
    n = members.count()
    if not n:
        return None
    centres = scratch.written(members.groupBy("key").agg(F.min("node").alias("a")), "centres")
    stars = members.join(centres, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    families = components(stars, n, scratch).select(F.col("node").alias("a"), F.col("label").alias("family"))
    named = scratch.written(members.join(centres.join(families, "a").select("key", "family"), "key"), "named")  # a bucket is of one family
    apart = named.groupBy("family", "key").agg(F.count("*").cast("double").alias("c")).groupBy("family").agg(F.sum(F.col("c") * F.col("c")).alias("apart"))
    whole = named.groupBy("family").agg(F.countDistinct("node").cast("double").alias("c")).join(apart, "family").where("c * c <= apart").select("family", F.lit(True).alias("whole"))
    whole = broadcast_if_small(scratch.written(whole, "whole"), NODE_BYTES)
    unit = F.when(F.col("whole"), F.xxhash64(F.lit("family"), "family")).otherwise(F.xxhash64(F.lit("key"), "key"))
    parts = named.join(whole, "family", "left").select(unit.alias("unit"), "node", "label").distinct().join(sizes, "node")
    parts = scratch.written(parts.withColumn("step", F.floor(F.log("n") / F.log(F.lit(SIZE_STEP)))).withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(1 << 20))), "sized")
    # Blocks of a unit: by size step. A class that fills a block has blocks of its own, which don't meet each other; the other classes share theirs.
    size = F.sum(F.greatest(F.lit(LEAST_BYTES), 4 * F.col("n")))
    classes_ = scratch.written(parts.groupBy("unit", "step", "label").agg(size.alias("bytes")), "classes")
    large = classes_.where(F.col("bytes") >= BLOCK_BYTES // 2).select("unit", "step", "label", F.ceil(F.col("bytes") / BLOCK_BYTES).alias("own"))
    large = broadcast_if_small(scratch.written(large, "large"), 2 * NODE_BYTES)
    shared = classes_.where(F.col("bytes") < BLOCK_BYTES // 2).groupBy("unit", "step").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("several"))
    shared = broadcast_if_small(scratch.written(shared, "shared"), NODE_BYTES)
    place = lambda several: F.floor(F.col("salt") * several / (1 << 20))
    alone = F.lit(1 << 40) + F.pmod(F.xxhash64("label"), F.lit(1 << 19)) * (1 << 20) + place(F.col("own"))
    block = F.col("step") * (1 << 48) + F.when(F.col("own").isNotNull(), alone).otherwise(place(F.coalesce("several", F.lit(1))))
    parts = parts.join(large, ["unit", "step", "label"], "left").join(shared, ["unit", "step"], "left")
    parts = scratch.written(parts.select("unit", "node", "label", "n", block.alias("blk")), "parts")
    blocks = parts.groupBy("unit", "blk").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("label").alias("from"), F.max("label").alias("to"))
    places = scratch.written(_meetings(blocks), "meet")
    blobs = _blobs_of(own, least, parts.select("node").distinct(), n, scratch)
    rows = parts.select("unit", "blk", "node", "label").join(places, ["unit", "blk"]).join(blobs, "node").select("unit", "blk1", "chunk", (F.col("blk") == F.col("blk1")).alias("own"), "node", "label", "blob")
    return scratch.written(rows.groupBy("unit", "blk1", "chunk").applyInArrow(_block_links, "a long, b long"), "rest")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, node, class (a node) and class_id of each row, as a written table."""
    arrow_rows(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near-dup")
    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("raw"), text.alias("text"))
    rows = scratch.written(own.mapInArrow(_sketch, "doc_id long, raw long, node long, n long, values array<long>"), "sketches")
    keys = rows.where("n > 0").select("node", F.explode("values").alias("key")).select("key", "node")
    shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members = scratch.written(keys.join(shared, "key").distinct(), "members")  # of buckets with several nodes
    least = rows.where("n > 0").groupBy("node").agg(F.min("raw").alias("raw"))
    tested = labels = None
    n_links = 0
    for end in (None, F.min, F.max):
        if end is None:  # each node with the least of all its buckets
            centres = members.groupBy("key").agg(F.min("node").alias("c"))
            apart = members.join(centres, "key").groupBy("node").agg(F.min("c").alias("c")).where("node <> c")
        else:
            known = broadcast_if_small(labels, NODE_BYTES, 2 * n_links) if labels is not None else None
            now = members.select("key", "node").join(known, "node", "left").withColumn("label", F.coalesce("label", "node")) if known is not None else members.select("key", "node", F.col("node").alias("label"))
            open_ = now.groupBy("key").agg(end("node").alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key", "c")
            members = scratch.written(now.join(open_, "key").select("key", "node", "c", "label"), "members")
            centres = members.where("node = c").select("key", F.col("label").alias("of"))
            apart = members.join(centres, "key").where("label <> of")
        pairs = apart.select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.written(pairs, "pairs")
        n = pairs.count()
        if not n:
            continue
        judged = _judged(own, least, pairs, n, scratch)
        tested = judged.select("a", "b") if tested is None else tested.unionByName(judged.select("a", "b"))
        new = judged.where("ok").select("a", "b")
        if found := new.count():
            n_links += found
            labels = joined(labels, new, found, scratch)
    now = members.select("key", "node")
    now = now.join(broadcast_if_small(labels, NODE_BYTES, 2 * n_links), "node", "left").withColumn("label", F.coalesce("label", "node")) if labels is not None else now.withColumn("label", F.col("node"))
    open_ = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    # Buckets of two nodes had their only pair judged.
    open_ = open_.join(members.groupBy("key").count().where("count > 2").select("key"), "key")
    rest = scratch.written(now.join(open_, "key").select("key", "node", "label"), "members")
    new = _rest(own, least, rows.where("n > 0").groupBy("node").agg(F.max("n").alias("n")), rest, scratch)
    if new is not None and (found := new.count()):
        n_links += found
        labels = joined(labels, new, found, scratch)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"))
    if labels is not None:
        labels = broadcast_if_small(labels, NODE_BYTES, 2 * n_links)
        nodes = nodes.join(labels, "node", "left").where("copies > 1 or label is not null").select("node", F.coalesce("label", "node").alias("class"), "doc")
    else:
        nodes = nodes.where("copies > 1").select("node", F.col("node").alias("class"), "doc")
    several = scratch.written(nodes, "several")  # nodes that share their class with others or have copies
    ids = several.groupBy("class").agg(F.min("doc").alias("class_id"))
    n_several = several.count()
    ids = scratch.written(ids, "class-ids")
    named = several.select("node", "class").join(broadcast_if_small(ids, NODE_BYTES), "class")
    named = broadcast_if_small(scratch.written(named, "named"), NODE_BYTES, n_several)
    own_node = F.when(F.col("n") > 0, F.col("node"))
    done = written(rows.select("doc_id", own_node.alias("node")).join(named, "node", "left").select("doc_id", "node", F.coalesce("class", "node").alias("class"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")), "classes")
    scratch.clear()
    return done


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id and kept (whether the row's id is its class's) of each row."""
    return classes(docs, id_col, text_col).select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull()).alias("kept"))


def _nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [words(t) for t in batch.column(0).to_pylist()]
        nodes = pa.array([np.uint64(n).view(np.int64).item() if len(h) else None for n, h in found], pa.int64())
        yield pa.RecordBatch.from_arrays([nodes, *batch.columns[1:]], names=["node", *batch.schema.names[1:]])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with one row of each class: that of its least id."""
    found = classes(docs, id_col, text_col).where("class is not null")
    names, back = docs.columns, [f"c{k}" for k in range(len(docs.columns))]
    rows, i, t = docs.toDF(*back), back[names.index(id_col)], back[names.index(text_col)]
    odd = written(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(i)), "repeated")
    n_odd, nulls = odd.count(), not rows.where(F.col(i).isNull()).isEmpty()
    go = written(found.where("doc_id <> class_id").select(F.col("doc_id").alias(i)).distinct(), "removed")
    go = broadcast_if_small(go, NODE_BYTES)
    if not n_odd and not nulls:
        return rows.join(go, i, "left_anti").select(*back).toDF(*names)
    odd = broadcast_if_small(odd, NODE_BYTES, n_odd)
    plain = rows.where(F.col(i).isNotNull()).join(odd, i, "left_anti").join(go, i, "left_anti").select(*back)
    others = rows.join(odd, i, "left_semi").select(*back).unionByName(rows.where(F.col(i).isNull()))
    marked = with_texts(others, t, _nodes, "node long")
    names_of = found.select("node", "class", "class_id").distinct()
    chosen = marked.join(names_of, "node").where(F.col(i).eqNullSafe(F.col("class_id"))).dropDuplicates(["class"]).select(*back)
    wordless = marked.where("node is null").select(*back)
    return plain.unionByName(chosen).unionByName(wordless).toDF(*names)
