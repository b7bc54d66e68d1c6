"""Prefix trie of conversations from mergeable partial tries.

A node is a distinct sequence of the first d turns (role, text) of conversations, named by
a 128-bit hash that each turn chains onto its parent's.  A task walks its conversations,
sorted by turn, and emits its own node table: of each node the depth, the parent, the bytes
of its last text, its least member and how many members it has, and the ids that end there.
Node tables merge by the node's hash in rounds (MERGES tables of each node first, then
one), so that a node of all conversations is summed up along a tree; lists of ends are cut
into sorted pieces of bounded size, which are dealt by node and id.

Rollup.  Along a node's path the least member never gets smaller, so the nodes with one
least member are a chain, hung to a node of another chain.  Sums of subtrees go bottom-up:
over chains by doubling (a chain's total goes to its 1st, 2nd, 4th ... chain above, in
log(height) rounds however deep the trie is), then along each chain from its end by a
window.

`rebuilt` conversations: with FAMILY and SHARED, conversation c is the first
h = crc32(c) % SHARED turns of conversation c - c % FAMILY and then its own turns after its
first h.  FAMILY = 1 leaves conversations as they are.

Memory: a task holds MOST_NODES nodes and, of one family, the first turns that the others
share.  Turns of one conversation and the digest of one node's ends are streamed through a
task in order.

Defined results: null role or text is empty; rows without a conv_id aren't in any conversation;
turns of the same number (null first) come by role and then text; repeated rows are turns each;
a conversation without turns is a member, and an end, of the root; % has the sign of c; an
empty table has no nodes, not even the root; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_rows, remembers, written

FAMILY, SHARED = 5, 9
MERGES = 32
#: Nodes and ends that a task combines before it emits them.
MOST_NODES = 100_000
#: Ids of one piece of a list of ends.
PIECE = 8192

ROOT = b"\0" * 16
PARTIAL = "node binary, parent binary, depth long, bytes long, conv_id long, n_convs long, ends binary"


class _Table:
    """The node table that a task has so far."""

    def __init__(self) -> None:
        self.nodes: dict[bytes, list] = {}
        self.n = 0

    def add(self, node: bytes, parent: bytes | None, depth: int, size: int, conv_id: int) -> None:
        held = self.nodes.get(node)
        if held is None:
            self.nodes[node] = [parent, depth, size, conv_id, 1, []]
            self.n += 1
        else:
            held[3] = min(held[3], conv_id)
            held[4] += 1

    def end(self, node: bytes, conv_id: int) -> None:
        self.nodes[node][5].append(conv_id)
        self.n += 1

    def batch(self) -> pa.RecordBatch:
        rows = self.nodes.values()
        ends = [np.array(sorted(r[5]), "<i8").tobytes() if r[5] else None for r in rows]
        out = [pa.array(self.nodes.keys(), pa.binary()), pa.array([r[0] for r in rows], pa.binary()), *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3, 4)), pa.array(ends, pa.binary())]
        self.__init__()
        return pa.RecordBatch.from_arrays(out, names=[c.split()[0] for c in PARTIAL.split(", ")])


def below(node: bytes, role: bytes, text: bytes) -> bytes:
    """The node of one turn more."""
    import xxhash

    return xxhash.xxh3_128_digest(b"%b%d:%b%b" % (node, len(role), role, text))


def walker(shared: int):
    """For mapInArrow: rows family, conv_id, role, text in order, each family's first conversation leading if it is there, to node tables."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembers("trie", None)
        table, family, lead, conv_id, node, depth, i, skip = _Table(), None, [], None, ROOT, 0, 0, 0

        def turn(role: bytes, text: bytes) -> None:
            nonlocal node, depth
            parent, node, depth = node, below(node, role, text), depth + 1
            table.add(node, parent, depth, len(text), conv_id)

        for batch in batches:
            for f, c, role, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                role, text = (role or "").encode("utf-8", "surrogatepass"), (text or "").encode("utf-8", "surrogatepass")
                if c != conv_id:
                    if conv_id is not None:
                        table.end(node, conv_id)
                        if table.n >= MOST_NODES:
                            yield table.batch()
                    if f != family:
                        family, lead = f, []
                    conv_id, node, depth, i = c, ROOT, 0, 0
                    skip = zlib.crc32(b"%d" % c) % shared if c != f else 0
                    table.add(ROOT, None, 0, 0, c)
                    for turn_before in lead[:skip]:
                        turn(*turn_before)
                if c == f and i < shared - 1:
                    lead.append((role, text))
                if i >= skip:
                    turn(role, text)
                i += 1
                if table.n >= 2 * MOST_NODES:  # within a very long conversation; its last node stays
                    yield table.batch()
                    table.nodes[node] = [None, depth, 0, conv_id, 0, []]
        if conv_id is not None:
            table.end(node, conv_id)
            yield table.batch()

    return run


def partial_tries(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """Node tables (PARTIAL), one or more of each task; families are dealt whole, sorted by turn."""
    own = conversations.where("conv_id IS NOT NULL").select(
        (F.col("conv_id") - F.col("conv_id") % family).cast("long").alias("family"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = own.repartition("family").sortWithinPartitions("family", F.col("conv_id") != F.col("family"), "conv_id", F.asc_nulls_first("turn"), "role", "text")
    return dealt.select("family", "conv_id", "role", "text").mapInArrow(walker(shared), PARTIAL)


def merged(partial: DataFrame) -> DataFrame:
    """One row a node of node tables."""
    for keys in (["node", "_part"], ["node"]):
        sums = [F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("bytes").alias("bytes"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs")]
        rows = partial.withColumn("_part", F.pmod(F.xxhash64("conv_id"), F.lit(MERGES))) if "_part" in keys else partial
        partial = rows.groupBy(*keys).agg(*sums).drop("_part")
    return partial


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.frombuffer(ids, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array([node] * len(ids), pa.binary()), pa.array(ids)], names=["node", "conv_id"])


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows node, conv_id to node, first, and the piece's ids as comma-joined text."""
    node, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])

    for batch in batches:
        for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (n != node or len(ids) >= PIECE):
                yield piece()
                ids = []
            node = n
            ids.append(c)
    if ids:
        yield piece()


def end_pieces(partial: DataFrame) -> DataFrame:
    """node, first and ids: the ids that end at a node, ascending and comma-joined, in pieces of PIECE ids at most, by their first id."""
    ends = partial.where("ends IS NOT NULL").select("node", "ends").mapInArrow(_ends, "node binary, conv_id long")
    return ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(_pieces, "node binary, first long, ids string")


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    node, digest = None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])
    for batch in batches:
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if n != node:
                if digest:
                    yield row()
                node, digest = n, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if digest:
        yield row()


def end_digests(pieces: DataFrame) -> DataFrame:
    """node and the SHA-256 of its comma-joined ends."""
    return pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(_digests, "node binary, ends_sha256 string")


def rolled_up(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """nodes (as merged) with parent_conv_id, n_children, n_leaves and saved."""
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    full = nodes.join(children, "node", "left").join(above, "parent", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    full = scratch.written(full.withColumn("own_saved", (F.col("n_convs") - 1) * F.col("bytes")).withColumn("own_leaves", (F.col("n_children") == 0).cast("long")), "nodes")
    # chains: nodes of one least member, hung to the node of chain `up` at depth `at`
    head = ~F.col("conv_id").eqNullSafe(F.col("parent_conv_id"))
    chains = full.groupBy(F.col("conv_id").alias("chain")).agg(
        F.max(F.when(head, F.col("parent_conv_id"))).alias("up"), F.max(F.when(head, F.col("depth") - 1)).alias("at"), F.sum("own_saved").alias("saved"), F.sum("own_leaves").alias("leaves")
    )
    now = scratch.written(chains.withColumn("jump", F.col("up")), "chains")
    while not now.where("jump IS NOT NULL").isEmpty():
        hung = now.where("jump IS NOT NULL").groupBy(F.col("jump").alias("chain")).agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
        far = now.select(F.col("chain").alias("jump"), F.col("jump").alias("far"))
        step = now.join(hung, "chain", "left").join(far, "jump", "left")
        now = scratch.written(step.select("chain", "up", "at", (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), F.col("far").alias("jump")), "chains")
    hung = now.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id"), F.col("at").alias("depth")).agg(F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    to_end = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = full.join(hung, ["conv_id", "depth"], "left")
    for k in ("saved", "leaves"):
        rows = rows.withColumn(k, F.sum(F.col(f"own_{k}") + F.coalesce(f"hung_{k}", F.lit(0))).over(to_end))
    return rows.select("node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), "saved")


def trie(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Written tables: the nodes with their sums, and the pieces of their lists of ends."""
    arrow_rows(conversations.sparkSession)
    scratch = Scratch(conversations.sparkSession, "trie")
    partial = scratch.written(partial_tries(conversations, family, shared), "partial")
    pieces = written(end_pieces(partial), "trie-ends")
    nodes = written(rolled_up(scratch.written(merged(partial), "merged"), scratch), "trie-nodes")
    scratch.clear()
    return nodes, pieces


def digest(nodes: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row a node, with the SHA-256 of its ends (of nothing, if none ends there)."""
    ends = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    return nodes.join(end_digests(pieces), "node", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), ends)
