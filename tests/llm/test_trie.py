"""op12 against a trie of whole tuples, with odd rows, and against its SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from broadleaf.llm import conversation_trie, queries
from harness import same

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h, lead = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(own.get(lead, [])[:h] + own[c][h:]) if lead != c else tuple(own[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    out = []
    for node, own_members in members.items():
        under = [n for n in members if n[: len(node)] == node]
        leaf = [n for n in under if not any(len(m) == len(n) + 1 and m[:-1] == n for m in under)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n)
        children = sum(len(n) == len(node) + 1 for n in under)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(own_members), len(node), min(members[node[:-1]]) if node else None, len(own_members), children, len(leaf), saved, digest))
    return sorted(out, key=str)


def odd_turns():
    rng = random.Random(3)
    rows = [(None, 1, "user", "no conversation"), (7, None, None, None), (7, None, None, None), (7, 2, "user", ""), (7, 2, "assistant", "tie"), (-7, 1, "user", "below zero"), (-5, 1, "user", "its lead"), (-5, 2, "user", "its lead's second")]
    rows += [(10, k, "user", f"turn {k} ü퟿") for k in range(300)] + [(11, 0, "user", "a"), (13, k := 0, "user", "x" * 100_000), (14, 0, "", "x")]
    for c in range(15, 90):  # a hot first turn, many conversations all alike, and nested prefixes
        if c % 3 == 0:
            rows += [(c, 0, "user", "hello"), (c, 1, "assistant", "hi"), (c, 2, "user", "bye")]
        elif c % 3 == 1:
            rows += [(c, k, "user", "hello" if k == 0 else f"step {k}") for k in range(c % 11)]
        else:
            rows += [(c, k, rng.choice(["user", "assistant"]), rng.choice("ab")) for k in range(rng.randrange(1, 12))]
    rows += [(c, 5, "user", "later than all turns before it") for c in (201, 202, 203)]  # leads that don't exist
    return rows


def test_trie_of_odd_turns(spark):
    rows = odd_turns()
    rng = random.Random(1)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).withColumn("node", F.lit("clash")).withColumn("family", F.lit(1)).withColumn("depth", F.lit(None))
    wanted = plain(rows)
    got = conversation_trie.digest(*conversation_trie.trie(df.repartition(7)))
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == wanted
    small, conversation_trie.MOST_NODES, conversation_trie.PIECE = (conversation_trie.MOST_NODES, conversation_trie.PIECE), 20, 3
    try:  # tasks that emit many tables each, lists of ends in many pieces
        run = conversation_trie.walker(9)
        import pyarrow as pa

        order = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0] - (r[0] % 5 if r[0] >= 0 else -(-r[0] % 5)), r[0] % 5 != 0, r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        lead = lambda c: c - (c % 5 if c >= 0 else -(-c % 5))
        batch = pa.RecordBatch.from_arrays([pa.array([lead(r[0]) for r in order]), pa.array([r[0] for r in order]), pa.array([r[2] for r in order], pa.string()), pa.array([r[3] for r in order], pa.string())], names=["f", "c", "r", "t"])
        tables = list(run([batch.slice(0, 100), batch.slice(100)]))
        assert len(tables) > 10
        partial = spark.createDataFrame(pa.Table.from_batches(tables).to_pandas(), conversation_trie.PARTIAL)
        nodes = {(r.conv_id, r.depth): r.n_convs for r in conversation_trie.merged(partial).collect()}
        assert nodes == {(w[0], w[1]): w[3] for w in wanted}
        pieces = conversation_trie.end_pieces(partial)
        assert {r.ends_sha256 for r in conversation_trie.end_digests(pieces).collect()} == {w[-1] for w in wanted} - {hashlib.sha256(b"").hexdigest()}
    finally:
        conversation_trie.MOST_NODES, conversation_trie.PIECE = small
    assert conversation_trie.digest(*conversation_trie.trie(df.limit(0))).count() == 0
    plain_trie = conversation_trie.trie(spark.createDataFrame([(1, 0, "u", "a"), (2, 0, "u", "a"), (2, 1, "u", "b")], TURNS), family=1)[0]
    assert {(r.conv_id, r.depth, r.n_convs) for r in plain_trie.collect()} == {(1, 0, 2), (1, 1, 2), (2, 2, 1)}


def test_trie_against_sql(spark, sf_dir):
    same(queries.op12_conversation_trie(spark, sf_dir), queries.SQL["op12_conversation_trie"], sf_dir)
