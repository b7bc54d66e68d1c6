"""Message archives, the two-phase sink, the hand-off, the footer and entities, beyond what the queries' SQL covers."""

import html
import random
import time
from html.entities import html5
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from broadleaf.functions import text as X
from broadleaf.sources import messages, sink
from broadleaf.streaming import handoff

BODIES = ["", "plain\n", "From 7 2024-01-01T00:00:00\n>From here\n\nFrom\n", "\r\nlines\rend\r\n\n", "é\u2028日本\x00", "From 8", "x" * 300_000, "\n\n\n", ">>From", "a\nFrom 9 x\n" * 2000, None]


@pytest.fixture
def mailbox(spark, tmp_path):
    rows = [(k, f"2024-01-{k + 1:02d}T0{k % 10}:00:00", "Dán <d@x.example>", "one\ntwo" if k == 2 else f"s{k}", f"<{k}@x>", b) for k, b in enumerate(BODIES)]
    root = f"file://{tmp_path}/mail"
    written = messages.write(spark.createDataFrame(rows, messages.NUMBERED), root, 3).collect()
    assert sum(r.messages for r in written) == len(rows) and len(written) > 1
    wanted = [(*r[:3], " ".join(r[3].split()), r[4], r[5] or "") for r in rows]
    return root, wanted


@pytest.mark.parametrize("size", [7, 100, 65_536, 1 << 30])
def test_archives_in_ranges_of_any_size(spark, mailbox, size):
    root, wanted = mailbox
    if size < 100:  # each range is read once, whole or not at all
        found = messages.archives(root)
        small = min(found, key=lambda a: a.size)
        some = [m for r in messages.ranges([small], size, messages.ANY_NUMBER, messages.ANY_TIME) for m in messages.messages(root, r)]
        assert [int(m[0]) for m in some] == [w[0] for w in wanted if small.first <= w[0] <= small.last]
        return
    assert sorted(tuple(r) for r in messages.read(spark, root, size).collect()) == wanted


def test_filters_prune_archives(spark, mailbox):
    root, wanted = mailbox
    got = messages.read(spark, root).where("sent >= '2024-01-03' AND sent < '2024-01-05' AND number <> 2")
    assert [r.number for r in got.collect()] == [3]
    reader = messages.Reader({"path": root})
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    whole = len(reader.partitions())
    assert len(list(reader.pushFilters([GreaterThanOrEqual(("sent",), "2024-01-10"), LessThan(("number",), 100)]))) == 2
    assert 0 < len(reader.partitions()) < whole
    list(reader.pushFilters([EqualTo(("number",), 10_000)]))
    assert [p.path for p in reader.partitions()] == [""]
    assert messages.read(spark, root).where("number = 10000").count() == 0
    assert messages.read(spark, root + "-none").count() == 0


def objects(spark, n, **more):
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    rows = spark.range(n).select(F.concat(F.lit("object "), F.col("id").cast("string")).alias("t"))
    return rows.select(X.object_key(F.lit("2024-01-02"), F.concat(F.lit("sha256:"), sha(F.col("t")))).alias("key"), F.col("t").cast("binary").alias("content"))


def files(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*") if p.is_file() and "_jobs" not in p.parts)


def test_a_failing_task_leaves_no_object(spark, tmp_path):
    root, rows = f"file://{tmp_path}/store", objects(spark, 40).repartition(4)
    for broken in (rows.unionByName(rows.limit(1).withColumn("key", F.lit("no key"))), rows.unionByName(rows.limit(1).withColumn("content", F.lit(None).cast("binary")))):
        with pytest.raises(Exception):
            sink.put(broken, root, f"file://{tmp_path}/result")
        assert files(f"{tmp_path}/store") == []
    done = sink.put(rows.unionByName(rows), root, f"file://{tmp_path}/result")
    assert done.count() == 40 and done.where("written").count() == 40
    assert files(f"{tmp_path}/store") == sorted(r.key for r in done.collect())
    again = sink.put(rows, root, f"file://{tmp_path}/again")
    assert again.where("written").count() == 0 and again.select("key", "sha256", "size").exceptAll(done.select("key", "sha256", "size")).isEmpty()
    with pytest.raises(Exception, match="other bytes"):
        sink.put(rows.limit(1).withColumn("content", F.lit(b"else")), root, f"file://{tmp_path}/other")
    assert len(files(f"{tmp_path}/store")) == 40


def test_a_committed_job_is_published_later(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    sink.staged(objects(spark, 5), root)
    assert all(f.startswith("_staged") for f in files(f"{tmp_path}/store"))
    assert sink.published(spark, root).where("written").count() == 5
    assert sink.published(spark, root).where("written").count() == 0


def test_a_task_writes_its_manifest_in_parts(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    monkeypatch.setattr(sink, "MANIFEST_ROWS", 4, raising=False)
    rows = [(f"k{k}", b"object %d" % k) for k in range(10)]
    batches = (pa.RecordBatch.from_pydict({"key": [k], "content": [c]}, schema=pa.schema([("key", pa.string()), ("content", pa.binary())])) for k, c in rows)
    done = sink.Writer({"path": f"file://{tmp_path}"}).write(batches)
    found = pq.ParquetFile(done.manifest)
    assert found.num_row_groups == 3 and found.read()["key"].to_pylist() == [k for k, _ in rows] and done.objects == 10


def test_notices_in_any_order_end_once():
    hour = handoff.HOUR_MS
    notices = [("noted", "s", "n", 0), ("source", "s", None, 2 * hour), ("normalized", None, "n", hour), ("gone", None, None, 9 * hour)]
    for order in [random.Random(k).sample(notices * 2, 8) for k in range(200)]:
        entry = None
        for n in order:
            entry = handoff.merged(entry, *n)
        assert handoff.due(dict(entry), -1) == ([], 2 * hour)
        steps, later = handoff.due(entry, 1 << 60)
        assert later is None and steps == [("acknowledge", 1, 2 * hour), ("retry", 2, 8 * hour), ("acknowledged", 2, 9 * hour)]
    alone = handoff.merged(None, "source", "s", None, 5)
    assert handoff.due(alone, 1 << 60) == ([], None)
    wrong = handoff.merged(handoff.merged(None, "noted", "s", "n", 1), "source", "x", None, 2)
    assert handoff.due(wrong, 1 << 60) == ([("unverified", 0, 1 + handoff.KEEP_MS)], None)
    never = [handoff.merged(None, *notices[0])]
    for n in notices[1:3]:
        never.append(handoff.merged(never[-1], *n))
    assert [s[0] for s in handoff.due(never[-1], 1 << 60)[0]] == ["acknowledge", "retry", "retry", "failed"]


def test_a_large_mailbox_is_many_buckets(spark, tmp_path):
    from broadleaf.plans import flows

    ids = spark.range(300).select(F.col("id").alias("event_id"), F.lit(7).cast("long").alias("user_id"), (F.timestamp_seconds(F.lit(1_700_000_000)) + F.make_dt_interval(F.lit(0), (F.col("id") % 90).cast("int"))).alias("ts"))
    rows = flows.notices(ids).withColumn("mailbox", F.when(F.col("key") != "1", F.col("mailbox"))).withColumn("key", F.when(F.col("key") == "2", "2|x").otherwise(F.col("key")))
    spread = rows.select(handoff.bucket_of(F.col("mailbox"), F.col("key"), handoff.LEAST_BUCKETS)).distinct().count()
    assert spread > handoff.LEAST_BUCKETS // 2
    got = flows.handed_off(spark, rows, f"file://{tmp_path}", 2).collect()
    ends = [(r.mailbox, r.key) for r in got if r.action in ("acknowledged", "failed", "unverified")]
    assert len(ends) == len(set(ends)) == 300 and (None, "1") in ends and (7, "2|x") in ends


def test_footer_in_linear_time(spark):
    blank = ["a" + "\n" * 100_000 + "b", "a" + " " * 100_000 + "b", "a" + " \n" * 50_000 + "Thanks for reading", "\u2028" * 100_000 + "x\u2028JOB BOARD \u2028y", "a\r\n\r\n  thanks for reading,\r\nb", "a\x85Share TLDR\x85", "unsubscribe\nsee [1] to unsubscribe\nc"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(blank)], "k int, t string").repartition(1)
    df.select(X.without_footer(F.col("t"))).collect()
    began = time.perf_counter()
    got = [r[1] for r in df.select("k", X.without_footer(F.col("t"))).orderBy("k").collect()]
    assert time.perf_counter() - began < 5
    assert got == [blank[0], blank[1], "a\n", "\n" * 100_000 + "x\n", "a\n", "a\n", "unsubscribe\n"]


def test_entities_as_a_browser_has_them(spark):
    rng, names = random.Random(1), list(html5)
    odd = ["notit", "notin", "ampamp", "lt", "ltx;", "AMPersand;", "a b", "#", "#x", "#;", "", "copy2", "frac12x", "zzz;"]

    def piece():
        return rng.choice([
            "&" + rng.choice(names), "&" + rng.choice(odd), "&#%d;" % rng.choice([0, 1, 9, 13, 38, 128, 150, 159, 160, 8217, 55296, 65534, 65535, 0x1F600, 1114112, 10**12, 64976]),
            "&#x%x" % rng.choice([0, 0x80, 0x26, 0x2019, 0x1F600, 0x110000]) + rng.choice([";", "", " ", "z"]), rng.choice(["a", "é", "<", "; ", "&", "\n", "日", "x1"]),
        ])

    texts = ["".join(piece() for _ in range(rng.randrange(1, 12))) for _ in range(1500)] + ["", "&", "&&amp;amp;", "&amp;lt;"]
    got = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", X.unescape_all(F.col("t")).alias("one"), X.decode_entities(F.col("t")).alias("two")).orderBy("k").collect()
    assert [r.one for r in got] == [html.unescape(t) for t in texts]
    assert [r.two for r in got] == [html.unescape(html.unescape(t)) for t in texts]
