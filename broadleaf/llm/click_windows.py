"""Expiring click deduplication: row-based transformWithState over hashed buckets.

Each click_id has at most one open window at a time.  A copy whose hour is at most
REPEAT_HOURS after the window's start is a repeat; a later one closes the window and
opens another.  A window whose last hour (its deadline) lies more than LATE_HOURS
before the largest hour seen closes too, and copies that late are dropped.

State.  Click ids are hashed to buckets, the grouping key.  A bucket keeps a MapState
click_id -> window and, as its timing wheel, a MapState deadline hour -> ids.  One
timer a bucket stands at the earliest slot of the wheel; when the watermark passes it,
all expired slots are drained and the timer moves to the next slot.  An id whose window
was replaced meanwhile is skipped when its old slot is drained.

A state call from Python costs some 0.2 ms, so a bucket's copies come packed: the
query's scan tasks sort their rows, count equal ones once and send a bucket its rows
in chunks.  A bucket goes over its chunks twice: first for the least hash of each
(click_id, hour), from which the windows follow, then for the counts of each window.
Chunks beyond SPOOL_BYTES wait in a temporary file of the task, so that memory follows
the ids and hours of a bucket and not its rows.  `horizon`, where the feed knows its
batch's largest hour, lets windows that the batch itself expires close at once instead
of going through the state; the bucket's expired slots are drained in the same call.
The feed then sends every bucket a bell, an event without a copy, so that those without
copies drain theirs too and a start is one micro-batch.  Without a horizon all goes by
timers, in a second micro-batch; the results are the same.

A micro-batch opens every state store anew, and Spark never frees the statistics of a
store that it closes, native memory that no setting bounds.  So there are no more
micro-batches than starts, and the rest of an executor's memory is kept low: all Python
of a start runs in one pool of workers, the result is read without Python, and the
copies are cut by writers with small row groups and no dictionary of unlike values.

Defined results: rows with a null click_id or arrived_at, or with click_id % 3 < 0, have no
copies; other nulls are empty in the hash; times without a zone are UTC, hours are from
1970 on; an infinite value is the largest or least long and NaN is 0, as Spark's floor
has them; repeated rows are repeats of one window, in the order of their hash; an empty
table has no windows; columns not named here are not read.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .common import delete, new_dir, remembers

REPEAT_HOURS, LATE_HOURS = 24, 96
BATCHES = 8
#: Copies of a bucket, over all batches; there are LEAST_BUCKETS at least.
BUCKET_COPIES, LEAST_BUCKETS = 500_000, 24
#: Rows that a scan task sorts at once, and windows of one packed row of the result.
PACK_ROWS, OUT_ROWS = 32_768, 25_000
SPOOL_BYTES = 8 << 20
#: Copies of a batch that a writing task holds; it writes to all batches at once.
BLOCK_BYTES = 4 << 20

HOUR_MS = 3_600_000
NEVER = 1 << 40
HASH = [("h0", "<u8"), ("h1", "<u8"), ("h2", "<u8"), ("h3", "<u8")]
#: n equal copies: click_id, hour, CRC of the hash, the hash as four numbers in the order of its digits.
COPY = np.dtype([("id", "<i8"), ("hour", "<i8"), ("crc", "<u4"), ("n", "<i8"), *HASH])
WINDOW = np.dtype([("id", "<i8"), ("start", "<i8"), ("closed", "<i8"), ("repeats", "<i8"), ("conflicts", "<i8"), ("crc", "<i8"), *HASH])
NAMES = [name for name, _ in HASH]
FED = "bucket int, click_id long, hour long, crc long, hash binary"
CLOSED = "click_id long, start_hour long, closed_batch long, n_repeats long, n_conflicts long, conflict_crc long, hash binary"
RESULT = CLOSED.replace("binary", "string")
#: For columns of nearly distinct values a dictionary only costs a writer's memory.
UNLIKE = {f"parquet.enable.dictionary#{c}": "false" for c in ("click_id", "crc", "conflict_crc", "hash")}


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a time column; one without a zone is taken as UTC whatever the session's zone is."""
    at = F.col(name)
    if df.schema[name].dataType.typeName() == "timestamp_ntz":
        at = F.from_utc_timestamp(at.cast("timestamp"), F.current_timezone())
    return F.unix_micros(at)


def copies(clicks: DataFrame, light: bool = False) -> DataFrame:
    """click_id, hour, lateness l, and hash and its crc (unless light) of the copies of all rows."""
    j = F.explode(F.expr("CASE WHEN click_id % 3 >= 0 THEN sequence(0, CAST(click_id % 3 AS INT)) END"))
    c = F.crc32(F.concat_ws(":", F.col("click_id").cast("string"), F.col("j").cast("string")).cast("binary"))
    rows = clicks.where("click_id IS NOT NULL AND arrived_at IS NOT NULL")
    hour = F.floor(micros(clicks, "arrived_at") / F.lit(3_600_000_000)).cast("long")
    if light:
        rows = rows.select("click_id", hour.alias("h"), j.alias("j"))
    else:
        empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))
        amount = F.floor(F.lit(100.0) * F.col("value") + F.lit(0.5)).cast("long")
        head = F.concat_ws("|", empty(F.col("client_id")), empty(F.col("kind")), empty(amount), empty(micros(clicks, "ts")), empty(F.col("props")))
        rows = rows.select("click_id", hour.alias("h"), head.alias("head"), j.alias("j"))
    rows = rows.withColumn("c", c).withColumn("hour", F.col("h") + 6 * F.col("j") * (F.col("c") % 10))
    late = (F.col("hour") + F.floor(F.col("c") / 10).cast("long") % 200).alias("l")
    if light:
        return rows.select("click_id", "hour", late)
    hashed = F.sha2(F.concat_ws("|", "head", (F.col("c") % 3).cast("string")).cast("binary"), 256)
    return rows.select("click_id", "hour", late, hashed.alias("hex")).select("click_id", "hour", "l", F.crc32(F.col("hex").cast("binary")).alias("crc"), F.unhex("hex").alias("hash"))


def bucket_of(click_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(click_id), F.lit(buckets)).cast("int")


def reduced(rows: np.ndarray) -> np.ndarray:
    """Rows in order of id, hour and hash, equal ones counted together."""
    rows = rows[np.lexsort([rows[k] for k in ("h3", "h2", "h1", "h0", "hour", "id")])]
    new = np.ones(len(rows), bool)
    new[1:] = np.any([rows[k][1:] != rows[k][:-1] for k in ("id", "hour", *NAMES)], axis=0)
    at = np.flatnonzero(new)
    out = rows[at]
    out["n"] = np.add.reduceat(rows["n"], at) if len(at) else 0
    return out


def first_hashes(rows: np.ndarray) -> np.ndarray:
    """The row with the least hash of each id and hour, from rows in any order."""
    rows = rows[np.lexsort([rows[k] for k in ("h3", "h2", "h1", "h0", "hour", "id")])]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["id"][1:] != rows["id"][:-1]) | (rows["hour"][1:] != rows["hour"][:-1])
    return rows[new]


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (FED) to chunks: bucket, event (a time: the chunk's largest hour) and the COPY rows as bytes."""
    remembers("clicks", None)

    def chunks(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        column = lambda k: t.column(k).combine_chunks()
        bells = pc.is_null(column("click_id")).to_numpy(zero_copy_only=False)
        rows = np.zeros(t.num_rows, COPY)
        rows["id"], rows["hour"], rows["crc"], rows["n"] = (x if isinstance(x, int) else pc.fill_null(x, 0).to_numpy(zero_copy_only=False) for x in (column("click_id"), column("hour"), column("crc"), 1))
        digits = np.frombuffer(b"".join(pc.fill_null(column("hash"), b"\0" * 32).to_pylist()), ">u8").reshape(-1, 4)
        for k, name in enumerate(NAMES):
            rows[name] = digits[:, k]
        bucket, keys, events, bodies = column("bucket").to_numpy(), [], [], []
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))
        for at in np.split(order, cuts[1:]):
            keys.append(int(bucket[at[0]]))
            events.append(int(rows["hour"][at].max()) * HOUR_MS * 1000)
            bodies.append(reduced(rows[at[~bells[at]]]).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(events, pa.timestamp("us", tz="UTC")), pa.array(bodies, pa.binary())], names=["bucket", "event", "body"])

    parts, n = [], 0
    for batch in batches:
        parts.append(batch)
        n += batch.num_rows
        if n >= PACK_ROWS:
            yield chunks(parts)
            parts, n = [], 0
    if n:
        yield chunks(parts)


def _unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed windows to rows (CLOSED)."""
    for batch in batches:
        for body in batch.column("windows"):
            w = np.frombuffer(body.as_py(), WINDOW)
            digits = np.stack([w[k] for k in NAMES], axis=1).astype(">u8").tobytes()
            hashes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(w), [None, pa.py_buffer(digits)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*(pa.array(w[k]) for k in ("id", "start", "closed", "repeats", "conflicts", "crc")), hashes], names=[x.split()[0] for x in CLOSED.split(", ")])


class Windows(StatefulProcessor):
    """A bucket of click ids. batch: the number that windows closed by this start of the query get; horizon: hour that the largest deadline of closing windows lies below, if known."""

    def __init__(self, batch: int, horizon: int | None = None):
        self.batch, self.horizon = batch, horizon

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("windows", "click_id long", "window binary")
        self.wheel = handle.getMapState("wheel", "deadline long", "ids binary")

    def close(self) -> None:
        pass

    def packed(self, done: list[np.ndarray]) -> Iterator[Row]:
        closed = np.concatenate(done) if done else np.zeros(0, WINDOW)
        for k in range(0, len(closed), OUT_ROWS):
            yield Row(windows=closed[k : k + OUT_ROWS].tobytes())

    def known(self) -> np.ndarray:
        """The bucket's open windows in order of id."""
        found = np.frombuffer(b"".join(value[0] for _, value in self.open.iterator()), WINDOW)
        return found[np.argsort(found["id"])]

    def set_timer(self, slots: list[int]) -> None:
        """One timer, at the earliest of the wheel's slots."""
        wanted = min(slots) * HOUR_MS if slots else None
        for at in [t[0] if isinstance(t, tuple) else t for t in self.handle.listTimers()]:
            if at == wanted:
                wanted = None
            else:
                self.handle.deleteTimer(at)
        if wanted is not None:
            self.handle.registerTimer(wanted)

    def drained(self, slots: list[int], known: np.ndarray) -> np.ndarray:
        """Takes slots off the wheel; which of the known windows, in order of id, expire with them."""
        out = np.zeros(len(known), bool)
        for slot in slots:
            ids = np.frombuffer(self.wheel.getValue((slot,))[0], "<i8")
            self.wheel.removeKey((slot,))
            at = np.searchsorted(known["id"], ids)
            inside = at < len(known)
            at, ids = at[inside], ids[inside]
            at = at[(known["id"][at] == ids) & (known["start"][at] + REPEAT_HOURS == slot)]
            out[at] = True
        return out

    def put(self, windows: np.ndarray) -> None:
        """Open windows into the state and onto the wheel."""
        for w in windows:
            self.open.updateValue((int(w["id"]),), (w.tobytes(),))
        deadline = windows["start"] + REPEAT_HOURS
        for slot in np.unique(deadline).tolist():
            held = self.wheel.getValue((slot,))
            self.wheel.updateValue((slot,), ((held[0] if held else b"") + windows["id"][deadline == slot].tobytes(),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        late = -(-passed // HOUR_MS) if passed > 0 else -NEVER
        with tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES) as spool:
            sizes, firsts, held = [], [np.zeros(0, COPY)], 0
            for row in rows:
                chunk = np.frombuffer(row.body, COPY)
                chunk = chunk[chunk["hour"] >= late]
                spool.write(chunk.tobytes())
                sizes.append(len(chunk))
                firsts.append(first_hashes(chunk))
                held += len(firsts[-1])
                if held > max(PACK_ROWS, 2 * len(firsts[0])):
                    firsts = [first_hashes(np.concatenate(firsts))]
                    held = 0
            known = self.known()
            w, fresh = opened(first_hashes(np.concatenate(firsts)), known)
            spool.seek(0)
            for n in sizes:
                counted(w, np.frombuffer(spool.read(n * COPY.itemsize), COPY))
        w["repeats"][fresh] -= 1  # the opener itself
        last = np.append(w["id"][1:] != w["id"][:-1], True)[: len(w)]
        ends = ~last
        slots = [k[0] for k in self.wheel.keys()]
        if self.horizon is not None:
            ends |= w["start"] + REPEAT_HOURS < self.horizon
            expired = [s for s in slots if s < self.horizon]
            slots = [s for s in slots if s >= self.horizon]
            self.drained(expired, known)  # known windows are in w, too
        # what was open and is no longer, what is open and new or changed
        kept, carried = w[~ends], w[ends & ~fresh]
        changed = fresh | np.isin(w["id"], touched(w, known))
        if len(kept) == 0 or (ends[~fresh].all() and len(carried)):
            self.open.clear()
        else:
            for i in np.setdiff1d(carried["id"], kept["id"]).tolist():
                self.open.removeKey((i,))
        self.put(w[~ends & changed])
        self.set_timer([*slots, *np.unique(w["start"][~ends & changed] + REPEAT_HOURS).tolist()])
        done = w[ends].copy()
        done["closed"] = self.batch
        yield from self.packed([done])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        slots = [k[0] for k in self.wheel.keys()]
        expired = [s for s in slots if s * HOUR_MS < passed]
        known = self.known()
        ends = self.drained(expired, known)
        if ends.all():
            self.open.clear()
        else:
            for i in known["id"][ends].tolist():
                self.open.removeKey((i,))
        if left := [s for s in slots if s * HOUR_MS >= passed]:
            self.handle.registerTimer(min(left) * HOUR_MS)
        done = known[ends].copy()
        done["closed"] = self.batch
        yield from self.packed([done])


def touched(w: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Ids of known windows whose counts differ in w."""
    at = np.searchsorted(w["id"], known["id"])  # a known window is the first of its id
    return known["id"][w["repeats"][at] != known["repeats"]]


def opened(first: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows in order of id and start, the known ones and those that the least hashes of each id and hour open; which are new."""
    new = []
    # each id's place in first, and the hour that its open window reaches
    at = np.flatnonzero(np.append(True, first["id"][1:] != first["id"][:-1])) if len(first) else np.zeros(0, int)
    ends = np.append(at[1:], len(first))
    reach = np.full(len(at), -NEVER)
    if len(known) and len(at):
        k = np.minimum(np.searchsorted(known["id"], first["id"][at]), len(known) - 1)
        own = known["id"][k] == first["id"][at]
        reach[own] = known["start"][k[own]] + REPEAT_HOURS
    rank = np.repeat(np.arange(len(at)), ends - at)
    keys = rank * (2 * NEVER) + first["hour"]
    ranks = np.arange(len(at))
    while len(at):
        nxt = np.searchsorted(keys, ranks * (2 * NEVER) + reach, side="right")
        more = nxt < ends
        nxt, ends, ranks = nxt[more], ends[more], ranks[more]
        if not len(nxt):
            break
        new.append(first[nxt])
        reach, at = first["hour"][nxt] + REPEAT_HOURS, nxt
    rows = np.concatenate(new) if new else np.zeros(0, COPY)
    w = np.zeros(len(known) + len(rows), WINDOW)
    w[: len(known)] = known
    w["id"][len(known) :], w["start"][len(known) :] = rows["id"], rows["hour"]
    for k in NAMES:
        w[k][len(known) :] = rows[k]
    fresh = np.arange(len(w)) >= len(known)
    # a known window stands before the new ones of its id even if it starts later
    order = np.lexsort([w["start"], fresh, w["id"]])
    return w[order], fresh[order]


def counted(w: np.ndarray, rows: np.ndarray) -> None:
    """Adds rows to the windows that they fall in."""
    if not len(rows):
        return
    low = np.searchsorted(w["id"], rows["id"], side="left")
    high = np.searchsorted(w["id"], rows["id"], side="right")
    at = low.copy()
    for k in range(1, int((high - low).max())):  # the last window of the id that starts at the row's hour or before, else the first
        later = np.minimum(low + k, len(w) - 1)
        fits = (low + k < high) & (w["start"][later] <= rows["hour"])
        at[fits] = later[fits]
    other = np.any([w[k][at] != rows[k] for k in NAMES], axis=0)
    np.add.at(w["repeats"], at, rows["n"])
    np.add.at(w["conflicts"], at[other], rows["n"][other])
    np.add.at(w["crc"], at[other], rows["n"][other] * rows["crc"][other].astype(np.int64))


def stream(spark: SparkSession, fed: str, batch: int, horizon: int | None = None) -> DataFrame:
    """Closed windows, packed, of the rows (FED) in the folders of fed, as one start of the streaming query."""
    rows = spark.readStream.schema(FED).parquet(fed)
    chunks = rows.mapInArrow(_pack, "bucket int, event timestamp, body binary").withWatermark("event", f"{LATE_HOURS} hours 1 second")
    return chunks.groupBy("bucket").transformWithState(Windows(batch, horizon), "windows binary", "Append", "EventTime")


#: Settings of the streaming query, put back when its starts are over. Stores are closed after each batch: every start opens its own, each with
#: some 4 MB of an executor's disk; the open ones share one cache. Batches are written side by side, without a sort of the copies before.
#: Spark gives stateful workers no simplified tracebacks; asking for none elsewhere lets all stages share a pool of workers.
SETTINGS = {
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled": "false",
    "spark.sql.maxConcurrentOutputFileWriters": str(BATCHES),
}


def bells(spark: SparkSession, buckets: int, hour: int) -> DataFrame:
    """A row (FED) without a copy for each bucket, with an event at this hour."""
    return spark.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("bucket"), *(F.lit(v).cast(k).alias(name) for name, k, v in (("click_id", "long", None), ("hour", "long", hour), ("crc", "long", None), ("hash", "binary", None))))


def deduplicate(clicks: DataFrame, announce: bool = True) -> DataFrame:
    """The windows of all copies of clicks, fed in BATCHES batches of lateness. announce: give each start its batch's horizon, and all buckets a bell."""
    spark = clicks.sparkSession
    root = new_dir(spark, "clicks")
    n, low, high = copies(clicks, light=True).agg(F.count("*"), F.min("l"), F.max("l")).first()
    if not n:
        return spark.createDataFrame([], RESULT)
    buckets = max(LEAST_BUCKETS, -(-n // BUCKET_COPIES))
    batch = F.floor((F.col("l") - F.lit(low)) * BATCHES / F.lit(high - low + 1)).cast("int")
    rows = copies(clicks).select(bucket_of(F.col("click_id"), buckets).alias("bucket"), "click_id", "hour", "crc", "hash", batch.alias("b"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{root}/fed"))
    settings = SETTINGS | {"spark.sql.streaming.noDataMicroBatches.enabled": str(not announce).lower()}
    before = {k: spark.conf.get(k, None) for k in settings}
    seen = -NEVER
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows.write.options(**UNLIKE).option("compression", "zstd").option("parquet.block.size", BLOCK_BYTES).partitionBy("b").parquet(f"{root}/cut")
        most = {r.b: r.m for r in spark.read.parquet(f"{root}/cut").groupBy("b").agg(F.max("hour").alias("m")).collect()}
        for b in range(BATCHES):
            if b in most:
                files.rename(path(f"{root}/cut/b={b}"), path(f"{root}/fed/{b}"))
            seen = max(seen, most.get(b, seen))
            if announce:
                bells(spark, buckets, seen).write.parquet(f"{root}/fed/bells-{b}")
            elif b == BATCHES - 1:  # past every deadline: its event moves the watermark on after the last batch, so that all timers fire
                bells(spark, 1, seen + 10 * (LATE_HOURS + REPEAT_HOURS)).write.parquet(f"{root}/fed/bell")
            horizon = (NEVER if b == BATCHES - 1 else seen - LATE_HOURS) if announce else None
            closed = stream(spark, f"{root}/fed/*", b, horizon)

            def keep(df: DataFrame, epoch: int, b: int = b) -> None:
                # in two steps: a worker that unpacks beside each stateful task would cost its memory
                df.write.mode("overwrite").parquet(f"{root}/packed/{b}-{epoch}")
                packed = df.sparkSession.read.schema("windows binary").parquet(f"{root}/packed/{b}-{epoch}")
                packed.mapInArrow(_unpack, CLOSED).write.options(**UNLIKE).mode("overwrite").parquet(f"{root}/closed/{b}-{epoch}")
                delete(spark, f"{root}/packed/{b}-{epoch}")

            query = closed.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
            query.awaitTermination()
        delete(spark, f"{root}/cut", f"{root}/fed", f"{root}/packed", f"{root}/state")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(CLOSED).parquet(f"{root}/closed/*").withColumn("hash", F.lower(F.hex("hash")))
