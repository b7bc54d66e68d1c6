"""J11 as a stream: a message is let go exactly once, after what was made of it is known to be safe.

Notices of a message come in any order and any number of times:

    noted    the digests that its source and its normalized form must have
    source, normalized    a file found, with its digest
    gone     the message is no longer in its mailbox

By event time each message goes through pending (noted), verified (both files found with the
digests noted: `acknowledge` is asked for), and acknowledged (gone) or asked for again every
RETRY_MS (`retry`) until MOST attempts are over (`failed`).  What isn't verified KEEP_MS after its first
notice ends as `unverified`.

Messages are hashed to buckets, the keys of a transformWithState operator, so that a large
mailbox is no task of its own: a bucket's state holds its messages under way, read and
written once a batch, and one event-time timer stands at the earliest step due.  Rows come
as Arrow batches and only add to the state; steps are taken when the watermark has passed
their time, so that notices out of order within the watermark's delay change nothing.  A
notice that comes again is either merged into the message under way or, once the message
has ended, older than the watermark and dropped: one end a message.  State follows the
messages under way.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

HOUR_MS = 3_600_000
RETRY_MS, KEEP_MS, MOST = 6 * HOUR_MS, 72 * HOUR_MS, 3
#: A watermark before all times: no step is taken.
NEVER_PASSED = -(1 << 62)
NOTICE = "mailbox long, key string, kind string, source_sha256 string, normalized_sha256 string, at timestamp"
STEPS = "mailbox long, key string, action string, attempt int, at timestamp"
TAKEN = {"name": "string", "action": "string", "attempt": "int", "at_ms": "long"}
#: Notices of a bucket, over all batches; there are LEAST_BUCKETS at least.
BUCKET_NOTICES, LEAST_BUCKETS = 100_000, 48


def merged(entry: dict | None, kind: str, source: str | None, normalized: str | None, at: int) -> dict:
    """A message under way after one notice more; in any order, the same."""
    entry = entry or {"since": at, "want": None, "noted": at, "source": {}, "normalized": {}, "gone": None, "attempt": 0}
    entry["since"] = min(entry["since"], at)
    if kind == "noted":
        entry["noted"] = min(entry["noted"], at) if entry["want"] else at
        entry["want"] = [source, normalized]
    elif kind in ("source", "normalized"):
        digest, found = (source if kind == "source" else normalized) or "", entry[kind]
        found[digest] = min(at, found.get(digest, at))
    elif kind == "gone":
        entry["gone"] = at if entry["gone"] is None else min(at, entry["gone"])
    return entry


def due(entry: dict, upto: int) -> tuple[list[tuple[str, int, int]], int | None]:
    """Steps (action, attempt, time) of a message that lie before `upto`, and when the next one is, None if it has ended."""
    steps: list[tuple[str, int, int]] = []
    want = entry["want"]
    if not want or want[0] not in entry["source"] or want[1] not in entry["normalized"]:
        end = entry["since"] + KEEP_MS
        return ([("unverified", 0, end)] if want else [], None) if end < upto else ([], end)
    verified = max(entry["noted"], entry["source"][want[0]], entry["normalized"][want[1]])
    while True:
        n = entry["attempt"]
        asked_again = verified + n * RETRY_MS
        gone = None if entry["gone"] is None else max(entry["gone"], verified)
        ends = n > 0 and gone is not None and gone <= asked_again
        at = gone if ends else asked_again
        if at >= upto:
            return steps, at
        if ends or n == MOST:
            return [*steps, ("acknowledged" if ends else "failed", n, at)], None
        entry["attempt"] = n + 1
        steps.append(("acknowledge" if n == 0 else "retry", n + 1, at))


class Messages(StatefulProcessor):
    """A bucket of messages."""

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("under_way", "messages string")

    def close(self) -> None:
        pass

    def load(self) -> tuple[int | None, dict]:
        """The time of the bucket's timer, and its messages."""
        held = self.state.get()
        return json.loads(held[0]) if held else (None, {})

    def keep(self, timer: int | None, under_way: dict) -> None:
        """The state, and one timer just after the earliest step due: Spark takes a timer at the watermark itself as expired, a step waits until its time has passed. timer: the one that stands."""
        wanted = min((due(e, NEVER_PASSED)[1] + 1 for e in under_way.values()), default=None)
        if timer != wanted:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        self.state.update((json.dumps([wanted, under_way]),)) if under_way else self.state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (timer, under_way), passed = self.load(), timerValues.getCurrentWatermarkInMs()
        for part in rows:
            columns = [part[c].astype(object).tolist() for c in ("name", "kind", "source_sha256", "normalized_sha256", "at_ms")]
            for name, kind, source, normalized, at in zip(*columns, strict=True):
                if isinstance(name, str) and at >= passed:  # a null is None or NaN, by the version of pandas
                    under_way[name] = merged(under_way.get(name), kind, source if isinstance(source, str) else None, normalized if isinstance(normalized, str) else None, at)
        self.keep(timer, under_way)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (_, under_way), passed = self.load(), timerValues.getCurrentWatermarkInMs()
        taken = []
        for name in list(under_way):
            done, later = due(under_way[name], passed)
            if later is None:
                del under_way[name]
            taken += [(name, *step) for step in done]
        self.keep(None, under_way)  # the timer that has expired is deleted by Spark
        if taken:
            yield pd.DataFrame(taken, columns=list(TAKEN))


def bucket_of(mailbox: Column, key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(mailbox, key), F.lit(buckets)).cast("int")


def steps(notices: DataFrame, delay: str, buckets: int = LEAST_BUCKETS) -> DataFrame:
    """STEPS of a stream of NOTICE rows; times are kept in milliseconds. A query has the same buckets at each of its starts."""
    name = F.concat(F.coalesce(F.col("mailbox").cast("string"), F.lit("")), F.lit("|"), "key")
    rows = notices.select(bucket_of(F.col("mailbox"), F.col("key"), buckets).alias("bucket"), name.alias("name"), "kind", "source_sha256", "normalized_sha256", "at", F.unix_millis("at").alias("at_ms"))
    taken = rows.withWatermark("at", delay).groupBy("bucket").transformWithStateInPandas(Messages(), ", ".join(f"{k} {v}" for k, v in TAKEN.items()), "Append", "EventTime")
    bar = F.instr("name", "|")
    mailbox = F.expr("try_cast(substr(name, 1, instr(name, '|') - 1) AS long)")
    return taken.select(mailbox.alias("mailbox"), F.col("name").substr(bar + 1, F.length("name")).alias("key"), "action", "attempt", F.timestamp_millis("at_ms").alias("at"))


#: Settings of a query with this operator.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
