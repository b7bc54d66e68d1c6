"""Queries that write, stream and read again: message archives, the two-phase sink, the hand-off of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadleaf.functions import text as X
from broadleaf.plans.catalogue import query, scratch, table
from broadleaf.sources import messages, sink
from broadleaf.streaming import handoff

# -- S10: conversations as message archives ------------------------------------

_SENT = "strftime(TIMESTAMP '2024-01-01' + to_hours(CAST(conv_id % 4096 * 5 + turn AS INTEGER)), '%Y-%m-%dT%H:%M:%S')"
_MAIL = f"m AS (SELECT conv_id * 4096 + turn AS number, {_SENT} AS sent, role || ' <' || role || conv_id || '@mail.example>' AS sender, 'Turn ' || turn || ' of ' || conv_id AS subject, '<' || conv_id || '.' || turn || '@mail.example>' AS message_id, text || CASE WHEN turn % 3 = 0 THEN chr(10) || 'From here on' || chr(10) || '>From there' ELSE chr(10) END AS body FROM conversations)"


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message of each turn; some bodies have lines that look like the marks between messages."""
    c, t = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    sent = F.date_format(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(conv_id % 4096 * 5 + turn as int), 0, 0)"), "yyyy-MM-dd'T'HH:mm:ss")
    body = F.concat("text", F.when(F.col("turn") % 3 == 0, "\nFrom here on\n>From there").otherwise("\n"))
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 4096 + F.col("turn")).alias("number"), sent.alias("sent"), F.concat("role", F.lit(" <"), "role", c, F.lit("@mail.example>")).alias("sender"),
        F.concat(F.lit("Turn "), t, F.lit(" of "), c).alias("subject"), F.concat(F.lit("<"), c, F.lit("."), t, F.lit("@mail.example>")).alias("message_id"), body.alias("body"),
    )


def archived(rows: DataFrame, root: str, n: int) -> int:
    """Writes archives and gives the number of their messages."""
    return messages.write(rows, root, n).agg(F.sum("messages")).first()[0] or 0


_FROM, _TO = "2024-01-03", "2024-01-20T12"


@query(f"WITH {_MAIL} SELECT number, sent, sender, subject, message_id, sha256(body) AS body_sha256 FROM m WHERE sent >= '{_FROM}' AND sent < '{_TO}'")
def q_message_archives(spark, sf_dir):
    """S10 in a batch: some days of archives, read in byte ranges; archives and messages of other days are passed over."""
    root = scratch(spark, "archives")
    archived(mail(spark, sf_dir), root, 8)
    rows = messages.read(spark, root, range_bytes=1 << 16).where(f"sent >= '{_FROM}' AND sent < '{_TO}'")
    return rows.select("number", "sent", "sender", "subject", "message_id", F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"))


@query(f"WITH {_MAIL}, h AS (SELECT (max(number) + 1) // 2 AS half FROM m) SELECT number, sent, body, CASE WHEN number < half THEN 0 ELSE 1 END AS start FROM m, h")
def q_message_stream(spark, sf_dir):
    """S10 as a stream: started on half of the archives, and again on the rest, from the number where it stopped."""
    root = scratch(spark, "archive-stream")
    rows = mail(spark, sf_dir)
    half = (rows.agg(F.max("number")).first()[0] + 1) // 2
    for start, part in enumerate((rows.where(F.col("number") < half), rows.where(F.col("number") >= half))):
        archived(part, f"{root}/archives", 4)

        def keep(df: DataFrame, epoch: int, start: int = start) -> None:
            df.withColumn("start", F.lit(start)).write.mode("overwrite").parquet(f"{root}/read/{epoch}")

        stream = messages.stream(spark, f"{root}/archives", 1 << 18).select("number", "sent", "body")
        stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("number long, sent string, body string, start int").parquet(f"{root}/read/*")


# -- S21: documents as objects -------------------------------------------------

_OBJECT = "'daily/2024/01/' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '/' || sha256(text) || '.webp'"


@query(f"""SELECT DISTINCT {_OBJECT} AS key, CAST(octet_length(encode(text)) AS BIGINT) AS size, sha256(text) AS sha256, 'image/webp' AS media_type, true AS written, false AS written_again FROM documents WHERE text IS NOT NULL""")
def q_object_sink(spark, sf_dir):
    """Every document as an object of a two-phase job; a second job of the same objects writes none."""
    root = scratch(spark, "objects")
    date = F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"))
    objects = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(X.object_key(date, X.content_hash(F.col("text"))).alias("key"), F.col("text").cast("binary").alias("content"))
    first, second = (sink.put(objects, f"{root}/store", f"{root}/result-{k}") for k in (1, 2))
    return first.join(second.select("key", F.col("written").alias("written_again")), "key").select("key", "size", "sha256", "media_type", "written", "written_again")


# -- J11: events as messages that are handed off -------------------------------

_EVENTS = """e AS (SELECT CAST(event_id AS VARCHAR) AS key, user_id AS mailbox, event_id AS i, date_trunc('millisecond', ts) AS noted FROM events),
v AS (SELECT *, noted + to_hours(CAST(greatest(i % 5, i % 3) AS INTEGER)) AS verified, i % 7 <> 0 AS safe, i % 11 <> 0 AS goes FROM e),
g AS (SELECT *, verified + to_hours(CAST(i % 4 * 5 AS INTEGER)) AS gone FROM v),
n AS (SELECT *, unnest([1, 2, 3]) AS attempt FROM g WHERE safe),
a AS (SELECT *, verified + to_hours(CAST((attempt - 1) * 6 AS INTEGER)) AS due FROM n)"""


@query(f"""WITH {_EVENTS} SELECT mailbox, key, CASE WHEN attempt = 1 THEN 'acknowledge' ELSE 'retry' END AS action, attempt, due AS "at" FROM a WHERE attempt = 1 OR NOT goes OR due < gone
UNION ALL SELECT mailbox, key, 'acknowledged', CAST(count(*) AS INTEGER), any_value(gone) FROM a WHERE goes AND (attempt = 1 OR due < gone) GROUP BY mailbox, key
UNION ALL SELECT mailbox, key, 'failed', 3, verified + to_hours(18) FROM g WHERE safe AND NOT goes UNION ALL SELECT mailbox, key, 'unverified', 0, noted + to_hours(72) FROM g WHERE NOT safe""")
def q_handoff(spark, sf_dir):
    """Notices of events' messages, each twice and out of order, in four starts of one query; one end a message."""
    return handed_off(spark, notices(table(spark, sf_dir, "events")), scratch(spark, "handoff"), 4)


def notices(events: DataFrame) -> DataFrame:
    """What becomes known of each event's message, with the time at which it arrives here: hours late, and once more up to ten days later."""
    i = F.col("event_id")
    hours = lambda n: F.make_dt_interval(F.lit(0), n.cast("int"))
    noted = F.date_trunc("millisecond", F.col("ts").cast("timestamp"))
    sha = lambda word: F.sha2(F.concat(F.lit(word), i.cast("string")).cast("binary"), 256)
    verified = noted + hours(F.greatest(i % 5, i % 3))
    none = F.lit(None).cast("string")
    notice = lambda kind, s, n, at, when=F.lit(True): F.when(when, F.struct(F.lit(kind).alias("kind"), s.alias("source_sha256"), n.alias("normalized_sha256"), at.alias("at")))
    some = F.array(
        notice("noted", sha("s"), sha("n"), noted),
        notice("source", F.when(i % 7 == 0, sha("x")).otherwise(sha("s")), none, noted + hours(i % 5)),
        notice("normalized", none, sha("n"), noted + hours(i % 3)),
        notice("gone", none, none, verified + hours(i % 4 * 5), (i % 11 != 0) & (i % 7 != 0)),
    )
    rows = events.select(F.col("user_id").alias("mailbox"), i.cast("string").alias("key"), F.explode(F.filter(some, lambda x: x.isNotNull())).alias("n")).select("mailbox", "key", "n.*")
    late = lambda k, most: F.pmod(F.xxhash64("key", "kind", F.lit(k)), F.lit(most))
    arrivals = F.array(F.col("at") + hours(late(1, 20)), F.col("at") + hours(late(1, 20) + late(2, 240)))
    return rows.withColumn("arrived", F.explode(arrivals))


def handed_off(spark: SparkSession, rows: DataFrame, root: str, starts: int, delay: str = "48 hours") -> DataFrame:
    """Steps of notices fed by arrival to so many starts of one query, and then a notice far ahead, which ends what is under way."""
    low, high, n = rows.agg(F.min("arrived"), F.max("arrived"), F.count("*")).first()
    buckets = max(handoff.LEAST_BUCKETS, -(-n // handoff.BUCKET_NOTICES))
    place = (F.col("arrived").cast("double") - F.lit(low).cast("double")) / (F.lit(high).cast("double") - F.lit(low).cast("double") + 1)
    rows.withColumn("b", F.floor(place * starts).cast("int")).drop("arrived").write.partitionBy("b").parquet(f"{root}/cut")
    last = spark.range(1).select(F.lit(None).cast("long").alias("mailbox"), *(F.lit(None).cast("string").alias(c) for c in ("key", "kind", "source_sha256", "normalized_sha256")), (F.lit(high) + F.expr("interval 400 days")).alias("at"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{root}/fed"))
    before = {k: spark.conf.get(k, None) for k in handoff.SETTINGS}
    try:
        for k, v in handoff.SETTINGS.items():
            spark.conf.set(k, v)
        for b in range(starts + 1):
            if b == starts:
                last.write.parquet(f"{root}/fed/last")
            elif files.exists(path(f"{root}/cut/b={b}")):
                files.rename(path(f"{root}/cut/b={b}"), path(f"{root}/fed/{b}"))

            def keep(df: DataFrame, epoch: int) -> None:
                df.write.mode("overwrite").parquet(f"{root}/steps/{epoch}")

            stream = spark.readStream.schema(handoff.NOTICE).parquet(f"{root}/fed/*")
            handoff.steps(stream, delay, buckets).writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(handoff.STEPS).parquet(f"{root}/steps/*").withColumn("at", F.col("at").cast("timestamp_ntz"))

