"""Structured Streaming over a landing folder: each message once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def landing(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def once(events: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Each key once; state is kept for the delay, so it stays bounded."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def ingest(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that has landed, once, as one folder a micro-batch: a batch that is run again replaces its own folder and no other is touched."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{batch_id}")

    return events.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingested(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ingest has kept."""
    return spark.read.schema(schema).parquet(f"{path}/*")


def windowed_counts(events: DataFrame, time: str = "ts", by: str = "event_type", window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Beyond the newsletter's own needs: events by tumbling window and type, with a watermark for late ones."""
    return events.withWatermark(time, delay).groupBy(F.window(time, window), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), by, "n", "total")
