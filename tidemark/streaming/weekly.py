"""Weekly activity of an event stream: counts, totals and exact distinct accounts per Monday-aligned week.

Files of events are a streaming source.  State is one row per open week and block of
accounts (a bitmap of 32,768 keys); the watermark closes weeks, hands them to an
append-only table and drops their state, so a stream of any length holds only the weeks
that may still change.  Rows that arrive after their week has closed are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The epoch was a Thursday: the first Monday came four days later.
MONDAY = "4 days"
DELAY = "2 days"


def event_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A file or folder of Parquet events as a stream, with the schema that it has now.

    A streaming source takes a folder or a pattern; the path is made a pattern of itself,
    so that a single file will do.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)).parquet(f"{path[:-1]}[{path[-1]}]")


def weekly_blocks(events: DataFrame, time: str = "ts", key: str = "user_id", value: str = "value", delay: str = DELAY) -> DataFrame:
    """(week, bucket, bits, events, total) per week and block of accounts; works on streams and on tables.

    Events without a time belong to no week; without an account they count as events only.
    Times without a zone are of the session's zone.
    """
    week = F.window(F.col(time), "7 days", "7 days", MONDAY)
    timed = events.withColumn(time, F.col(time).cast("timestamp")).where(F.col(time).isNotNull())
    grouped = timed.withWatermark(time, delay).groupBy(week, F.bitmap_bucket_number(key).alias("bucket"))
    return grouped.agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"),
        F.count(F.lit(1)).alias("events"),
        F.sum(value).alias("total"),
    ).select(F.col("window.start").cast("date").alias("week"), "bucket", "bits", "events", "total")


def drain(blocks: DataFrame, table: str, checkpoint: str) -> None:
    """Run the stream over all files that have arrived; closed weeks are appended to ``table``, the rest stays in state.

    A run goes on where the last one with this checkpoint ended.
    """
    started = blocks.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    started.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def weekly_activity(blocks: DataFrame) -> DataFrame:
    """Events, total and distinct accounts per week, from weekly blocks."""
    return blocks.groupBy("week").agg(
        F.sum("events").alias("events"), F.sum("total").alias("total"), F.sum(F.bitmap_count("bits")).alias("accounts")
    )
