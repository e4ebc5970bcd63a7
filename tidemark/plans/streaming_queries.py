"""Weekly activity as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.plans.inputs import Inputs
from tidemark.plans.registry import add, rounded
from tidemark.session import scratch_path
from tidemark.streaming import weekly


def closed_weeks(t: Inputs) -> DataFrame:
    """The weeks of the events that the stream's watermark has closed."""
    blocks, state = scratch_path(t.spark, "blocks"), scratch_path(t.spark, "state")
    stream = weekly.weekly_blocks(weekly.event_stream(t.spark, f"{t.folder}/events.parquet"))
    weekly.drain(stream, blocks, state)
    return rounded(weekly.weekly_activity(t.spark.read.parquet(blocks)), 4)


add(
    "weekly_activity_stream", "A24 A26",
    closed_weeks,
    """SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS events, round(sum(value), 4) AS total, count(DISTINCT user_id) AS accounts
        FROM events GROUP BY 1 HAVING CAST(date_trunc('week', ts) AS DATE) + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)""",
)
