"""Logs as streams: what is an aggregate of a log over time is the same plan on a stream, with a watermark.

The batch functions take any DataFrame; on a streaming one a watermark bounds their state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity(events: DataFrame, time: str = "ts", user: str = "user_id", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """user, start, end, events: stretches of a user's events no more than `gap` apart."""
    own = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late) if events.isStreaming else events
    return own.groupBy(F.session_window(time, gap).alias("w"), F.col(user).alias("user")).agg(F.count(F.lit(1)).alias("events")).select("user", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def latest(events: DataFrame, key: str = "user_id", time: str = "ts", value: str = "event_type") -> DataFrame:
    """The last value of each key: the state of a session log."""
    return events.groupBy(key).agg(F.max(time).alias(time), F.max_by(value, F.struct(time, value)).alias(value))
