"""Streams over logs and new days: extensions that give the same rows as the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.sources.tables import replace_days


def daily_usage(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Counts by day and type; days close once the watermark has passed them.

    Users are counted exactly: the state holds the set of users of each open day and type.
    """
    by = events.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w"), "event_type")
    return by.agg(F.count("*").alias("n"), F.size(F.collect_set("user_id")).cast("long").alias("users")).select(F.to_date("w.start").alias("day"), "event_type", "n", "users")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a user: events no further apart than the gap."""
    by = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
    return by.agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def once(feedback: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Feedback that was sent twice counts once."""
    return feedback.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def publish_days(days: DataFrame, path: str, checkpoint: str):
    """Take in new daily files as they are there now; a day that is published again replaces its rows as a whole."""
    return days.writeStream.foreachBatch(lambda batch, _: replace_days(batch, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
