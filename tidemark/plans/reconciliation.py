"""Reconciling keyed events into units: what to report about each unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.messages import ACCOUNT_SCHEMA, json_columns


def events_of_messages(messages: DataFrame) -> DataFrame:
    """``key, value, topic, timestamp, offset`` of broker records, key and value as text."""
    return messages.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "timestamp", "offset",
    )


def accounts_of_messages(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``windowId, counter, account`` of JSON account messages."""
    return json_columns(messages, ACCOUNT_SCHEMA, keep=keep)


def idle_note(key: str) -> Column:
    """Text that goes with a unit grouped by idle time."""
    return F.when(F.col("status") == "completed", "Completed").otherwise(
        F.concat(F.col(key).cast("string"), F.lit(" is timing out"))
    )


def deadline_note() -> Column:
    """Text that goes with a unit grouped by deadline."""
    return F.when(F.col("status") == "completed", "Completed").otherwise("Timed out")


def is_timed_out() -> Column:
    return F.col("status") == "timed_out"


def with_note(units: DataFrame, note: Column) -> DataFrame:
    return units.withColumn("note", note)
