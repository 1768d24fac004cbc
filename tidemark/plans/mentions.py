"""Which names are mentioned most in posts, per five minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import post_time
from tidemark.operators.rows import top
from tidemark.operators.windows import tumbling
from tidemark.operators.words import mentions
from tidemark.sources.messages import POST_SCHEMA, json_columns
from tidemark.streaming.views import Ranking


def posts_of_messages(messages: DataFrame) -> DataFrame:
    """``created_at, id, id_str, text, timestamp`` of JSON posts."""
    return json_columns(messages, POST_SCHEMA).withColumn("timestamp", post_time(F.col("created_at")))


def mention_windows(posts: DataFrame, size: str = "5 minutes", late: str = "10 hours") -> DataFrame:
    """``window_start, window_end, mention, count``, for streams and batches."""
    return tumbling(mentions(posts), "timestamp", size, "mention", late=late, count=F.count(F.lit(1)))


def trending(counts: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent mentions of all windows."""
    return top(counts, k, "count", "mention", "window_start")


def trending_view(counts: DataFrame, folder: str, k: int = 20) -> Ranking:
    """What ranks a stream of ``mention_windows`` in update mode at every trigger."""
    keys = ["window_start", "window_end", "mention"]
    return Ranking(counts.sparkSession, folder, counts.schema, keys, k, "count", "mention", "window_start")
