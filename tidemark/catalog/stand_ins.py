"""How the standard tables stand in for logs, exam results, posts, views and unit events.

All are projections, so they also work on a stream of the ``events`` table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import table
from tidemark.sources.streams import table_stream
from tidemark.streaming.replay import replay_in_slices


#: Spans of time that a replay of the test tables has at least, so that their streams go through several micro-batches.
SPANS = 4


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Events as a stream; times become instants, since watermarks take no wall-clock type."""
    stream = table_stream(spark, f"{folder}/events.parquet", files_per_trigger=files_per_trigger)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def replayed(spark: SparkSession, folder: str, columns: list[str], build, run, timeless: bool = False):
    """The events, in spans of time, through a streaming job; times become instants, as in ``event_stream``."""

    def instants(rows):
        return build(rows.withColumn("ts", F.col("ts").cast("timestamp")))

    return replay_in_slices(events(spark, folder).select("ts", *columns), "ts", instants, run, least=SPANS, timeless=timeless)


def log(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).select(F.col("event_type").alias("level"), F.col("ts").alias("datetime"))


def exam_results(spark: SparkSession, folder: str) -> DataFrame:
    """Scores are text here, as an untyped CSV has them."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("subject"),
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").cast("string").alias("score"),
        F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "A+").otherwise("B")
        .alias("grade"),
    )


def exam_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Exam results as comma-separated lines with whole-number scores."""
    results = exam_results(spark, folder)
    score = F.floor(F.col("score").cast("double")).cast("string")
    fields = [F.col("id"), F.lit("x"), F.col("subject"), F.col("year"), F.lit("x"), score, F.col("grade")]
    return results.select(F.concat_ws(",", *(field.cast("string") for field in fields)).alias("value"))


def broker_records(rows: DataFrame, value: Column, topic: str = "records") -> DataFrame:
    """Events in the shape of broker records, keyed by user."""
    return rows.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.cast("string").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def view_records(rows: DataFrame) -> DataFrame:
    return broker_records(rows, F.col("event_type"), "viewrecords")


def post_messages(rows: DataFrame) -> DataFrame:
    """JSON posts. A fifth mentions nobody; the others mention a user, in first place or after other words."""
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    text = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("mail a@b about "), kind))
        .when(F.col("event_id") % 2 == 0, F.concat(F.lit("@"), user, F.lit(" did "), kind, F.lit(" with @all")))
        .otherwise(F.concat(kind, F.lit(" by @"), user))
    )
    created = F.date_format(F.col("ts").cast("timestamp"), "EEE MMM dd HH:mm:ss Z yyyy")
    post = F.struct(
        created.alias("created_at"), F.col("event_id").alias("id"),
        F.col("event_id").cast("string").alias("id_str"), text.alias("text"),
    )
    return broker_records(rows, F.to_json(post), "posts")


def account_json() -> Column:
    """An account message as text: the window is the user, the account comes from the event."""
    account = F.struct(
        F.col("event_id").cast("string").alias("accountNumber"),
        F.col("event_type").alias("accountName"), F.col("value").alias("balance"),
    )
    return F.to_json(
        F.struct(F.col("user_id").alias("windowId"), F.col("event_id").alias("counter"), account.alias("account"))
    )


def account_messages(rows: DataFrame) -> DataFrame:
    return broker_records(rows, account_json(), "reconcile")


def wall_clock(df: DataFrame, *names: str) -> DataFrame:
    """Instants as the wall-clock type the tables use."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})
