"""Where a stream's results go. Every sink takes the query's own checkpoint folder; it must never be shared."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.levels import Levels


def every(interval: str) -> dict:
    """Trigger of a job that runs for good, e.g. ``every("5 minutes")``."""
    return {"processingTime": interval}


ALL_THERE_IS = {"availableNow": True}


def writer(stream: DataFrame, mode: str, checkpoint: str, trigger: dict | None):
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def to_console(stream: DataFrame, mode: str, checkpoint: str, trigger: dict | None = None,
               rows: int = 20, truncate: bool = False) -> StreamingQuery:
    """Print the first rows of each micro-batch."""
    return (
        writer(stream, mode, checkpoint, trigger)
        .format("console").option("numRows", rows).option("truncate", truncate).start()
    )


def to_table(stream: DataFrame, mode: str, folder: str, checkpoint: str, trigger: dict | None = None,
             keys: Sequence[str] = ()) -> StreamingQuery:
    """Keep results as parquet.

    Append mode uses Spark's file sink. Update mode keeps the latest row per key in runs that are merged level by level,
    complete mode the last micro-batch only (``levels.py``); either is repeated safely after a failure.
    """
    out = writer(stream, mode, checkpoint, trigger)
    if mode == "append":
        return out.format("parquet").option("path", folder).start()
    table = Levels(stream.sparkSession, folder, stream.schema, keys)
    return out.foreachBatch(table.add if mode == "update" else table.replace).start()


def to_branches(stream: DataFrame, mode: str, branches: Mapping[str, Column], folder: str, checkpoint: str,
                trigger: dict | None = None) -> StreamingQuery:
    """Several outputs of one stream: each condition's rows go to ``<folder>/<name>``.

    A micro-batch is kept while its branches are written, so the stream is computed once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, condition in branches.items():
                batch.where(condition).write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return writer(stream, mode, checkpoint, trigger).foreachBatch(write).start()
