"""Tables that cut a job in two: written to the shared folder once, read by all later steps."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from tidemark.session import shared_folder


def staged(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back.

    Later steps depend on the files alone, so a lost executor never sends them back to the source, and the table is
    gone when the application ends. Shuffle files of the steps behind it are released once nothing refers to them.
    """
    spark = frame.sparkSession
    folder = shared_folder(spark, purpose)
    frame.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    gc.collect()
    spark._jvm.java.lang.System.gc()
    return spark.read.schema(frame.schema).parquet(folder)
