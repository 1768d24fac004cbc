"""Stream readers. All return an unbounded DataFrame that takes the same operators as a batch one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Columns every broker record carries.
BROKER_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)


def broker_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                  per_trigger: int | None = None, **options: str) -> DataFrame:
    """Records of a message topic. Read positions live in the query's checkpoint, so nothing is committed by hand.

    Needs Spark's public Kafka connector on the class path. ``per_trigger`` bounds the records of one
    micro-batch and with it the memory that one busy key can claim.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def _file_stream(spark: SparkSession, files_per_trigger: int | None):
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader


def replayed_broker(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Broker-shaped records kept as parquet files, for replays without a broker."""
    return _file_stream(spark, files_per_trigger).schema(BROKER_SCHEMA).parquet(path)


def table_stream(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table, a folder or one file, as a stream of its files."""
    if schema is None:
        schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    # Written as a pattern, the path may be a single file too.
    return _file_stream(spark, files_per_trigger).schema(schema).parquet(f"{folder}/{{{name}}}")


def line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None, arrived: bool = False) -> DataFrame:
    """Text lines of files that arrive in a folder, column ``value``; with ``arrived`` also when their file came."""
    lines = _file_stream(spark, files_per_trigger).text(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("arrived")) if arrived else lines


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a socket. Spark keeps no record of what it read, so lost lines stay lost."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def rate_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """Generated rows ``timestamp, value``."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
